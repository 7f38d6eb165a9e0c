import corpus_pipeline
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    folder = tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        out.append((docs, spark.read.parquet(f"{folder}/{name}")))
        docs = out[-1][1]
    return out


def test_stages_keep_columns_and_drop_only_what_they_judge(results):
    (raw, spoken), (_, good), (_, distinct), (_, mixed), (_, packed) = results
    for before, after in results[:4]:
        assert after.columns == before.columns and after.join(before, "doc_id", "left_anti").count() == 0
    assert raw.join(spoken, "doc_id", "left_anti").filter(F.col("text").rlike("[A-Za-z]{3}")).count() == 0
    assert 0 < good.count() < spoken.count() and 0 < distinct.count() < good.count()
    assert distinct.count() == distinct.select("doc_id").distinct().count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
    assert packed.filter("piece = 0").count() == mixed.count()


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_language_stage_keeps_every_text_with_letters(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    kept = corpus_pipeline.keep_languages(spark, docs, f"/root/testdata/{size}").select("doc_id")
    lost = [r["text"] for r in docs.join(kept, "doc_id", "left_anti").collect()]
    assert not [t for t in lost if any(map(str.isalpha, t or ""))]


def test_run_on_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_languages_of_the_first_stage_decide_the_mixture(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.col("lang")))  # unknown where nothing is learned
    spoken = corpus_pipeline.keep_languages(spark, wrong, SF).cache()
    given = spoken.join(docs.select("doc_id", F.col("lang").alias("right")), "doc_id")
    assert spoken.filter("lang IS NULL").count() == 0
    assert given.filter("lang = right").count() >= 0.95 * given.count()
    # the same documents with and without what the stage found
    unjudged = wrong.join(spoken.select("doc_id"), "doc_id", "left_semi").select(*spoken.columns)
    counts = [{r.doc_id: r["count"] for r in corpus_pipeline.mix_sources(spark, d, SF).groupBy("doc_id").count().collect()} for d in (spoken, unjudged)]
    assert counts[0] != counts[1]


def test_tempered_within_keeps_the_shares_of_sources(spark):
    from mercato.llm import mixing
    rows = [("a", "x")] * 90 + [("a", "y")] * 10 + [("b", None)] * 25 + [(None, "x")] * 4
    docs = spark.createDataFrame(rows, "source string, lang string")
    got = {(r.source, r.lang): r.weight for r in mixing.tempered_within(docs, 0.5, "lang").collect()}
    assert got[("b", None)] == pytest.approx(5) and got[(None, "x")] == pytest.approx(2)
    assert got[("a", "x")] + got[("a", "y")] == pytest.approx(10) and got[("a", "x")] / got[("a", "y")] == pytest.approx(3)
