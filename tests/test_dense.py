"""Dense embeddings against a full decomposition, and their refresh from the change feed."""

import numpy as np

from mercato.plans import dense
from mercato.plans.serving import product_catalog
from mercato.plans.silver import silver
from mercato.plans.store import Store
from mercato.streaming.feed import changes, current, record, sync

SF001 = "/root/testdata/sf0.001"


def _matrix(model):
    rows = model.table("postings").toPandas()
    docs, terms = sorted(rows.iloc[:, 0].unique()), sorted(rows["term"].unique())
    a = np.zeros((len(docs), len(terms)))
    for doc, term, w in rows.itertuples(index=False):
        a[docs.index(doc), terms.index(term)] = w
    return a, docs, terms


def test_subspace_equals_a_full_decomposition(spark, tmp_path):
    texts = product_catalog(silver(spark, SF001).dim_part)
    model = dense.fit(texts, "product_id", str(tmp_path / "m"), size=8, passes=6)
    a, docs, terms = _matrix(model)
    assert np.allclose((a ** 2).sum(axis=1), 1)
    _, s, vt = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(model.strengths[:6], s[:6] ** 2, rtol=0.02)
    v = model.table("terms").toPandas().set_index("term").loc[terms].to_numpy()
    assert np.allclose(v.T @ v, np.eye(8), atol=1e-6)
    # what the directions keep is close to the most that eight directions can keep
    assert np.linalg.norm(a @ v) ** 2 > 0.985 * (s[:8] ** 2).sum()
    got = {r.product_id: np.array(r.embedding) for r in dense.embed(model, texts, "product_id").collect()}
    want = a @ v
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    assert all(np.allclose(got[d], want[i], atol=1e-6) for i, d in enumerate(docs))


def test_words_never_seen_together_match(spark, tmp_path):
    texts = [("a", "boat sea"), ("b", "sea ship"), ("c", "boat harbour"), ("d", "harbour ship"), ("e", "wheat field"),
             ("f", "field barley"), ("g", "wheat farm"), ("h", "farm barley"), ("x", "boat"), ("y", "ship"), ("z", "barley")]
    df = spark.createDataFrame(texts, "k string, t string")
    model = dense.fit(df, "k", str(tmp_path / "m"), "t", size=2, passes=8)
    v = {r.k: np.array(r.embedding) for r in dense.embed(model, df, "k", "t").collect()}
    assert v["x"] @ v["y"] > 0.95 and abs(v["x"] @ v["z"]) < 0.3


def test_edges(spark, tmp_path):
    df = spark.createDataFrame([(1, "one two"), (2, "one two"), (3, None), (4, ""), (5, "?!")], "k long, t string")
    model = dense.fit(df, "k", str(tmp_path / "m"), "t", size=4)
    assert model.size == 1  # one independent text
    got = {r.k: r.embedding for r in dense.embed(model, df, "k", "t").collect()}
    assert got[1] == got[2] and abs(abs(got[1][0]) - 1) < 1e-9 and got[3] is got[4] is got[5] is None
    unknown = spark.createDataFrame([(9, "never seen")], "k long, t string")
    assert dense.embed(model, unknown, "k", "t").first().embedding is None
    none = dense.fit(df.limit(0), "k", str(tmp_path / "e"), "t")
    assert none.size == 0 and dense.embed(none, df, "k", "t").where("embedding is not null").count() == 0


def test_embeddings_follow_the_feed(spark, tmp_path):
    schema = "k long, t string"
    first = spark.createDataFrame([(1, "red apple"), (2, "green pear"), (3, "red pear"), (4, "green apple")], schema)
    second = spark.createDataFrame([(1, "red apple"), (2, "red apple"), (4, "green apple"), (5, "green pear")], schema)
    model = dense.fit(first, "k", str(tmp_path / "m"), "t", size=3)
    feed, out = str(tmp_path / "texts"), str(tmp_path / "vectors")
    store, check = Store(spark, str(tmp_path / "copy")), str(tmp_path / "check")
    none = first.limit(0)
    for version, (old, new) in enumerate([(none, first), (first, second)], 1):
        record(old, new, ["k"], feed, version)
    rows = changes(spark, feed, first.schema, ["k"])
    assert rows.count() == 4 + 3
    made = dense.embedding_changes(model, rows, "k", "t")
    assert made.count() == 7
    made.write.parquet(out + "/v1")
    sync(spark, out, store, dense.embed(model, first, "k", "t").schema, ["k"], check, buckets=4)
    got = {r.k: r.embedding for r in current(store).collect()}
    want = {r.k: r.embedding for r in dense.embed(model, second, "k", "t").collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)
