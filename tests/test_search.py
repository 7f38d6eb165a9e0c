"""Search operators against brute force on small fixtures."""

import math
import re
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from mercato.plans.search import passage_topk, similar_vectors
from mercato.plans import textindex
from mercato.plans.silver import silver
from mercato.plans.search import product_index, type_and_brand_queries
from mercato.plans.serving import product_catalog
from mercato.sources.tables import read

TOKEN = re.compile(r"[^\W_]+", re.UNICODE)


def plain_passages(docs, queries, k=5):
    rows = []
    for doc_id, text in docs[["doc_id", "text"]].itertuples(index=False):
        for i, line in enumerate(text.split("\n")):
            if line.strip():
                rows.append((int(doc_id), i, [t for t in TOKEN.findall(line.lower())]))
    n = len(rows)
    df = Counter(t for _, _, ts in rows for t in set(ts))
    idf = {t: math.floor(1000 * (math.log((n + 1) / (c + 1)) + 1) + 0.5) for t, c in df.items()}

    def vec(ts):
        c = Counter(ts)
        v = {t: c[t] * idf[t] for t in c if t in idf}
        nrm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / nrm for t, x in v.items()} if nrm else {}
    pv = [(d, ln, vec(ts)) for d, ln, ts in rows]
    out = []
    for qid, text in queries[["query_id", "text"]].itertuples(index=False):
        qv = vec(TOKEN.findall(text.lower()))
        scored = []
        for d, ln, v in pv:
            s = sum(v.get(t, 0.0) * x for t, x in qv.items())
            if s > 0:
                scored.append((-round(s, 12), d, ln, s))
        scored.sort()
        for r, (_, d, ln, s) in enumerate(scored[:k], 1):
            out.append((int(qid), d, ln, s, r))
    return pd.DataFrame(out, columns=["query_id", "doc_id", "line_no", "score", "rank"])


def test_passage_topk_matches_bruteforce(spark):
    docs = read(spark, SF001, "documents").orderBy("doc_id").limit(60)
    queries = read(spark, SF001, "benchmark").select(F.col("item_id").alias("query_id"), "text").limit(5)
    ours = passage_topk(docs, queries, k=5).toPandas().sort_values(["query_id", "rank"]).reset_index(drop=True)
    ref = plain_passages(docs.toPandas(), queries.toPandas(), k=5)
    ref = ref.sort_values(["query_id", "rank"]).reset_index(drop=True)
    assert list(ours["query_id"]) == list(ref["query_id"])
    assert list(zip(ours["doc_id"], ours["line_no"])) == list(zip(ref["doc_id"], ref["line_no"]))
    assert ours["score"].tolist() == pytest.approx(ref["score"].round(6).tolist(), abs=1e-6)


def test_similar_vectors_bruteforce(spark):
    import numpy as np
    emb = read(spark, SF001, "embeddings")
    ours = similar_vectors(emb, k=3).toPandas()
    pdf = emb.toPandas()
    vecs = np.stack(pdf["embedding"].map(lambda v: np.asarray(v, dtype=float)))
    ids = pdf["vec_id"].to_numpy()
    for label, g in pdf.groupby("label"):
        q = int(g["vec_id"].min())
        qv = vecs[list(ids).index(q)]
        sims = vecs @ qv / (np.linalg.norm(vecs, axis=1) * np.linalg.norm(qv))
        order = [i for i in np.lexsort((ids, -sims)) if ids[i] != q][:3]
        got = ours[ours.query_id == q].sort_values("rank")
        assert list(got["match_id"]) == [int(ids[i]) for i in order]


def test_exact_topk_ties_nulls_and_zero_vectors(spark):
    from mercato.plans.search import exact_topk
    rows = [(i, [1.0, 2.0]) for i in range(100, 0, -1)] + [(0, [1.0, 2.0]), (200, None), (201, [0.0, 0.0])]
    emb = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    queries = emb.where("vec_id = 0").selectExpr("vec_id AS qid", "embedding AS qvec")
    assert [r["match_id"] for r in exact_topk(emb, queries, 3).orderBy("rank").collect()] == [1, 2, 3]


def test_any_number_of_queries(spark):
    from mercato.plans.search import exact_topk
    import numpy as np
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(1500)]
    emb = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = exact_topk(emb, emb.selectExpr("vec_id AS qid", "embedding AS qvec"), 2, block=400).toPandas()
    m = np.array([v for _, v in rows])
    m /= np.linalg.norm(m, axis=1)[:, None]
    sims = np.round(m @ m.T, 12)
    np.fill_diagonal(sims, -9)
    assert len(got) == 3000
    assert {(q, r): i for q, i, r in zip(got.query_id, got.match_id, got["rank"])} == \
        {(q, r + 1): int(i) for q in range(1500) for r, i in enumerate(np.argsort(-sims[q], kind="stable")[:2])}


def test_product_lookup_skips_blocks_and_loses_nothing(spark, tmp_path):
    catalog = product_catalog(silver(spark, SF001).dim_part)
    asks = type_and_brand_queries(catalog)
    index = product_index(catalog, str(tmp_path / "i"), block_rows=16)
    top, report = textindex.search(index, asks, 3, str(tmp_path / "s"), probe=2)
    got = {(r.query_id, r["rank"]): (r.product_id, round(r.score, 9)) for r in top.collect()}
    whole, _ = textindex.search(product_index(catalog, str(tmp_path / "j"), block_rows=1 << 20), asks, 3, str(tmp_path / "t"))
    assert got == {(r.query_id, r["rank"]): (r.product_id, round(r.score, 9)) for r in whole.collect()}
    blocks, scored = report.agg(F.sum("blocks"), F.sum("scored")).first()
    assert scored < 0.7 * blocks


def test_text_index_edges(spark, tmp_path):
    rows = [(1, "red red box", "x"), (1, "RED box!", "x"), (2, None, "x"), (3, "", "x"), (4, "...", "x"), (None, "box", "x")]
    texts = spark.createDataFrame(rows, "id long, text string, term string")
    index = textindex.build(texts, ["id"], str(tmp_path / "i"), block_rows=2)
    asks = spark.createDataFrame([("a", "box"), ("b", "unknown"), ("c", None), ("d", "red red box")], "query_id string, text string")
    got = [tuple(r)[:2] for r in textindex.search(index, asks, 2, str(tmp_path / "s"), probe=1)[0].orderBy("query_id", "rank").collect()]
    assert got == [("a", None), ("a", 1), ("d", 1), ("d", 1)]
    empty = textindex.build(texts.limit(0), ["id"], str(tmp_path / "e"))
    assert textindex.search(empty, asks, 2, str(tmp_path / "u"))[0].count() == 0


def test_terms_are_counted_without_making_vectors_dense(spark):
    from pyspark.ml.linalg import SparseVector, Vectors

    from mercato.plans.search import nonzero_terms
    width = 1 << 30  # dense, 8 GB a vector
    rows = [(1, SparseVector(width, {3: 0.5, 70: 0.0, width - 1: 2.0})), (2, SparseVector(width, {})), (3, Vectors.dense([0.0, 1.0]))]
    counts = spark.createDataFrame(rows, ["id", "embedding"]).select("id", nonzero_terms("embedding").alias("n")).collect()
    assert {r.id: r.n for r in counts} == {1: 2, 2: 0, 3: 1}


def test_scores_leave_a_piece_as_its_best_rows_only(spark, tmp_path):
    """Every row has the query's word: (query, row) pairs are not shuffled, each piece hands on its best."""
    rows = [(i, "common " + " ".join(["word"] * (i % 7)) + f" w{i}") for i in range(2000)]
    texts = spark.createDataFrame(rows, "id long, text string").coalesce(2)
    index = textindex.build(texts, ["id"], str(tmp_path / "i"), block_rows=16)
    asks = spark.createDataFrame([("a", "word"), ("b", "common")], "query_id string, text string")
    weights = textindex.weigh(index, asks)
    cells = index.table("maxima").join(weights, "term").select("query_id", "block").distinct()
    plan = textindex._scores(index, cells, weights, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "sum(" not in plan.split("FlatMapCoGroupsInArrow")[0]
    top, _ = textindex.search(index, asks, 3, str(tmp_path / "s"))
    got = {(r.query_id, r["rank"]): r.id for r in top.collect()}
    assert [got["a", r] for r in (1, 2, 3)] == [6, 13, 20] and len(got) == 6
