import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import mixing, topk, url_filter


def plain_top(rows, k, is_query):
    fine = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
            if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in fine}:
        if is_query(i):
            scored = sorted((-min(max(sum(a * b for a, b in zip(q, v)), -2 ** 63), 2 ** 63 - 1), j) for j, v in fine if j != i)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return Counter(out)


@pytest.mark.parametrize("seed", [0, 1])
def test_top_k_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(600)]
    rows += [(600 + i, rows[50][1]) for i in range(200)]  # many equal vectors
    rows += [(900, None), (901, [float("nan")] * 8), (902, [None] + [1.0] * 7), (None, [1.0] * 8), (950, [0.5, 0.5]), (950, [0.5, 0.5]), (951, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    got = topk.exact_top_k(df, F.col("vec_id") % 50 == 0, candidate_block=150, query_block=5).collect()
    assert Counter(map(tuple, got)) == plain_top(rows, 5, lambda i: i % 50 == 0)


def test_top_k_edges(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0]), (1, [1e30]), (2, [-1e30])], schema)
    assert Counter(map(tuple, topk.exact_top_k(few, F.lit(True)).collect())) == plain_top(
        [(0, [1.0]), (1, [1e30]), (2, [-1e30])], 5, lambda i: True)
    assert topk.exact_top_k(few.limit(0), F.lit(True)).count() == 0


def plain_verdict(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)] if url and "://" in url else []
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_urls(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
             ("net", "/fr", "block"), ("a.org", "", "block"), ("com", "/", "block"), ("example.com", "/en/", "block")]
    urls = [None, "", "no scheme/x", "http://", "http://com", "HTTP://Www.EXAMPLE.com/en/x?q#f", "https://example.com/en", "x://example.com/en/",
            "http://net/es/1", "http://notnet/es/", "http://a.net/french#x", "http://b.a.org", "http://b.a.org?x", "http://a.org./", "http://u@example.com:80/en/",
            "a://b://example.com/en/", "http://ex\nample.com/en/\n", "http://" + "a." * 5000 + "com/" + "p" * 9000, "http://net/es/1"]
    pages = spark.createDataFrame([(i if i else None, u, "r", "v") for i, u in enumerate(urls)], "page_id long, url string, rule string, verdict string")
    folded = [(h, p, max(v for a, b, v in rules if (a, b) == (h, p))) for h, p, _ in rules]
    got = Counter(map(tuple, url_filter.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()))
    assert got == Counter((i if i else None, *plain_verdict(u, folded)) for i, u in enumerate(urls))
    assert url_filter.judge(pages.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r["verdict"] for r in url_filter.judge(pages, none, default="block").collect()} == {"block"}


def test_mixing_reaches_the_targets(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 3 == 1, "mid")
                                     .when(F.col("id") < 10000, "small").otherwise(None).alias("source"), F.lit("t").alias("copy0"))
    weights = spark.createDataFrame([("big", 1.0), ("mid", 2.0), ("small", 1.0), ("nowhere", 5.0), (None, 0.0)], "source string, weight double")
    out = mixing.replicate(docs, weights)
    shares = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert None not in shares and sum(shares.values()) == pytest.approx(20000, rel=0.03)
    assert shares["mid"] / shares["big"] == pytest.approx(2, rel=0.06) and shares["small"] / shares["big"] == pytest.approx(1, rel=0.06)
    counts = Counter(r["n"] for r in out.filter("source = 'mid'").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect())
    rate, n = shares["mid"] / 6667, 6667  # the counts follow a Poisson distribution
    for k in (1, 2, 3):
        expected = n * math.exp(-rate) * rate ** k / math.factorial(k)
        assert counts[k] == pytest.approx(expected, abs=5 * expected ** 0.5)
    again = mixing.replicate(docs.repartition(7), weights)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, out.collect()))
    keys = [r["shuffle_key"] for r in out.collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_mixing_edges(spark):
    docs = spark.createDataFrame([(1, "t", "a"), (1, "t", "a"), (None, None, "a"), (4, "u", None), (5, "v", "b")], "doc_id long, text string, source string")
    many = mixing.replicate(docs, spark.createDataFrame([("b", 1.0)], "source string, weight double"), total=F.lit(1000))
    assert {r["doc_id"] for r in many.collect()} == {5} and many.count() == pytest.approx(1000, abs=160)
    assert many.select("copy").distinct().count() == many.count()
    assert mixing.replicate(docs, mixing.tempered(docs, 0.5)).count() >= 0
    assert mixing.replicate(docs.limit(0), mixing.tempered(docs.limit(0), 0.5)).count() == 0


def test_mixing_keeps_all_columns_whatever_their_names(spark):
    names = ["copy", "shuffle_key", "_count", "_u", "_i", "_draw", "row", "id", "key", "u", "_source", "_cdf"]
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), *[F.lit(f"own {n}").alias(n) for n in names])
    out = mixing.replicate(docs, spark.createDataFrame([("a", 1.0)], "source string, weight double")).collect()
    assert out and all(r[n] == f"own {n}" for r in out for n in names)
    assert {"_copy", "_shuffle_key"} <= set(out[0].asDict())
    keys = [r["_shuffle_key"] for r in out]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_rows_without_an_id_draw_apart(spark):
    docs = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.col("id").cast("string").alias("text"))
    n = mixing.replicate(docs, spark.createDataFrame([("a", 1.0)], "source string, weight double")).count()
    assert abs(n - 4000) < 6 * math.sqrt(4000)
