"""distributed_ntile / global_rank / exact_percentiles against Spark built-ins."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.operators.ranking import distributed_ntile, exact_percentiles, global_rank, ntiles, total_percentiles


def _data(spark, n, distinct):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 7919 % distinct).alias("v"),
                                 F.when(F.col("id") % 97 == 0, None).otherwise(F.col("id") % 13).alias("nv"))


@pytest.mark.parametrize("n,tiles", [(3, 5), (1003, 4), (1499, 5), (1500, 7)])
@pytest.mark.parametrize("asc", [True, False])
def test_ntile_matches_builtin(spark, n, tiles, asc):
    df = _data(spark, n, 22)
    ours = distributed_ntile(df, tiles, [("v", asc), ("k", True)], "t", rows_per_bucket=100)
    w = Window.orderBy(F.col("v").asc() if asc else F.col("v").desc(), "k")
    ref = df.withColumn("t", F.ntile(tiles).over(w))
    assert sorted(ours.select("k", "t").collect()) == sorted(ref.select("k", "t").collect())


def test_ntile_with_nulls(spark):
    df = _data(spark, 777, 5)
    ours = distributed_ntile(df, 5, [("nv", False), ("k", True)], "t", rows_per_bucket=50)
    ref = df.withColumn("t", F.ntile(5).over(Window.orderBy(F.col("nv").desc_nulls_last(), "k")))
    assert sorted(ours.select("k", "t").collect()) == sorted(ref.select("k", "t").collect())


def test_rank_is_a_permutation_and_buckets_are_bounded(spark):
    df = _data(spark, 5000, 3)  # a hot value holds a third of the rows
    ranked, n = global_rank(df, [("v", True), ("k", True)], "r", rows_per_bucket=500)
    rows = ranked.select("k", "v", "r").collect()
    assert n == 5000 and sorted(r.r for r in rows) == list(range(1, 5001))
    by_rank = [r for r in sorted(rows, key=lambda r: r.r)]
    assert by_rank == sorted(rows, key=lambda r: (r.v, r.k))


def test_percentiles_match_builtin(spark):
    df = _data(spark, 2000, 1000).withColumn("g", F.col("k") % 3)
    ours = exact_percentiles(df, "v", {"p50": 0.5, "p90": 0.9}, group_cols=["g"], key="k",
                             rows_per_bucket=200)
    ref = df.groupBy("g").agg(F.percentile("v", 0.5).alias("p50"), F.percentile("v", 0.9).alias("p90"))
    a = {r.g: (r.p50, r.p90) for r in ours.collect()}
    b = {r.g: (r.p50, r.p90) for r in ref.collect()}
    assert a.keys() == b.keys()
    for g in a:
        assert a[g] == pytest.approx(b[g], rel=1e-12)


def test_several_orders_are_searched_together(spark):
    df = _data(spark, 4001, 3).withColumn("s", F.concat(F.lit("n"), F.col("nv")))
    orders = {"a": [("v", False), ("k", True)], "b": [("nv", True), ("k", True)], "c": [("s", True), ("k", True)]}
    got = ntiles(df, 6, orders, rows_per_bucket=40)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan  # a tile is an expression over the stored row
    want = df.withColumn("a", F.ntile(6).over(Window.orderBy(F.desc("v"), "k"))) \
        .withColumn("b", F.ntile(6).over(Window.orderBy("nv", "k"))).withColumn("c", F.ntile(6).over(Window.orderBy("s", "k")))
    assert sorted(got.select("k", "a", "b", "c").collect()) == sorted(want.select("k", "a", "b", "c").collect())


def test_narrowing_takes_several_rounds(spark):
    from mercato.operators import ranking
    df = _data(spark, 60_000, 7)
    got = ntiles(df, 3, {"t": [("v", True), ("k", True)]}, rows_per_bucket=3)
    want = df.withColumn("t", F.ntile(3).over(Window.orderBy("v", "k")))
    assert got.groupBy("t").agg(F.sum("k"), F.count("k")).sort("t").collect() == \
        want.groupBy("t").agg(F.sum("k"), F.count("k")).sort("t").collect()
    assert ranking.SAMPLE_PER_BOUNDARY < 60_000


def test_repeated_keys_are_refused(spark):
    with pytest.raises(ValueError, match="unique"):
        ntiles(spark.range(300).select(F.lit(1).alias("v")), 4, {"t": [("v", True)]}, rows_per_bucket=10)


@pytest.mark.parametrize("n", [0, 1, 2, 1777])
def test_total_percentiles(spark, n):
    df = _data(spark, n, 50)
    got = total_percentiles(df, {"a": ("v", 0.75), "b": ("nv", 0.25), "c": ("v", 1.0)}, "k", rows_per_bucket=20)
    want = df.agg(F.percentile("v", 0.75), F.percentile("nv", 0.25), F.percentile("v", 1.0)).first()
    assert list(got.values()) == [pytest.approx(w) if w is not None else None for w in want]


def test_empty_and_few_rows_by_ranges(spark):
    empty, n = global_rank(spark.range(0), [("id", True)], "r", min_buckets=4)
    assert (empty.count(), n) == (0, 0)
    few, _ = global_rank(spark.range(3), [("id", False)], "r", min_buckets=8)
    assert sorted((r.id, r.r) for r in few.collect()) == [(0, 3), (1, 2), (2, 1)]
