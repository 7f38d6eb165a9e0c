"""Layout of clustered and bucketed tables."""

import os

import pytest
from pyspark.sql import functions as F

from mercato.plans.clustering import cluster, interleave, rank_code
from mercato.plans.layers import database, write_layer


def _ranges(spark, path, column):
    rows = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min(column).alias("a"), F.max(column).alias("b"))
    return [(r.a, r.b) for r in rows.collect()]


def test_curve_interleaves_bits(spark):
    rows = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a long, b long")
    got = rows.select("a", "b", interleave([F.col("a"), F.col("b")], 2).alias("z")).collect()
    for r in got:
        want = (r.a >> 1 & 1) << 3 | (r.b >> 1 & 1) << 2 | (r.a & 1) << 1 | r.b & 1
        assert r.z == want


def test_rank_codes_are_stretched_and_monotone(spark):
    rows = spark.createDataFrame([(None,), ("a",), ("b",), ("c",)], "v string")
    got = [r[0] for r in rows.select(rank_code("v", ["b", "c"], 4)).collect()]
    assert got == [0, 5, 10, 15]


def test_each_clustering_column_prunes_alone(spark, tmp_path):
    rows = spark.range(20_000).select("id", (F.hash("id", F.lit(1)) % 1000).alias("a"),
                                      F.concat(F.lit("v"), F.pmod(F.hash("id", F.lit(2)), F.lit(50))).alias("b"))
    path = str(tmp_path / "t")
    cluster(rows, ["a", "b"], ["id"], files=64).write.parquet(path)
    assert sorted(spark.read.parquet(path).collect()) == sorted(rows.collect())
    for column, value in (("a", 17), ("b", "v7")):
        ranges = _ranges(spark, path, column)
        assert len(ranges) == 64
        assert sum(a <= value <= b for a, b in ranges) <= 24


@pytest.mark.parametrize("value", ["x", None])
def test_one_value_still_gives_many_files(spark, tmp_path, value):
    rows = spark.range(5_000).withColumn("c", F.lit(value).cast("string"))
    cluster(rows, ["c"], ["id"], files=10).write.parquet(str(tmp_path / "t"))
    ids = _ranges(spark, str(tmp_path / "t"), "id")
    assert len(ids) == 10 and max(b - a for a, b in ids) < 1000
    cluster(rows, ["c"], files=10).write.parquet(str(tmp_path / "u"))
    assert len(_ranges(spark, str(tmp_path / "u"), "id")) == 10


def test_empty_table(spark, tmp_path):
    path = write_layer(spark.range(0).withColumn("c", F.lit("x")), str(tmp_path), "gold", "t", cluster_by=["c"])
    assert spark.read.parquet(path).count() == 0


def test_a_bucket_is_one_file_and_comments_stay(spark, tmp_path):
    rows = spark.range(0, 10_000, numPartitions=8).withColumnRenamed("id", "order_key")
    path = write_layer(rows, str(tmp_path), "silver", "fact_orders", bucket_by="order_key", buckets=4, comment="the fact's orders")
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 4
    write_layer(rows, str(tmp_path), "silver", "plain", cluster_by=["order_key"], comment="it's plain")
    db = database(str(tmp_path), "silver")
    for table, text in (("fact_orders", "the fact's orders"), ("plain", "it's plain")):
        assert spark.catalog.getTable(f"{db}.{table}").description == text
        assert spark.table(f"{db}.{table}").count() == 10_000
    assert not os.listdir(tmp_path / "_staging")
    spark.sql(f"DROP DATABASE {db} CASCADE")
