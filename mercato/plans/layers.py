"""Layer writer and the bronze → silver → gold refresh job.

* ``write_layer``: overwrite a table as Parquet, laid out for pruning: in ranges of a
  space-filling curve over the clustering columns (``plans/clustering``), so file
  statistics skip data for a filter on any of them; facts joined on ``order_key`` are
  *bucketed* by it, one file a bucket, so gold's lineitem ⋈ orders join runs without a
  shuffle.  Every table is registered in a database of its warehouse's own, with its
  comment.
* ``refresh``: every stage reads the previous stage back from storage (the
  storage layer is the stage boundary, lineage is cut and a lost executor only
  re-runs the current stage); a run log records what was written.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators.joins import plan_stats
from mercato.plans import gold as G
from mercato.plans.clustering import cluster
from mercato.plans.silver import (dim_customer, dim_date, dim_geography, dim_part, dim_supplier,
                                  fact_lineitem, fact_orders)
from mercato.sources import tables as src

TARGET_FILE_BYTES = 256 * 1024 * 1024
BRONZE_TABLES = ["region", "nation", "supplier", "part", "partsupp", "customer", "orders", "lineitem"]
# columns that filters name, per table
BRONZE_CLUSTER = {"supplier": ["s_nationkey"], "part": ["p_brand", "p_type"],
                  "partsupp": ["ps_partkey", "ps_suppkey"], "customer": ["c_nationkey", "c_mktsegment"],
                  "orders": ["o_orderdate", "o_custkey"], "lineitem": ["l_shipdate", "l_orderkey"]}
SILVER_CLUSTER = {"dim_customer": ["market_segment", "region_name"], "dim_supplier": ["region_name"],
                  "dim_part": ["brand", "part_type"]}
SILVER_BUCKET = {"fact_orders": "order_key", "fact_lineitem": "order_key"}
GOLD_CLUSTER = {"daily_sales": ["sale_date", "region"], "monthly_sales": ["year_month", "region"],
                "customer_rfm": ["rfm_segment", "customer_region"], "product_performance": ["brand"],
                "supplier_scorecard": ["supplier_region"]}


# what spreads rows of equal clustering values; other tables by a hash of the row
CLUSTER_KEY = {"supplier": ["s_suppkey"], "part": ["p_partkey"], "customer": ["c_custkey"], "orders": ["o_orderkey"],
               "dim_customer": ["customer_key"], "dim_supplier": ["supplier_key"], "dim_part": ["part_key"],
               "customer_rfm": ["customer_key"], "supplier_scorecard": ["supplier_key"]}


def _n_files(df: DataFrame) -> int:
    """Files of about ``TARGET_FILE_BYTES`` by the optimizer's estimate, without a ceiling."""
    return max(1, -(-plan_stats(df)[1] // TARGET_FILE_BYTES))


def table_path(base: str, layer: str, name: str) -> str:
    return os.path.join(base, layer, name)


def database(base: str, layer: str) -> str:
    """The layer's database: one for each warehouse."""
    return f"{layer}_{hashlib.md5(base.rstrip('/').encode()).hexdigest()[:12]}"


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _describe(spark: SparkSession, table: str, comment: str | None) -> None:
    if comment:
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {table} IS '{text}'")


def write_layer(df: DataFrame, base: str, layer: str, name: str, cluster_by: list[str] | None = None,
                bucket_by: str | None = None, buckets: int | None = None, comment: str | None = None,
                stored: bool = False) -> str:
    """Overwrite ``<base>/<layer>/<name>`` (Parquet), register it in the layer's database and return its path.

    bucket_by: dealt by the key first, so each bucket is one file, and written as a
    bucketed table; joins on the bucket key skip the shuffle.
    cluster_by: cutting the ranges reads the rows more than once, so they are written to
    a staging folder first unless they are ``stored`` already (plain reads of files).
    Files come from the session's shuffle partitions, put together by measured size; a
    table estimated larger than that many files of ``TARGET_FILE_BYTES`` gets as many
    ranges as it needs.
    """
    spark = df.sparkSession
    path, db = table_path(base, layer, name), database(base, layer)
    table = f"{db}.{name}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    if bucket_by:
        n = buckets or _n_files(df)
        (df.repartition(n, bucket_by).write.mode("overwrite").bucketBy(n, bucket_by).sortBy(bucket_by)
         .option("path", path).format("parquet").saveAsTable(table))
        _describe(spark, table, comment)
        return path
    staging = None
    if cluster_by:
        if not stored:
            staging = os.path.join(base, "_staging", uuid.uuid4().hex)
            df.write.parquet(staging)
            df = spark.read.parquet(staging)
        n = _n_files(df)
        wide = n > int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = cluster(df, cluster_by, CLUSTER_KEY.get(name), n if wide else None)
    df.write.mode("overwrite").parquet(path)
    if staging:
        _delete(spark, staging)
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # the entry; the files stay
    spark.catalog.createTable(table, path=path, source="parquet")
    _describe(spark, table, comment)
    return path


def read_layer(spark: SparkSession, base: str, layer: str, name: str) -> DataFrame:
    """The warehouse's bucketed table where the catalog knows it, else the files."""
    table = f"{database(base, layer)}.{name}"
    if name in SILVER_BUCKET and layer == "silver" and spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.read.parquet(table_path(base, layer, name))


def bronze(df: DataFrame, source_table: str, batch_id: str) -> DataFrame:
    """Stamp the three audit columns."""
    return df.withColumns({"_ingested_at": F.current_timestamp(),
                           "_source_table": F.lit(source_table),
                           "_batch_id": F.lit(batch_id)})


def _log(spark, base, batch_id, layer, name, started):
    row = [(batch_id, layer, name, started, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))]
    (spark.createDataFrame(row, "batch_id string, layer string, table_name string, started timestamp, "
                                "finished timestamp")
     .write.mode("append").parquet(os.path.join(base, "_run_log")))


def history(spark: SparkSession, base: str) -> DataFrame:
    """The append-only run log (what ``DESCRIBE HISTORY`` showed)."""
    return spark.read.parquet(os.path.join(base, "_run_log"))


def detail(spark: SparkSession, path: str) -> DataFrame:
    """File count and bytes of a stored table (what ``DESCRIBE DETAIL`` showed)."""
    df = spark.read.parquet(path)
    files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).distinct()
    return files.agg(F.lit(path).alias("location"), F.count(F.lit(1)).alias("num_files"),
                     F.sum("s").alias("size_in_bytes"))


def refresh(spark: SparkSession, src_dir: str, base: str, batch_id: str | None = None,
            variant: str = G.NOTEBOOK, layers=("bronze", "silver", "gold")) -> dict[str, str]:
    """Run the layered job; returns {layer.table: path}."""
    batch_id = batch_id or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    out: dict[str, str] = {}

    def put(layer, name, df, **kw):
        t0 = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        out[f"{layer}.{name}"] = write_layer(df, base, layer, name, **kw)
        _log(spark, base, batch_id, layer, name, t0)

    if "bronze" in layers:
        for t in BRONZE_TABLES:
            put("bronze", t, bronze(src.raw(spark, src_dir, t), t, batch_id), cluster_by=BRONZE_CLUSTER.get(t),
                stored=t != "partsupp")
    b = lambda t: read_layer(spark, base, "bronze", t).drop("_ingested_at", "_source_table", "_batch_id")
    if "silver" in layers:
        put("silver", "dim_geography", dim_geography(b("region"), b("nation")))
        geo = read_layer(spark, base, "silver", "dim_geography")
        put("silver", "dim_customer", dim_customer(b("customer"), geo), cluster_by=SILVER_CLUSTER["dim_customer"])
        put("silver", "dim_supplier", dim_supplier(b("supplier"), geo), cluster_by=SILVER_CLUSTER["dim_supplier"])
        put("silver", "dim_part", dim_part(b("part")), cluster_by=SILVER_CLUSTER["dim_part"])
        put("silver", "dim_date", dim_date(spark, dates=b("orders").select("o_orderdate")))
        s = lambda t: read_layer(spark, base, "silver", t)
        put("silver", "fact_orders", fact_orders(b("orders"), s("dim_customer")), bucket_by="order_key")
        put("silver", "fact_lineitem", fact_lineitem(b("lineitem"), b("partsupp"), s("dim_part"),
                                                     s("dim_supplier")), bucket_by="order_key",
            buckets=_buckets_of(spark, f"{database(base, 'silver')}.fact_orders"))
    if "gold" in layers:
        s = lambda t: read_layer(spark, base, "silver", t)
        li, od = s("fact_lineitem"), s("fact_orders")
        put("gold", "daily_sales", G.daily_sales(li, od, variant), cluster_by=GOLD_CLUSTER["daily_sales"])
        daily = read_layer(spark, base, "gold", "daily_sales")
        put("gold", "monthly_sales", G.monthly_sales(daily, variant, s("dim_date")),
            cluster_by=GOLD_CLUSTER["monthly_sales"])
        put("gold", "customer_rfm", G.customer_rfm(od, variant), cluster_by=GOLD_CLUSTER["customer_rfm"])
        put("gold", "product_performance", G.product_performance(li, variant),
            cluster_by=GOLD_CLUSTER["product_performance"])
        put("gold", "supplier_scorecard", G.supplier_scorecard(li, variant),
            cluster_by=GOLD_CLUSTER["supplier_scorecard"])
        put("gold", "shipping_analysis", G.shipping_analysis(li, od, variant))
        put("gold", "executive_summary", G.executive_summary(od, variant))
    return out


def _buckets_of(spark, table):
    """Bucket count of an existing table, so both facts share one layout."""
    try:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
        for r in rows:
            if r[0] == "Num Buckets":
                return int(r[1])
    except Exception:
        pass
    return None
