"""Serving layer: keyed online tables, JDBC sink, snapshot diff, feature lookup.

The reference pulled whole tables to the driver and inserted rows from one
connection; here every partition writes its own JDBC batches from the
executors (``DataFrame.write.jdbc``), so the sink scales with the cluster.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.operators.quality import assert_key

# Typed target DDL for the three serving tables (column types of the target database).
DDL = {
    "customer_rfm_online": ("customer_key BIGINT, market_segment VARCHAR(20), customer_nation VARCHAR(30), "
                            "customer_region VARCHAR(30), recency_days INTEGER, frequency BIGINT, "
                            "lifetime_value DOUBLE, avg_order_value DOUBLE, rfm_score INTEGER, "
                            "rfm_segment VARCHAR(30), customer_lifetime_days INTEGER"),
    "product_perf_online": ("product_id VARCHAR(200), brand VARCHAR(20), part_type VARCHAR(50), "
                            "manufacturer VARCHAR(30), price_band VARCHAR(20), net_revenue DOUBLE, "
                            "total_profit DOUBLE, profit_margin_pct DOUBLE, total_quantity_sold DOUBLE, "
                            "return_rate_pct DOUBLE, avg_discount DOUBLE"),
    "supplier_score_online": ("supplier_key BIGINT, supplier_name VARCHAR(50), supplier_nation VARCHAR(30), "
                              "supplier_region VARCHAR(30), net_revenue DOUBLE, total_profit DOUBLE, "
                              "profit_margin_pct DOUBLE, on_time_delivery_pct DOUBLE, "
                              "avg_delivery_delay_days DOUBLE, return_rate_pct DOUBLE, total_line_items BIGINT"),
}
KEYS = {"customer_rfm_online": ["customer_key"], "product_perf_online": ["product_id"],
        "supplier_score_online": ["supplier_key"], "product_catalog": ["product_id"]}


def customer_online(rfm: DataFrame) -> DataFrame:
    return rfm.select("customer_key", "market_segment", "customer_nation", "customer_region", "recency_days",
                      "frequency", F.col("monetary").cast("double").alias("lifetime_value"), "avg_order_value",
                      "rfm_score", "rfm_segment", "customer_lifetime_days")


def product_online(product: DataFrame) -> DataFrame:
    return product.select(
        F.concat_ws("|", "brand", "part_type", "manufacturer", "price_band").alias("product_id"),
        "brand", "part_type", "manufacturer", "price_band", F.col("net_revenue").cast("double").alias("net_revenue"),
        F.col("total_profit").cast("double").alias("total_profit"), "profit_margin_pct", "total_quantity_sold",
        "return_rate_pct", "avg_discount")


def supplier_online(supplier: DataFrame) -> DataFrame:
    return supplier.select("supplier_key", "supplier_name", "supplier_nation", "supplier_region",
                           F.col("net_revenue").cast("double").alias("net_revenue"),
                           F.col("total_profit").cast("double").alias("total_profit"), "profit_margin_pct",
                           "on_time_delivery_pct", "avg_delivery_delay_days", "return_rate_pct",
                           "total_line_items")


def product_catalog(dim_prt: DataFrame) -> DataFrame:
    return dim_prt.select(
        F.col("part_key").alias("product_id"), "part_name", "brand", "manufacturer", "part_type", "container",
        "price_band", "retail_price",
        F.concat_ws(" | ", "part_name", "brand", "manufacturer", "part_type", "container", "price_band")
        .alias("search_text"))


def key_report(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [assert_key(df, KEYS[n], n) for n, df in tables.items()])


def jdbc_sink(df: DataFrame, url: str, table: str, mode: str = "overwrite", batchsize: int = 1000,
              ddl: str | None = None, properties: dict | None = None, partitions: int | None = None) -> None:
    """Write from the executors in batches of ``batchsize`` rows per round trip.

    ``partitions`` caps concurrent connections (coalesce, no shuffle).
    """
    out = df.coalesce(partitions) if partitions else df
    props = {"batchsize": str(batchsize), "truncate": "true", **(properties or {})}
    w = out.write.mode(mode)
    if ddl:
        w = w.option("createTableColumnTypes", ddl)
    w.jdbc(url, table, properties=props)


def snapshot_diff(old: DataFrame, new: DataFrame, key: list[str], cols: list[str] | None = None) -> DataFrame:
    """Changes between two snapshots of a keyed table.

    One full outer join on the key; a row is ``insert`` (only new), ``delete``
    (only old) or ``update`` (some compared column differs, NULL-safe).  Rows
    that did not change are dropped.  Output: key, change_type, changed_columns,
    then the new values (old values for deletes).
    """
    cols = cols or [c for c in new.columns if c not in key]
    o = old.select(*key, *[F.col(c).alias(f"_old_{c}") for c in cols]).withColumn("_in_old", F.lit(True))
    n = new.select(*key, *cols).withColumn("_in_new", F.lit(True))
    j = o.join(n, key, "full_outer")
    changed = F.array_compact(F.array(*[F.when(~F.col(f"_old_{c}").eqNullSafe(F.col(c)), F.lit(c)) for c in cols]))
    kind = (F.when(F.col("_in_old").isNull(), "insert").when(F.col("_in_new").isNull(), "delete")
            .when(F.size(changed) > 0, "update"))
    out = j.select(*key, kind.alias("change_type"),
                   F.when(kind == "update", F.concat_ws(",", changed)).alias("changed_columns"),
                   *[F.when(F.col("_in_new").isNull(), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c)
                     for c in cols])
    return out.where(F.col("change_type").isNotNull())


def with_features(df: DataFrame, features: DataFrame, key: list[str]) -> DataFrame:
    """Feature lookup: left join of a keyed feature table (keys checked unique upstream)."""
    return df.join(features, key, "left")
