"""Read the given Parquet tables and complete them to the TPC-H shape.

The given tables lack some columns the warehouse needs (commit/receipt dates,
ship mode, partsupp, …).  They are derived from the keys by integer arithmetic
so that any engine computes the same values; the formulas are the fixture
contract (FIXTURES.md §2).  Everything is a projection over the scan, so
filters and column pruning still reach the Parquet reader.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed values of the fixture contract (FIXTURES.md §2), in natural order.
SHIP_MODES = ["REG AIR", "AIR", "RAIL", "SHIP", "TRUCK", "MAIL", "FOB"]
SHIP_INSTRUCTIONS = ["DELIVER IN PERSON", "COLLECT COD", "NONE", "TAKE BACK RETURN"]
CONTAINER_SIZES = ["SM", "MED", "LG", "WRAP", "JUMBO"]
CONTAINER_KINDS = ["CASE", "BOX", "PACK", "PKG", "JAR", "BAG", "CAN", "DRUM"]
SUPPLIERS_PER_PART = 4


def path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Plain scan of one given table."""
    return spark.read.parquet(path(sf_dir, name))


def _pick(values: list[str], idx0: Column) -> Column:
    """values[idx0] with a 0-based integer index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx0 + 1).cast("int"))


def _lpad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _phone(nation: Column, key: Column) -> Column:
    return F.concat((nation + 10).cast("string"), F.lit("-"), _lpad(key * 17 % 999, 3), F.lit("-"),
                    _lpad(key * 29 % 999, 3), F.lit("-"), _lpad(key * 37 % 9999, 4))


def region(spark, sf_dir):
    return read(spark, sf_dir, "region")


def nation(spark, sf_dir):
    return read(spark, sf_dir, "nation")


def customer(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.withColumns({
        "c_address": F.concat(F.lit("CustAddr-"), (k * 7919 % 99999).cast("string")),
        "c_phone": _phone(F.col("c_nationkey"), k),
    })


def supplier(spark, sf_dir):
    s = read(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.withColumns({
        "s_address": F.concat(F.lit("Addr-"), (k * 7919 % 99999).cast("string")),
        "s_phone": _phone(F.col("s_nationkey"), k),
    })


def part(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.withColumns({
        "p_mfgr": F.concat(F.lit("Manufacturer#"), (k % 5 + 1).cast("string")),
        "p_container": F.concat(_pick(CONTAINER_SIZES, k % 5), F.lit(" "),
                                _pick(CONTAINER_KINDS, F.floor(k / 5) % 8)),
    })


def orders(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return o.withColumns({
        "o_orderdate": F.col("o_orderdate").cast("date"),
        "o_clerk": F.concat(F.lit("Clerk#"), _lpad(F.col("o_orderkey") * 31 % 1000, 9)),
    })


def lineitem(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    o, p, s, n = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    ship = F.col("l_shipdate").cast("date")
    return li.withColumns({
        "l_shipdate": ship,
        "l_commitdate": F.date_add(ship, ((o * 13 + s * 5) % 61 - 15).cast("int")),
        "l_receiptdate": F.date_add(ship, (1 + (o * 3 + p) % 30).cast("int")),
        "l_shipmode": _pick(SHIP_MODES, (o * 7 + p * 3 + n) % 7),
        "l_shipinstruct": _pick(SHIP_INSTRUCTIONS, (o + n) % 4),
    })


def partsupp(spark, sf_dir):
    """Four suppliers per part, derived from the part key.

    The supplier count is a one-row aggregate joined as a broadcast constant
    (one row: a proven size bound), so no value travels through the driver.
    """
    n_supp = read(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("_n_supp"))
    p = read(spark, sf_dir, "part").select("p_partkey")
    ps = (p.crossJoin(F.broadcast(n_supp))
          .withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(SUPPLIERS_PER_PART - 1)))))
    k, i = F.col("p_partkey"), F.col("_i").cast("long")
    return ps.select(
        k.alias("ps_partkey"),
        ((k + i) % F.col("_n_supp")).alias("ps_suppkey"),
        (1 + (k * 11 + i * 7) % 9999).cast("int").alias("ps_availqty"),
        ((F.lit(100) + (k * 31 + i * 97) % 99900).cast("decimal(12,0)")
         * F.lit(0.01).cast("decimal(2,2)")).cast("decimal(12,2)").alias("ps_supplycost"),
    )


RAW = {"region": region, "nation": nation, "customer": customer, "supplier": supplier,
       "part": part, "partsupp": partsupp, "orders": orders, "lineitem": lineitem}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A TPC-H-shaped source table (given columns + derived ones)."""
    if name in RAW:
        return RAW[name](spark, sf_dir)
    return read(spark, sf_dir, name)
