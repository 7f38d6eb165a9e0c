"""Refresh of daily and monthly sales from new rows only (B6).

The state of the view lies in a :mod:`store <mercato.plans.store>`, by month:

* ``sums``: per day, region and segment the sums of the measures and the numbers of
  values behind them.  Sums merge, and a withdrawn line counts with sign -1.
* ``keys``: per day, region, segment, kind (order, product) and key the number of lines.
  A key counts as long as its number is above zero, so exact distinct counts take
  inserts and deletes.
* ``daily``: the finished rows.

A batch of new lines is turned into signed partial sums and key counts.  Only the
months it touches are read, merged and rewritten; the lines of earlier batches are
never read again.  The monthly table is a roll-up of the finished days.

A line joins its order, wherever it arrives: orders are kept by hash bucket of
their key (``orders``), lines whose order is not there yet wait (``waiting``).
Lines whose order came with the same batch, the usual case, need no old order.

Each join of lines with orders is run once and stored for the batch, found and missing
orders alike, as the months, sums, keys and waiting lines all read it; the finished days
are made from the sums and keys just written.

All tables of a batch become visible together, and a batch id takes effect once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.plans import gold as G
from mercato.plans.store import PART, Store, Write, bucket_of, touched_parts

GRAIN = ["order_date", "customer_region", "market_segment"]
MEASURES = ["quantity", "net_revenue", "gross_revenue", "supply_cost", "profit", "discount"]
LINE = ["order_key", "part_key", *MEASURES]
SIGN = "_sign"


def _month() -> Column:
    return F.coalesce(F.date_format("order_date", "yyyy-MM"), F.lit("none"))


def _sum_type(kind: str) -> str:
    """Wide enough for any number of lines, so that merged sums keep their type."""
    return f"decimal(38,{kind.split(',')[1]}" if kind.startswith("decimal") else kind


class SalesView:
    """Daily and monthly sales, kept up to date batch by batch."""

    def __init__(self, spark: SparkSession, base: str, variant: str = G.NOTEBOOK, buckets: int = 64):
        self.spark, self.store, self.variant, self.buckets = spark, Store(spark, base), variant, buckets

    # -- reading -----------------------------------------------------------------------

    def daily(self) -> DataFrame | None:
        return self.store.read("daily")

    def monthly(self, dim_date: DataFrame | None = None) -> DataFrame | None:
        days = self.daily()
        return None if days is None else G.monthly_sales(days, self.variant, dim_date)

    # -- a batch -----------------------------------------------------------------------

    def apply(self, lines: DataFrame, orders: DataFrame, batch_id: str) -> list[str]:
        """Take in new lines and orders; returns the months that were rewritten.

        ``lines``: fact lines, with an optional column ``_sign`` (1 new, -1 withdrawn);
        ``orders``: fact orders that no earlier batch brought.
        """
        listing = self.store.listing()
        if batch_id in listing["marks"]:
            return []
        sign = F.col(SIGN).cast("long") if SIGN in lines.columns else F.lit(1).cast("long")
        lines = lines.select(*LINE, sign.alias(SIGN))
        orders = orders.select("order_key", *GRAIN)
        bucket = bucket_of(["order_key"], self.buckets)
        work = f"_batch/{uuid.uuid4().hex}"
        try:
            delta, writes = self._match(lines, orders, bucket, listing, work)
            months = touched_parts(delta.withColumn(PART, _month()))
            if months:
                writes["sums"] = Write(self._merged("sums", self._sums(delta), GRAIN, months, listing), months)
                writes["keys"] = Write(self._merged("keys", self._keys(delta), [*GRAIN, "kind", "key"], months, listing), months)
                writes["daily"] = Write(lambda new: self._finished(*[self.store.read(t, months, new) for t in ("sums", "keys")]), months)
            self.store.publish(writes, batch_id)
        finally:
            self.store._fs().delete(self.store._path(work), True)
        return months

    def _found(self, lines: DataFrame, orders: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
        """The lines joined with their orders, and those without; the join is stored, so that it runs once."""
        lines.join(orders.withColumn("_found", F.lit(True)), "order_key", "left").write.parquet(f"{self.store.base}/{folder}")
        both = self.spark.read.parquet(f"{self.store.base}/{folder}")
        return both.where("_found").drop("_found"), both.where("_found IS NULL").select(*lines.columns)

    def _match(self, lines: DataFrame, orders: DataFrame, bucket, listing: dict, work: str) -> tuple[DataFrame, dict[str, Write]]:
        """Lines with their order, and what changes among the kept orders and the waiting lines."""
        new_orders = orders.withColumn(PART, bucket)
        order_buckets = touched_parts(new_orders)
        writes = {"orders": Write(new_orders, order_buckets, append=True)} if order_buckets else {}
        matched, without = self._found(lines, orders, f"{work}/new")
        # null keys have no order, now or later
        without = without.where(F.col("order_key").isNotNull())
        line_buckets = touched_parts(without.withColumn(PART, bucket))
        kept, waiting = self.store.read("orders", line_buckets, listing), self.store.read("waiting", order_buckets, listing)
        if line_buckets:
            rest = without
            if kept is not None:
                late, rest = self._found(without, kept, f"{work}/late")
                matched = matched.unionByName(late)
            writes["waiting"] = Write(rest.withColumn(PART, bucket), line_buckets, append=True)
        if waiting is not None and order_buckets:
            arrived, still = self._found(waiting, orders, f"{work}/arrived")
            matched, still = matched.unionByName(arrived), still.withColumn(PART, bucket)
            if "waiting" in writes:
                # one write a table: buckets with new waiting lines keep their old ones beside them
                other = [p for p in line_buckets if p not in order_buckets]
                untouched = self.store.read("waiting", other, listing).withColumn(PART, bucket)
                still = still.unionByName(untouched).unionByName(writes["waiting"].rows)
            writes["waiting"] = Write(still, sorted({*order_buckets, *line_buckets}))
        return matched, writes

    def _sums(self, delta: DataFrame) -> DataFrame:
        kinds = dict(delta.dtypes)
        signed = [F.sum(F.col(m) * F.col(SIGN)).cast(_sum_type(kinds[m])).alias(m) for m in MEASURES]
        behind = [F.sum(F.when(F.col(m).isNotNull(), F.col(SIGN)).otherwise(0)).alias(f"n_{m}") for m in MEASURES]
        return delta.groupBy(*GRAIN).agg(*signed, *behind, F.sum(SIGN).alias("lines"))

    def _keys(self, delta: DataFrame) -> DataFrame:
        """One row a line, kind and key; they are counted together with the kept ones."""
        each = F.explode(F.array(F.struct(F.lit("order").alias("kind"), F.col("order_key").alias("key")),
                                 F.struct(F.lit("product").alias("kind"), F.col("part_key").alias("key"))))
        return delta.select(*GRAIN, each.alias("_k"), F.col(SIGN).alias("lines")).where(F.col("_k.key").isNotNull()) \
            .select(*GRAIN, "_k.kind", "_k.key", "lines")

    def _merged(self, table: str, new: DataFrame, by: list[str], months: list[str], listing: dict) -> DataFrame:
        """New and kept rows added up; a month belongs to a day, so that it need not be grouped by."""
        old = self.store.read(table, months, listing)
        kinds = dict(new.dtypes)
        rest = [c for c in new.columns if c not in by]
        return (new if old is None else new.unionByName(old)).groupBy(*by).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in rest]) \
            .where(F.col("lines") != 0).withColumn(PART, _month())

    def _finished(self, sums: DataFrame, keys: DataFrame) -> DataFrame:
        counts = keys.where(F.col("lines") > 0).groupBy(*GRAIN).agg(
            F.count_if(F.col("kind") == "order").alias("num_orders"), F.count_if(F.col("kind") == "product").alias("distinct_products"))
        same = [sums[c].eqNullSafe(counts[c]) for c in GRAIN]
        value = {m: F.when(F.col(f"n_{m}") > 0, F.col(m)) for m in MEASURES}  # a sum of nothing is null
        rows = sums.join(counts, same, "left").select(
            *[sums[c] for c in GRAIN], "num_orders", value["quantity"].alias("total_quantity"),
            value["net_revenue"].alias("net_revenue"), value["gross_revenue"].alias("gross_revenue"),
            value["supply_cost"].alias("total_cost"), value["profit"].alias("total_profit"),
            value["discount"].alias("_discount"), F.col("n_discount").alias("_discounts"), "distinct_products")
        return rows.select(_month().alias(PART), *G.daily_columns())
