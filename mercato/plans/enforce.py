"""Rules and keys enforced when a table is written (N1, N3).

``write_checked`` writes every row once, to a staging folder, valid rows and
violating rows apart, and counts rows and violations in that same pass
(``DataFrame.observe``).  Then it either publishes, by switching the table's pointer
(:mod:`mercato.plans.store`), or leaves the pointer where it is and raises.  Readers
follow the pointer, so a violating row is never visible, not even for a moment.

Rules are CHECK expressions; a null result passes, as in SQL.  The key adds two
rules: no null in it (``key_not_null``) and no value twice (``key_unique``).  Of
rows that share a key one that breaks no rule stays, the first by content, and
the others violate.  The key
needs one shuffle by key, which also lays the table out by it; without a key there
is none.  Rows whose key holds a null are not gathered: they are spread at random.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from mercato.operators.quality import violated
from mercato.plans.store import PART, Store

VALID, QUARANTINE = "valid", "quarantine"
NOT_NULL, UNIQUE = "key_not_null", "key_unique"
FAILED = "_failed_rules"


class RuleViolation(ValueError):
    """The write was refused; ``report`` has the number of violations by rule."""

    def __init__(self, table: str, report: dict[str, int]):
        bad = {k: v for k, v in report.items() if v and k not in ("rows", "published", "quarantined")}
        super().__init__(f"{table}: {bad}")
        self.report = report


def tagged(df: DataFrame, rules: dict[str, str], key: list[str] | None = None) -> DataFrame:
    """The rows with the names of the rules they violate, in ``_failed_rules``."""
    failed = F.array_compact(F.array(*[F.when(violated(e), F.lit(n)) for n, e in rules.items()])) if rules \
        else F.array().cast("array<string>")
    out = df.withColumn(FAILED, failed)
    if not key:
        return out
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    # a null key is dealt by the row's content, so that such rows do not meet in one task
    same = Window.partitionBy(*key, "_deal").orderBy(F.size(FAILED), content, *[F.col(f"`{c}`").cast("string") for c in df.columns])
    by_key = F.array_compact(F.array(F.when(no_key, F.lit(NOT_NULL)), F.when(~no_key & (F.col("_place") > 1), F.lit(UNIQUE))))
    return out.withColumn("_deal", F.when(no_key, content).otherwise(F.lit(0))).withColumn("_place", F.row_number().over(same)) \
        .withColumn(FAILED, F.concat(F.col(FAILED), by_key)).drop("_deal", "_place")


def write_checked(df: DataFrame, base: str, name: str, rules: dict[str, str], key: list[str] | None = None,
                  on_violation: str = QUARANTINE, mark: str | None = None) -> dict[str, int]:
    """Write the table ``name`` of the store at ``base``; returns rows, published, quarantined and violations by rule.

    ``on_violation``: "quarantine" publishes the valid rows and keeps the others in
    ``<name>_quarantine`` with the rules they violate; "refuse" publishes only a
    table without a violation and raises :class:`RuleViolation` otherwise.  A ``mark``
    that took effect before is not written again.
    """
    if on_violation not in (QUARANTINE, "refuse"):
        raise ValueError("on_violation must be 'quarantine' or 'refuse'")
    spark = df.sparkSession
    store = Store(spark, base)
    if mark is not None and mark in store.marks():
        return {}
    names = [*rules, *([NOT_NULL, UNIQUE] if key else [])]
    seen = Observation()
    counts = [F.count_if(F.array_contains(FAILED, n)).alias(f"rule_{i}") for i, n in enumerate(names)]
    rows = tagged(df, rules, key).observe(seen, F.count(F.lit(1)).alias("rows"),
                                          F.count_if(F.size(FAILED) > 0).alias("bad"), *counts)
    state = F.when(F.size(FAILED) > 0, QUARANTINE).otherwise(VALID)
    staged = store.stage(name, rows.withColumn(PART, state))
    got = seen.get
    report = {"rows": got["rows"], "published": got["rows"] - got["bad"], "quarantined": got["bad"],
              **{n: got[f"rule_{i}"] for i, n in enumerate(names)}}
    if report["quarantined"] and on_violation == "refuse":
        staged.discard()
        raise RuleViolation(name, report)
    staged.publish({name: (VALID, [FAILED]), f"{name}_{QUARANTINE}": (QUARANTINE, [])}, mark)
    return report


def read_checked(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """The published rows of a table."""
    return Store(spark, base).read(name)


def quarantine(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """The rows of the last write that violate a rule, with the names of the rules."""
    return Store(spark, base).read(f"{name}_{QUARANTINE}")

