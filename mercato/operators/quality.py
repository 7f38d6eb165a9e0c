"""Data-quality operators: CHECK rules, key assertions, reconciliation.

All reports are single aggregation passes (one ``count_if`` per rule), built
on executors; only the tiny report reaches the driver when someone looks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed rule set (table, rule name, CHECK expression), in the reference's order.
RULES = [
    ("dim_customer", "valid_customer_key", "customer_key > 0"),
    ("dim_supplier", "valid_supplier_key", "supplier_key > 0"),
    ("dim_part", "valid_part_key", "part_key > 0"),
    ("dim_part", "positive_price", "retail_price > 0"),
    ("fact_orders", "valid_order_key", "order_key > 0"),
    ("fact_orders", "positive_total", "total_price > 0"),
    ("fact_lineitem", "valid_quantity", "quantity > 0"),
    ("fact_lineitem", "valid_net_revenue", "net_revenue >= 0"),
]


def violated(expr: str):
    """A CHECK passes on NULL, so only a FALSE result is a violation."""
    return F.coalesce(~F.expr(expr), F.lit(False))


def check(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid rows, violating rows with the failed rule names, per-rule report)."""
    failed = F.array_compact(F.array(*[F.when(violated(e), F.lit(n)) for n, e in rules.items()]))
    tagged = df.withColumn("_failed_rules", failed)
    valid = tagged.where(F.size("_failed_rules") == 0).drop("_failed_rules")
    bad = tagged.where(F.size("_failed_rules") > 0)
    report = rule_report(df, rules)
    return valid, bad, report


def rule_report(df: DataFrame, rules: dict[str, str], table: str | None = None) -> DataFrame:
    """One row per rule: (table, rule, expression, violations) from one pass."""
    agg = df.agg(*[F.count_if(violated(e)).alias(n) for n, e in rules.items()])
    stack = ", ".join(f"'{n}', {n}" for n in rules)
    long = agg.selectExpr(f"stack({len(rules)}, {stack}) AS (rule, violations)")
    exprs = F.create_map(*[x for n, e in rules.items() for x in (F.lit(n), F.lit(e))])
    return long.select(F.lit(table).cast("string").alias("table_name"), "rule",
                       exprs[F.col("rule")].alias("expression"), "violations")


def assert_key(df: DataFrame, cols: list[str], table: str | None = None) -> DataFrame:
    """Primary-key check: rows, rows with a NULL key part, key values seen twice+."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    per_key = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    dup = per_key.agg(F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
                      F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"))
    nulls = df.agg(F.count_if(any_null).alias("null_keys"))
    return dup.crossJoin(nulls).select(
        F.lit(table).cast("string").alias("table_name"), F.lit(",".join(cols)).alias("key_columns"),
        F.col("rows").cast("long").alias("rows"), "null_keys", "duplicate_keys")


def counts(tables: dict[str, DataFrame], label: str) -> DataFrame:
    """(table_name, <label>) row counts, one aggregate per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias(label)).select(F.lit(n).alias("table_name"), label)
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def reconcile(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    """Source vs target row counts per table with a match/mismatch status."""
    s, t = counts(source, "source_rows"), counts(target, "bronze_rows")
    j = s.join(t, "table_name", "full_outer")
    return j.select("table_name", "source_rows", "bronze_rows",
                    F.when(F.col("source_rows").eqNullSafe(F.col("bronze_rows")), "match")
                    .otherwise("mismatch").alias("status"))


def inventory(tables: dict[str, DataFrame], layer: str) -> DataFrame:
    """(layer, table_name, rows, columns) per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(layer).alias("layer"), F.lit(n).alias("table_name"), "rows", F.lit(len(df.columns)).alias("columns"))
        for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def validate_queries(spark: SparkSession, queries: dict[str, DataFrame]) -> DataFrame:
    """Run every query (count) and report rows/columns/status, like a dashboard check."""
    rows = []
    for name, df in queries.items():
        try:
            rows.append((name, int(df.count()), len(df.columns), "ok"))
        except Exception as e:  # noqa: BLE001
            rows.append((name, None, None, f"error: {str(e)[:200]}"))
    return spark.createDataFrame(rows, "query string, rows long, columns int, status string")
