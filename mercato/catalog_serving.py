"""Registry entries for feeds, incremental refresh, enforced writes and text lookup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.oracle import CTE, d, rhu, with_ctes
from mercato.plans import gold as G
from mercato.plans.silver import silver
from mercato.streaming.ingest import scratch

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str):
    def deco(fn):
        QUERIES[name], ORACLE[name] = fn, sql
        return fn
    return deco


# -- B12 change feed and triggered sync ------------------------------------------------

_DEMAND_KEY = ["part_key"]
_DEMAND = """
dy AS (SELECT l_partkey AS part_key, CAST(year(l_shipdate) AS BIGINT) AS y, COUNT(*) AS line_items, SUM(l_quantity) AS quantity,
  CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS revenue FROM lineitem GROUP BY ALL),
ends AS (SELECT MIN(y) AS y0, MAX(y) AS y1 FROM dy)"""
_VALUES = ["line_items", "quantity", "revenue"]


def _demand_feed(spark, sf_dir):
    """A keyed table with a history: demand by part in one shipping year after the other, recorded version by version."""
    from mercato.sources.tables import lineitem
    from mercato.streaming import feed
    base = scratch(spark, "feed")
    lineitem(spark, sf_dir).groupBy(F.col("l_partkey").alias("part_key"), F.year("l_shipdate").alias("y")).agg(
        F.count(F.lit(1)).alias("line_items"), F.sum("l_quantity").alias("quantity"),
        F.sum(F.col("l_extendedprice").cast("decimal(12,2)")).cast("double").alias("revenue")).write.parquet(f"{base}/years")
    years = spark.read.parquet(f"{base}/years")
    first, last = years.agg(F.min("y"), F.max("y")).first()
    old = years.limit(0).drop("y")
    for version, year in enumerate(range(first, last + 1), 1):
        new = years.where(F.col("y") == year).drop("y")
        feed.record(old, new, _DEMAND_KEY, f"{base}/changes", version)
        old = new
        yield base, old.schema, version


@register("change_feed", f"""
WITH {_DEMAND.strip()},
o AS (SELECT dy.* REPLACE (y + 1 AS y) FROM dy, ends WHERE y < y1)
SELECT COALESCE(n.part_key, o.part_key) AS part_key, COALESCE(n.y, o.y) - y0 + 1 AS version,
  CASE WHEN o.part_key IS NULL THEN 'insert' WHEN n.part_key IS NULL THEN 'delete' ELSE 'update' END AS change_type,
  {', '.join(f'CASE WHEN n.part_key IS NULL THEN o.{c} ELSE n.{c} END AS {c}' for c in _VALUES)}
FROM dy n FULL JOIN o ON n.part_key = o.part_key AND n.y = o.y CROSS JOIN ends
WHERE o.part_key IS NULL OR n.part_key IS NULL OR {' OR '.join(f'n.{c} IS DISTINCT FROM o.{c}' for c in _VALUES)}""")
def change_feed(spark, sf_dir):
    """Every version's inserts, updates and deletes of demand by part, from year to year."""
    from mercato.streaming import feed
    for base, schema, _ in _demand_feed(spark, sf_dir):
        pass
    return feed.changes(spark, f"{base}/changes", schema, _DEMAND_KEY).select(
        "part_key", F.col(feed.VERSION).alias("version"), F.col(feed.CHANGE).alias("change_type"), *_VALUES)


@register("serving_sync", f"WITH {_DEMAND.strip()}\nSELECT part_key, {', '.join(_VALUES)} FROM dy, ends WHERE y = y1")
def serving_sync(spark, sf_dir):
    """The serving copy after a triggered sync at the second version, one at the last, and a replay of all versions."""
    from mercato.plans.store import Store
    from mercato.streaming import feed
    for base, schema, version in _demand_feed(spark, sf_dir):
        copy = Store(spark, f"{base}/copy")
        if version == 2:
            feed.sync(spark, f"{base}/changes", copy, schema, _DEMAND_KEY, f"{base}/trigger", buckets=8)
    for trigger in ("trigger", "replay"):
        feed.sync(spark, f"{base}/changes", copy, schema, _DEMAND_KEY, f"{base}/{trigger}", buckets=8)
    return feed.current(copy)


# -- B6 incremental refresh --------------------------------------------------------------

def _sales_view(spark, sf_dir):
    """Daily sales after two batches: lines by shipping date, orders by order date, so that lines wait for orders and orders for lines."""
    from mercato.plans.incremental import SalesView
    s = silver(spark, sf_dir)
    lines = s.lines(*G.LINES_OF["daily_sales"], "ship_date", "return_flag")
    orders = s.fact_orders.select("order_key", "order_date", "customer_region", "market_segment")
    view = SalesView(spark, scratch(spark, "sales-view"), buckets=8)
    a, b = lines.agg(F.min("ship_date"), F.max("ship_date")).first()
    middle = F.lit(a + (b - a) / 2).cast("date")
    for i, (some, more) in enumerate(((F.col("ship_date") < middle, F.col("order_date") < middle),
                                      (~(F.col("ship_date") < middle), ~(F.col("order_date") < middle)))):
        view.apply(lines.where(F.coalesce(some, F.lit(i == 1))), orders.where(F.coalesce(more, F.lit(i == 1))), f"batch{i}")
    return view, lines, orders


_MONEY = ("net_revenue", "gross_revenue", "total_cost", "total_profit")
_AS_DOUBLE = ", ".join(f"{d(c)} AS {c}" for c in _MONEY)


@register("incremental_daily_sales", with_ctes(["gold_daily_sales"], f"""
SELECT * EXCLUDE ({', '.join(_MONEY)}), {_AS_DOUBLE} FROM gold_daily_sales"""))
def incremental_daily_sales(spark, sf_dir):
    return G.as_output(_sales_view(spark, sf_dir)[0].daily(), "daily_sales")


def _kept_lines(sql: str) -> str:
    """The SQL over lines that were not returned."""
    lines = CTE["gold_daily_sales"][0].strip()
    kept = lines.replace("FROM fact_lineitem li", "FROM (SELECT * FROM fact_lineitem WHERE return_flag <> 'R') li")
    assert kept != lines and lines in sql
    return sql.replace(lines, kept)


@register("incremental_monthly_sales", _kept_lines(with_ctes(["gold_monthly_sales"], f"""
SELECT * EXCLUDE ({', '.join(_MONEY)}), {_AS_DOUBLE} FROM gold_monthly_sales""")))
def incremental_monthly_sales(spark, sf_dir):
    """Monthly sales after a third batch that withdraws the returned lines."""
    from mercato.plans.incremental import SIGN
    view, lines, orders = _sales_view(spark, sf_dir)
    view.apply(lines.where(F.col("return_flag") == "R").withColumn(SIGN, F.lit(-1)), orders.limit(0), "returns")
    return G.as_output(view.monthly(), "monthly_sales")


# -- N1, N3 rules and keys enforced on write ----------------------------------------------

_KEYS = {"dim_customer": "customer_key", "dim_supplier": "supplier_key", "dim_part": "part_key", "fact_orders": "order_key",
         "fact_lineitem": None}


def _enforced_sql() -> str:
    from mercato.operators.quality import RULES
    parts = []
    for table, key in _KEYS.items():
        rules = {n: e for t, n, e in RULES if t == table}
        broken = " + ".join(f"CASE WHEN NOT ({e}) THEN 1 ELSE 0 END" for e in rules.values())
        place = f"ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY broken)" if key else "1"
        null_key = f"{key} IS NULL" if key else "FALSE"
        conditions = {**{n: f"COALESCE(NOT ({e}), FALSE)" for n, e in rules.items()},
                      **({"key_not_null": null_key, "key_unique": f"NOT ({null_key}) AND place > 1"} if key else {})}
        bad = " OR ".join(conditions.values())
        parts += [f"SELECT '{table}' AS table_name, '{n}' AS rule, COUNT(*) FILTER (WHERE {c}) AS violations, "
                  f"COUNT(*) FILTER (WHERE NOT ({bad})) AS published, COUNT(*) FILTER (WHERE {bad}) AS quarantined "
                  f"FROM (SELECT *, {place} AS place FROM (SELECT *, {broken} AS broken FROM {table}))" for n, c in conditions.items()]
    return with_ctes(list(_KEYS), " UNION ALL ".join(parts))


@register("enforced_writes", _enforced_sql())
def enforced_writes(spark, sf_dir):
    """The silver tables written with their rules and keys enforced: what was published, and what was kept back by which rule."""
    from mercato.operators.quality import RULES
    from mercato.plans import enforce as E
    base, s, out = scratch(spark, "enforced"), silver(spark, sf_dir), []
    for table, key in _KEYS.items():
        rules = {n: e for t, n, e in RULES if t == table}
        E.write_checked(getattr(s, table), base, table, rules, [key] if key else None)
        names = [*rules, *([E.NOT_NULL, E.UNIQUE] if key else [])]
        kept_back = E.quarantine(spark, base, table).agg(
            F.count(F.lit(1)).alias("quarantined"), *[F.count_if(F.array_contains(E.FAILED, n)).alias(n) for n in names])
        stack = ", ".join(f"'{n}', `{n}`" for n in names)
        published = E.read_checked(spark, base, table).agg(F.count(F.lit(1)).alias("published"))
        out.append(kept_back.crossJoin(published).selectExpr(
            f"'{table}' AS table_name", f"stack({len(names)}, {stack}) AS (rule, violations)", "published", "quarantined"))
    return reduce(DataFrame.unionByName, out)


# -- P3, P6 text lookup on stored postings ------------------------------------------------

def _tfidf_sql(texts: str, queries: str, ids: str, k: int) -> str:
    """Brute force over all rows: ``texts`` gives the ids and text, ``queries`` query_id and text."""
    terms = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda t: len(t) > 0)"
    return f"""
t AS (SELECT row_number() OVER () AS r, * FROM ({texts})),
tf AS (SELECT r, term, {d('COUNT(*)')} AS tf FROM (SELECT r, unnest({terms}) AS term FROM t) GROUP BY ALL),
idf AS (SELECT term, floor(1000 * (ln(((SELECT COUNT(*) FROM t) + 1)::DOUBLE / (COUNT(*) + 1)) + 1) + 0.5) AS idf FROM tf GROUP BY term),
w AS (SELECT r, term, tf * idf AS w FROM tf JOIN idf USING (term)),
n AS (SELECT r, sqrt(SUM(w * w)) AS norm FROM w GROUP BY r),
q AS (SELECT query_id, term, {d('COUNT(*)')} * idf AS wq FROM (SELECT query_id, unnest({terms}) AS term FROM ({queries})) JOIN idf USING (term)
  GROUP BY query_id, term, idf),
qn AS (SELECT query_id, sqrt(SUM(wq * wq)) AS qnorm FROM q GROUP BY query_id),
s AS (SELECT query_id, r, SUM(wq * w) AS dot FROM q JOIN w USING (term) GROUP BY ALL),
f AS (SELECT query_id, {ids}, dot / (qnorm * norm) AS score FROM s JOIN n USING (r) JOIN qn USING (query_id) JOIN t USING (r))
SELECT query_id, {ids}, {rhu('score', 6)} AS score,
  CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, {ids}) AS INTEGER) AS rank
FROM f QUALIFY rank <= {k}"""


_CATALOG = "concat_ws(' | ', part_name, brand, manufacturer, part_type, container, price_band)"


@register("product_lookup", with_ctes(["dim_part"], "," + _tfidf_sql(
    f"SELECT part_key AS product_id, {_CATALOG} AS text FROM dim_part",
    "SELECT DISTINCT concat_ws(' ', part_type, brand, container) AS query_id, concat_ws(' ', part_type, brand, container) AS text FROM dim_part",
    "product_id", 10)))
def product_lookup(spark, sf_dir):
    """The ten catalog products most like each "type brand container" text that a user may type."""
    from mercato.plans.search import product_lookup as lookup
    from mercato.plans.search import type_and_brand_queries
    from mercato.plans.serving import product_catalog
    catalog = product_catalog(silver(spark, sf_dir).dim_part)
    return lookup(catalog, type_and_brand_queries(catalog))


@register("passage_topk", "WITH" + _tfidf_sql(
    """SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, text FROM (
  SELECT doc_id, unnest(range(0, len(l))) AS line_no, unnest(l) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
  WHERE length(trim(text)) > 0""", "SELECT item_id AS query_id, text FROM benchmark", "doc_id, line_no", 5))
def passage_topk(spark, sf_dir):
    """Benchmark items as questions → top-5 document passages (all documents, every line)."""
    from mercato.plans.search import passage_topk as lookup
    from mercato.sources.tables import read
    queries = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return lookup(read(spark, sf_dir, "documents"), queries, k=5)
