"""SQL table functions over the gold tables (the analytics "tools"), K1-K7.

A tool is a view, a condition on its parameters and an order.  ``register`` publishes the
views and creates one temporary SQL table function for each tool; :func:`call` invokes one
with *bound* named parameters (never string-formatted) and orders the rows.  A tool with a
row count keeps the first rows by a metric that the caller names; after binding, Spark
reads that one column and cuts to the first rows within every task.

:func:`execute_tool` is the JSON dispatcher: arguments as a JSON object or list, one page
of rows as JSON; :func:`tool_rows` gives all rows as JSON without the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions.numeric import dbl, exact_avg, round_half_up

PAGE = 50


@dataclass(frozen=True)
class Tool:
    """``metrics``: sort name -> (column, descending); the first is used for unknown names."""

    params: dict[str, str]
    rows: Callable[..., DataFrame]
    where: str = "true"
    order: tuple[str, ...] = ()
    metrics: dict[str, tuple[str, bool]] = field(default_factory=dict)
    metric_param: str | None = None
    count_param: str | None = None
    hidden: tuple[str, ...] = ()

    def metric(self, asked: str | None) -> tuple[str, bool]:
        return self.metrics.get(asked, next(iter(self.metrics.values())))


def _doubles(df: DataFrame, columns: str, money: str = "") -> DataFrame:
    return df.select(*[dbl(c).alias(c) if c in money.split() else F.col(c) for c in columns.split()])


def _revenue(gold) -> DataFrame:
    m = gold.monthly_sales
    return m.groupBy("year_month", "region").agg(
        dbl(F.sum("net_revenue")).alias("net_revenue"), F.sum("num_orders").alias("num_orders"),
        *[round_half_up(exact_avg(c, 2), 2).alias(c) for c in ("profit_margin_pct", "yoy_growth_pct")])


def _profiles(gold) -> DataFrame:
    r = gold.customer_rfm.select(
        "customer_key", "rfm_segment", "rfm_score", dbl("monetary").alias("lifetime_value"), "frequency", "recency_days",
        round_half_up("avg_order_value", 2).alias("avg_order_value"))
    return _doubles(gold.s.dim_customer.join(r, "customer_key", "left"),
                    "customer_key customer_name market_segment nation_name region_name balance_tier rfm_segment rfm_score "
                    "lifetime_value frequency recency_days avg_order_value")


def _products(gold) -> DataFrame:
    return _doubles(gold.product_performance, "brand part_type price_band net_revenue profit_margin_pct return_rate_pct "
                    "total_quantity_sold num_orders manufacturer", "net_revenue")


def _suppliers(gold) -> DataFrame:
    return _doubles(gold.supplier_scorecard, "supplier_name supplier_nation supplier_region net_revenue profit_margin_pct "
                    "on_time_delivery_pct return_rate_pct total_line_items supplier_key", "net_revenue")


def _churn(gold, churn_scores: DataFrame) -> DataFrame:
    return _doubles(churn_scores, "customer_key market_segment customer_region lifetime_value rfm_score churn_probability risk_tier")


def _summary(gold) -> DataFrame:
    return _doubles(gold.executive_summary, "year_quarter total_orders active_customers gross_order_value avg_order_value "
                    "revenue_per_customer qoq_revenue_growth_pct", "gross_order_value")


def _down(*names: str) -> dict[str, tuple[str, bool]]:
    return {n: (n, True) for n in names}


TOOLS = {
    "get_revenue_by_region": Tool(
        {"region_name": "STRING", "start_month": "STRING", "end_month": "STRING"}, _revenue,
        "(region_name = 'ALL' OR region = region_name) AND year_month BETWEEN start_month AND end_month", ("year_month", "region")),
    "get_customer_profile": Tool({"cust_key": "BIGINT"}, _profiles, "customer_key = cust_key", ("customer_key",)),
    "get_top_products": Tool(
        {"n": "INT", "sort_by": "STRING"}, _products, order=("brand", "part_type", "price_band", "manufacturer"),
        metrics=_down("net_revenue", "profit_margin_pct", "return_rate_pct", "total_quantity_sold"),
        metric_param="sort_by", count_param="n", hidden=("manufacturer",)),
    "get_churn_risk": Tool(
        {"risk_level": "STRING", "top_n": "INT"}, _churn, "risk_level = 'ALL' OR risk_tier = risk_level", ("customer_key",),
        metrics=_down("churn_probability"), count_param="top_n"),
    "get_supplier_scorecard": Tool(
        {"region_filter": "STRING", "sort_metric": "STRING", "top_n": "INT"}, _suppliers,
        "region_filter = 'ALL' OR supplier_region = region_filter", ("supplier_key",),
        metrics={**_down("on_time_delivery_pct", "net_revenue", "profit_margin_pct"), "return_rate_pct": ("return_rate_pct", False)},
        metric_param="sort_metric", count_param="top_n", hidden=("supplier_key",)),
    "get_executive_summary": Tool(
        {"start_quarter": "STRING", "end_quarter": "STRING"}, _summary,
        "year_quarter BETWEEN start_quarter AND end_quarter", ("year_quarter",)),
}


def _view(name: str) -> str:
    return f"tool_{name}"


def _body(name: str, columns: list[str]) -> str:
    tool = TOOLS[name]
    rows = f"SELECT {', '.join(columns)} FROM {_view(name)} WHERE {tool.where}"
    if not tool.count_param:
        return rows
    # one double a metric, larger first; the name is bound, so the map folds to one column
    signed = ", ".join(f"'{m}', CAST({'' if down else '-'}{c} AS DOUBLE)" for m, (c, down) in tool.metrics.items())
    first = next(iter(tool.metrics))
    names = ", ".join(f"'{m}'" for m in tool.metrics)
    asked = f"CASE WHEN {tool.metric_param} IN ({names}) THEN {tool.metric_param} ELSE '{first}' END" if tool.metric_param else f"'{first}'"
    return (f"SELECT {', '.join(columns)} FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY map({signed})[{asked}] DESC NULLS LAST, "
            f"{', '.join(tool.order)}) AS _place FROM ({rows})) WHERE _place <= {tool.count_param}")


def register(spark: SparkSession, gold, churn_scores: DataFrame | None = None,
             names: list[str] | None = None) -> None:
    """Publish the views needed by ``names`` and create the functions."""
    names = names or [n for n in TOOLS if n != "get_churn_risk" or churn_scores is not None]
    for name in names:
        tool = TOOLS[name]
        rows = tool.rows(gold, churn_scores) if name == "get_churn_risk" else tool.rows(gold)
        rows.createOrReplaceTempView(_view(name))
        params = ", ".join(f"{p} {t}" for p, t in tool.params.items())
        returns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS TABLE({returns}) RETURN {_body(name, rows.columns)}")


def _ordered(tool: Tool, asked: str | None) -> list[Column]:
    out = [F.col(c).asc() for c in tool.order]
    if tool.count_param:
        column, down = tool.metric(asked)
        out.insert(0, F.desc_nulls_last(column) if down else F.asc_nulls_last(column))
    return out


def call(spark: SparkSession, name: str, **params) -> DataFrame:
    """The tool's rows in its order, by ``SELECT * FROM name(:p1, :p2, …)`` with bound named parameters."""
    if name not in TOOLS:
        raise ValueError(f"unknown tool {name!r}")
    tool = TOOLS[name]
    missing = [p for p in tool.params if p not in params]
    if missing:
        raise ValueError(f"missing parameters {missing}")
    marks = ", ".join(f":{p}" for p in tool.params)
    rows = spark.sql(f"SELECT * FROM {name}({marks})", args={p: params[p] for p in tool.params})
    return rows.orderBy(*_ordered(tool, params.get(tool.metric_param))).drop(*tool.hidden)


def _called(spark: SparkSession, name: str, arguments_json: str) -> DataFrame:
    args = json.loads(arguments_json)
    if isinstance(args, list) and name in TOOLS:
        args = dict(zip(TOOLS[name].params, args, strict=False))
    return call(spark, name, **args)


def tool_rows(spark: SparkSession, name: str, arguments_json: str) -> DataFrame:
    """All rows of a call, each as a JSON object in column ``row``."""
    return _called(spark, name, arguments_json).select(F.to_json(F.struct("*")).alias("row"))


def execute_tool(spark: SparkSession, name: str, arguments_json: str, page: int = 0, page_rows: int = PAGE) -> str:
    """JSON in, JSON out: one page of the call's rows in their order, a list; errors as ``{"error": …}``."""
    try:
        rows = tool_rows(spark, name, arguments_json).offset(page * page_rows).limit(page_rows)
        return json.dumps([json.loads(r["row"]) for r in rows.collect()])
    except Exception as e:  # noqa: BLE001 — the tool contract returns errors as data
        return json.dumps({"error": str(e)})
