"""Layers, serving sink, snapshot diff, streaming ingest, quality operators, tools."""

import datetime as _dt
import json
import os
import tempfile
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from mercato.operators.quality import assert_key, check, reconcile
from mercato.plans import gold as G
from mercato.plans.layers import detail, history, read_layer, refresh
from mercato.plans.serving import jdbc_sink, snapshot_diff
from mercato.plans.silver import silver
from mercato.sources.tables import read
from mercato.streaming.ingest import drop_files, ingest


@pytest.fixture(scope="module")
def warehouse(spark):
    base = tempfile.mkdtemp(prefix="mercato-wh-")
    paths = refresh(spark, SF001, base, batch_id="t1")
    return base, paths


def test_refresh_equals_direct_plans(spark, warehouse):
    base, paths = warehouse
    assert len(paths) == 8 + 7 + 7
    stored = read_layer(spark, base, "gold", "daily_sales")
    direct = G.daily_sales(silver(spark, SF001).fact_lineitem, silver(spark, SF001).fact_orders)
    assert sorted(stored.collect()) == sorted(direct.collect())
    assert history(spark, base).where("batch_id = 't1'").count() == 22
    d = detail(spark, paths["gold.daily_sales"]).first()
    assert d.num_files >= 1 and d.size_in_bytes > 0


def test_bucketed_facts_join_without_shuffle(spark, warehouse):
    base, _ = warehouse
    li, od = read_layer(spark, base, "silver", "fact_lineitem"), read_layer(spark, base, "silver", "fact_orders")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = li.join(od, "order_key")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_bronze_reconciles(spark, warehouse):
    base, _ = warehouse
    from mercato.sources.tables import raw
    src = {t: raw(spark, SF001, t) for t in ("orders", "lineitem", "partsupp")}
    tgt = {t: read_layer(spark, base, "bronze", t) for t in src}
    rep = {r.table_name: r for r in reconcile(src, tgt).collect()}
    assert all(r.status == "match" for r in rep.values())
    b = read_layer(spark, base, "bronze", "orders")
    assert {"_ingested_at", "_source_table", "_batch_id"} <= set(b.columns)


def test_check_rules_and_keys(spark):
    df = spark.createDataFrame([(0, 1.0), (1, -2.0), (2, None), (2, 3.0)], "k long, v double")
    valid, bad, report = check(df, {"pos_key": "k > 0", "pos_v": "v > 0"})
    rep = {r.rule: r.violations for r in report.collect()}
    assert rep == {"pos_key": 1, "pos_v": 1}            # NULL passes a CHECK
    assert valid.count() == 2 and bad.count() == 2
    k = assert_key(df, ["k"], "t").first()
    assert (k.rows, k.null_keys, k.duplicate_keys) == (4, 0, 1)


def test_snapshot_diff_kinds(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "product_id long, search_text string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d"), (5, "e")], "product_id long, search_text string")
    got = {r.product_id: r.change_type for r in snapshot_diff(old, new, ["product_id"]).collect()}
    assert got == {2: "update", 3: "delete", 4: "update", 5: "insert"}


def test_jdbc_sink_roundtrip_embedded_derby(spark):
    url = "jdbc:derby:memory:mercato_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.createDataFrame([(i, f"s{i}", i * 1.5) for i in range(2500)], "supplier_key long, name string, v double")
    jdbc_sink(df, url, "SUPPLIER_SCORE_ONLINE", batchsize=1000, properties=props, partitions=3,
              ddl="name VARCHAR(50)")
    back = spark.read.jdbc(url, "SUPPLIER_SCORE_ONLINE", properties=props)
    assert back.count() == 2500
    row = back.where(F.col(back.columns[0]) == 42).first()
    assert row[2] == 63.0


def test_streaming_two_drops_equal_batch_and_rerun_adds_nothing(spark):
    ev = read(spark, SF001, "events")
    base = tempfile.mkdtemp(prefix="mercato-st-")
    landing, target = os.path.join(base, "landing"), os.path.join(base, "bronze")
    cut = ev.agg(F.percentile_approx("ts", 0.5)).first()[0]
    drop_files(ev.where(F.col("ts") < cut), landing, "ts", [])
    first = ingest(spark, os.path.join(landing, "*"), target, ev.schema, "events")
    drop_files(ev.where(F.col("ts") >= cut), os.path.join(base, "landing2"), "ts", [])
    os.rename(os.path.join(base, "landing2", "drop=0000"), os.path.join(landing, "drop=0001"))
    second = ingest(spark, os.path.join(landing, "*"), target, ev.schema, "events")
    third = ingest(spark, os.path.join(landing, "*"), target, ev.schema, "events")
    out = spark.read.parquet(target).select(*ev.columns)
    assert first["rows"] + second["rows"] == ev.count() and third["rows"] == 0
    assert sorted(out.collect()) == sorted(ev.collect())


def test_read_layer_stays_in_its_warehouse(spark, tmp_path):
    from mercato.plans.layers import database, write_layer
    df = spark.range(3).withColumnRenamed("id", "order_key")
    for base, rows in (("a", df), ("b", df.where("order_key > 0"))):
        write_layer(rows, str(tmp_path / base), "silver", "fact_orders", bucket_by="order_key", buckets=2)
    assert read_layer(spark, str(tmp_path / "a"), "silver", "fact_orders").count() == 3
    assert read_layer(spark, str(tmp_path / "b"), "silver", "fact_orders").count() == 2
    for base in ("a", "b"):
        bucketed = f"{database(str(tmp_path / base), 'silver')}.fact_orders"
        plan = spark.table(bucketed).join(spark.table(bucketed).hint("merge"), "order_key")
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
        spark.sql(f"DROP DATABASE {database(str(tmp_path / base), 'silver')} CASCADE")


def test_invalid_app_parameters_raise(spark):
    from mercato.plans import analytics as A
    g = G.Gold(silver(spark, SF001))
    with pytest.raises(ValueError):
        A.revenue_by_region_month(g.monthly_sales, start_month="1996-1")
    with pytest.raises(ValueError):
        A.products_by_brand_band(g.product_performance, sort_by="nonsense")
    assert A.products_by_brand_band(g.product_performance, top_n=3).count() == 3


def test_drop_files_keeps_rows_without_a_split_value(spark, tmp_path):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    paths = drop_files(df, str(tmp_path), "x", [3])
    assert [spark.read.parquet(p).count() for p in paths] == [2, 1]


def test_tools_bound_parameters_and_json(spark):
    from mercato.functions import tools
    g = G.Gold(silver(spark, SF001))
    tools.register(spark, g)
    df = tools.call(spark, "get_revenue_by_region", region_name="ASIA", start_month="1996-01", end_month="1996-12")
    rows = df.collect()
    assert rows and all(r.region == "ASIA" and "1996-01" <= r.year_month <= "1996-12" for r in rows)
    assert tools.call(spark, "get_top_products", n=7, sort_by="unknown").count() == 7
    assert tools.call(spark, "get_top_products", n=500, sort_by="net_revenue").count() == min(500, g.product_performance.count())
    prof = json.loads(tools.execute_tool(spark, "get_customer_profile", json.dumps({"cust_key": 3})))
    assert len(prof) == 1 and prof[0]["customer_key"] == 3
    # ordered by the metric, in pages
    args = json.dumps({"region_filter": "ALL", "sort_metric": "return_rate_pct", "top_n": 9})
    pages = [json.loads(tools.execute_tool(spark, "get_supplier_scorecard", args, page=i, page_rows=4)) for i in range(4)]
    rates = [r["return_rate_pct"] for p in pages for r in p]
    assert [len(p) for p in pages] == [4, 4, 1, 0] and rates == sorted(rates)
    plan = tools.call(spark, "get_top_products", n=7, sort_by="net_revenue")._jdf.queryExecution().optimizedPlan().toString()
    assert "map(" not in plan  # the bound name left one column
    # quotes are data, not SQL
    evil = json.loads(tools.execute_tool(spark, "get_executive_summary", json.dumps(["1995-Q1' OR '1'='1", "z"])))
    assert evil == [] or isinstance(evil, list)
    assert "error" in json.loads(tools.execute_tool(spark, "get_executive_summary", "{not json"))


def test_dashboard_queries_validate(spark):
    import __spark_entry__ as E
    from mercato.operators.quality import validate_queries
    qs = E.queries()
    rep = validate_queries(spark, {n: qs[n](spark, SF001) for n in qs if n.startswith("dash_") and "churn" not in n})
    assert all(r.status == "ok" and r.rows > 0 for r in rep.collect())


def test_reembed_changed_and_feature_lookup(spark):
    from mercato.plans.search import embed, reembed_changed
    from mercato.plans.serving import with_features
    old = spark.createDataFrame([(1, "brass bolt"), (2, "steel nut"), (3, "tin can")], "product_id long, search_text string")
    new = spark.createDataFrame([(1, "brass bolt"), (2, "polished steel nut"), (4, "copper wire")],
                                "product_id long, search_text string")
    model, _ = embed(old)
    diff = snapshot_diff(old, new, ["product_id"])
    emb = reembed_changed(model, diff, ["product_id"])
    assert sorted(r.product_id for r in emb.collect()) == [2, 4]
    feats = spark.createDataFrame([(1, 0.5), (4, 0.9)], "product_id long, score double")
    got = {r.product_id: r.score for r in with_features(new, feats, ["product_id"]).collect()}
    assert got == {1: 0.5, 2: None, 4: 0.9}


def _scans(df, column):
    """How many scans of the physical plan read a column."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return sum(line.count(column) > 0 for line in plan.splitlines() if "FileScan" in line)


def test_lines_join_only_the_lookups_they_need(spark):
    g = G.Gold(silver(spark, SF001))
    keys = ("p_partkey", "s_suppkey", "c_custkey", "l_orderkey")
    assert [_scans(g.shipping_analysis, k) for k in keys] == [0, 0, 1, 1]
    assert [_scans(g.product_performance, k) for k in keys] == [2, 0, 0, 1]  # parts also make partsupp
    assert [_scans(g.daily_sales, k) for k in keys[2:]] == [1, 1]


def test_lines_of_a_larger_table_are_dealt_over_more_tasks(spark):
    s = silver(spark, SF001)
    assert s.lines_by_order("order_key").rdd.getNumPartitions() == 4
    assert s.lines_by_order("order_key", task_bytes=10_000).rdd.getNumPartitions() > 8
    # the join by order takes them as they are dealt
    plan = G.daily_sales(s.lines_by_order(*G.LINES_OF["daily_sales"], task_bytes=10_000), s.fact_orders)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(order_key" in line]
    assert len([line for line in dealt if "REPARTITION_BY_NUM" in line]) == 1 and "hashpartitioning(order_key" in plan


def test_daily_sales_counts_orders_and_products_once(spark):
    line = ("order_key long, part_key long, quantity double, net_revenue decimal(12,2), gross_revenue decimal(12,2), "
            "supply_cost decimal(12,2), profit decimal(12,2), discount decimal(4,2)")
    one = D("1.00")
    li = spark.createDataFrame([(1, 7, 2.0, one, one, None, one, D("0.10")), (1, 7, 1.0, one, one, None, one, None),
                                (1, 8, 1.0, one, one, one, one, D("0.30")), (2, 7, 1.0, one, one, one, one, D("0.20")),
                                (2, None, 1.0, one, one, one, one, D("0.20")), (9, 7, 1.0, one, one, one, one, one)], line)
    day = _dt.date(1995, 1, 1)
    od = spark.createDataFrame([(1, day, None, "S"), (2, day, None, "S")],
                               "order_key long, order_date date, customer_region string, market_segment string")
    r = G.daily_sales(li, od).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.num_orders, r.distinct_products, r.total_quantity, r.net_revenue, r.total_cost) == (2, 2, 6.0, 5, 3)
    assert r.avg_discount == 0.2 and r.region is None
