"""Stores in parts, change feed and sync, incremental refresh, enforced writes."""

import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from mercato.plans import gold as G
from mercato.plans.enforce import RuleViolation, quarantine, read_checked, write_checked
from mercato.plans.incremental import SIGN, SalesView
from mercato.plans.silver import silver
from mercato.plans.store import PART, Store, Write
from mercato.streaming import feed as CF


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_store_switches_all_tables_at_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.read("a") is None and store.version() == 0
    part = lambda n, p: spark.range(n).withColumn(PART, F.lit(p))
    store.publish({"a": Write(part(3, "x").unionByName(part(2, "y")), ["x", "y"]), "b": Write(part(1, "x"), ["x"])}, "one")
    store.publish({"a": Write(part(9, "y"), ["y"])}, "one")  # the mark took effect before
    assert (store.read("a").count(), store.read("b").count(), store.marks()) == (5, 1, ["one"])
    before = store.listing()
    store.publish({"a": Write(part(7, "y"), ["x", "y"]), "b": Write(part(4, "x"), ["x"], append=True)})
    assert (store.read("a").count(), store.parts("a"), store.read("b").count()) == (7, ["y"], 5)
    assert store.read("a", listing=before).count() == 5  # a reader that began earlier
    with pytest.raises(ValueError):
        store.publish({"a": Write(part(1, "z"), ["y"])})
    assert store.read("a").count() == 7
    with pytest.raises(Exception):  # another writer was first
        store._switch({**before, "version": store.version()})
    assert store.vacuum(0) > 0 and store.read("a").count() == 7 and store.read("b").count() == 5


KEY = ["k"]
SCHEMA = "k long, v string, w int"


def snapshots(spark, seed, n=4):
    rng = random.Random(seed)
    return [spark.createDataFrame([(k, rng.choice(["a", "b", None]), rng.choice([1, 2])) for k in range(40) if rng.random() < 0.6]
                                  + ([(None, "null key", i)] if i % 2 else []), SCHEMA) for i in range(n)]


def test_sync_ends_up_at_the_last_snapshot_in_any_order_and_twice(spark, tmp_path):
    snaps = snapshots(spark, 1)
    old = spark.createDataFrame([], SCHEMA)
    where = str(tmp_path / "feed")
    for v, new in enumerate(snaps, 1):
        CF.record(old, new, KEY, where, v)
        old = new
    store = Store(spark, str(tmp_path / "copy"))
    CF.sync(spark, where, store, old.schema, KEY, str(tmp_path / "c1"), buckets=5)
    assert rows_of(CF.current(store)) == rows_of(snaps[-1])
    assert CF.sync(spark, where, store, old.schema, KEY, str(tmp_path / "c1"), buckets=5) == []  # nothing new
    CF.sync(spark, where, store, old.schema, KEY, str(tmp_path / "c2"), buckets=5)  # everything once more
    assert rows_of(CF.current(store)) == rows_of(snaps[-1])
    backwards = Store(spark, str(tmp_path / "backwards"))
    for v in (4, 2, 2, 3, 1, 4):
        CF.apply_changes(spark.read.schema(CF.feed_schema(old.schema, KEY)).parquet(CF.version_folder(where, v)), backwards, KEY, 5)
    assert rows_of(CF.current(backwards)) == rows_of(snaps[-1])
    CF.record(snaps[-2], snaps[-1], KEY, where, 4)  # recorded again: the same changes in new files
    CF.sync(spark, where, store, old.schema, KEY, str(tmp_path / "c1"), buckets=5)
    assert rows_of(CF.current(store)) == rows_of(snaps[-1])


def test_sync_rewrites_touched_buckets_only(spark, tmp_path):
    old = spark.createDataFrame([(k, "x", 0) for k in range(200)], SCHEMA)
    where, store = str(tmp_path / "feed"), Store(spark, str(tmp_path / "copy"))
    CF.record(spark.createDataFrame([], SCHEMA), old, KEY, where, 1)
    CF.sync(spark, where, store, old.schema, KEY, str(tmp_path / "c"), buckets=16)
    before = store.listing()["tables"][CF.TABLE]["parts"]
    CF.record(old, old.withColumn("v", F.when(F.col("k") == 7, "new").otherwise(F.col("v"))), KEY, where, 2)
    (touched,) = CF.sync(spark, where, store, old.schema, KEY, str(tmp_path / "c"), buckets=16)
    after = store.listing()["tables"][CF.TABLE]["parts"]
    assert len(touched) == 1 and len(before) == 16
    assert {p for p in after if after[p] != before[p]} == set(touched)


# ------------------------------------------------------------ incremental refresh

def sales(df):
    return rows_of(df.select(*[F.col(c).cast("double") if t.startswith("decimal") else F.col(c) for c, t in df.dtypes]))


@pytest.fixture(scope="module")
def facts(spark):
    s = silver(spark, SF001)
    lines = s.fact_lineitem.select("order_key", "part_key", "quantity", "net_revenue", "gross_revenue", "supply_cost", "profit", "discount",
                                   "ship_date", "return_flag", "line_number")
    return lines.cache(), s.fact_orders.cache()


def test_batches_equal_a_full_rebuild(spark, tmp_path, facts):
    lines, orders = facts
    view = SalesView(spark, str(tmp_path / "view"), buckets=4)
    early, first = F.col("ship_date") < "1998-06-01", F.col("order_date") < "1998-01-01"
    view.apply(lines.where(early), orders.where(first), "b1")  # lines without their order, and orders without all lines
    waiting = view.store.read("waiting").count()
    view.apply(lines.where(~early), orders.where(~first), "b2")
    view.apply(lines.where(~early), orders.where(~first), "b2")  # again: no effect
    assert waiting > 0 and view.store.read("waiting").count() == 0
    assert sales(view.daily()) == sales(G.daily_sales(lines, orders))
    assert sales(view.monthly()) == sales(G.monthly_sales(G.daily_sales(lines, orders)))
    back = F.col("return_flag") == "R"
    view.apply(lines.where(back).withColumn(SIGN, F.lit(-1)), orders.limit(0), "b3")
    assert sales(view.daily()) == sales(G.daily_sales(lines.where(~back), orders))


def test_nulls_and_whole_days_that_go(spark, tmp_path):
    schema = "order_key long, part_key long, quantity double, net_revenue decimal(12,2), gross_revenue decimal(12,2), " \
             "supply_cost decimal(12,2), profit decimal(12,2), discount decimal(4,2)"
    from decimal import Decimal as D
    one, two = D("1.00"), D("2.50")
    lines = spark.createDataFrame([(1, 5, 1.0, one, two, None, None, D("0.10")), (1, None, 2.0, two, two, None, None, None),
                                   (2, 5, 1.0, one, one, one, one, D("0.10")), (None, 5, 1.0, one, one, one, one, None),
                                   (3, 5, 9.0, one, one, one, one, None), (9, 5, 9.0, one, one, one, one, None)], schema)
    orders = spark.createDataFrame([(1, "2020-01-01", "ASIA", None), (2, None, "ASIA", "X"), (3, "2021-05-05", None, "X")],
                                   "order_key long, order_date string, customer_region string, market_segment string") \
        .withColumn("order_date", F.to_date("order_date"))
    view = SalesView(spark, str(tmp_path / "v"), buckets=2)
    assert view.daily() is None
    view.apply(lines, orders, "a")
    assert sales(view.daily()) == sales(G.daily_sales(lines, orders))
    view.apply(lines.where("order_key = 3").withColumn(SIGN, F.lit(-1)), orders.limit(0), "b")
    left = lines.where("order_key is null or order_key <> 3")
    assert sales(view.daily()) == sales(G.daily_sales(left, orders))
    assert view.apply(lines.limit(0), orders.limit(0), "c") == []
    assert sales(view.daily()) == sales(G.daily_sales(left, orders))


def test_a_refresh_reads_touched_months_only(spark, tmp_path, facts):
    lines, orders = facts
    view = SalesView(spark, str(tmp_path / "view"), buckets=4)
    last = F.col("order_date") >= "2001-07-01"
    view.apply(lines.join(orders.where(~last).select("order_key"), "order_key"), orders.where(~last), "b1")
    before = {t: view.store.listing()["tables"][t]["parts"] for t in ("sums", "keys", "daily")}
    months = view.apply(lines.join(orders.where(last).select("order_key"), "order_key"), orders.where(last), "b2")
    after = {t: view.store.listing()["tables"][t]["parts"] for t in ("sums", "keys", "daily")}
    assert set(months) <= {"2001-07", "2001-08"}
    for t in before:
        assert {p for p in after[t] if after[t][p] != before[t].get(p)} == set(months)
    plan = view.store.read("keys", months)._jdf.queryExecution().executedPlan().toString()
    assert "1995-" not in plan
    assert sales(view.daily()) == sales(G.daily_sales(lines, orders))


def test_a_batch_computes_its_lines_once(spark, tmp_path, facts):
    lines, orders = facts
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    view = SalesView(spark, str(tmp_path / "view"), buckets=2)
    view.apply(lines.mapInArrow(counted, lines.schema), orders, "b1")
    assert seen.value == lines.count()
    assert sales(view.daily()) == sales(G.daily_sales(lines, orders))


# ---------------------------------------------------------------- enforced writes

def test_bad_rows_are_never_visible(spark, tmp_path):
    base = str(tmp_path / "t")
    rows = [(1, 5.0), (2, -1.0), (2, 4.0), (2, 4.0), (None, 3.0), (None, None), (0, None)]
    df = spark.createDataFrame(rows, "id long, price double")
    rules = {"positive_id": "id > 0", "positive_price": "price > 0"}
    with pytest.raises(RuleViolation) as e:
        write_checked(df, base, "t", rules, ["id"], on_violation="refuse")
    assert e.value.report["positive_price"] == 1 and e.value.report["key_not_null"] == 2
    assert read_checked(spark, base, "t") is None and not glob.glob(f"{base}/t/*/_part=*")
    report = write_checked(df, base, "t", rules, ["id"])
    assert report == {"rows": 7, "published": 2, "quarantined": 5, "positive_id": 1, "positive_price": 1, "key_not_null": 2, "key_unique": 2}
    assert rows_of(read_checked(spark, base, "t")) == [(1, 5.0), (2, 4.0)]
    assert quarantine(spark, base, "t").count() == 5
    write_checked(df.where("id = 1"), base, "t", rules, ["id"], on_violation="refuse", mark="m")
    assert rows_of(read_checked(spark, base, "t")) == [(1, 5.0)] and quarantine(spark, base, "t").count() == 0
    assert write_checked(df, base, "t", rules, ["id"], mark="m") == {}
    assert write_checked(df.limit(0), base, "t", rules, ["id"])["rows"] == 0 and read_checked(spark, base, "t").count() == 0


def test_one_scan_serves_write_and_counts(spark, tmp_path):
    base = str(tmp_path / "t")
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(1000).mapInArrow(look, "id long")
    report = write_checked(df, base, "t", {"small": "id < 900"}, ["id"])
    assert report["quarantined"] == 100 and seen.value == 1000
    assert json.loads(open(sorted(glob.glob(f"{base}/_listing/*.json"))[-1]).read())["version"] == 1
    assert os.path.isdir(f"{base}/t")
