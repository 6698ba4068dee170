"""The shape of the physical plans."""

import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import cleaning, core, marts, staging
from ledgerloom.plans.measures import Measures
from ledgerloom.plans.warehouse import SCOPE, Warehouse
from ledgerloom.queries import QUERIES
from ledgerloom.sources import feed
from ledgerloom.sources.store import Store

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture
def written_plans(monkeypatch):
    """The plans of the tables written while a test runs."""
    from ledgerloom.sources.store import Store

    plans, write = {}, Store.write

    def spy(self, name, df):
        plans[name.rsplit("-", 1)[0]] = plan(df)
        return write(self, name, df)

    monkeypatch.setattr(Store, "write", spy)
    return plans


def test_no_query_runs_python_or_pairs_rows(spark, written_plans):
    plans = {name: plan(query(spark, SF)) for name, query in QUERIES.items()}
    for name, text in {**plans, **written_plans}.items():
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|InPandas", text), name
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_latest_version_is_picked_before_the_shuffle(warehouse):
    for df in (
        cleaning.settle(warehouse.judged_order_items, "order_items", SCOPE),
        staging.stg_orders(warehouse.raw("orders")),
        staging.stg_order_items(warehouse.raw("order_items")),
    ):
        text = plan(df)
        partial, final = text.index("row_number(), 1, Partial"), text.index("row_number(), 1, Final")
        assert final < text.index("Exchange hashpartitioning") < partial


def test_clean_orders_do_not_wait_for_the_newest_lines(spark, written_plans):
    feeds = {name: df for name, df in feed.extracts(spark, SF).items()}
    w = Warehouse(feeds, feed.BATCHES, Store.for_session(spark))
    assert w.clean_orders.count() > 0 and w.empty_orders.count() > 0
    assert "settled_order_items" not in written_plans
    filled = written_plans["filled_orders"]
    # an order is sent once per task that has lines of it
    assert filled.count("HashAggregate(keys=[_batch_id") == 2 and "line_number" not in filled[: filled.index("FileScan")]
    known = w.settled_order_items.select(*SCOPE, "order_id").distinct()
    assert known.exceptAll(w.filled_orders).isEmpty() and w.filled_orders.exceptAll(known).isEmpty()


def test_scans_read_only_the_needed_columns(spark, warehouse):
    kpi = plan(marts.revenue_by_category(warehouse.fct_order_items))
    assert re.search(r"ReadSchema: struct<category:string,order_month:date,status:string,quantity:int,net", kpi)
    assert "EqualTo(status,completed)" in kpi
    items = plan(feed.extracts(spark, SF)["order_items"])
    assert "l_tax" not in items and "l_returnflag" not in items


def test_incremental_delta_filters_the_landing_scan(warehouse):
    text = plan(core.changed_orders(warehouse.raw("orders"), warehouse.first_load_orders, warehouse.params))
    assert "GreaterThanOrEqual(ingested_at" in text


def test_facts_meet_customers_at_customer_grain(warehouse, no_broadcast):
    text = plan(marts.revenue_by_segment(warehouse.fct_orders, warehouse.dim_customer))
    join = text.index("SortMergeJoin")
    assert "partial_sum(net_revenue_usd" in text[join:]


def test_measures_that_ask_for_no_customer_do_not_shuffle_by_customer(spark, warehouse, written_plans):
    measures = Measures(warehouse, spark)
    texts = [plan(measures.evaluate(["last_refreshed"]))]
    measures.evaluate(["total_revenue", "revenue_ytd"], ["year", "quarter", "category"])
    texts.append(written_plans["scratch/sold"])  # the facts are read once, for all that follows
    for text in texts:
        assert "customer_id" not in text
    assert "customer_id" in plan(measures.evaluate(["active_customers"], ["year"]))


def test_measures_of_no_orders_are_unknown(spark, warehouse):
    empty = Measures(warehouse, spark)
    empty.warehouse = SimpleNamespace(fct_orders=warehouse.fct_orders.filter("false"), store=warehouse.store)
    row = empty.evaluate(["total_revenue", "completed_orders", "gross_sales"]).first()
    assert row.asDict() == {"total_revenue": None, "completed_orders": None, "gross_sales": None}


def test_customer_windows_run_per_slice(spark, store, written_plans, warehouse):
    base = marts.customer_base(warehouse.fct_orders, warehouse.dim_customer, warehouse.params)
    placed = marts.placed_customers(base, store)
    assert "rangepartitioning" in next(p for n, p in written_plans.items() if "customers_by_value" in n)
    # what moves to one task has already been reduced to one row per slice, date bound or group
    for text in (plan(placed), *written_plans.values()):
        lines = text.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = next(x for x in lines[i + 1 :] if not re.search(r"Project|ColumnarToRow|WholeStage", x))
                assert "HashAggregate" in below or "SortAggregate" in below or "ObjectHashAggregate" in below, line


def test_a_hot_order_is_split_between_tasks(spark, store):
    """With one order holding most lines, the join reads its partition in several pieces."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        # a partition is split along the tasks that wrote it, so there must be several
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        lines = spark.range(60_000, numPartitions=8).select(
            F.when(F.col("id") % 3 > 0, "SO1").otherwise(F.concat(F.lit("SO"), F.col("id") % 500)).alias("order_id"),
            F.col("id").cast("int").alias("line_number"),
            F.lit("P1").alias("product_id"),
            F.lit(1).alias("quantity"),
            F.lit(2).cast("decimal(14,2)").alias("unit_price"),
            F.lit("b1").alias("_batch_id"),
            F.lit("2001-01-01").cast("timestamp_ntz").alias("_loaded_at"),
        )
        orders = spark.range(500).select(
            F.concat(F.lit("SO"), F.col("id")).alias("order_id"),
            F.lit("C1").alias("customer_id"),
            F.lit("2001-01-01").cast("timestamp_ntz").alias("order_ts"),
            F.lit("2001-01-01").cast("date").alias("order_date"),
            F.lit("completed").alias("status"),
            F.lit("web").alias("sales_channel"),
            F.lit("USD").alias("currency"),
            F.lit(0).cast("decimal(5,4)").alias("discount_pct"),
            F.lit("2001-01-01").cast("timestamp_ntz").alias("ingested_at"),
            F.lit("b1").alias("_batch_id"),
            F.lit("2001-01-01").cast("timestamp_ntz").alias("_loaded_at"),
        )
        rates = spark.createDataFrame([("USD",)], "currency string").withColumn("rate_to_usd", F.lit(1).cast("decimal(18,6)"))
        products = spark.createDataFrame([("P1", "x")], "product_id string, category string")
        tables = [store.write(n, df) for n, df in (("o", orders), ("f", rates), ("p", products))]
        items = staging.stg_order_items(store.write("l", lines.repartition(8)))
        converted = core.order_items_converted(items, *tables)
        counted = converted.groupBy("category").count()
        counted.collect()
        final = plan(counted)
        assert "SortMergeJoin(skew=true)" in final
        assert counted.first()["count"] == 60_000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_orders_do_not_wait_for_the_line_fact_or_clean_tables(spark, written_plans):
    w = Warehouse(feed.extracts(spark, SF), feed.BATCHES, Store.for_session(spark))
    orders = w.fct_orders
    assert not {"settled_order_items", "clean_orders", "fct_order_items", "stg_products"} & written_plans.keys()
    # lines and orders lie by order; the sums are sent once more, so that the join is free to split a hot order
    text = written_plans["fct_orders"]
    sums = text.index("partial_sum(line_amount_usd")
    assert "Exchange hashpartitioning" in text[:sums] and "product_id" not in text
    # the same rows as the way over the clean tables and the line fact
    assert orders.exceptAll(core.fct_orders(w.stg_orders, w.fct_order_items)).isEmpty()
    assert core.fct_orders(w.stg_orders, w.fct_order_items).exceptAll(orders).isEmpty()
    staged = staging.stg_order_items(w.raw("order_items"))
    assert staged.exceptAll(w.stg_order_items).isEmpty() and w.stg_order_items.exceptAll(staged).isEmpty()


def test_a_wide_key_set_does_not_move_the_rows_it_is_asked_for(spark, written_plans):
    feeds = feed.extracts(spark, SF)
    w = Warehouse(feeds, feed.BATCHES, Store.for_session(spark))
    orders, lines = w.judged_orders, w.judged_order_items
    assert written_plans["judged_orders"].count("LeftOuter") == 2
    # lines are judged where they are read: the few strangers are broadcast, and no line is shuffled
    assert "hashpartitioning" not in written_plans["judged_order_items"]
    for name, key in (
        ("unknown_customers", "customer_id"),
        ("unknown_orders", "order_id"),
        ("unknown_products", "product_id"),
    ):
        assert "LeftAnti" in written_plans[name] and re.search(rf"HashAggregate\(keys=\[{key}", written_plans[name])
        assert 0 < getattr(w, name).count() < 100
    expected = cleaning.judge_orders(feeds["orders"], w.settled_customers, w.settled_fx_rates, SCOPE)
    assert orders.exceptAll(expected).isEmpty() and expected.exceptAll(orders).isEmpty()
    expected = cleaning.judge_order_items(feeds["order_items"], w.settled_orders, w.settled_products, SCOPE)
    assert lines.exceptAll(expected).isEmpty() and expected.exceptAll(lines).isEmpty()
    assert lines.filter("reject_reason = 'unknown_product'").count() > 0


def test_a_missing_key_is_not_familiar(spark):
    from ledgerloom.operators.rules import mark_familiar, strangers

    rows = spark.createDataFrame([("a", "x"), (None, "x"), ("b", "x"), ("a", None)], "k string, s string")
    known = spark.createDataFrame([("a", "x")], "k string, s string")
    unknown = strangers(rows, "k", known, ["s"])
    got = {(r.k, r.s): r.ok for r in mark_familiar(rows, "k", unknown, "ok", ["s"]).collect()}
    assert got == {("a", "x"): True, (None, "x"): False, ("b", "x"): False, ("a", None): False}
    assert {(r.k, r.s): r.ok for r in mark_familiar(rows, "k", unknown.limit(0), "ok", ["s"]).collect()}[(None, "x")] is False
