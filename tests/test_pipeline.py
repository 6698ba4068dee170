"""End to end over files: two batches, idempotent reloads, history, audit, export."""

import json
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.quality import DataQualityError
from ledgerloom.plans import pipeline
from ledgerloom.plans.cleaning import transform_all
from ledgerloom.sources import feed, lake
from ledgerloom.sources.extracts import SOURCES, read_extract, read_extracts
from ledgerloom.sources.lake import load_staged, read_batches, replace_batch
from ledgerloom.sources.schemas import EXTRACT_COLUMNS, LANDED

SF = "/root/testdata/sf0.001"


def write_landing(spark, landing, change=lambda name, df: df):
    """The extracts as the source systems deliver them, each a folder of part files."""
    for name, df in feed.extracts(spark, SF).items():
        rows = df.filter("_batch_id = 'b1'").select(*EXTRACT_COLUMNS[name])
        if name == "customers":
            rows = rows.filter("updated_at > '1991'")
        rows = change(name, rows)
        spec = SOURCES[name]
        out = rows.coalesce(2).write.mode("overwrite")
        path = f"{landing}/{spec.system}/{spec.file}"
        if spec.format == "json":
            out.option("ignoreNullFields", False).json(path)
        else:
            out.option("header", True).option("escape", '"').csv(path)


@pytest.fixture(scope="module")
def env(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("e2e")
    landing, root = f"{base}/landing", f"{base}/lake"
    write_landing(spark, landing)
    pipeline.ingest(spark, landing, root, "20010101")
    pipeline.transform(spark, root, "20010101")
    return {"landing": landing, "lake": root, "base": base}


def table(spark, env, name):
    return pipeline.catalog(spark, env["lake"]).read(pipeline.place(name))


def totals(spark, env):
    return table(spark, env, "fct_orders").agg(F.count("*"), F.sum("net_revenue_usd")).first()


def test_all_marts_are_built_and_revenue_equals_a_separate_calculation(spark, env):
    for name in pipeline.Warehouse.CORE + pipeline.Warehouse.ANALYTICS:
        assert not table(spark, env, name).isEmpty(), name
    clean = {t: spark.read.parquet(f"{env['lake']}/clean/{t}/batch_id=20010101").toPandas() for t in LANDED}
    lines = clean["order_items"].merge(clean["orders"], on="order_id").merge(clean["fx_rates"], on="currency")
    lines = lines[lines["status"] == "completed"]
    expected = sum(
        round(q * p * r * (1 - d), 12)
        for q, p, r, d in zip(lines["quantity"], lines["unit_price"], lines["rate_to_usd"], lines["discount_pct"])
    )
    actual = table(spark, env, "monthly_revenue").agg(F.sum("revenue_usd")).first()[0]
    # every line is rounded to cents: half a cent each
    assert abs(actual - expected) <= Decimal("0.005") * len(lines)


def test_second_batch_is_idempotent_and_keeps_history(spark, env):
    before = totals(spark, env)
    target = table(spark, env, "dim_customer").filter("segment = 'Consumer'").agg(F.min("customer_id")).first()[0]

    def upgrade(name, df):
        if name != "customers":
            return df
        hit = F.upper(F.trim("customer_id")) == target
        return df.withColumns(
            {
                "segment": F.when(hit, "Enterprise").otherwise(F.col("segment")),
                "updated_at": F.when(hit, "2026-09-15 00:00:00").otherwise(F.col("updated_at")),
            }
        )

    landing = f"{env['base']}/landing2"
    write_landing(spark, landing, upgrade)
    pipeline.ingest(spark, landing, env["lake"], "20010102")
    pipeline.replay_batch(spark, env["lake"], "20010102")  # landing the same batch again changes nothing
    pipeline.transform(spark, env["lake"], "20010102")

    raw = read_batches(spark, f"{env['lake']}/raw/orders", LANDED["orders"])
    assert raw.select("_batch_id").distinct().count() == 2
    assert raw.groupBy("_batch_id", "order_id").count().filter("count > 1").isEmpty()
    assert totals(spark, env) == before
    history = table(spark, env, "dim_customer_history").filter(F.col("customer_id") == target).orderBy("valid_from")
    assert [(r.segment, r.is_current) for r in history.collect()] == [("Consumer", False), ("Enterprise", True)]
    now = table(spark, env, "dim_customer").filter(F.col("customer_id") == target).first()
    assert now.segment == "Enterprise"

    pipeline.transform(spark, env["lake"], "full", full_refresh=True)
    assert totals(spark, env) == before

    # a batch can be loaded again from its clean files
    landed = raw.filter("_batch_id = '20010101'").count()
    assert pipeline.replay_batch(spark, env["lake"], "20010101")["orders"] == landed


def test_audit_quarantine_and_report(spark, env):
    runs = spark.read.parquet(f"{env['lake']}/ops/pipeline_runs").orderBy("started_at").collect()
    ended = [r for r in runs if r.status != "running"]
    assert len(runs) == 2 * len(ended)
    assert [(r.stage, r.status) for r in ended[:2]] == [("ingest", "success"), ("transform", "success")]
    assert json.loads(ended[0].metrics)["rows_loaded"]["orders"] > 0
    checks = spark.read.parquet(f"{env['lake']}/ops/dq_results").filter("run_id = '20010101'")
    assert checks.count() == 27
    assert checks.filter("severity = 'error'").agg(F.bool_and("passed")).first()[0]
    rejects = spark.read.option("header", True).csv(f"{env['lake']}/rejects/orders/batch_id=20010101")
    assert "no_valid_items" in {r.reject_reason for r in rejects.select("reject_reason").distinct().collect()}
    report = spark.read.json(f"{env['lake']}/dq/batch_id=20010101").first()
    assert len(report.checks) == 27 and len(report.duplicates_removed) == 5 and report.run_id == "20010101"


def test_publish_exports_every_table(spark, env, tmp_path):
    exported = pipeline.publish(spark, env["lake"], str(tmp_path / "out"))
    assert set(exported) == set(pipeline.Warehouse.CORE + pipeline.Warehouse.ANALYTICS)
    people = spark.read.option("header", True).csv(str(tmp_path / "out/dim_customer"))
    assert people.filter("email NOT LIKE '*****@%'").isEmpty() and not people.isEmpty()
    kpi = spark.read.option("header", True).csv(str(tmp_path / "out/kpi_summary"))
    assert "paying_customers" in kpi.columns and kpi.count() == 1


def test_a_failed_gate_lands_nothing_but_leaves_evidence(spark, env, tmp_path):
    landing = str(tmp_path / "landing")

    def no_customers(name, df):
        return df.limit(0) if name == "customers" else df

    write_landing(spark, landing, no_customers)
    root = str(tmp_path / "lake")
    with pytest.raises(DataQualityError, match="min_rows"):
        pipeline.ingest(spark, landing, root, "bad")
    assert not Path(root, "raw").exists()
    run = spark.read.parquet(f"{root}/ops/pipeline_runs").filter("status <> 'running'").first()
    assert (run.stage, run.status) == ("ingest", "failed") and run.error_message.startswith("DataQualityError")
    assert spark.read.parquet(f"{root}/ops/dq_results").count() == 27
    assert Path(root, "rejects/orders/batch_id=bad").exists()


def test_missing_extract_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="customers.csv"):
        read_extract(spark, str(tmp_path), "customers")


def test_csv_reads_text_and_missing_tokens(spark, tmp_path):
    (tmp_path / "finance").mkdir()
    (tmp_path / "finance/fx_rates.csv").write_text('currency,rate_to_usd\nUSD,1.0\nNA,NaN\n"A ""b"", c",007\n')
    rows = read_extract(spark, str(tmp_path), "fx_rates").collect()
    assert {tuple(r) for r in rows} == {("USD", "1.0"), (None, None), ('A "b", c', "007")}


def test_unreadable_lines_are_quarantined_with_their_text(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "lake")
    (tmp_path / "landing/crm").mkdir(parents=True)
    (tmp_path / "landing/erp").mkdir()
    (tmp_path / "landing/catalog").mkdir()
    (tmp_path / "landing/finance").mkdir()
    customer = "C%d,Ann,Lee,ann@example.com,US,SMB,web,2024-01-01,2024-01-02"
    header = ",".join(EXTRACT_COLUMNS["customers"])
    short = "C2,Bo,Ray,bo@example.com,US,SMB,web,2024-01-01"  # the last field is missing
    quoted = 'C3,"Lee, Ann",Lee,ann@example.com,US,SMB,web,2024-01-01,2024-01-02'
    too_long = customer % 4 + ",2024-01-03"
    (tmp_path / "landing/crm/customers.csv").write_text("\n".join([header, customer % 1, short, quoted, too_long]) + "\n")
    order = '{"order_id": "O%d", "customer_id": "C1", "order_ts": "2024-02-01", "currency": "USD", "status": "completed"}'
    torn, no_object = (order % 2)[:40], "12"
    (tmp_path / "landing/erp/orders.jsonl").write_text("\n".join([order % 1, torn, no_object, "", order % 3]) + "\n")
    (tmp_path / "landing/erp/order_items.csv").write_text("order_id,line_number,product_id,quantity,unit_price\nO1,1,P1,1,2\nO3,1,P1,1,2\n")
    (tmp_path / "landing/catalog/products.csv").write_text("product_id,product_name,category,list_price_usd\nP1,Pen,office,2\n")
    (tmp_path / "landing/finance/fx_rates.csv").write_text("currency,rate_to_usd\nUSD,1\n")

    cleaned = transform_all(read_extracts(spark, landing))
    for table, kept in (("customers", ["C1", "C2", "C3"]), ("orders", ["O1", "O3"])):
        data = cleaned[table].data
        assert set(data.columns) == set(EXTRACT_COLUMNS[table])
        assert sorted(r[0] for r in data.select(data.columns[0]).collect()) == kept
    bad = {t: {(r["reject_reason"], r["_line"], r["_source_file"].split("/")[-1]) for r in cleaned[t].rejects.collect()} for t in cleaned}
    assert bad["customers"] == {("unreadable_line", too_long, "customers.csv")}
    assert bad["orders"] == {("unreadable_line", torn, "orders.jsonl"), ("unreadable_line", no_object, "orders.jsonl")}
    assert not bad["products"] and not bad["fx_rates"] and not bad["order_items"]

    # every raw row is accounted for, and the text is in the files of the quarantine
    pipeline.ingest(spark, landing, root, "b")
    results = spark.read.parquet(f"{root}/ops/dq_results").filter("check_name = 'row_reconciliation'").collect()
    assert len(results) == 5 and all(r.passed for r in results), results
    kept = spark.read.options(header=True, escape='"').csv(f"{root}/rejects/orders/batch_id=b")
    assert {r["_line"] for r in kept.collect()} == {torn, no_object}


def test_reloading_a_batch_replaces_it_and_an_empty_one_clears_it(spark, tmp_path):
    path = str(tmp_path / "things")
    df = spark.createDataFrame([(1,), (2,)], "id int")
    for batch in ("1", "1", "2"):
        replace_batch(df, path, batch)
    counts = {r["_batch_id"]: r["count"] for r in read_batches(spark, path, df.schema).groupBy("_batch_id").count().collect()}
    assert counts == {"1": 2, "2": 2}
    replace_batch(df.limit(0), path, "1")
    assert {r["_batch_id"] for r in read_batches(spark, path, df.schema).collect()} == {"2"}
    with pytest.raises(ValueError):
        replace_batch(df, path, "../x")


def test_staged_columns_match_in_any_case(spark, tmp_path):
    staged, raw = str(tmp_path / "staged"), str(tmp_path / "raw")
    df = spark.createDataFrame([("USD", "1.5", datetime(2024, 1, 1))], "RATE_TO_USD string, Currency string, _LOADED_AT timestamp_ntz")
    df = df.withColumnsRenamed({"RATE_TO_USD": "Currency2"}).withColumnRenamed("Currency", "RATE_TO_USD")
    df.withColumnRenamed("Currency2", "CURRENCY").write.parquet(f"{staged}/batch_id=x")
    assert load_staged(spark, staged, raw, LANDED["fx_rates"], "x") == 1
    row = read_batches(spark, raw, LANDED["fx_rates"]).first()
    assert (row.currency, row.rate_to_usd, row["_batch_id"]) == ("USD", Decimal("1.5"), "x")


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    (tmp_path / "finance").mkdir()
    path = tmp_path / "finance/fx_rates.csv"
    path.write_text('rate_to_usd,note,currency\n1.5,"a, b",EUR\n')
    assert [tuple(r) for r in read_extract(spark, str(tmp_path), "fx_rates").collect()] == [("EUR", "1.5")]
    path.write_text("rate,currency\n1.5,EUR\n")
    with pytest.raises(ValueError, match="rate_to_usd"):
        read_extract(spark, str(tmp_path), "fx_rates")


def test_written_csv_reads_back(spark, tmp_path):
    rows = [('say "hi"', " a "), ("x,y", "line"), (None, "z")]
    lake.write_csv(spark.createDataFrame(rows, "a string, b string"), str(tmp_path / "t"))
    back = spark.read.options(header=True, escape='"').csv(str(tmp_path / "t"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_a_failed_test_leaves_the_tables_before_and_publishes_nothing(spark, env, monkeypatch, tmp_path):
    before = totals(spark, env), pipeline.catalog(spark, env["lake"]).version()
    broken = spark.createDataFrame([("t", "c", "error", False, 1, "1 rows")], "table_name string, check_name string, severity string, passed boolean, failures long, detail string")
    with monkeypatch.context() as m:
        m.setattr(pipeline.checks, "model_tests", lambda built: broken)
        with pytest.raises(DataQualityError, match="t.c"):
            pipeline.transform(spark, env["lake"], "bad-tests", full_refresh=True)
    assert (totals(spark, env), pipeline.catalog(spark, env["lake"]).version()) == before
    with pytest.raises(DataQualityError, match="failed"):
        pipeline.publish(spark, env["lake"], str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()
    pipeline.transform(spark, env["lake"], "good-tests")
    assert totals(spark, env) == before[0]


def test_freshness_stops_the_day(spark, env):
    assert set(pipeline.check_freshness(spark, env["lake"], pipeline.utc_now()).values()) == {"pass"}
    with pytest.raises(DataQualityError, match="orders"):
        pipeline.check_freshness(spark, env["lake"], pipeline.utc_now() + timedelta(hours=51))


def test_old_batches_leave_the_landing_tables_only(spark, env):
    assert pipeline.expire(spark, env["lake"], pipeline.utc_now()) == []
    later = pipeline.utc_now() + timedelta(days=91)
    dropped = pipeline.expire(spark, env["lake"], later)
    assert sorted(dropped) == sorted(f"{t}/{b}" for t in ("orders", "order_items") for b in ("20010101", "20010102"))
    # what is known only from an old batch still belongs to later orders
    assert not read_batches(spark, f"{env['lake']}/raw/products", LANDED["products"]).isEmpty()
    assert read_batches(spark, f"{env['lake']}/raw/orders", LANDED["orders"]).isEmpty()
    assert not spark.read.parquet(f"{env['lake']}/clean/orders").isEmpty()
