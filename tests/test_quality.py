import pytest

from ledgerloom.operators import quality as q
from ledgerloom.plans import checks


def tables(spark, status="completed"):
    def one(schema, *row):
        return spark.createDataFrame([row], schema)

    return {
        "customers": one("customer_id string, email string, signup_date string, segment string", "C1", "a@b.com", "2024-01-01", "SMB"),
        "orders": one(
            "order_id string, customer_id string, order_ts string, status string, currency string",
            "SO1", "C1", "2024-02-01", status, "USD",
        ),
        "order_items": one(
            "order_id string, line_number int, product_id string, quantity int, unit_price double", "SO1", 1, "P1", 1, 9.99
        ),
        "products": one("product_id string, list_price_usd double", "P1", 9.99),
        "fx_rates": one("currency string, rate_to_usd double", "USD", 1.0),
    }


def test_clean_tables_pass_all_17_checks(spark):
    results = checks.gate_checks(tables(spark))
    assert results.count() == 17
    q.assert_passed(results)


def test_gate_raises_and_names_the_check(spark):
    with pytest.raises(q.DataQualityError, match="accepted_values"):
        q.assert_passed(checks.gate_checks(tables(spark, "shipped")))


def test_empty_table_fails_the_row_minimum(spark):
    broken = tables(spark)
    broken["customers"] = broken["customers"].limit(0)
    failed = {(r.table_name, r.check_name) for r in checks.gate_checks(broken).filter("not passed").collect()}
    assert failed == {("customers", "min_rows(1)"), ("orders", "relationship(customer_id -> customer_id)")}


def test_duplicates_and_orphans_are_counted(spark):
    ids = spark.createDataFrame([(1,), (1,), (2,), (1,)], "id int")
    keys = spark.createDataFrame([(1,), (3,), (None,), (3,)], "fk int")
    assert q.check_unique(ids, "t", ["id"]).first().failures == 2
    # and it counts NULL as a key
    assert q.check_unique(keys, "t", ["fk"]).first().failures == 1
    nulls = keys.unionByName(keys.filter("fk IS NULL"))
    assert q.check_unique(nulls, "t", ["fk"]).first().failures == 2
    assert q.check_unique(nulls, "t", ["fk"], nulls_count=False).first().failures == 1
    # the gate counts NULL as an orphan, the model tests do not
    assert q.check_relationship(keys, "t", "fk", ids, "id").first().failures == 3
    assert q.check_relationship(keys, "t", "fk", ids, "id", null_is_orphan=False).first().failures == 2


def test_nulls_pass_value_checks(spark):
    df = spark.createDataFrame([(None, None), (-1, "x"), (5, "a")], "n int, s string")
    results = q.check_columns(
        df,
        "t",
        [q.positive("n"), q.accepted_values("s", ["a"]), q.accepted_range("n", 0, 4), q.expression_is_true("n > 0"), q.not_null("n", "s")],
    )
    assert {r.check_name.split("(")[0]: r.failures for r in results.collect()} == {
        "positive": 1, "accepted_values": 1, "accepted_range": 2, "expression_is_true": 1, "not_null": 2,
    }


def test_scopes_without_rows_still_report(spark):
    scopes = spark.createDataFrame([("b1",), ("b2",)], "_batch_id string")
    df = spark.createDataFrame([("b1", 1)], "_batch_id string, n int")
    results = q.check_columns(df, "t", [q.min_rows(1), q.positive("n")], ["_batch_id"], scopes)
    assert {(r._batch_id, r.check_name): r.passed for r in results.collect()} == {
        ("b1", "min_rows(1)"): True, ("b1", "positive(n)"): True,
        ("b2", "min_rows(1)"): False, ("b2", "positive(n)"): True,
    }


def test_fixed_calendar_ends_can_fail_the_fact(spark, warehouse):
    from datetime import date

    from ledgerloom.params import Params
    from ledgerloom.plans import core

    def orphans(**ends):
        days = core.dim_date(warehouse.fct_orders, Params(**ends))
        return q.check_relationship(warehouse.fct_orders, "fct_orders", "order_date", days, "date_day").first().failures

    assert orphans(calendar_start=date(1990, 1, 1), calendar_end=date(2002, 1, 1)) == 0
    assert orphans(calendar_start=date(1998, 1, 1), calendar_end=date(2002, 1, 1)) > 0


def test_every_raw_row_is_accounted_for(warehouse):
    from ledgerloom.plans.warehouse import SCOPE
    from ledgerloom.queries import _accounts

    rows = checks.reconciliation(_accounts(warehouse), SCOPE).filter("check_name = 'row_reconciliation'").collect()
    assert len(rows) == 10 and all(r.passed for r in rows)


def test_all_61_model_tests_pass(warehouse):
    results = checks.model_tests(warehouse).collect()
    assert len(results) == 61
    assert [r for r in results if not r.passed] == []


def test_counts_taken_while_writing_equal_those_of_a_scan(spark, tmp_path):
    rows = [("b1", 1, "a"), ("b1", -1, None), ("b2", 5, "x"), ("b2", None, "a"), ("b2", 0, "a")]
    df = spark.createDataFrame(rows, "_batch_id string, n int, s string").repartition(3)
    asked = [q.min_rows(2), q.positive("n"), q.accepted_values("s", ["a"]), q.accepted_range("n", 0, 4), q.expression_is_true("n > 0"), q.not_null("n", "s")]
    scopes = spark.createDataFrame([("b1",), ("b2",), ("b3",)], "_batch_id string")
    counted, told = q.counting(df, {"t": asked, "u": asked[:1]}, "_batch_id", ["b1", "b2", "b3"])
    counted.write.parquet(str(tmp_path / "t"))
    counts = told()
    want = q.check_columns(df, "t", asked, ["_batch_id"], scopes)
    got = q.counted_checks(spark, "t", asked, counts["t"], ["_batch_id"])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert counts["u"] == {b: {"min_rows(2)": n} for b, n in (("b1", 0), ("b2", 0), ("b3", 2))}
    whole, told = q.counting(df.limit(0), {"t": asked})
    whole.write.parquet(str(tmp_path / "none"))
    got, want = q.counted_checks(spark, "t", asked, told()["t"]), q.check_columns(df.limit(0), "t", asked)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_column_checks_read_no_table_again(warehouse):
    tests = checks.model_column_tests(warehouse)
    assert len(tests) == len(checks.column_tests()) and not any(map(scans, tests))
    clean = {t: warehouse.clean(t) for t in checks.gate()}
    scopes = warehouse.extracts["customers"].select("_batch_id").distinct()
    counts = checks.gate_counts(warehouse.observed)
    assert set(counts) == {t for t, asked in checks.gate().items() if asked.columns}
    with_counts = checks.gate_checks(clean, ["_batch_id"], scopes, counts)
    assert scans(with_counts) < scans(checks.gate_checks(clean, ["_batch_id"], scopes))
