import re
from datetime import date, datetime

from pyspark.sql import functions as F

from ledgerloom.functions.temporal import _parse_zoned, calendar_months, parse_date, parse_utc
from ledgerloom.functions.text import strip, title_case
from ledgerloom.operators.rules import rejected
from ledgerloom.plans import cleaning
from ledgerloom.plans.warehouse import SCOPE

CUSTOMER = "customer_id first_name last_name email country segment acquisition_channel signup_date updated_at".split()
ORDER = "order_id customer_id order_ts currency status sales_channel discount_pct ingested_at".split()
ITEM = "order_id line_number product_id quantity unit_price".split()


def text_frame(spark, columns, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def one_column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def reasons(judged, key):
    return {r[key]: r["reject_reason"] for r in rejected(judged).collect()}


def test_customers_are_standardised_and_the_latest_version_kept(spark):
    raw = text_frame(
        spark,
        CUSTOMER,
        [
            ("C1", "  ada ", "lovelace", "ADA@Example.com", "uk", "CONSUMER", "Organic", "2024-03-01", "2024-05-01 00:00:00"),
            ("C1", "ADA", "Lovelace", "ada@example.com", "GB", "consumer", "Organic", "01 Mar 2024", "2022-12-31 00:00:00"),
            ("c2", "Grace", "hopper", "grace@example.com", None, "smb", "Referral", "15 Jan 2025", "2025-02-01 00:00:00"),
            ("C3", "Alan", "turing", "not-an-email", "US", "Enterprise", "Partner", "2023-06-30", "2023-07-01 00:00:00"),
        ],
    )
    judged = cleaning.judge_customers(raw)
    rows = {r.customer_id: r for r in cleaning.settle(judged, "customers").collect()}
    assert set(rows) == {"C1", "C2"}
    assert cleaning.duplicates(judged, "customers").first()[0] == 1
    assert (rows["C1"].first_name, rows["C1"].email, rows["C1"].country) == ("Ada", "ada@example.com", "GB")
    assert (rows["C2"].country, rows["C2"].segment, rows["C2"].signup_date) == ("UNKNOWN", "SMB", date(2025, 1, 15))
    assert reasons(judged, "customer_id") == {"C3": "invalid_email"}


def test_orders_reject_in_rule_order_and_keep_the_latest_delivery(spark):
    raw = text_frame(
        spark,
        ORDER,
        [
            ("SO1", "C1", "2025-01-01T10:00:00Z", "usd", "COMPLETED", "web", "0.1", "2025-01-01T11:00:00Z"),
            ("SO1", "C1", "2025-01-01 10:00:00", "USD", "refunded", "web", "0.1", "2025-01-05T00:00:00Z"),
            ("SO2", "C1", None, "USD", "completed", "web", "0", "2025-01-01T11:00:00Z"),
            ("SO3", "C404", "2025-01-02T10:00:00Z", "USD", "completed", "web", "0", "2025-01-02T11:00:00Z"),
            ("SO4", "C1", "2025-01-03T10:00:00Z", "XYZ", "completed", "web", "0.9", "2025-01-03T11:00:00Z"),
            # breaks two rules: the earlier one names it
            ("SO5", "C404", None, "USD", "completed", "web", "0", "2025-01-03T11:00:00Z"),
        ],
    )
    customers = spark.createDataFrame([("C1",)], "customer_id string")
    rates = spark.createDataFrame([("USD",)], "currency string")
    judged = cleaning.judge_orders(raw, customers, rates)
    kept = cleaning.settle(judged, "orders").collect()
    assert [(r.order_id, r.status) for r in kept] == [("SO1", "refunded")]
    assert cleaning.duplicates(judged, "orders").first()[0] == 1
    assert reasons(judged, "order_id") == {
        "SO2": "missing_order_ts",
        "SO3": "orphan_customer",
        "SO4": "unknown_currency",
        "SO5": "missing_order_ts",
    }


def test_order_items_reject_invalid_lines(spark):
    raw = text_frame(
        spark,
        ITEM,
        [
            ("SO1", "1", "p0001", "2", "10.5"),
            ("SO1", "2", "P0001", "0", "10"),
            ("SO1", "3", "P0001", "1", None),
            ("SO9", "1", "P0001", "1", "3"),
            ("SO1", "1", "P0001", "2", "10.5"),
            ("SO1", "4", "P0001", "2.5", "3"),
            ("SO1", "5", "P0001", "1", "NaN"),
            ("SO1", None, "P0001", "1", "3"),
            ("SO1", "6", "P9", "1", "3"),
        ],
    )
    orders = spark.createDataFrame([("SO1",)], "order_id string")
    products = spark.createDataFrame([("P0001",)], "product_id string")
    judged = cleaning.judge_order_items(raw, orders, products)
    kept = cleaning.settle(judged, "order_items").collect()
    assert [(r.product_id, r.line_number, r.quantity) for r in kept] == [("P0001", 1, 2)]
    assert cleaning.duplicates(judged, "order_items").first()[0] == 1
    assert sorted(r.reject_reason for r in rejected(judged).collect()) == [
        "invalid_unit_price", "invalid_unit_price", "missing_line_number", "non_positive_quantity",
        "non_positive_quantity", "orphan_order", "unknown_product",
    ]


def test_values_beyond_their_types_have_reasons_of_their_own(spark):
    orders = spark.createDataFrame([("SO1",)], "order_id string")
    products = spark.createDataFrame([("P1",)], "product_id string")
    lines = [
        ("10000000", "999.99", None),
        ("7", "10000000000.00", None),
        ("1", "1000000000000.00", "unit_price_out_of_range"),
        ("1", "999999999999.999", "unit_price_out_of_range"),
        ("2147483648", "1", "quantity_out_of_range"),
        ("2147483647", "999999999999.99", "amount_out_of_range"),
        ("-99999999999", "1", "non_positive_quantity"),
        ("1", "-1000000000000000", "invalid_unit_price"),
    ]
    raw = text_frame(spark, ITEM, [("SO1", str(i), "P1", q, p) for i, (q, p, _) in enumerate(lines, 1)])
    judged = {r.line_number: r.reject_reason for r in cleaning.judge_order_items(raw, orders, products).collect()}
    assert judged == {i: why for i, (_, _, why) in enumerate(lines, 1)}
    rates = text_frame(spark, ["currency", "rate_to_usd"], [("A", "999999.999999"), ("B", "1000000"), ("C", "-5"), ("D", "x")])
    assert reasons(cleaning.judge_fx_rates(rates), "currency") == {"B": "rate_out_of_range", "C": "invalid_rate", "D": "invalid_rate"}
    listed = text_frame(spark, ["product_id", "product_name", "category", "list_price_usd"], [("P1", "a", "b", "10000000000"), ("P2", "a", "b", "1")])
    assert reasons(cleaning.judge_products(listed), "product_id") == {"P1": "price_out_of_range"}


def test_large_amounts_stay_exact(spark):
    from decimal import Decimal

    from ledgerloom.plans.core import order_items_converted

    items = spark.sql("SELECT 'i' AS order_item_id, 'SO1' AS order_id, 1 AS line_number, 'P' AS product_id, 2147483647 AS quantity, CAST(4656612.87 AS DECIMAL(14,2)) AS unit_price_local, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS _loaded_at")
    orders = spark.sql("SELECT 'SO1' AS order_id, 'C' AS customer_id, DATE'2024-01-01' AS order_date, 'completed' AS status, 'X' AS currency, CAST(0.1234 AS DECIMAL(5,4)) AS discount_pct, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ingested_at, 'b' AS _batch_id, TIMESTAMP_NTZ'2024-01-01 00:00:00' AS _loaded_at")
    rates = spark.sql("SELECT 'X' AS currency, CAST(999999.999999 AS DECIMAL(18,6)) AS rate_to_usd")
    products = spark.sql("SELECT 'P' AS product_id, 'c' AS category")
    row = order_items_converted(items, orders, rates, products).first()
    local = 2147483647 * Decimal("4656612.87")
    exact = local * Decimal("999999.999999")
    assert row.line_amount_local == local
    assert abs(row.line_amount_usd - exact) <= Decimal("0.005")
    assert abs(row.net_revenue_usd - exact * Decimal("0.8766")) <= Decimal("0.005")


def test_an_unreadable_update_stamp_wins(spark):
    row = ("C1", "A", "B", "a@b.com", "US", "smb", "x", "2024-01-01")
    raw = text_frame(spark, CUSTOMER, [(*row, "2024-05-01 00:00:00"), (*row[:1], "Z", *row[2:], "soon")])
    kept = cleaning.settle(cleaning.judge_customers(raw), "customers").collect()
    assert [(r.first_name, r.updated_at) for r in kept] == [("Z", None)]


def test_order_without_valid_lines_is_rejected(spark):
    orders = spark.createDataFrame([("SO1",), ("SO2",)], "order_id string")
    items = spark.createDataFrame([("SO1",)], "order_id string")
    filled, empty = cleaning.split_empty_orders(orders, items)
    assert [r.order_id for r in filled.collect()] == ["SO1"]
    assert [(r.order_id, r.reject_reason) for r in empty.collect()] == [("SO2", "no_valid_items")]


def test_discount_is_clipped_not_rejected(spark):
    rows = [(f"SO{i}", "C1", "2025-01-01T10:00:00Z", "USD", "completed", None, d, "2025-01-01T11:00:00Z")
            for i, d in enumerate(["0.9", "-1", "n/a", None, "12", "0.25"])]
    customers = spark.createDataFrame([("C1",)], "customer_id string")
    rates = spark.createDataFrame([("USD",)], "currency string")
    judged = cleaning.judge_orders(text_frame(spark, ORDER, rows), customers, rates).orderBy("order_id")
    assert [float(r.discount_pct) for r in judged.collect()] == [0.5, 0, 0, 0, 0.5, 0.25]
    assert {r.sales_channel for r in judged.collect()} == {"unknown"}


def test_strip_takes_every_kind_of_white_space(spark):
    values = ["  x\t", "　", "", None, "a b", "\n y "]
    assert one_column(spark, values, strip) == ["x", None, None, None, "a b", "y"]


def test_title_case_starts_a_word_after_every_non_letter(spark):
    values = ["o'brien-smith", "MARY jane", "éric", "r2d2", None]
    assert one_column(spark, values, title_case) == ["O'Brien-Smith", "Mary Jane", "Éric", "R2D2", None]


def test_dates_in_mixed_formats(spark):
    values = ["2024-03-01", "01 Mar 2024", "03/04/2024", "2024-02-30", "soon", "2024-3-1", "1 Mar 2024", None]
    parsed = one_column(spark, values, parse_date)
    assert parsed[:5] == [date(2024, 3, 1), date(2024, 3, 1), date(2024, 3, 4), None, None]
    assert parsed[7] is None


def test_offsets_become_utc_in_any_session_zone(spark):
    values = [
        "2024-11-03T05:30:00Z",  # inside the hour New York repeats
        "2024-11-03T06:30:00Z",
        "2024-03-10T02:30:00",  # an hour New York skips
        "2024-06-01T12:00:00+02:00",
        "2024-06-01T12:00:00-0530",
        "2024-06-01 12:00:00.250",
        "2024-06-01",
        "2024-06-01T12:00:00+02",
        "2024-06-01 12:00:00 -02:30",
        "2024-06-01T12:00:00 CET",
        "2024-06-01T12:00:00 Europe/Paris",
        "never",
    ]
    assert one_column(spark, values, parse_utc) == [
        datetime(2024, 11, 3, 5, 30),
        datetime(2024, 11, 3, 6, 30),
        datetime(2024, 3, 10, 2, 30),
        datetime(2024, 6, 1, 10, 0),
        datetime(2024, 6, 1, 17, 30),
        datetime(2024, 6, 1, 12, 0, 0, 250000),
        datetime(2024, 6, 1),
        datetime(2024, 6, 1, 10, 0),
        datetime(2024, 6, 1, 14, 30),
        None,
        None,
        None,
    ]


def test_usual_stamps_are_read_as_those_searched_for_a_zone(spark):
    values = [
        "2024-03-01T10:30:00Z", "2024-03-01T10:30:00", "2024-03-01 10:30:00", "2024-02-30T10:30:00Z", "2024-03-01T24:30:00Z",
        "2024-03-01T10:30:00Z\n", "2024-03-01T10:30:00 Z", "2024-03-01T10:30:00z", "2024-03-01T10:30:00.5Z", "2024-03-01", "x", "", None,
    ]
    assert one_column(spark, values, parse_utc) == one_column(spark, values, _parse_zoned)


def test_code_that_reads_stamps_stays_small_enough_to_be_compiled(spark):
    """The JVM does not compile a method of 8000 bytes or more, so every row would be interpreted."""
    df = spark.range(9).select(F.concat(F.lit("2024-03-01T10:30:0"), "id", F.lit("Z")).alias("x"), F.lit(None).cast("string").alias("y"))
    read = df.repartition(2).select(parse_utc(F.col("x")), parse_utc(F.col("y")))
    text = spark._sc._jvm.PythonSQLUtils.explainString(read._jdf.queryExecution(), "codegen")
    assert all(int(size) < 8000 for size in re.findall(r"maxMethodCodeSize:(\d+)", text)), text[:200]
    assert "lambdafunction" in plan(read)


def test_lines_travel_without_helper_columns(spark, warehouse):
    text = plan(cleaning.judge_order_items(warehouse.extracts["order_items"], warehouse.settled_orders, warehouse.settled_products, SCOPE))
    joins = text.index("Join")
    assert "_own_reason" in text[joins:] and not re.search(r"[ ,(\[]_(quantity|price)#", text[:joins])


def test_months_are_counted_by_boundaries(spark):
    df = spark.createDataFrame([(date(2024, 1, 31), date(2024, 2, 1)), (date(2023, 12, 1), date(2024, 12, 31))], "a date, b date")
    assert [r[0] for r in df.select(calendar_months(F.col("a"), F.col("b"))).collect()] == [1, 12]


def test_input_order_and_partitions_do_not_change_the_result(spark, warehouse):
    from ledgerloom.plans.warehouse import SCOPE

    judged = warehouse.judged_order_items
    shuffled = judged.repartition(7, "quantity").sortWithinPartitions(F.col("unit_price").desc())
    again = cleaning.settle(shuffled, "order_items", SCOPE).drop("_src_pos")
    assert again.exceptAll(warehouse.settled_order_items).isEmpty()
    assert warehouse.settled_order_items.exceptAll(again).isEmpty()
