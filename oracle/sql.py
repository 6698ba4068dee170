"""The expected results in DuckDB SQL.

Written apart from the Spark jobs and on another footing: amounts are whole cents, rates whole
millionths and discounts whole basis points, so that every rounding is an integer division. A query
is a final SELECT; the common table expressions it needs are put in front of it.
"""

from __future__ import annotations

import re


def half_up(num: str, den: str) -> str:
    """num / den rounded half away from zero, as an integer; NULL if den is 0. den may be negative."""
    return (
        f"(CASE WHEN ({den}) = 0 THEN NULL ELSE sign(({num})::HUGEINT)::HUGEINT * sign(({den})::HUGEINT)::HUGEINT * "
        f"((2 * abs(({num})::HUGEINT) + abs(({den})::HUGEINT)) // (2 * abs(({den})::HUGEINT))) END)"
    )


def rate(num: str, den: str, places: int) -> str:
    return f"({half_up(f'({num})::HUGEINT * {10**places}', den)}::DOUBLE / {10**places})"


def usd(cents: str) -> str:
    return f"(({cents})::DOUBLE / 100)"


def text_list(*values: str) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


COUNTRIES = text_list("US", "GB", "DE", "FR", "IN", "CA", "AU")
CURRENCIES = text_list("USD", "GBP", "EUR", "EUR", "INR", "CAD", "AUD")
CHANNELS = text_list("Newsletter", "Trade Fair", "Search", "Reseller", "Word of Mouth")
FIRST_NAMES = text_list("Ada", "Grace", "Alan", "Mary-Jane", "Edsger", "Barbara")
LAST_NAMES = text_list("Lovelace", "O'Brien", "Turing", "Hopper", "Van Rossum")
DISCOUNTS = text_list("0.05", "0.1", "0.15", "0.2")


def strip(x: str) -> str:
    return rf"nullif(regexp_replace({x}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'), '')"


def title(x: str) -> str:
    return (
        rf"array_to_string(list_transform(regexp_extract_all({x}, '\p{{L}}+|[^\p{{L}}]+'), "
        "lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


def as_date(x: str) -> str:
    forms = ", ".join(f"try_strptime({x}, '{f}')" for f in ("%Y-%m-%d", "%d %b %Y", "%m/%d/%Y"))
    return f"coalesce({forms})::DATE"


def as_utc(x: str) -> str:
    return (
        f"CASE WHEN {x} LIKE '%Z' THEN try_cast(rtrim({x}, 'Z') AS TIMESTAMP) "
        f"WHEN {x} LIKE '%+02:00' THEN try_cast(rtrim(left({x}, length({x}) - 6)) AS TIMESTAMP) - INTERVAL 2 HOUR "
        f"WHEN {x} LIKE '%+02' THEN try_cast(left({x}, length({x}) - 3) AS TIMESTAMP) - INTERVAL 2 HOUR "
        f"WHEN {x} LIKE '%CET' THEN NULL "
        f"ELSE try_cast({x} AS TIMESTAMP) END"
    )


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S')"


def reason(*rules: tuple[str, str]) -> str:
    whens = " ".join(f"WHEN coalesce({broken}, true) THEN '{name}'" for name, broken in rules)
    return f"CASE {whens} END"


def loaded(name: str) -> str:
    return (
        "CASE _batch_id WHEN 'b1' THEN TIMESTAMP '2001-12-01 02:00:00' "
        f"ELSE TIMESTAMP '2001-12-02 02:00:00' END AS {name}"
    )


CTE: dict[str, str] = {}

# ---- the extracts -----------------------------------------------------------------------------

CTE["x_customers"] = f"""
SELECT CASE WHEN kind <> 'noid' THEN (CASE WHEN k % 10 = 0 THEN 'c' ELSE 'C' END) || k END AS customer_id,
       CASE WHEN k % 20 = 0 THEN '  ' || lower(fn) || ' ' ELSE fn END AS first_name,
       CASE WHEN k % 7 = 3 THEN lower(ln) ELSE ln END AS last_name,
       CASE WHEN k % 250 = 9 THEN 'not-an-email'
            WHEN k % 12 = 0 THEN 'CUSTOMER.' || k || '@EXAMPLE.COM'
            ELSE 'customer.' || k || '@example.com' END AS email,
       CASE WHEN k % 97 = 0 THEN NULL WHEN co = 'GB' AND k % 3 = 0 THEN 'uk' ELSE co END AS country,
       CASE WHEN k % 25 = 0 THEN upper(seg) ELSE seg END AS segment,
       CASE WHEN k % 90 = 4 THEN '' ELSE ({CHANNELS})[k % 5 + 1] END AS acquisition_channel,
       CASE WHEN k % 250 = 13 THEN '2024-02-30'
            WHEN k % 4 = 0 THEN strftime(signup, '%d %b %Y')
            ELSE strftime(signup, '%Y-%m-%d') END AS signup_date,
       CASE WHEN kind = 'stale' THEN '1990-01-01 00:00:00'
            ELSE strftime(signup + (k % 400 + CASE WHEN batch = 'b2' AND k % 10 = 5 THEN 1460 ELSE 0 END)::INTEGER,
                          '%Y-%m-%d') || CASE WHEN k % 60 = 30 THEN 'T02:00:00+02:00' ELSE ' 00:00:00' END END
            AS updated_at,
       batch AS _batch_id,
       kind AS _pos
FROM (
    SELECT c_custkey AS k, batch, kind,
           ({FIRST_NAMES})[c_custkey % 6 + 1] AS fn,
           ({LAST_NAMES})[c_custkey % 5 + 1] AS ln,
           ({COUNTRIES})[c_custkey % 7 + 1] AS co,
           DATE '1994-01-01' + (c_custkey % 365)::INTEGER AS signup,
           CASE WHEN c_custkey % 250 = 11 THEN 'other'
                WHEN batch = 'b2' AND c_custkey % 10 = 5 THEN 'Enterprise'
                WHEN c_mktsegment = 'BUILDING' THEN 'Enterprise'
                WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'SMB'
                ELSE 'Consumer' END AS seg
    FROM customer, (VALUES ('b1', 'main'), ('b1', 'stale'), ('b1', 'noid'), ('b2', 'main')) d(batch, kind)
    WHERE (batch = 'b1' AND kind = 'main')
       OR (kind = 'stale' AND c_custkey % 50 = 0)
       OR (kind = 'noid' AND c_custkey = 0)
       OR (batch = 'b2' AND c_custkey % 40 <> 6)
)
"""

CTE["x_orders"] = f"""
SELECT CASE WHEN kind <> 'noid' THEN 'SO' || k END AS order_id,
       (CASE WHEN k % 250 = 3 THEN 'CX' ELSE 'C' END) || c AS customer_id,
       CASE WHEN k % 333 = 5 THEN NULL
            WHEN k % 5 = 0 THEN strftime(placed, '%Y-%m-%d %H:%M:%S')
            WHEN k % 77 = 11 THEN {iso("placed + INTERVAL 2 HOUR")} || '+02:00'
            WHEN k % 77 = 12 THEN {iso("placed + INTERVAL 2 HOUR")} || '+02'
            WHEN k % 77 = 13 THEN {iso("placed + INTERVAL 2 HOUR")} || ' +02:00'
            WHEN k % 770 = 14 THEN {iso("placed")} || ' CET'
            ELSE {iso("placed")} || 'Z' END AS order_ts,
       CASE WHEN k % 20 = 7 THEN lower(cur) ELSE cur END AS currency,
       CASE WHEN k % 33 = 0 THEN upper(st) ELSE st END AS status,
       CASE WHEN k % 400 = 2 THEN NULL
            ELSE CASE left(o_orderpriority, 1) WHEN '1' THEN 'sales_rep' WHEN '2' THEN 'web'
                 WHEN '3' THEN 'mobile_app' ELSE 'marketplace' END END AS sales_channel,
       CASE WHEN k % 640 = 4 THEN '0.9' WHEN k % 710 = 8 THEN 'n/a'
            WHEN k % 10 < 3 THEN ({DISCOUNTS})[k % 4 + 1] ELSE '0' END AS discount_pct,
       CASE WHEN kind <> 'again' THEN {iso("placed + to_seconds(k % 86340 + 60)")} || 'Z'
            WHEN batch = 'b1' THEN '2001-10-15T00:00:00Z'
            ELSE '2001-11-30T00:00:00Z' END AS ingested_at,
       batch AS _batch_id,
       kind AS _pos
FROM (
    SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority, batch, kind,
           o_orderdate + INTERVAL 8 HOUR + to_seconds(o_orderkey % 54000) AS placed,
           CASE WHEN o_orderkey % 500 = 13 THEN 'XYZ' ELSE ({CURRENCIES})[o_custkey % 7 + 1] END AS cur,
           CASE WHEN o_orderkey % 500 = 9 THEN 'shipped'
                WHEN kind = 'again' OR o_orderkey % 20 = 0 THEN 'refunded'
                WHEN o_orderkey % 20 = 1 THEN 'cancelled'
                ELSE 'completed' END AS st
    FROM orders, (VALUES ('b1', 'first'), ('b1', 'again'), ('b1', 'noid'), ('b2', 'again')) d(batch, kind)
    WHERE kind = 'first'
       OR (batch = 'b1' AND kind = 'again' AND o_orderkey % 100 = 57)
       OR (kind = 'noid' AND o_orderkey = 0)
       OR (batch = 'b2' AND o_orderkey % 100 = 7)
)
"""

CTE["x_order_items"] = """
SELECT (CASE WHEN k % 11 = 2 THEN 'so' ELSE 'SO' END) || k AS order_id,
       CASE WHEN m % 1000 <> 6 THEN l_linenumber::VARCHAR END AS line_number,
       CASE WHEN m % 500 = 4 THEN 'P-none'
            ELSE (CASE WHEN l_partkey % 9 = 0 THEN 'p' ELSE 'P' END) || l_partkey END AS product_id,
       CASE WHEN m % 20000 = 17 THEN '10000000' WHEN m % 500 = 0 THEN '0' WHEN m % 1000 = 1 THEN '-1'
            WHEN m % 700 = 3 THEN q || '.0' ELSE q::VARCHAR END AS quantity,
       CASE WHEN m % 500 = 2 THEN NULL WHEN m % 1000 = 8 THEN 'NaN' WHEN m % 20000 = 19 THEN '10000000000.00'
            WHEN m % 3000 = 23 THEN '1000000000000.00'
            ELSE (u // 100) || '.' || lpad((u % 100)::VARCHAR, 2, '0') END AS unit_price,
       batch AS _batch_id,
       l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity
FROM (
    SELECT *, (2 * ext + q) // (2 * q) AS u
    FROM (
        SELECT l_orderkey AS k, l_orderkey + l_linenumber AS m, l_linenumber, l_partkey, l_suppkey, l_shipdate,
               l_extendedprice, l_quantity, batch,
               greatest(l_quantity::BIGINT, 1) AS q,
               round(l_extendedprice * 100)::BIGINT AS ext
        FROM lineitem, (VALUES ('b1'), ('b2')) d(batch)
        WHERE batch = 'b1' OR l_orderkey % 100 = 7
    )
)
"""

CTE["x_products"] = """
SELECT CASE kind WHEN 'free' THEN 'P-free'
            WHEN 'main' THEN (CASE WHEN p_partkey % 9 = 0 THEN 'p' ELSE 'P' END) || p_partkey END AS product_id,
       CASE WHEN p_partkey % 8 = 0 THEN '  ' || p_name ELSE p_name END AS product_name,
       CASE WHEN p_partkey % 4 = 0 THEN lower(p_type) ELSE p_type END AS category,
       CASE WHEN kind = 'free' THEN '0' ELSE p_retailprice::DECIMAL(12, 2)::VARCHAR END AS list_price_usd,
       batch AS _batch_id,
       kind AS _pos
FROM part, (VALUES ('b1', 'main'), ('b1', 'noid'), ('b1', 'free'), ('b2', 'main')) d(batch, kind)
WHERE kind = 'main' OR p_partkey = 0
"""

CTE["x_fx_rates"] = f"""
SELECT CASE WHEN k % 20 = 7 THEN 'JPY' WHEN k % 1000 = 3 THEN NULL
            WHEN k % 20 = 9 THEN lower(cur) ELSE cur END AS currency,
       CASE WHEN k % 20 = 7 THEN '-1' WHEN k % 1000 = 11 THEN 'NaN' WHEN k % 1000 = 13 THEN '10000000'
            ELSE moved::VARCHAR END AS rate_to_usd,
       batch AS _batch_id, ts, k
FROM (
    SELECT event_id AS k, ts, batch, cur,
           CASE cur WHEN 'USD' THEN 1.0::DECIMAL(10, 6) WHEN 'EUR' THEN 1.125 WHEN 'GBP' THEN 1.3334
                WHEN 'INR' THEN 0.0157 WHEN 'CAD' THEN 0.8021 ELSE 0.7312 END
           + ((event_id % 5)::DECIMAL(10, 6) / 10000)::DECIMAL(10, 6) AS moved
    FROM (SELECT *, ({CURRENCIES})[user_id % 7 + 1] AS cur FROM events), (VALUES ('b1'), ('b2')) d(batch)
)
"""

# ---- cleaning ---------------------------------------------------------------------------------

CTE["j_fx_rates"] = f"""
SELECT *, {
    reason(
        ("missing_currency", "currency IS NULL"),
        ("rate_out_of_range", "coalesce(rate_to_usd >= 1000000, false)"),
        ("invalid_rate", "NOT (rate_to_usd > 0)"),
    )
} AS reject_reason
FROM (SELECT upper({strip("currency")}) AS currency, try_cast(rate_to_usd AS DECIMAL(18, 6)) AS rate_to_usd,
             _batch_id, ts, k FROM x_fx_rates)
"""
CTE["s_fx_rates"] = """
SELECT currency, rate_to_usd, _batch_id FROM (
    SELECT *, row_number() OVER (PARTITION BY _batch_id, currency ORDER BY ts DESC, k DESC) AS rn
    FROM j_fx_rates WHERE reject_reason IS NULL) WHERE rn = 1
"""
CTE["j_products"] = f"""
SELECT *, {reason(("missing_product_id", "product_id IS NULL"), ("invalid_price", "NOT (list_price_usd > 0)"))}
       AS reject_reason
FROM (SELECT upper({strip("product_id")}) AS product_id, {strip("product_name")} AS product_name,
             {title(strip("category"))} AS category, try_cast(list_price_usd AS DECIMAL(12, 2)) AS list_price_usd,
             _batch_id, _pos FROM x_products)
"""
CTE["s_products"] = """
SELECT product_id, product_name, category, list_price_usd, _batch_id FROM (
    SELECT *, row_number() OVER (PARTITION BY _batch_id, product_id ORDER BY _pos DESC) AS rn
    FROM j_products WHERE reject_reason IS NULL) WHERE rn = 1
"""
CTE["j_customers"] = f"""
SELECT *, {
    reason(
        ("missing_customer_id", "customer_id IS NULL"),
        ("invalid_email", r"NOT regexp_matches(email, '^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$')"),
        ("invalid_signup_date", "signup_date IS NULL"),
        ("unknown_segment", "segment IS NULL"),
    )
} AS reject_reason
FROM (SELECT upper({strip("customer_id")}) AS customer_id, {title(strip("first_name"))} AS first_name,
             {title(strip("last_name"))} AS last_name, lower({strip("email")}) AS email,
             CASE upper({strip("country")}) WHEN 'UK' THEN 'GB'
                  ELSE coalesce(upper({strip("country")}), 'UNKNOWN') END AS country,
             CASE lower({strip("segment")}) WHEN 'consumer' THEN 'Consumer' WHEN 'smb' THEN 'SMB'
                  WHEN 'enterprise' THEN 'Enterprise' END AS segment,
             coalesce({strip("acquisition_channel")}, 'Unknown') AS acquisition_channel,
             {as_date(strip("signup_date"))} AS signup_date,
             {as_utc(strip("updated_at"))} AS updated_at,
             _batch_id, _pos FROM x_customers)
"""
CTE["s_customers"] = """
SELECT * EXCLUDE (rn, _pos, reject_reason) FROM (
    SELECT *, row_number() OVER (PARTITION BY _batch_id, customer_id
                                 ORDER BY updated_at DESC NULLS FIRST, _pos DESC) AS rn
    FROM j_customers WHERE reject_reason IS NULL) WHERE rn = 1
"""
CTE["j_orders"] = f"""
SELECT o.*, {
    reason(
        ("missing_order_id", "o.order_id IS NULL"),
        ("missing_order_ts", "o.order_ts IS NULL"),
        ("invalid_status", "o.status NOT IN ('completed', 'refunded', 'cancelled')"),
        ("unknown_currency", "f.currency IS NULL"),
        ("orphan_customer", "c.customer_id IS NULL"),
    )
} AS reject_reason
FROM (SELECT upper({strip("order_id")}) AS order_id, upper({strip("customer_id")}) AS customer_id,
             {as_utc("order_ts")} AS order_ts, upper({strip("currency")}) AS currency,
             lower({strip("status")}) AS status, coalesce(lower({strip("sales_channel")}), 'unknown') AS sales_channel,
             least(greatest(coalesce(try_cast(discount_pct AS DECIMAL(20, 6)), 0), 0), 0.5)::DECIMAL(5, 4)
                 AS discount_pct,
             {as_utc("ingested_at")} AS ingested_at, _batch_id, _pos FROM x_orders) o
LEFT JOIN s_customers c ON c.customer_id = o.customer_id AND c._batch_id = o._batch_id
LEFT JOIN s_fx_rates f ON f.currency = o.currency AND f._batch_id = o._batch_id
"""
CTE["s_orders"] = """
SELECT * EXCLUDE (rn, _pos, reject_reason) FROM (
    SELECT *, row_number() OVER (PARTITION BY _batch_id, order_id
                                 ORDER BY ingested_at DESC NULLS FIRST, _pos DESC) AS rn
    FROM j_orders WHERE reject_reason IS NULL) WHERE rn = 1
"""
CTE["j_order_items"] = f"""
SELECT i.*, {
    reason(
        ("orphan_order", "o.order_id IS NULL"),
        ("unknown_product", "p.product_id IS NULL"),
        ("missing_line_number", "i.line_number IS NULL"),
        ("non_positive_quantity", "NOT (i.quantity > 0)"),
        ("unit_price_out_of_range", "coalesce(i.asked >= 1000000000000, false)"),
        ("invalid_unit_price", "NOT (i.unit_price > 0)"),
    )
} AS reject_reason
FROM (SELECT upper({strip("order_id")}) AS order_id, try_cast(line_number AS INTEGER) AS line_number,
             upper({strip("product_id")}) AS product_id,
             try_cast(try_cast(quantity AS DECIMAL(20, 6)) AS INTEGER) AS quantity,
             try_cast(unit_price AS DECIMAL(14, 2)) AS unit_price, try_cast(unit_price AS DECIMAL(30, 2)) AS asked,
             _batch_id, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity FROM x_order_items) i
LEFT JOIN s_orders o ON o.order_id = i.order_id AND o._batch_id = i._batch_id
LEFT JOIN s_products p ON p.product_id = i.product_id AND p._batch_id = i._batch_id
"""
CTE["s_order_items"] = """
SELECT order_id, line_number, product_id, quantity, unit_price, _batch_id FROM (
    SELECT *, row_number() OVER (
        PARTITION BY _batch_id, order_id, line_number
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn
    FROM j_order_items WHERE reject_reason IS NULL) WHERE rn = 1
"""
CTE["c_orders"] = "SELECT * FROM s_orders WHERE (order_id, _batch_id) IN (SELECT (order_id, _batch_id) FROM s_order_items)"
CTE["e_orders"] = """
SELECT *, 'no_valid_items' AS reject_reason FROM s_orders o
WHERE NOT EXISTS (SELECT 1 FROM s_order_items i WHERE i.order_id = o.order_id AND i._batch_id = o._batch_id)
"""

# ---- landing and staging ----------------------------------------------------------------------

for _t, _source in {
    "customers": "s_customers",
    "orders": "c_orders",
    "order_items": "s_order_items",
    "products": "s_products",
    "fx_rates": "s_fx_rates",
}.items():
    CTE[f"raw_{_t}"] = f"SELECT *, {loaded('_loaded_at')} FROM {_source}"


def newest(table: str, keys: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
        f"ORDER BY {order}_loaded_at DESC, _batch_id DESC) AS rn FROM {table}) WHERE rn = 1"
    )


CTE["stg_customers"] = newest("raw_customers", "customer_id", "updated_at DESC NULLS LAST, ")
CTE["stg_orders"] = (
    "SELECT *, order_ts::DATE AS order_date FROM ("
    + newest("raw_orders", "order_id", "ingested_at DESC NULLS LAST, ")
    + ")"
)
CTE["stg_order_items"] = (
    "SELECT *, order_id || '-' || line_number AS order_item_id FROM ("
    + newest("raw_order_items", "order_id, line_number", "")
    + ")"
)
CTE["stg_products"] = newest("raw_products", "product_id", "")
CTE["stg_fx_rates"] = newest("raw_fx_rates", "currency", "")


def converted(items: str, orders: str, fx: str, products: str) -> str:
    return f"""
SELECT order_item_id, order_id, line_number, product_id, category, customer_id, order_date, order_month, status,
       currency, ingested_at, quantity, price, local AS local_cents,
       (local * micro + 500000) // 1000000 AS usd_cents,
       CASE WHEN status = 'completed' THEN (local * micro * (10000 - bp) + 5000000000) // 10000000000
            ELSE 0 END AS net_cents
FROM (
    SELECT i.order_item_id, i.order_id, i.line_number, i.product_id, p.category, o.customer_id, o.order_date,
           date_trunc('month', o.order_ts)::DATE AS order_month, o.status, o.currency, o.ingested_at, i.quantity,
           i.unit_price AS price,
           (i.quantity::HUGEINT * (i.unit_price * 100)::HUGEINT) AS local,
           (f.rate_to_usd * 1000000)::HUGEINT AS micro,
           (o.discount_pct * 10000)::HUGEINT AS bp
    FROM {items} i
    JOIN {orders} o ON o.order_id = i.order_id
    JOIN {fx} f ON f.currency = o.currency
    JOIN {products} p ON p.product_id = i.product_id
)
"""


def order_fact(orders: str, lines: str) -> str:
    return f"""
SELECT o.order_id, o.customer_id, o.order_ts, o.order_date, date_trunc('month', o.order_ts)::DATE AS order_month,
       o.status, o.status = 'completed' AS is_revenue_order, o.sales_channel, o.currency, o.discount_pct,
       l.line_count, l.units, l.gross_cents,
       (l.gross_cents * (o.discount_pct * 10000)::HUGEINT + 5000) // 10000 AS discount_cents,
       l.net_cents, o.ingested_at
FROM {orders} o
JOIN (SELECT order_id, count(*) AS line_count, sum(quantity)::BIGINT AS units, sum(usd_cents) AS gross_cents,
             sum(net_cents) AS net_cents FROM {lines} GROUP BY order_id) l ON l.order_id = o.order_id
"""


LINE_COLUMNS = f"""order_item_id, order_id, line_number::BIGINT AS line_number, product_id, category, customer_id,
order_date, order_month, status, currency, ingested_at, quantity::BIGINT AS quantity,
price::DOUBLE AS unit_price_local, {usd("local_cents")} AS line_amount_local, {usd("usd_cents")} AS line_amount_usd,
{usd("net_cents")} AS net_revenue_usd"""
ORDER_COLUMNS = f"""order_id, customer_id, order_ts, order_date, order_month, status, is_revenue_order, sales_channel,
currency, discount_pct::DOUBLE AS discount_pct, line_count, units, {usd("gross_cents")} AS gross_amount_usd,
{usd("discount_cents")} AS discount_amount_usd, {usd("net_cents")} AS net_revenue_usd, ingested_at"""

CTE["lines"] = converted("stg_order_items", "stg_orders", "stg_fx_rates", "stg_products")
CTE["facts"] = order_fact("stg_orders", "lines")

# the first load alone, then the lookback upsert
for _t, _keys, _order in (
    ("orders", "order_id", "ingested_at DESC NULLS LAST, "),
    ("order_items", "order_id, line_number", ""),
    ("products", "product_id", ""),
    ("fx_rates", "currency", ""),
):
    CTE[f"raw1_{_t}"] = f"SELECT * FROM raw_{_t} WHERE _batch_id = 'b1'"
    CTE[f"stg1_{_t}"] = newest(f"raw1_{_t}", _keys, _order)
CTE["stg1d_orders"] = "SELECT *, order_ts::DATE AS order_date FROM stg1_orders"
CTE["stg1d_order_items"] = "SELECT *, order_id || '-' || line_number AS order_item_id FROM stg1_order_items"
CTE["lines1"] = converted("stg1d_order_items", "stg1d_orders", "stg1_fx_rates", "stg1_products")
CTE["facts1"] = order_fact("stg1d_orders", "lines1")
CTE["delta_lines"] = "SELECT * FROM lines WHERE ingested_at >= (SELECT max(ingested_at) - INTERVAL 3 DAY FROM lines1)"
CTE["delta_facts"] = "SELECT * FROM facts WHERE ingested_at >= (SELECT max(ingested_at) - INTERVAL 3 DAY FROM facts1)"

# ---- dimensions -------------------------------------------------------------------------------

CTE["purchases"] = """
SELECT customer_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
       count(*) AS completed_orders, sum(net_cents) AS cents
FROM facts WHERE is_revenue_order GROUP BY customer_id
"""
CTE["customers"] = """
SELECT c.customer_id, c.first_name, c.last_name, c.first_name || ' ' || c.last_name AS full_name, c.email, c.country,
       c.segment, c.acquisition_channel, c.signup_date, date_trunc('month', c.signup_date)::DATE AS signup_month,
       p.first_order_date, date_trunc('month', p.first_order_date)::DATE AS first_order_month, p.last_order_date,
       coalesce(p.completed_orders, 0) AS completed_orders, coalesce(p.cents, 0) AS cents,
       p.customer_id IS NOT NULL AS is_paying_customer
FROM stg_customers c LEFT JOIN purchases p USING (customer_id)
"""
CTE["days"] = """
SELECT unnest(generate_series(date_trunc('year', min(order_date)),
                              date_trunc('year', max(order_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                              INTERVAL 1 DAY))::DATE AS date_day
FROM facts
"""
CTE["months"] = """
SELECT DISTINCT date_trunc('month', date_day)::DATE AS order_month FROM days
WHERE date_day BETWEEN (SELECT min(order_date) FROM facts) AND (SELECT max(order_date) FROM facts)
"""
CTE["versions"] = """
SELECT DISTINCT ON (customer_id, updated_at) customer_id, segment, country, acquisition_channel, updated_at
FROM raw_customers ORDER BY customer_id, updated_at, _loaded_at DESC
"""
CTE["history"] = """
SELECT md5(concat_ws('|', customer_id, updated_at::VARCHAR)) AS customer_version_key, *, updated_at AS valid_from,
       lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at NULLS FIRST) AS valid_to,
       row_number() OVER (PARTITION BY customer_id ORDER BY updated_at NULLS FIRST) AS version
FROM versions
"""

# twelve daily snapshots, taken in one after the other
CTE["daily"] = """
SELECT 'd' || lpad(day::VARCHAR, 2, '0') AS _batch_id, customer_id,
       CASE WHEN changes % 2 = 1 THEN 'Enterprise' ELSE segment END AS segment, country, acquisition_channel,
       CASE WHEN k % 50 = 7 OR k % 50 = 8 AND day % 3 = 0 THEN NULL
            WHEN k % 10 = 3 AND day % 5 = 0 THEN updated_at - INTERVAL 1 DAY
            WHEN k % 20 = 5 THEN updated_at + to_days((changes * 150)::INTEGER)
            ELSE updated_at + to_days(changes::INTEGER) END AS updated_at
FROM (SELECT *, (day * (k % 3)) // 4 AS changes
      FROM (SELECT *, substr(customer_id, 2)::BIGINT AS k FROM s_customers WHERE _batch_id = 'b1'),
           (SELECT unnest(range(1, 13)) AS day))
WHERE k % 4 = 0 OR (k * 5 + day * 3) % 13 >= 2
"""
_VERSION = "customer_id, segment, country, acquisition_channel, updated_at"
CTE["taken01"] = f"SELECT {_VERSION}, updated_at AS valid_from, NULL::TIMESTAMP AS valid_to FROM daily WHERE _batch_id = 'd01'"
for _i in range(2, 13):
    _was, _at = f"taken{_i - 1:02d}", f"TIMESTAMP '2002-01-{_i:02d} 02:00:00'"
    CTE[f"news{_i:02d}"] = f"""
SELECT d.*, CASE WHEN e.ended IS NOT NULL AND NOT coalesce(d.updated_at >= e.ended, false) THEN {_at}
                 ELSE d.updated_at END AS start
FROM daily d LEFT JOIN (SELECT customer_id, max(valid_to) AS ended FROM {_was} GROUP BY 1) e USING (customer_id)
WHERE d._batch_id = 'd{_i:02d}'
"""
    CTE[f"taken{_i:02d}"] = f"""
SELECT {_VERSION}, valid_from, valid_to FROM {_was} WHERE valid_to IS NOT NULL
UNION ALL
SELECT o.customer_id, o.segment, o.country, o.acquisition_channel, o.updated_at, o.valid_from,
       CASE WHEN n.customer_id IS NULL THEN {_at} WHEN n.updated_at > o.updated_at THEN n.start END
FROM {_was} o LEFT JOIN news{_i:02d} n USING (customer_id) WHERE o.valid_to IS NULL
UNION ALL
SELECT n.customer_id, n.segment, n.country, n.acquisition_channel, n.updated_at, n.start, NULL
FROM news{_i:02d} n LEFT JOIN (SELECT * FROM {_was} WHERE valid_to IS NULL) o USING (customer_id)
WHERE o.customer_id IS NULL OR n.updated_at > o.updated_at
"""

# ---- marts ------------------------------------------------------------------------------------

CTE["monthly"] = """
SELECT m.order_month, coalesce(o.cents, 0)::HUGEINT AS cents, coalesce(o.orders, 0) AS orders,
       coalesce(o.active, 0) AS active, coalesce(n.new, 0) AS new
FROM months m
LEFT JOIN (SELECT order_month, sum(net_cents) AS cents, count(*) AS orders, count(DISTINCT customer_id) AS active
           FROM facts WHERE is_revenue_order GROUP BY 1) o USING (order_month)
LEFT JOIN (SELECT first_order_month AS order_month, count(*) AS new FROM customers
           WHERE first_order_month IS NOT NULL GROUP BY 1) n USING (order_month)
"""
CTE["trend"] = """
SELECT *, lag(cents) OVER (ORDER BY order_month) AS pm, lag(cents, 12) OVER (ORDER BY order_month) AS py,
       sum(cents) OVER (ORDER BY order_month ROWS 2 PRECEDING) AS rolling,
       sum(cents) OVER (PARTITION BY year(order_month) ORDER BY order_month ROWS UNBOUNDED PRECEDING) AS ytd,
       sum(cents) OVER (ORDER BY order_month ROWS UNBOUNDED PRECEDING) AS running
FROM monthly
"""
CTE["base"] = f"""
SELECT *, {half_up("cents", "orders")} AS aov
FROM (SELECT customer_id, full_name, segment, country, acquisition_channel, signup_month, first_order_date,
             last_order_date, completed_orders AS orders, cents::HUGEINT AS cents,
             date_diff('day', last_order_date, (SELECT max(order_date) FROM facts)) AS days_since_last_order,
             date_diff('month', first_order_date, (SELECT max(order_date) FROM facts)) + 1 AS tenure
      FROM customers WHERE is_paying_customer)
"""
CTE["ltv"] = f"""
SELECT *, CASE WHEN days_since_last_order <= 90 THEN 'Active' WHEN days_since_last_order <= 180 THEN 'Lapsing'
               ELSE 'Churned' END AS lifecycle_status,
       {half_up("aov * orders * 84", "tenure * 10")} AS clv,
       rank() OVER (PARTITION BY segment ORDER BY cents DESC) AS revenue_rank_in_segment,
       CASE WHEN count(*) OVER () = 1 THEN 0 ELSE
           {half_up("(rank() OVER (ORDER BY cents) - 1) * 10000", "count(*) OVER () - 1")} END AS pct,
       {
    half_up(
        "sum(cents) OVER (ORDER BY cents DESC, customer_id ROWS UNBOUNDED PRECEDING) * 10000", "sum(cents) OVER ()"
    )
} AS share
FROM base
"""
CTE["scored"] = """
SELECT customer_id, segment, country, days_since_last_order AS recency_days, orders AS frequency, cents,
       ntile(5) OVER (ORDER BY days_since_last_order DESC, customer_id) AS r,
       ntile(5) OVER (ORDER BY orders, customer_id) AS f,
       ntile(5) OVER (ORDER BY cents, customer_id) AS m
FROM ltv
"""
CTE["rfm"] = """
SELECT *, CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'Champions' WHEN r >= 3 AND f >= 3 THEN 'Loyal'
               WHEN r >= 4 AND f <= 2 THEN 'New / Promising' WHEN r <= 2 AND f >= 3 THEN 'At Risk'
               WHEN r <= 2 AND m >= 4 THEN 'Cannot Lose' WHEN r <= 2 THEN 'Hibernating'
               ELSE 'Needs Attention' END AS rfm_segment
FROM scored
"""
CTE["cohorts"] = """
SELECT a.*, s.size, sum(a.cents) OVER (PARTITION BY a.cohort_month ORDER BY a.age ROWS UNBOUNDED PRECEDING) AS running
FROM (SELECT c.first_order_month AS cohort_month, date_diff('month', c.first_order_month, o.order_month) AS age,
             count(DISTINCT o.customer_id) AS active, sum(o.net_cents) AS cents
      FROM facts o JOIN customers c USING (customer_id) WHERE o.is_revenue_order GROUP BY 1, 2) a
JOIN (SELECT first_order_month AS cohort_month, count(*) AS size FROM customers
      WHERE is_paying_customer GROUP BY 1) s USING (cohort_month)
"""
CTE["bought"] = "SELECT DISTINCT customer_id, order_date FROM facts WHERE is_revenue_order"
CTE["base90"] = """
SELECT DISTINCT m.month_start, p.customer_id
FROM (SELECT DISTINCT order_month AS month_start FROM facts) m
JOIN bought p ON p.order_date >= m.month_start - 90 AND p.order_date < m.month_start
"""
CTE["kept90"] = """
SELECT b.month_start, count(DISTINCT b.customer_id) AS kept
FROM base90 b JOIN bought p ON p.customer_id = b.customer_id AND p.order_date >= b.month_start
     AND p.order_date < b.month_start + 90
GROUP BY 1
"""
CTE["ret90"] = """
SELECT b.month_start, b.n, coalesce(k.kept, 0) AS kept
FROM (SELECT month_start, count(*) AS n FROM base90 GROUP BY 1) b LEFT JOIN kept90 k USING (month_start)
WHERE b.month_start + 90 <= (SELECT max(order_date) FROM facts)
"""
CTE["by_segment"] = """
SELECT o.order_month, c.segment, c.country, c.acquisition_channel, o.sales_channel, sum(o.net_cents) AS cents,
       count(*) AS orders, count(DISTINCT o.customer_id) AS customers
FROM facts o JOIN customers c USING (customer_id) WHERE o.is_revenue_order GROUP BY 1, 2, 3, 4, 5
"""
CTE["by_category"] = """
SELECT order_month, category, sum(net_cents) AS cents, sum(quantity)::BIGINT AS units
FROM lines WHERE status = 'completed' GROUP BY 1, 2
"""
CTE["by_category_lag"] = """
SELECT *, lag(cents) OVER (PARTITION BY category ORDER BY order_month) AS before,
       sum(cents) OVER (PARTITION BY order_month) AS of_month FROM by_category
"""
CTE["kpi"] = """
SELECT count(*) AS n, sum(cents) AS cents, sum(orders)::BIGINT AS orders, sum(clv) AS clv,
       count(*) FILTER (orders > 1) AS again, count(*) FILTER (lifecycle_status = 'Active') AS active,
       coalesce(sum(cents) FILTER (pct >= 9000), 0) AS top
FROM ltv
"""

# ---- accounts and checks ----------------------------------------------------------------------

TABLES = ("fx_rates", "products", "customers", "orders", "order_items")
KEYS = {
    "fx_rates": "currency",
    "products": "product_id",
    "customers": "customer_id",
    "orders": "order_id",
    "order_items": "order_id, line_number",
}
CLEAN = {t: "c_orders" if t == "orders" else f"s_{t}" for t in TABLES}

CTE["batches"] = "SELECT DISTINCT _batch_id FROM x_customers"
CTE["rejected"] = " UNION ALL ".join(
    [
        f"SELECT _batch_id, '{t}' AS table_name, reject_reason FROM j_{t} WHERE reject_reason IS NOT NULL"
        for t in TABLES
    ]
    + ["SELECT _batch_id, 'orders', reject_reason FROM e_orders"]
)
CTE["accounts"] = " UNION ALL ".join(
    f"""SELECT r._batch_id, '{t}' AS table_name, r.n AS raw,
       coalesce((SELECT count(*) FROM {CLEAN[t]} c WHERE c._batch_id = r._batch_id), 0) AS clean,
       coalesce((SELECT count(*) FROM rejected x WHERE x._batch_id = r._batch_id AND x.table_name = '{t}'), 0) AS rejected,
       coalesce((SELECT count(*) - count(DISTINCT ({KEYS[t]})) FROM j_{t} j
                 WHERE j._batch_id = r._batch_id AND j.reject_reason IS NULL), 0) AS deduped
FROM (SELECT _batch_id, count(*) AS n FROM x_{t} GROUP BY 1) r"""
    for t in TABLES
)


def check(table: str, name: str, failures: str, detail: str, by_batch: bool = True) -> str:
    """One check; ``failures`` is a scalar subquery that may look at b._batch_id."""
    scope = "_batch_id, " if by_batch else ""
    source = "batches b" if by_batch else "(SELECT 1)"
    return (
        f"SELECT {scope}'{table}' AS table_name, '{name.replace(chr(39), chr(39) * 2)}' AS check_name, "
        f"'error' AS severity, f = 0 AS passed, f::BIGINT AS failures, {detail} AS detail "
        f"FROM (SELECT {'b._batch_id, ' if by_batch else ''}coalesce(({failures}), 0) AS f FROM {source})"
    )


def unique_check(table: str, source: str, keys: str, by_batch: bool = True) -> str:
    where = "WHERE _batch_id = b._batch_id" if by_batch else ""
    return check(
        table,
        f"unique({keys})",
        f"SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM {source} {where} GROUP BY {keys})",
        "f || ' duplicate keys'",
        by_batch,
    )


def count_check(table: str, name: str, source: str, failing: str, detail: str, by_batch: bool = True) -> str:
    where = "AND _batch_id = b._batch_id" if by_batch else ""
    return check(table, name, f"SELECT count(*) FROM {source} WHERE {failing} {where}", detail, by_batch)


def null_check(table: str, source: str, columns: tuple[str, ...], by_batch: bool = True) -> str:
    where = "WHERE _batch_id = b._batch_id" if by_batch else ""
    total = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in columns)
    detail = "CASE WHEN f = 0 THEN 'no nulls' ELSE f || ' nulls' END"
    return check(table, f"not_null({', '.join(columns)})", f"SELECT {total} FROM {source} {where}", detail, by_batch)


def rows_check(table: str, source: str) -> str:
    return check(
        table,
        "min_rows(1)",
        f"SELECT greatest(1 - count(*), 0) FROM {source} WHERE _batch_id = b._batch_id",
        "f || ' rows short'",
    )


def link_check(
    table: str, child: str, column: str, parent: str, key: str, by_batch: bool = True, nulls: bool = True
) -> str:
    scope = "AND p._batch_id = c._batch_id" if by_batch else ""
    where = "AND c._batch_id = b._batch_id" if by_batch else ""
    ignore = "" if nulls else f"AND c.{column} IS NOT NULL"
    return check(
        table,
        f"relationship({column} -> {key})",
        f"SELECT count(*) FROM {child} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column} {scope}) "
        f"{where} {ignore}",
        "f || ' orphan rows'",
        by_batch,
    )


VALID = "CASE WHEN f = 0 THEN 'all valid' ELSE f || ' unexpected' END"
GATE = [
    rows_check("customers", "s_customers"),
    null_check("customers", "s_customers", ("customer_id", "email", "signup_date", "segment")),
    unique_check("customers", "s_customers", "customer_id"),
    count_check("products", "positive(list_price_usd)", "s_products", "list_price_usd <= 0", "f || ' non-positive values'"),
    unique_check("products", "s_products", "product_id"),
    unique_check("fx_rates", "s_fx_rates", "currency"),
    rows_check("orders", "c_orders"),
    null_check("orders", "c_orders", ("order_id", "customer_id", "order_ts", "status", "currency")),
    count_check(
        "orders", "accepted_values(status)", "c_orders", "status NOT IN ('completed', 'refunded', 'cancelled')", VALID
    ),
    unique_check("orders", "c_orders", "order_id"),
    link_check("orders", "c_orders", "customer_id", "s_customers", "customer_id"),
    link_check("orders", "c_orders", "currency", "s_fx_rates", "currency"),
    count_check("order_items", "positive(quantity)", "s_order_items", "quantity <= 0", "f || ' non-positive values'"),
    count_check("order_items", "positive(unit_price)", "s_order_items", "unit_price <= 0", "f || ' non-positive values'"),
    unique_check("order_items", "s_order_items", "order_id, line_number"),
    link_check("order_items", "s_order_items", "order_id", "c_orders", "order_id"),
    link_check("order_items", "s_order_items", "product_id", "s_products", "product_id"),
]
LINKS = [
    link_check("orders", "j_orders", "customer_id", "s_customers", "customer_id"),
    link_check("orders", "j_orders", "currency", "s_fx_rates", "currency"),
    link_check("order_items", "j_order_items", "order_id", "j_orders", "order_id"),
    link_check("order_items", "j_order_items", "product_id", "s_products", "product_id"),
]


def model_test_checks() -> list[str]:
    def u(table, source, keys):
        return unique_check(table, source, keys, by_batch=False)

    def n(table, source, column):
        return null_check(table, source, (column,), by_batch=False)

    def values(table, source, column, *allowed):
        bad = f"{column} NOT IN ({', '.join(repr(a) for a in allowed)})"
        return count_check(table, f"accepted_values({column})", source, bad, VALID, by_batch=False)

    def within(table, source, column, bad):
        return count_check(table, f"accepted_range({column})", source, bad, "f || ' out of range'", by_batch=False)

    def true(table, source, expression, bad):
        return count_check(table, f"expression_is_true({expression})", source, bad, "f || ' false'", by_batch=False)

    def link(table, child, column, parent, key):
        return link_check(table, child, column, parent, key, by_batch=False, nulls=False)

    def rows(table, name, source, bad):
        return count_check(table, name, source, bad, "f || ' rows'", by_batch=False)

    segments = ("Consumer", "SMB", "Enterprise")
    statuses = ("completed", "refunded", "cancelled")
    grants = (
        "(VALUES ('emea.manager@example.com', 'GB'), ('emea.manager@example.com', 'DE'), "
        "('emea.manager@example.com', 'FR'), ('americas.manager@example.com', 'US'), "
        "('americas.manager@example.com', 'CA'), ('apac.manager@example.com', 'IN'), "
        "('apac.manager@example.com', 'AU')) g(user_email, country)"
    )
    lines_vs = (
        "(SELECT o.order_id AS a, l.order_id AS z, o.net_cents AS n1, l.net_cents AS n2, o.gross_cents AS g1, "
        "l.usd_cents AS g2 FROM facts o FULL JOIN (SELECT order_id, sum(net_cents) AS net_cents, "
        "sum(usd_cents) AS usd_cents FROM lines GROUP BY 1) l ON l.order_id = o.order_id)"
    )
    trend_vs = (
        "(SELECT (SELECT sum(cents) FROM monthly) AS t, (SELECT sum(net_cents) FROM facts WHERE is_revenue_order) AS f)"
    )
    return [
        n("raw_customers", "raw_customers", "customer_id"),
        n("raw_orders", "raw_orders", "order_id"),
        n("security_country_access", grants, "user_email"),
        n("security_country_access", grants, "country"),
        u("stg_customers", "stg_customers", "customer_id"),
        n("stg_customers", "stg_customers", "customer_id"),
        n("stg_customers", "stg_customers", "email"),
        values("stg_customers", "stg_customers", "segment", *segments),
        u("stg_orders", "stg_orders", "order_id"),
        n("stg_orders", "stg_orders", "order_id"),
        n("stg_orders", "stg_orders", "customer_id"),
        values("stg_orders", "stg_orders", "status", *statuses),
        within("stg_orders", "stg_orders", "discount_pct", "(discount_pct < 0 OR discount_pct > 0.5)"),
        link("stg_orders", "stg_orders", "customer_id", "stg_customers", "customer_id"),
        link("stg_orders", "stg_orders", "currency", "stg_fx_rates", "currency"),
        u("stg_order_items", "stg_order_items", "order_item_id"),
        n("stg_order_items", "stg_order_items", "order_item_id"),
        within("stg_order_items", "stg_order_items", "quantity", "quantity < 1"),
        link("stg_order_items", "stg_order_items", "product_id", "stg_products", "product_id"),
        u("stg_products", "stg_products", "product_id"),
        n("stg_products", "stg_products", "product_id"),
        u("stg_fx_rates", "stg_fx_rates", "currency"),
        n("stg_fx_rates", "stg_fx_rates", "currency"),
        u("fct_orders", "facts", "order_id"),
        n("fct_orders", "facts", "order_id"),
        n("fct_orders", "facts", "customer_id"),
        n("fct_orders", "facts", "order_date"),
        values("fct_orders", "facts", "status", *statuses),
        within("fct_orders", "facts", "net_revenue_usd", "net_cents < 0"),
        true("fct_orders", "facts", "net_revenue_usd <= gross_amount_usd", "net_cents > gross_cents"),
        link("fct_orders", "facts", "customer_id", "customers", "customer_id"),
        link("fct_orders", "facts", "order_date", "days", "date_day"),
        u("fct_order_items", "lines", "order_item_id"),
        n("fct_order_items", "lines", "order_item_id"),
        link("fct_order_items", "lines", "product_id", "stg_products", "product_id"),
        u("dim_customer", "customers", "customer_id"),
        n("dim_customer", "customers", "customer_id"),
        values("dim_customer", "customers", "segment", *segments),
        u("dim_customer_history", "history", "customer_version_key"),
        n("dim_customer_history", "history", "customer_version_key"),
        true("dim_customer_history", "history", "valid_from < valid_to", "valid_from >= valid_to"),
        u("dim_product", "stg_products", "product_id"),
        n("dim_product", "stg_products", "product_id"),
        u("dim_date", "days", "date_day"),
        n("dim_date", "days", "date_day"),
        u("monthly_revenue", "monthly", "order_month"),
        n("monthly_revenue", "monthly", "order_month"),
        u("customer_ltv", "ltv", "customer_id"),
        n("customer_ltv", "ltv", "customer_id"),
        values("customer_ltv", "ltv", "lifecycle_status", "Active", "Lapsing", "Churned"),
        link("customer_ltv", "ltv", "customer_id", "customers", "customer_id"),
        check(
            "cohort_retention",
            "unique(cohort_month, months_since_first)",
            "SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM cohorts GROUP BY cohort_month, age)",
            "f || ' duplicate keys'",
            by_batch=False,
        ),
        within("cohort_retention", "cohorts", "retention_rate", "(active < 0 OR active > size)"),
        u("retention_90d", "ret90", "month_start"),
        u("rfm_segments", "rfm", "customer_id"),
        values(
            "rfm_segments", "rfm", "rfm_segment",
            "Champions", "Loyal", "New / Promising", "At Risk", "Cannot Lose", "Hibernating", "Needs Attention",
        ),
        u("revenue_by_category", "by_category", "order_month, category"),
        true("kpi_summary", "kpi", "repeat_purchase_rate between 0 and 1", "(again < 0 OR again > n)"),
        rows("fct_orders", "order_totals_match_lines", lines_vs,
             "(a IS NULL OR z IS NULL OR abs(n1 - n2) > 1 OR abs(g1 - g2) > 1)"),
        rows("monthly_revenue", "monthly_revenue_reconciles", trend_vs, "abs(t - f) > 1"),
        rows("cohort_retention", "cohort_month_zero_full_retention", "cohorts", "age = 0 AND active <> size"),
    ]


# ---- the queries ------------------------------------------------------------------------------

CUSTOMER = (
    "customer_id, first_name, last_name, email, country, segment, acquisition_channel, signup_date, updated_at, _batch_id"
)
ORDER = (
    "order_id, customer_id, order_ts, currency, status, sales_channel, discount_pct::DOUBLE AS discount_pct, "
    "ingested_at, _batch_id"
)
ITEM = (
    "order_id, line_number::BIGINT AS line_number, product_id, quantity::BIGINT AS quantity, "
    "unit_price::DOUBLE AS unit_price, _batch_id"
)

DAILY = (
    "SELECT strftime(ingested_at, '%Y%m%d') AS _batch_id, "
    "(ingested_at::DATE + 1)::TIMESTAMP + INTERVAL 2 HOUR AS _loaded_at FROM c_orders"
)
NOW = "TIMESTAMP '2001-12-03 12:00:00'"

Q: dict[str, str] = {
    "clean_fx_rates": "SELECT currency, rate_to_usd::DOUBLE AS rate_to_usd, _batch_id FROM s_fx_rates",
    "clean_products": "SELECT product_id, product_name, category, list_price_usd::DOUBLE AS list_price_usd, _batch_id FROM s_products",
    "clean_customers": f"SELECT {CUSTOMER} FROM s_customers",
    "clean_orders": f"SELECT {ORDER} FROM c_orders",
    "clean_order_items": f"SELECT {ITEM} FROM s_order_items",
    "rejects_customers": f"SELECT {CUSTOMER}, reject_reason FROM j_customers WHERE reject_reason IS NOT NULL",
    "rejects_orders": f"SELECT {ORDER}, reject_reason FROM j_orders WHERE reject_reason IS NOT NULL "
    f"UNION ALL SELECT {ORDER}, reject_reason FROM e_orders",
    "rejects_order_items": f"SELECT {ITEM}, reject_reason FROM j_order_items WHERE reject_reason IS NOT NULL",
    "rejects_no_valid_items": f"SELECT {ORDER}, reject_reason FROM e_orders",
    "dedupe_counts": "SELECT * FROM accounts",
    "dq_checks": " UNION ALL ".join(GATE),
    "dq_relationships": " UNION ALL ".join(LINKS),
    "dq_reconciliation": f"""
        SELECT _batch_id, table_name, 'row_reconciliation' AS check_name, 'error' AS severity,
               raw = clean + rejected + deduped AS passed, abs(raw - clean - rejected - deduped) AS failures,
               'raw=' || raw || ' clean=' || clean || ' rejected=' || rejected || ' deduped=' || deduped AS detail
        FROM accounts
        UNION ALL
        SELECT _batch_id, table_name, 'reject_rate<5%', 'warning', rejected * 100 < raw * 5, rejected,
               (pct // 100) || '.' || lpad((pct % 100)::VARCHAR, 2, '0') || '% rejected'
        FROM (SELECT *, {half_up("rejected * 10000", "greatest(raw, 1)")} AS pct FROM accounts)""",
    "dq_rejects_by_reason": "SELECT _batch_id, table_name, reject_reason, count(*) AS rows FROM rejected GROUP BY ALL",
    "model_tests": " UNION ALL ".join(model_test_checks()),
    "recon_order_totals": f"""
        SELECT count(*) AS orders_compared,
               count(*) FILTER (o.order_id IS NULL OR l.order_id IS NULL OR abs(o.net_cents - l.n) > 1
                                OR abs(o.gross_cents - l.g) > 1) AS failures,
               {usd("sum(o.net_cents)")} AS order_net_usd, {usd("sum(l.n)")} AS line_net_usd
        FROM facts o FULL JOIN (SELECT order_id, sum(net_cents) AS n, sum(usd_cents) AS g FROM lines GROUP BY 1) l
          ON l.order_id = o.order_id""",
    "recon_monthly_revenue": f"""
        SELECT {usd("t")} AS trend_revenue, {usd("f")} AS fact_revenue, abs(t - f) <= 1 AS passed
        FROM (SELECT (SELECT sum(cents) FROM monthly) AS t,
                     (SELECT sum(net_cents) FROM facts WHERE is_revenue_order) AS f)""",
    "recon_cohort_month_zero": "SELECT count(*) AS cohorts, count(*) FILTER (active <> size) AS failures FROM cohorts WHERE age = 0",
    "raw_batch_replace": "SELECT _batch_id, count(*) AS rows, count(DISTINCT order_id) AS orders, "
    "sum(discount_pct)::DOUBLE AS discounts FROM c_orders GROUP BY 1",
    "stg_customers": f"SELECT {CUSTOMER}, _loaded_at FROM stg_customers",
    "stg_orders": f"SELECT {ORDER}, order_date, _loaded_at FROM stg_orders",
    "stg_order_items": "SELECT order_item_id, order_id, line_number::BIGINT AS line_number, product_id, "
    "quantity::BIGINT AS quantity, unit_price::DOUBLE AS unit_price_local, _loaded_at FROM stg_order_items",
    "stg_products": "SELECT product_id, product_name, category, list_price_usd::DOUBLE AS list_price_usd FROM stg_products",
    "stg_fx_rates": "SELECT currency, rate_to_usd::DOUBLE AS rate_to_usd FROM stg_fx_rates",
    "extract_csv": "SELECT order_id, line_number, product_id, quantity, nullif(unit_price, 'NaN') AS unit_price "
    "FROM x_order_items WHERE _batch_id = 'b1'",
    "extract_jsonl": "SELECT order_id, customer_id, order_ts, currency, status, sales_channel, discount_pct, ingested_at "
    "FROM x_orders WHERE _batch_id = 'b1'",
    "quarantine_csv": "SELECT order_id, line_number::VARCHAR AS line_number, product_id, quantity::VARCHAR AS quantity, "
    "unit_price::VARCHAR AS unit_price, _batch_id, reject_reason FROM j_order_items WHERE reject_reason IS NOT NULL",
    "quarantine_unreadable": """
        SELECT 'orders' AS table_name, 'unreadable_line' AS reject_reason, left(line, length(line) - 1) AS line
        FROM (SELECT json_object('order_id', order_id, 'customer_id', customer_id, 'order_ts', order_ts, 'currency', currency,
                                 'status', status, 'sales_channel', sales_channel, 'discount_pct', discount_pct,
                                 'ingested_at', ingested_at)::VARCHAR AS line
              FROM x_orders WHERE _batch_id = 'b1' AND order_id LIKE '%7')
        UNION ALL
        SELECT 'order_items', 'unreadable_line', coalesce(order_id, '') || ',' || coalesce(line_number, '') || ',' ||
               coalesce(product_id, '') || ',' || coalesce(quantity, '') || ',' || coalesce(unit_price, '') || ',late'
        FROM x_order_items WHERE _batch_id = 'b1' AND order_id LIKE '%7'""",
    "staged_load": "SELECT product_id, product_name, category, list_price_usd::DOUBLE AS list_price_usd, _loaded_at, "
    "'b' AS _batch_id FROM raw_products WHERE _batch_id = 'b1'",
    "export_customers": "SELECT customer_id, full_name, '*****' || substr(email, strpos(email, '@')) AS email, country, "
    "completed_orders::VARCHAR AS completed_orders FROM customers",
    "stream_orders_once": f"SELECT DISTINCT upper({strip('order_id')}) AS order_id, {as_utc('ingested_at')} AS ingested_at "
    "FROM x_orders",
    "order_items_converted": f"SELECT {LINE_COLUMNS} FROM lines",
    "fct_order_items": f"SELECT {LINE_COLUMNS} FROM lines",
    "fct_orders": f"SELECT {ORDER_COLUMNS} FROM facts",
    "fct_order_items_incremental": f"""
        SELECT {LINE_COLUMNS} FROM (
            SELECT * FROM delta_lines
            UNION ALL
            SELECT * FROM lines1 WHERE order_item_id NOT IN (SELECT order_item_id FROM delta_lines))""",
    "fct_orders_incremental": f"""
        SELECT {ORDER_COLUMNS} FROM (
            SELECT * FROM delta_facts
            UNION ALL
            SELECT * FROM facts1 WHERE order_id NOT IN (SELECT order_id FROM delta_facts))""",
    "fct_orders_in_folders": f"""
        SELECT {ORDER_COLUMNS} FROM (
            SELECT * FROM delta_facts
            UNION ALL
            SELECT * FROM facts1 WHERE order_id NOT IN (SELECT order_id FROM delta_facts))""",
    "dim_customer": f"SELECT * EXCLUDE (cents), {usd('cents')} AS lifetime_revenue_usd FROM customers",
    "dim_customer_history": """
        SELECT customer_version_key, customer_id, segment, country, acquisition_channel, valid_from,
               coalesce(valid_to, TIMESTAMP '9999-12-31 00:00:00') AS valid_to, valid_to IS NULL AS is_current
        FROM history""",
    "dim_product": "SELECT product_id, product_name, category, list_price_usd::DOUBLE AS list_price_usd FROM stg_products",
    "dim_date": """
        SELECT date_day, year(date_day) AS year, quarter(date_day) AS quarter, month(date_day) AS month,
               date_trunc('month', date_day)::DATE AS month_start, strftime(date_day, '%Y-%m') AS year_month
        FROM days""",
    "scd2_apply": """
        WITH v AS (SELECT customer_id, segment, country, acquisition_channel, updated_at, _batch_id FROM s_customers),
        a AS (SELECT * FROM v WHERE _batch_id = 'b1'), z AS (SELECT * FROM v WHERE _batch_id = 'b2')
        SELECT md5(concat_ws('|', customer_id, updated_at::VARCHAR)) AS customer_version_key, customer_id, segment,
               country, acquisition_channel, updated_at, updated_at AS valid_from, valid_to
        FROM (
            SELECT a.customer_id, a.segment, a.country, a.acquisition_channel, a.updated_at,
                   CASE WHEN z.customer_id IS NULL THEN TIMESTAMP '2001-12-02 02:00:00'
                        WHEN z.updated_at > a.updated_at THEN z.updated_at END AS valid_to
            FROM a LEFT JOIN z ON z.customer_id = a.customer_id
            UNION ALL
            SELECT z.customer_id, z.segment, z.country, z.acquisition_channel, z.updated_at, NULL
            FROM z LEFT JOIN a ON a.customer_id = z.customer_id
            WHERE a.customer_id IS NULL OR z.updated_at > a.updated_at)
        UNION ALL
        SELECT md5(concat_ws('|', customer_id, '2001-12-03 02:00:00')), customer_id, segment, country,
               acquisition_channel, updated_at, TIMESTAMP '2001-12-03 02:00:00', NULL
        FROM a WHERE customer_id NOT IN (SELECT customer_id FROM z)""",
    "scd2_daily_snapshots": "SELECT md5(concat_ws('|', customer_id, valid_from::VARCHAR)) AS customer_version_key, * FROM taken12",
    "scd2_history": "SELECT * EXCLUDE (version) FROM history",
    "monthly_revenue": f"""
        SELECT order_month, {usd("cents")} AS revenue_usd, orders, active AS active_customers, new AS new_customers,
               active - new AS returning_customers, {rate("cents", "orders * 100", 2)} AS avg_order_value_usd,
               {usd("pm")} AS prev_month_revenue_usd, {rate("(cents - pm) * 100", "pm", 2)} AS mom_growth_pct,
               {rate("(cents - py) * 100", "py", 2)} AS yoy_growth_pct, {usd("rolling")} AS rolling_3m_revenue_usd,
               {usd("ytd")} AS ytd_revenue_usd, {usd("running")} AS cumulative_revenue_usd
        FROM trend""",
    "customer_ltv": f"""
        SELECT customer_id, full_name, segment, country, acquisition_channel, signup_month, first_order_date,
               last_order_date, orders, {usd("cents")} AS total_revenue_usd, {usd("aov")} AS avg_order_value_usd,
               days_since_last_order, tenure AS tenure_months, {rate("orders", "tenure", 3)} AS orders_per_month,
               lifecycle_status, {usd("clv")} AS predicted_clv_usd, revenue_rank_in_segment,
               pct::DOUBLE / 10000 AS revenue_percentile, share::DOUBLE / 10000 AS cumulative_revenue_share
        FROM ltv""",
    "rfm_segments": f"""
        SELECT customer_id, segment, country, recency_days, frequency, {usd("cents")} AS monetary_usd, r AS r_score,
               f AS f_score, m AS m_score, r * 100 + f * 10 + m AS rfm_code, rfm_segment FROM rfm""",
    "cohort_retention": f"""
        SELECT cohort_month, age AS months_since_first, size AS cohort_customers, active AS active_customers,
               {rate("active", "size", 4)} AS retention_rate, {usd("cents")} AS revenue_usd,
               {rate("running", "size * 100", 2)} AS cumulative_revenue_per_customer_usd FROM cohorts""",
    "retention_90d": f"""
        SELECT month_start, n AS base_customers, kept AS retained_customers, {rate("kept", "n", 4)} AS retention_rate_90d,
               {rate("n - kept", "n", 4)} AS churn_rate_90d FROM ret90""",
    "revenue_by_segment": f"""
        SELECT order_month, segment, country, acquisition_channel, sales_channel, {usd("cents")} AS revenue_usd, orders,
               customers, {rate("cents", "sum(cents) OVER (PARTITION BY order_month)", 4)} AS share_of_month_revenue
        FROM by_segment""",
    "revenue_by_category": f"""
        SELECT order_month, category, {usd("cents")} AS revenue_usd, units,
               dense_rank() OVER (PARTITION BY order_month ORDER BY cents DESC) AS rank_in_month,
               {rate("cents", "of_month", 4)} AS share_of_month_revenue,
               {rate("(cents - before) * 100", "before", 2)} AS mom_growth_pct FROM by_category_lag""",
    "kpi_summary": f"""
        SELECT n AS paying_customers, {usd("cents")} AS total_revenue_usd, orders AS completed_orders,
               {rate("cents", "orders * 100", 2)} AS avg_order_value_usd,
               {rate("cents", "n * 100", 2)} AS avg_historical_clv_usd, {rate("clv", "n * 100", 2)} AS avg_predicted_clv_usd,
               {rate("again", "n", 4)} AS repeat_purchase_rate, {rate("active", "n", 4)} AS active_customer_rate,
               {rate("top", "cents", 4)} AS top_10pct_revenue_share FROM kpi""",
    "revenue_by_segment_as_of": f"""
        SELECT o.order_month, h.segment, {usd("sum(o.net_cents)")} AS revenue_usd, count(*) AS orders
        FROM facts o JOIN history h ON h.customer_id = o.customer_id
         AND (h.version = 1 OR o.order_ts >= h.valid_from) AND (h.valid_to IS NULL OR o.order_ts < h.valid_to)
        WHERE o.is_revenue_order GROUP BY 1, 2""",
    "top_customers": f"""
        SELECT customer_id, full_name, {usd("cents")} AS total_revenue_usd, {usd("clv")} AS predicted_clv_usd,
               lifecycle_status FROM ltv ORDER BY cents DESC, customer_id LIMIT 20""",
    "measures_revenue": f"""
        SELECT strftime(o.order_month, '%Y-%m') AS year_month, c.segment, {usd("sum(net_cents)")} AS total_revenue,
               {usd("coalesce(sum(gross_cents) FILTER (is_revenue_order), 0)")} AS gross_sales,
               {usd("coalesce(sum(discount_cents) FILTER (is_revenue_order), 0)")} AS total_discounts,
               {
        rate(
            "coalesce(sum(discount_cents) FILTER (is_revenue_order), 0)",
            "coalesce(sum(gross_cents) FILTER (is_revenue_order), 0)",
            6,
        )
    } AS discount_rate_pct,
               count(*) FILTER (is_revenue_order) AS completed_orders,
               {rate("sum(net_cents)", "count(*) FILTER (is_revenue_order) * 100", 2)} AS average_order_value,
               {rate("count(*) FILTER (status = 'refunded')", "count(*)", 6)} AS refund_rate_pct
        FROM facts o JOIN customers c USING (customer_id) GROUP BY 1, 2""",
    "measures_time_intelligence": f"""
        SELECT order_month, {usd("rev")} AS total_revenue, {usd("pm")} AS revenue_pm, {usd("py")} AS revenue_py,
               {usd("ytd")} AS revenue_ytd, {usd("rolling")} AS revenue_rolling_3m,
               {rate("coalesce(rev, 0) - pm", "pm", 6)} AS revenue_mom_pct,
               {rate("coalesce(rev, 0) - py", "py", 6)} AS revenue_yoy_pct,
               CASE WHEN coalesce({rate("coalesce(rev, 0) - py", "py", 6)}, 0) >= 0 THEN '#16A34A' ELSE '#DC2626' END
                   AS yoy_colour
        FROM (
            SELECT m.order_month, r.rev,
                   lag(r.rev) OVER (ORDER BY m.order_month) AS pm, lag(r.rev, 12) OVER (ORDER BY m.order_month) AS py,
                   sum(r.rev) OVER (PARTITION BY year(m.order_month) ORDER BY m.order_month ROWS UNBOUNDED PRECEDING) AS ytd,
                   sum(r.rev) OVER (ORDER BY m.order_month ROWS 2 PRECEDING) AS rolling
            FROM months m LEFT JOIN (SELECT order_month, sum(net_cents) AS rev FROM facts GROUP BY 1) r USING (order_month))""",
    "measures_yoy_by_year": f"""
        WITH r AS (SELECT year(o.order_date) AS y, c.segment, sum(o.net_cents) AS rev
                   FROM facts o JOIN customers c USING (customer_id) GROUP BY 1, 2),
        y AS (SELECT unnest(range((SELECT min(y) FROM r), (SELECT max(y) FROM r) + 1)) AS y)
        SELECT y.y AS year, s.segment, {usd("r.rev")} AS total_revenue, {usd("p.rev")} AS revenue_py,
               {rate("coalesce(r.rev, 0) - p.rev", "p.rev", 6)} AS revenue_yoy_pct,
               CASE WHEN coalesce({rate("coalesce(r.rev, 0) - p.rev", "p.rev", 6)}, 0) >= 0 THEN '#16A34A' ELSE '#DC2626' END
                   AS yoy_colour
        FROM y CROSS JOIN (SELECT DISTINCT segment FROM r) s
        LEFT JOIN r ON r.y = y.y AND r.segment = s.segment LEFT JOIN r p ON p.y = y.y - 1 AND p.segment = s.segment""",
    "measures_time_by_quarter": f"""
        WITH q AS (SELECT unnest(generate_series(date_trunc('quarter', min(order_date)), date_trunc('quarter', max(order_date)),
                                                 INTERVAL 3 MONTH))::DATE AS a FROM facts),
        m AS (SELECT order_month, sales_channel, sum(net_cents) AS rev FROM facts GROUP BY 1, 2),
        x AS (SELECT q.a, s.sales_channel,
                     sum(rev) FILTER (order_month >= q.a AND order_month < q.a + INTERVAL 3 MONTH) AS rev,
                     sum(rev) FILTER (order_month >= q.a - INTERVAL 1 MONTH AND order_month < q.a + INTERVAL 2 MONTH) AS pm,
                     sum(rev) FILTER (order_month >= q.a - INTERVAL 1 YEAR AND order_month < q.a - INTERVAL 9 MONTH) AS py,
                     sum(rev) FILTER (year(order_month) = year(q.a) AND order_month < q.a + INTERVAL 3 MONTH) AS ytd
              FROM q CROSS JOIN (SELECT DISTINCT sales_channel FROM m) s JOIN m ON m.sales_channel = s.sales_channel GROUP BY 1, 2)
        SELECT year(a) AS year, quarter(a) AS quarter, sales_channel, {usd("rev")} AS total_revenue, {usd("pm")} AS revenue_pm,
               {usd("py")} AS revenue_py, {usd("ytd")} AS revenue_ytd, {usd("rev")} AS revenue_rolling_3m,
               {rate("coalesce(rev, 0) - py", "py", 6)} AS revenue_yoy_pct
        FROM x""",
    "measures_time_by_day": f"""
        WITH d AS (SELECT order_date AS d, sum(net_cents) AS rev FROM facts GROUP BY 1),
        s AS (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS x FROM d)
        SELECT x AS order_date, {usd("(SELECT rev FROM d WHERE d = x)")} AS total_revenue,
               {usd("(SELECT sum(rev) FROM d WHERE (d + INTERVAL 1 MONTH)::DATE = x AND day(d) = day(x))")} AS revenue_pm,
               {usd("(SELECT sum(rev) FROM d WHERE (d + INTERVAL 1 YEAR)::DATE = x AND day(d) = day(x))")} AS revenue_py,
               {usd("(SELECT sum(rev) FROM d WHERE year(d) = year(x) AND d <= x)")} AS revenue_ytd,
               {usd("(SELECT sum(rev) FROM d WHERE d > x - INTERVAL 3 MONTH AND d <= x)")} AS revenue_rolling_3m
        FROM s""",
    "measures_ytd_by_category": f"""
        WITH q AS (SELECT unnest(generate_series(date_trunc('quarter', min(order_date)), date_trunc('quarter', max(order_date)),
                                                 INTERVAL 3 MONTH))::DATE AS a FROM lines),
        m AS (SELECT date_trunc('quarter', order_date)::DATE AS q, category, sum(net_cents) AS rev FROM lines GROUP BY 1, 2)
        SELECT year(q.a) AS year, quarter(q.a) AS quarter, c.category, {usd("sum(rev) FILTER (m.q = q.a)")} AS total_revenue,
               {usd("sum(rev) FILTER (year(m.q) = year(q.a) AND m.q <= q.a)")} AS revenue_ytd,
               {usd("sum(rev) FILTER (m.q = q.a - INTERVAL 1 YEAR)")} AS revenue_py
        FROM q CROSS JOIN (SELECT DISTINCT category FROM m) c JOIN m ON m.category = c.category GROUP BY q.a, c.category""",
    "measure_revenue_share": f"""
        SELECT year, segment, {usd("cents")} AS total_revenue,
               {rate("cents", "sum(cents) OVER (PARTITION BY year)", 6)} AS revenue_share_pct
        FROM (SELECT year(o.order_date) AS year, c.segment, sum(o.net_cents) AS cents
              FROM facts o JOIN customers c USING (customer_id) GROUP BY 1, 2)""",
    "measures_customers": f"""
        SELECT a.order_month, a.n AS active_customers, coalesce(w.n, 0) AS new_customers,
               a.n - coalesce(w.n, 0) AS returning_customers, {rate("a.cents", "a.n * 100", 2)} AS revenue_per_customer
        FROM (SELECT order_month, count(DISTINCT customer_id) FILTER (is_revenue_order) AS n, sum(net_cents) AS cents
              FROM facts GROUP BY 1) a
        LEFT JOIN (SELECT first_order_month AS order_month, count(*) AS n FROM customers GROUP BY 1) w USING (order_month)""",
    "measure_retained_mom": f"""
        WITH buyers AS (SELECT DISTINCT order_month AS m, customer_id FROM facts WHERE is_revenue_order),
        spans AS (SELECT m FROM buyers UNION SELECT (m + INTERVAL 1 MONTH)::DATE FROM buyers)
        SELECT order_month, active_customers, prior_customers, retained_customers_mom,
               {rate("retained_customers_mom", "prior_customers", 6)} AS customer_retention_rate_mom
        FROM (
            SELECT s.m AS order_month,
                   (SELECT count(*) FROM buyers b WHERE b.m = s.m) AS active_customers,
                   (SELECT count(*) FROM buyers b WHERE b.m = (s.m - INTERVAL 1 MONTH)::DATE) AS prior_customers,
                   (SELECT count(*) FROM buyers b JOIN buyers p ON p.customer_id = b.customer_id
                     AND p.m = (b.m - INTERVAL 1 MONTH)::DATE WHERE b.m = s.m) AS retained_customers_mom
            FROM spans s WHERE s.m <= (SELECT max(order_month) FROM facts))""",
    "measures_customer_flow": f"""
        WITH b AS (SELECT DISTINCT o.customer_id, c.segment, o.order_month AS m FROM facts o JOIN customers c USING (customer_id)
                   WHERE o.is_revenue_order),
        f AS (SELECT customer_id, segment, m, bool_or(cur) AS cur, bool_or(NOT cur) AS prv
              FROM (SELECT *, true AS cur FROM b UNION ALL SELECT customer_id, segment, (m + INTERVAL 1 MONTH)::DATE, false FROM b)
              WHERE m <= (SELECT max(order_month) FROM facts) GROUP BY 1, 2, 3),
        g AS (SELECT m, segment, count(*) FILTER (cur) AS a, count(*) FILTER (prv) AS p, count(*) FILTER (cur AND prv) AS r
              FROM f GROUP BY 1, 2),
        n AS (SELECT first_order_month AS m, segment, count(*) AS n FROM customers GROUP BY 1, 2)
        SELECT strftime(x.m, '%Y-%m') AS year_month, x.segment, x.act AS active_customers,
               CASE WHEN g.m IS NOT NULL THEN coalesce(n.n, 0) END AS new_customers,
               g.a - coalesce(n.n, 0) AS returning_customers, g.r AS retained_customers_mom,
               {rate("g.r", "g.p", 6)} AS customer_retention_rate_mom
        FROM (SELECT coalesce(g.m, o.m) AS m, coalesce(g.segment, o.segment) AS segment, o.act
              FROM g FULL JOIN (SELECT o.order_month AS m, c.segment, count(DISTINCT o.customer_id) FILTER (is_revenue_order) AS act
                                FROM facts o JOIN customers c USING (customer_id) GROUP BY 1, 2) o
                ON o.m = g.m AND o.segment = g.segment) x
        LEFT JOIN g ON g.m = x.m AND g.segment = x.segment
        LEFT JOIN n ON n.m = x.m AND n.segment = x.segment AND g.m IS NOT NULL""",
    "measures_customer_flow_by_year": """
        WITH b AS (SELECT DISTINCT o.customer_id, c.country, o.order_month AS m FROM facts o JOIN customers c USING (customer_id)
                   WHERE o.is_revenue_order AND c.segment = 'SMB'),
        f AS (SELECT customer_id, country, year(m) AS y, bool_or(cur) AS cur, bool_or(NOT cur) AS prv
              FROM (SELECT *, true AS cur FROM b UNION ALL SELECT customer_id, country, (m + INTERVAL 1 MONTH)::DATE, false FROM b)
              WHERE m <= (SELECT max(o.order_month) FROM facts o JOIN customers c USING (customer_id) WHERE c.segment = 'SMB')
              GROUP BY 1, 2, 3),
        n AS (SELECT year(first_order_date) AS y, country, count(*) AS n FROM customers
              WHERE segment = 'SMB' AND first_order_date IS NOT NULL GROUP BY 1, 2)
        SELECT f.y AS year, f.country, coalesce(max(n.n), 0) AS new_customers,
               count(*) FILTER (f.cur) - coalesce(max(n.n), 0) AS returning_customers,
               count(*) FILTER (f.cur AND f.prv) AS retained_customers_mom
        FROM f LEFT JOIN n ON n.y = f.y AND n.country = f.country GROUP BY 1, 2""",
    "measures_buyers_by_channel": f"""
        WITH b AS (SELECT DISTINCT customer_id, sales_channel, order_month AS m FROM facts WHERE is_revenue_order),
        f AS (SELECT customer_id, sales_channel, year(m) AS y, quarter(m) AS q, bool_or(cur) AS cur, bool_or(NOT cur) AS prv
              FROM (SELECT *, true AS cur FROM b
                    UNION ALL SELECT customer_id, sales_channel, (m + INTERVAL 1 MONTH)::DATE, false FROM b)
              WHERE m <= (SELECT max(order_month) FROM facts) GROUP BY 1, 2, 3, 4),
        g AS (SELECT y, q, sales_channel, count(*) FILTER (cur) AS a, count(*) FILTER (prv) AS p,
                     count(*) FILTER (cur AND prv) AS r FROM f GROUP BY 1, 2, 3),
        n AS (SELECT year(first_order_date) AS y, quarter(first_order_date) AS q, count(*) AS n FROM customers
              WHERE first_order_date IS NOT NULL GROUP BY 1, 2),
        o AS (SELECT year(order_date) AS y, quarter(order_date) AS q, sales_channel,
                     count(DISTINCT customer_id) FILTER (is_revenue_order) AS act FROM facts GROUP BY 1, 2, 3)
        SELECT coalesce(g.y, o.y) AS year, coalesce(g.q, o.q) AS quarter, coalesce(g.sales_channel, o.sales_channel) AS sales_channel,
               o.act AS active_customers, CASE WHEN g.y IS NOT NULL THEN coalesce(n.n, 0) END AS new_customers,
               g.a - coalesce(n.n, 0) AS returning_customers, g.r AS retained_customers_mom,
               {rate("g.r", "g.p", 6)} AS customer_retention_rate_mom
        FROM g FULL JOIN o ON g.y = o.y AND g.q = o.q AND g.sales_channel = o.sales_channel
        LEFT JOIN n ON n.y = g.y AND n.q = g.q""",
    "measures_buyers_by_channel_and_segment": f"""
        WITH b AS (SELECT DISTINCT o.customer_id, o.sales_channel, c.segment, o.order_month AS m
                   FROM facts o JOIN customers c USING (customer_id) WHERE o.is_revenue_order AND c.country IN ('GB', 'DE', 'FR')),
        f AS (SELECT customer_id, sales_channel, segment, m, bool_or(cur) AS cur, bool_or(NOT cur) AS prv
              FROM (SELECT *, true AS cur FROM b
                    UNION ALL SELECT customer_id, sales_channel, segment, (m + INTERVAL 1 MONTH)::DATE, false FROM b)
              WHERE m <= (SELECT max(order_month) FROM facts) GROUP BY 1, 2, 3, 4)
        SELECT m AS order_month, sales_channel, segment, count(*) FILTER (cur AND prv) AS retained_customers_mom,
               {rate("count(*) FILTER (cur AND prv)", "count(*) FILTER (prv)", 6)} AS customer_retention_rate_mom
        FROM f GROUP BY 1, 2, 3""",
    "measures_yoy_by_segment": f"""
        SELECT order_month, segment, {usd("rev")} AS total_revenue, {usd("py")} AS revenue_py,
               {rate("coalesce(rev, 0) - py", "py", 6)} AS revenue_yoy_pct,
               CASE WHEN coalesce({rate("coalesce(rev, 0) - py", "py", 6)}, 0) >= 0 THEN '#16A34A' ELSE '#DC2626' END
                   AS yoy_colour
        FROM (
            SELECT m.order_month, g.segment, r.rev, lag(r.rev, 12) OVER (PARTITION BY g.segment ORDER BY m.order_month) AS py
            FROM months m
            JOIN (SELECT DISTINCT c.segment FROM facts o JOIN customers c USING (customer_id) WHERE c.country = 'DE') g ON true
            LEFT JOIN (SELECT o.order_month, c.segment, sum(o.net_cents) AS rev FROM facts o JOIN customers c USING (customer_id)
                       WHERE c.country = 'DE' GROUP BY 1, 2) r ON r.order_month = m.order_month AND r.segment = g.segment)
        WHERE year(order_month) = 2000""",
    "measures_category": f"""
        SELECT year, category, {usd("cents")} AS total_revenue,
               {rate("cents", "sum(cents) OVER (PARTITION BY year)", 6)} AS revenue_share_pct
        FROM (SELECT year(l.order_date) AS year, l.category, sum(l.net_cents) AS cents FROM lines l
              JOIN customers c USING (customer_id) WHERE c.country IN ('GB', 'DE', 'FR') GROUP BY 1, 2)""",
    "measures_executive": f"""
        SELECT country, {usd("cents")} AS total_revenue, n AS active_customers,
               {rate("cents", "sum(cents) OVER ()", 6)} AS revenue_share_pct
        FROM (SELECT c.country, sum(o.net_cents) AS cents, count(DISTINCT o.customer_id) FILTER (o.is_revenue_order) AS n
              FROM facts o JOIN customers c USING (customer_id) GROUP BY 1)""",
    "measures_ltv": f"""
        SELECT segment, {rate("sum(cents)", "count(*) * 100", 2)} AS avg_customer_ltv,
               {rate("sum(clv)", "count(*) * 100", 2)} AS avg_predicted_clv,
               {rate("count(*) FILTER (orders > 1)", "count(*)", 6)} AS repeat_purchase_rate_pct,
               count(*) FILTER (lifecycle_status = 'Churned') AS churned_customers,
               {rate("count(*) FILTER (lifecycle_status = 'Churned')", "count(*)", 6)} AS churn_rate_pct,
               {rate("coalesce(sum(cents) FILTER (pct >= 9000), 0)", "sum(cents)", 6)} AS top_10pct_customer_revenue_share,
               max(champions) AS champions_count
        FROM ltv JOIN (SELECT segment, count(*) FILTER (rfm_segment = 'Champions') AS champions FROM rfm GROUP BY 1)
             USING (segment) GROUP BY 1""",
    "measures_cohort": f"""
        SELECT age AS months_since_first, {rate("sum(active)", "sum(size)", 6)} AS cohort_retention_pct,
               max({rate("running", "size * 100", 2)}) AS cohort_cumulative_revenue_per_customer
        FROM cohorts GROUP BY 1""",
    "measure_last_refreshed": "SELECT 'Data as of ' || strftime(max(order_date), '%d %b %Y') AS last_refreshed FROM facts",
    "visual_channel_year_matrix": f"""
        WITH s AS (SELECT sales_channel, year(order_date) AS year, sum(net_cents) AS cents,
                          coalesce(sum(discount_cents) FILTER (is_revenue_order), 0) AS d,
                          coalesce(sum(gross_cents) FILTER (is_revenue_order), 0) AS g FROM facts GROUP BY 1, 2)
        SELECT s.sales_channel, s.year, {usd("s.cents")} AS total_revenue,
               {rate("s.cents - p.cents", "p.cents", 6)} AS revenue_yoy_pct, {rate("s.d", "s.g", 6)} AS discount_rate_pct
        FROM s LEFT JOIN s p ON p.sales_channel = s.sales_channel AND p.year = s.year - 1""",
    "visual_lifecycle_by_segment": "SELECT segment, lifecycle_status, count(*) AS customers FROM ltv GROUP BY 1, 2",
    "visual_clv_by_channel": f"SELECT acquisition_channel, {rate('sum(clv)', 'count(*) * 100', 2)} AS avg_predicted_clv, "
    "count(*) AS customers FROM ltv GROUP BY 1",
    "visual_rfm_donut": f"SELECT rfm_segment, count(*) AS customers, {usd('sum(cents)')} AS revenue_usd FROM rfm GROUP BY 1",
    "visual_revenue_by_country": f"""
        SELECT c.country, {usd("sum(net_cents)")} AS total_revenue, count(*) FILTER (is_revenue_order) AS completed_orders,
               count(DISTINCT customer_id) FILTER (is_revenue_order) AS active_customers
        FROM facts JOIN customers c USING (customer_id) GROUP BY 1""",
    "visual_new_vs_returning": """
        SELECT a.order_month, coalesce(w.n, 0) AS new_customers, a.n - coalesce(w.n, 0) AS returning_customers
        FROM (SELECT order_month, count(DISTINCT customer_id) FILTER (is_revenue_order) AS n FROM facts GROUP BY 1) a
        LEFT JOIN (SELECT first_order_month AS order_month, count(*) AS n FROM customers GROUP BY 1) w USING (order_month)""",
    "rls_revenue_by_country": f"""
        SELECT c.country, {usd("sum(net_cents)")} AS total_revenue, count(*) FILTER (is_revenue_order) AS completed_orders,
               count(DISTINCT customer_id) FILTER (is_revenue_order) AS active_customers
        FROM facts JOIN customers c USING (customer_id) WHERE c.country IN ('GB', 'DE', 'FR') GROUP BY 1""",
    "mask_email": "SELECT customer_id, '*****' || substr(email, strpos(email, '@')) AS email, country FROM customers",
    "ops_latest_run_per_stage": """
        SELECT stage, run_id, status, started_at, duration_seconds, error_message FROM (
            SELECT *, row_number() OVER (PARTITION BY stage ORDER BY started_at DESC, run_id DESC) AS rn FROM (
                SELECT CASE WHEN event_type IN ('view', 'click') THEN 'ingest' WHEN event_type = 'purchase'
                            THEN 'transform' ELSE 'publish' END AS stage,
                       'run-' || event_id AS run_id,
                       CASE WHEN event_id % 9 = 4 THEN 'failed' ELSE 'success' END AS status, ts AS started_at,
                       (event_id % 600)::DOUBLE AS duration_seconds,
                       CASE WHEN event_id % 9 = 4 THEN 'boom' END AS error_message
                FROM events)) WHERE rn = 1""",
    "ops_failed_checks_7d": """
        SELECT ts AS checked_at, 'run-' || event_id AS run_id,
               CASE WHEN event_id % 2 = 0 THEN 'orders' ELSE 'customers' END AS table_name,
               'check-' || (event_id % 27) AS check_name,
               CASE WHEN event_id % 7 = 0 THEN 'warning' ELSE 'error' END AS severity, (event_id % 11) || ' rows' AS detail
        FROM events WHERE event_id % 5 = 3 AND ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY""",
    "ops_rows_per_batch": f"""
        SELECT _batch_id, min(_loaded_at) AS loaded_at, count(*) AS order_rows FROM ({DAILY})
        GROUP BY 1 ORDER BY loaded_at DESC, _batch_id LIMIT 30""",
    "source_freshness": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, max(_loaded_at) AS max_loaded_at, CASE WHEN max(_loaded_at) IS NULL OR "
        f"max(_loaded_at) < {NOW} - INTERVAL 50 HOUR THEN 'error' WHEN max(_loaded_at) < {NOW} - INTERVAL 26 HOUR "
        f"THEN 'warn' ELSE 'pass' END AS freshness FROM raw_{t}"
        for t in TABLES
    ),
    "batch_retention_tier": f"""
        SELECT _batch_id, loaded_at, rows, CASE WHEN age > 2555 THEN 'delete' WHEN age > 180 THEN 'archive'
               WHEN age > 30 THEN 'cool' ELSE 'hot' END AS tier, age <= 90 AS kept_in_raw
        FROM (SELECT _batch_id, max(_loaded_at) AS loaded_at, count(*) AS rows,
                     date_diff('day', max(_loaded_at)::DATE, DATE '2001-12-03') AS age FROM ({DAILY}) GROUP BY 1)""",
    "stream_orders_folded": f"SELECT {ORDER}, order_date, _loaded_at FROM stg_orders",
    "stream_orders_latest": f"SELECT {ORDER}, order_date, _loaded_at FROM stg_orders",
}


def _needed(sql: str) -> list[str]:
    """The expressions a statement refers to, directly or not, in order of definition."""
    found: set[str] = set()
    queue = [sql]
    while queue:
        words = set(re.findall(r"[a-z_0-9]+", queue.pop()))
        for name in words & CTE.keys() - found:
            found.add(name)
            queue.append(CTE[name])
    return [name for name in CTE if name in found]


def oracle() -> dict[str, str]:
    result = {}
    for name, sql in Q.items():
        parts = ",\n".join(f"{cte} AS MATERIALIZED ({CTE[cte].strip()})" for cte in _needed(sql))
        result[name] = f"WITH {parts}\nSELECT * FROM ({sql.strip()})" if parts else sql.strip()
    return result
