"""Intake, warehouse and listing results in DuckDB SQL, straight from the source rows."""

from __future__ import annotations

from verification import oracle_metrics as m

NOW = "TIMESTAMP '2024-06-01'"
H8 = "INTERVAL 8 HOUR"  # the zone is eight hours ahead of UTC all through the data


def rows(table: str, key: str, start: str | None = None, later: str | None = None) -> str:
    """Source rows with k, and local times a (first) and b (later)."""
    start = start or "TIMESTAMP '1999-01-01' + to_days(CAST(k % 700 AS INTEGER)) + to_hours(k % 24)"
    later = later or "to_days(CAST(k % 11 AS INTEGER))"
    return (
        f"(SELECT *, a + {later} AS b FROM (SELECT *, {start} + {H8} AS a "
        f"FROM (SELECT *, {key} AS k FROM {table})))"
    )


PART, SUPPLIER, CUSTOMER = (
    rows("part", "p_partkey"), rows("supplier", "s_suppkey"), rows("customer", "c_custkey"),
)
ORDERS = rows(
    "orders", "o_orderkey", "o_orderdate + to_hours(k % 24)", "to_days(CAST(k % 5 AS INTEGER))"
)
EVENTS = rows("events", "event_id", "date_trunc('second', ts)", "to_hours(1 + k % 9)")
NATION = rows("nation", "n_nationkey")

GOOD_ORDER = "k % 41 <> 0 AND k % 301 <> 1"
GOOD_TAX = "(k % 45) * 2.5 <= 100"
GOOD_MODIFIER = "k % 29 <> 0 AND k % 23 <> 0"
KIND = """CASE k % 6 WHEN 0 THEN 'FIXED_PERCENT' WHEN 1 THEN 'FIXED_AMOUNT' WHEN 2 THEN 'VARIABLE_PERCENT'
          WHEN 3 THEN 'VARIABLE_AMOUNT' WHEN 4 THEN 'DISCOUNT_BY_POINTS' ELSE 'OTHER' END"""
AMOUNT = "CASE WHEN k % 7 <> 0 THEN CAST(k % 50 - 1 AS DOUBLE) END"
PERCENT = "CASE WHEN k % 11 <> 0 THEN CAST(k % 110 AS DOUBLE) END"
COLOUR = """CASE WHEN k % 31 = 0 THEN 'BEIGE' WHEN k % 3 = 0 THEN 'GREY' ELSE
            list_extract(['GREY','RED','PINK','ORANGE','GREEN','BLUE','PURPLE','LIME'], 1 + k % 8) END"""
HOOK = """list_extract(['inventory_levels.update','items.update','customers.update','receipts.update',
          'shifts.create','orders.update'], 1 + k % 6)"""


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, '[A-Za-z]+|[^A-Za-z]+'), "
        "lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


def tidy(x: str) -> str:
    return f"nullif(trim(regexp_replace({x}, '\\s+', ' ', 'g')), '')"


def reasons(source: str, key: str, tests: dict[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {bad} THEN '{name}' END" for name, bad in tests.items())
    return f"""
        SELECT * FROM (SELECT {key}, array_to_string(list_filter([{cases}], lambda x: x IS NOT NULL), '; ')
          AS reasons FROM {source}) WHERE reasons <> ''"""


CUSTOMER_NAME = title(tidy("chr(9) || upper(c_mktsegment) || '  d''arc ' || c_name"))
DISCOUNT_TESTS = {
    "discount_amount out of range": f"{AMOUNT} < 0",
    "discount_percent out of range": f"{PERCENT} > 100",
    "type not allowed": f"{KIND} = 'OTHER'",
    "discount_amount missing": f"{KIND} = 'FIXED_AMOUNT' AND {AMOUNT} IS NULL",
    "discount_percent missing": f"{KIND} = 'FIXED_PERCENT' AND {PERCENT} IS NULL",
}
GOOD_DISCOUNT = " AND ".join(f"({t}) IS NOT TRUE" for t in DISCOUNT_TESTS.values())
SKU = "repeat('S', CAST(k % 43 AS INTEGER)) || '-' || k"
GOOD_VARIANT = f"length({SKU}) <= 40 AND (k % 37 <> 0 OR k % 8 = 0)"

LINES = f"""
    SELECT 'R-' || k || '-' || i AS id, 'R-' || k AS receipt_id,
           CAST((k * 7 + i) % 200 AS VARCHAR) AS item_id,
           CASE WHEN i <> 2 THEN CAST((k * 7 + i) % 200 AS VARCHAR) END AS variant_id,
           'Item ' || ((k * 7 + i) % 40) AS item_name,
           CAST(i AS DOUBLE) AS quantity, CAST(k % 90 AS DOUBLE) AS price,
           CASE WHEN i = 1 THEN CAST(k % 90 AS DOUBLE) ELSE 0e0 END AS gross_total_money,
           CAST(i * (k % 90) AS DOUBLE) AS total_money,
           CASE WHEN i <> 3 THEN CAST(k % 45 AS DOUBLE) END AS cost,
           CASE WHEN i <> 3 THEN CAST(i * (k % 45) AS DOUBLE) END AS cost_total,
           0e0 AS total_discount
    FROM (SELECT *, unnest(range(1, 2 + k % 3)) AS i FROM {ORDERS}) WHERE {GOOD_ORDER}"""

HEADERS = f"""
    SELECT 'R-' || k AS receipt_number, CASE WHEN k % 20 = 0 THEN 'REFUND' ELSE 'SALE' END AS receipt_type,
           a AS receipt_date, b AS updated_at, o_totalprice AS total_money
    FROM {ORDERS} WHERE {GOOD_ORDER}"""

PAYMENTS = f"""
    SELECT 'R-' || k AS receipt_id, CAST(1 AS INTEGER) AS position,
           CASE WHEN k % 10 = 3 THEN 'pay-1' ELSE 'pay-' || (k % 3) END AS payment_type_id,
           CASE WHEN k % 10 = 3 THEN 'Cash' ELSE o_orderpriority END AS name, 'CASH' AS type,
           CASE WHEN k % 10 = 3 THEN o_totalprice - 100e0 ELSE o_totalprice END AS money_amount, a AS paid_at
    FROM {ORDERS} WHERE {GOOD_ORDER}
    UNION ALL
    SELECT 'R-' || k, 2, 'pay-2', 'Card', 'CARD', 100e0, b FROM {ORDERS} WHERE {GOOD_ORDER} AND k % 10 = 3"""

# pending orders have come back completed, the others are as loaded
AFTER_CHANGE = f"""
    SELECT 'R-' || k AS receipt_number, 'SALE' AS receipt_type, a AS receipt_date,
           TIMESTAMP '2001-09-10 08:00:00' + to_days(CAST(k % 20 AS INTEGER)) AS updated_at, o_totalprice + 1e3 AS total_money
    FROM {ORDERS} WHERE o_orderstatus = 'P'
    UNION ALL
    SELECT * FROM ({HEADERS} AND o_orderstatus <> 'P')"""
LINES_AFTER_CHANGE = f"""
    SELECT 'R-' || k || '-1' AS id, 'R-' || k AS receipt_id, 'Completed' AS item_name, 1e0 AS quantity,
           5e0 AS total_money
    FROM {ORDERS} WHERE o_orderstatus = 'P'
    UNION ALL
    SELECT id, receipt_id, item_name, quantity, total_money FROM ({LINES} AND o_orderstatus <> 'P')"""

_N = "SELECT COUNT(*) FROM"
COUNTS = {
    "categories": f"{_N} part WHERE p_partkey % 31 <> 0",
    "stores": f"{_N} supplier WHERE s_suppkey % 9 <> 0 AND s_suppkey % 37 <= 34",
    "suppliers": f"{_N} supplier WHERE 5 + s_suppkey % 13 <= 15",
    "taxes": f"{_N} {PART} WHERE {GOOD_TAX}",
    "modifiers": f"{_N} {PART} WHERE {GOOD_MODIFIER}",
    "discounts": f"{_N} {PART} WHERE {GOOD_DISCOUNT}",
    "employees": f"{_N} customer WHERE c_custkey % 19 <> 0",
    "customers": f"{_N} customer",
    "pos_devices": f"{_N} supplier WHERE s_suppkey % 13 <> 0",
    "payment_types": f"{_N} supplier",
    "items": f"{_N} part",
    "variants": f"{_N} {PART} WHERE {GOOD_VARIANT}",
    "receipts": f"{_N} {ORDERS} WHERE {GOOD_ORDER}",
    "merchant": f"{_N} nation WHERE n_nationkey % 6 <> 5 AND n_nationkey % 8 <> 7",
    "inventory": f"{_N} part WHERE p_partkey % 53 <> 0",
    "webhooks": f"{_N} customer WHERE c_custkey % 6 <> 5",
    "shifts": f"{_N} events WHERE event_id % 61 <> 0",
    "employee_store": f"{_N} customer WHERE c_custkey % 19 <> 0",
    "item_tax": "SELECT SUM(1 + p_partkey % 3) FROM part",
    "item_modifier": f"{_N} part WHERE p_partkey % 2 = 1",
    "modifier_store": f"{_N} {PART} WHERE {GOOD_MODIFIER}",
    "tax_store": f"SELECT SUM(1 + k % 4) FROM {PART} WHERE {GOOD_TAX}",
    "discount_store": f"{_N} {PART} WHERE {GOOD_DISCOUNT}",
    "payment_type_store": f"{_N} supplier",
    "variant_store": f"{_N} {PART} WHERE {GOOD_VARIANT}",
    "receipt_line_items": f"SELECT SUM(1 + k % 3) FROM {ORDERS} WHERE {GOOD_ORDER}",
    "receipt_payments": f"SELECT COUNT(*) + SUM(CASE WHEN k % 10 = 3 THEN 1 ELSE 0 END) FROM {ORDERS} WHERE {GOOD_ORDER}",
    "modifier_options": f"SELECT SUM(1 + k % 3) FROM {PART} WHERE {GOOD_MODIFIER}",
    "shift_taxes": f"{_N} events WHERE event_id % 61 <> 0",
    "shift_payments": f"{_N} events WHERE event_id % 61 <> 0",
    "shift_cash_movements": f"{_N} events WHERE event_id % 61 <> 0 AND event_id % 5 = 0",
    "sync_metadata": "SELECT 17",
}
TIMES = {  # rows per parent row
    "employee_store": 2, "item_modifier": 2, "modifier_store": 2, "discount_store": 2,
    "payment_type_store": 2, "variant_store": 3, "shift_payments": 2,
}

HEAD = "receipt_number, receipt_type, created_at, total_money"
LIVE = "deleted_at IS NULL"
TEXT = "strftime({0}, '%Y-%m-%dT%H:%M:%S')"

CUSTOMERS_CLEAN = f"""
    SELECT CAST(k AS VARCHAR) AS id, {CUSTOMER_NAME} AS name,
           CASE WHEN k % 3 <> 0 THEN 'c' || k || '@example.org' END AS email,
           CASE WHEN k % 2 <> 0 THEN '+63 900 ' || k END AS phone_number,
           CASE WHEN k % 17 <> 0 THEN a END AS first_visit, b AS last_visit,
           CASE WHEN k % 9 = 0 THEN 1 ELSE CAST(k % 9 AS INTEGER) END AS total_visits, c_acctbal AS total_spent,
           CASE WHEN k % 6 = 0 THEN {NOW} ELSE a END AS created_at, b AS updated_at
    FROM {CUSTOMER}"""
EMPLOYEE_NAME = title(tidy("'  o''neil   mc-' || lower(c_mktsegment) || ' ' || k || 'th '"))

RECEIPT_ROUNDTRIP = """
    SELECT receipt_number, receipt_type, {0} AS receipt_date, total_money, customer_id,
           'say "' || receipt_number || '", then, go' AS note FROM receipts"""

RAW = {
    "i01_page_reader": f"""
        SELECT CAST(k AS VARCHAR) AS id,
               CASE WHEN k % 6 = 0 THEN 'null' ELSE strftime(a - {H8}, '%Y-%m-%dT%H:%M:%SZ') END AS created_at,
               c_acctbal AS total_spent
        FROM {CUSTOMER} WHERE k % 10 NOT IN (3, 5, 7)""",
    "i01_unreadable_pages": f"""
        SELECT CASE k % 10 WHEN 3 THEN 'temporarily unavailable ' || k
                 WHEN 5 THEN '{{"customers": "none", "cursor": "' || k || '"}}'
                 ELSE '{{"errors": [' || k || ']}}' END AS page,
               CASE k % 10 WHEN 3 THEN 'not a JSON object' ELSE 'no list ''customers''' END AS reason
        FROM {CUSTOMER} WHERE k % 10 IN (3, 5, 7)""",
    "i02_rename_aliases": f"SELECT CAST(k AS VARCHAR) AS id, 'it-' || k AS item_id, {SKU} AS sku FROM {PART}",
    "i03_defaults": f"""
        SELECT 'it-' || k AS id, p_name AS name, CASE WHEN k % 2 = 0 THEN p_name ELSE 'h-' || k END AS handle,
               'SQUARE' AS form, 'GREY' AS color, k % 3 = 0 AS track_stock FROM {PART}""",
    "i04_string_hygiene": f"SELECT id, name, email, phone_number FROM ({CUSTOMERS_CLEAN})",
    "i04_title_case": f"""
        SELECT 'emp-' || k AS id, CASE WHEN k % 19 <> 0 THEN {EMPLOYEE_NAME} END AS name,
               'e' || k || '@shop.example' AS email FROM {CUSTOMER}""",
    "i05_enums_colour": f"SELECT 'cat-' || k AS id, {COLOUR} AS color FROM {PART}",
    "i05_enums_merchant": f"""
        SELECT 'm-' || k AS id, CASE WHEN k % 6 = 5 THEN 'XYZ' ELSE 'PH' END AS country,
               CASE WHEN k % 8 <> 7 THEN 'PHP' END AS currency FROM {NATION}""",
    "i06_timestamps": f"""
        SELECT id, first_visit, last_visit, created_at, updated_at FROM ({CUSTOMERS_CLEAN})""",
    "i07_validate_discounts": reasons(PART, "'dis-' || k AS id", DISCOUNT_TESTS),
    "i07_validate_taxes": reasons(PART, "'tax-' || k AS id", {"rate out of range": f"NOT {GOOD_TAX}"}),
    "i07_validate_variants": reasons(
        PART, "CAST(k AS VARCHAR) AS id",
        {"sku longer than 40": f"length({SKU}) > 40", "cost out of range": "k % 37 = 0 AND k % 8 <> 0"},
    ),
    "i07_validate_modifiers": reasons(
        PART, "'mod-' || k AS id",
        {"position missing": "k % 29 = 0", "modifier_options price out of range": "k % 23 = 0"},
    ),
    "i07_validate_categories": reasons(PART, "'cat-' || k AS id", {"color not allowed": "k % 31 = 0"}),
    "i07_validate_stores": reasons(
        SUPPLIER, "'st-' || k AS id",
        {"name longer than 40": "6 + k % 37 > 40", "country longer than 2": "k % 9 = 0"},
    ),
    "i08_required_receipts": reasons(
        ORDERS, "'R-' || k AS receipt_number",
        {"receipt_type missing": "k % 41 = 0", "line_items item_name missing": "k % 301 = 1"},
    ),
    "i08_required_shifts": reasons(EVENTS, "'sh-' || k AS id", {"opened_at missing": "k % 61 = 0"}),
    "i09_ids_as_text": f"""
        SELECT 'R-' || k AS receipt_number, 'R-' || k AS id,
               CASE WHEN o_custkey % 10 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id FROM {ORDERS}""",
    "i10_split_receipts": f"""
        SELECT 'R-' || k AS receipt_number, CASE WHEN k % 20 = 0 THEN 'REFUND' ELSE 'SALE' END AS receipt_type,
               a AS receipt_date, a AS created_at, b AS updated_at, CASE WHEN k % 97 = 0 THEN b END AS deleted_at,
               CASE WHEN k % 50 = 7 THEN a END AS cancelled_at, o_totalprice AS total_money,
               CASE WHEN k % 3 = 0 THEN floor(o_totalprice * 2e0) / 1e2 ELSE 0e0 END AS tip, 0e0 AS surcharge,
               CASE WHEN o_custkey % 10 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
               'emp-' || (k % 25) AS employee_id, 'st-' || (k % 5) AS store_id
        FROM {ORDERS} WHERE {GOOD_ORDER}""",
    "i10_split_receipts_lines": LINES,
    "i10_split_receipts_payments": PAYMENTS,
    "i11_split_items": f"""
        SELECT 'it-' || k AS id, p_name AS name, CASE WHEN k % 13 <> 0 THEN 'cat-' || k END AS category_id,
               a AS created_at FROM {PART}""",
    "i11_split_items_tax": f"""
        SELECT 'it-' || k AS item_id, 'tax-' || unnest(range(1, 2 + k % 3)) AS tax_id FROM {PART}""",
    "i11_split_items_modifier": f"""
        SELECT 'it-' || k AS item_id, unnest(['mod-1', 'mod-2']) AS modifier_id FROM {PART} WHERE k % 2 = 1""",
    "i12_split_employees": f"""
        SELECT 'emp-' || k AS employee_id, unnest(['st-1', 'st-' || (k % 7 + 2)]) AS store_id
        FROM {CUSTOMER} WHERE k % 19 <> 0""",
    "i13_split_modifiers": f"""
        SELECT 'mod-' || k AS modifier_id, unnest(['st-1', 'st-2']) AS store_id FROM {PART} WHERE {GOOD_MODIFIER}""",
    "i13_split_modifier_options": f"""
        SELECT 'mod-' || k || '-' || i AS id, 'mod-' || k AS modifier_id, 'Option ' || i AS name,
               CASE WHEN i = 2 THEN 0e0 ELSE CAST(i * 10 AS DOUBLE) END AS price,
               CAST(CASE WHEN i = 3 THEN 0 ELSE i END AS INTEGER) AS position, a AS created_at
        FROM (SELECT *, unnest(range(1, 2 + k % 3)) AS i FROM {PART}) WHERE {GOOD_MODIFIER}""",
    "i14_split_taxes": f"""
        SELECT 'tax-' || k AS tax_id, 'st-' || unnest(range(0, 1 + k % 4)) AS store_id FROM {PART} WHERE {GOOD_TAX}""",
    "i15_split_discounts": f"""
        SELECT 'dis-' || k AS discount_id, unnest(['st-0', 'st-' || (k % 5 + 1)]) AS store_id
        FROM {PART} WHERE {GOOD_DISCOUNT}""",
    "i15_split_discounts_values": f"""
        SELECT 'dis-' || k AS id, {KIND} AS type,
               CASE WHEN k % 6 = 1 THEN {AMOUNT} END AS discount_amount,
               CASE WHEN k % 6 = 0 THEN {PERCENT} END AS discount_percent, FALSE AS restricted_access
        FROM {PART} WHERE {GOOD_DISCOUNT}""",
    "i16_split_payment_types": f"""
        SELECT 'pay-' || k AS payment_type_id, unnest(['st-1', 'st-2']) AS store_id FROM {SUPPLIER}""",
    "i17_split_variants": f"""
        SELECT CAST(k AS VARCHAR) AS variant_id,
               CASE s WHEN 0 THEN 'st-0' WHEN 1 THEN 'st-1' ELSE 'st-' || (2 + k % 3) END AS store_id,
               CASE WHEN s = 0 THEN k % 2 = 0 ELSE TRUE END AS available_for_sale,
               CASE WHEN s = 1 THEN CAST(k % 20 AS DOUBLE) END AS optimal_stock,
               CASE WHEN s = 0 THEN CAST(k % 9 AS DOUBLE) END AS low_stock_threshold
        FROM (SELECT *, unnest(range(3)) AS s FROM {PART}) WHERE {GOOD_VARIANT}""",
    "i18_split_shifts": f"""
        SELECT 'sh-' || k AS id, 'st-' || (user_id % 5) AS store_id, a AS opened_at,
               CASE WHEN k % 4 <> 0 THEN b END AS closed_at, value AS starting_cash,
               CASE WHEN k % 3 = 0 THEN 0e0 ELSE value * 2 END AS gross_sales, 0e0 AS refunds
        FROM {EVENTS} WHERE k % 61 <> 0""",
    "i18_split_shifts_taxes": f"""
        SELECT 'sh-' || k || '-t' AS id, 'sh-' || k AS shift_id, 'VAT' AS name,
               CASE WHEN k % 2 = 0 THEN 12e0 ELSE 0e0 END AS rate, value AS amount FROM {EVENTS} WHERE k % 61 <> 0""",
    "i18_split_shifts_payments": f"""
        SELECT 'sh-' || k || '-p' || i AS id, 'sh-' || k AS shift_id,
               CASE WHEN i = 1 THEN event_type ELSE 'CARD' END AS name, CASE WHEN i = 1 THEN value ELSE 0e0 END AS amount
        FROM (SELECT *, unnest(range(1, 3)) AS i FROM {EVENTS}) WHERE k % 61 <> 0""",
    "i18_split_shifts_cash": f"""
        SELECT 'sh-' || k || '-c' AS id, 'sh-' || k AS shift_id, a AS time, value AS amount, event_type AS note
        FROM {EVENTS} WHERE k % 61 <> 0 AND k % 5 = 0""",
    "i19_pass_categories": f"""
        SELECT 'cat-' || k AS id, p_type AS name, {COLOUR} AS color,
               CASE WHEN k % 4 = 0 THEN {NOW} ELSE a END AS updated_at, CAST(NULL AS TIMESTAMP) AS deleted_at
        FROM {PART} WHERE k % 31 <> 0""",
    "i19_pass_stores": f"""
        SELECT 'st-' || k AS id, 'Store ' || repeat('x', CAST(k % 37 AS INTEGER)) AS name, 'City ' || k AS city,
               'PH' AS country, a AS created_at FROM {SUPPLIER} WHERE k % 9 <> 0 AND 6 + k % 37 <= 40""",
    "i19_pass_suppliers": f"""
        SELECT CAST(k AS VARCHAR) AS id, s_name AS name, 'Contact ' || k AS contact,
               repeat('9', CAST(5 + k % 13 AS INTEGER)) AS phone_number FROM {SUPPLIER} WHERE 5 + k % 13 <= 15""",
    "i19_pass_customers": f"SELECT id, name, total_visits, total_spent FROM ({CUSTOMERS_CLEAN})",
    "i19_pass_pos_devices": f"""
        SELECT 'pos-' || k AS id, 'Till ' || k AS name, 'st-' || (k % 5) AS store_id, k % 2 = 0 AS activated,
               CAST(NULL AS TIMESTAMP) AS deleted_at FROM {SUPPLIER} WHERE k % 13 <> 0""",
    "i19_pass_payment_types": f"""
        SELECT 'pay-' || k AS id, 'Tender ' || k AS name,
               CASE WHEN k % 2 = 0 THEN 'CASH' ELSE 'NONINTEGRATEDCARD' END AS type FROM {SUPPLIER}""",
    "i19_pass_inventory": f"""
        SELECT CAST(k AS VARCHAR) AS variant_id, 'st-' || (k % 5) AS store_id,
               CAST(CASE WHEN k % 10 = 0 THEN 0 ELSE k % 23 - 1 END AS INTEGER) AS in_stock, a AS updated_at
        FROM {PART} WHERE k % 53 <> 0""",
    "i19_pass_webhooks": f"""
        SELECT 'wh-' || k AS id, 'm-' || (k % 25) AS merchant_id, 'https://hook.example/' || k AS url, {HOOK} AS type,
               CASE WHEN k % 4 = 0 THEN 'ENABLED' ELSE 'DISABLED' END AS status, a AS created_at, a AS updated_at
        FROM {CUSTOMER} WHERE k % 6 <> 5""",
    "i19_pass_merchant": f"""
        SELECT 'm-' || k AS id, n_name AS business_name, 'PH' AS country, 'PHP' AS currency
        FROM {NATION} WHERE k % 6 <> 5 AND k % 8 <> 7""",
    "w02_upsert_receipts": AFTER_CHANGE,
    "w02_upsert_receipt_lines": LINES_AFTER_CHANGE,
    "w03_full_load_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(({sql}) * {TIMES.get(t, 1)} AS BIGINT) AS row_count"
        for t, sql in COUNTS.items()
    ),
    "w03_windowed_load": f"""
        SELECT * FROM ({HEADERS}) WHERE receipt_date >= DATE '1999-01-01' AND receipt_date < DATE '2000-01-01'""",
    "w04_incremental_sync": AFTER_CHANGE,
    "w05_streaming_sync": AFTER_CHANGE,
    "w06_sync_metadata": f"""
        WITH c AS ({AFTER_CHANGE})
        SELECT 'receipts' AS resource_name, (SELECT MAX(updated_at) FROM c) AS last_sync_at,
               (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'P') AS records_count, 'incremental' AS sync_type
        UNION ALL SELECT 'items', MAX(a), COUNT(*), 'full' FROM {PART}
        UNION ALL SELECT 'customers', MAX(b), COUNT(*), 'full' FROM {CUSTOMER}""",
    "w04_late_page": HEADERS,
    "w04_missing_updated_at": f"""
        SELECT c.receipt_number, c.receipt_type, c.receipt_date,
               CASE WHEN o.o_orderkey % 50 = 2 AND o.o_orderstatus <> 'P' THEN {NOW} ELSE c.updated_at END AS updated_at,
               c.total_money
        FROM ({AFTER_CHANGE}) c JOIN orders o ON c.receipt_number = 'R-' || o.o_orderkey""",
    "w03_window_then_sync": HEADERS,
    "w04_one_resource_fails": f"""
        SELECT 'customers' AS table_name, COUNT(*) AS row_count FROM ({CUSTOMERS_CLEAN})
        UNION ALL SELECT 'receipts', COUNT(*) FROM ({HEADERS})""",
    "w02_clashing_line_ids": """
        SELECT 'R-' || o_orderkey AS receipt_id, unnest(['1', '2']) AS id FROM orders""",
    "i07_wrong_types": reasons(
        f"(SELECT *, 'tax-' || k AS id FROM {PART})",
        "id",
        {
            "rate is no number": "k % 5 IN (0, 1, 4)",
            "created_at is no time": "k % 4 = 0",
        },
    ),
    "i01_mixed_page": f"SELECT id, name, total_visits, total_spent FROM ({CUSTOMERS_CLEAN})",
    "i01_mixed_page_rejects": f"""
        SELECT 'record' AS kind, 'not an object' AS reasons, unnest(['17', 'x', 'null', '[1]']) AS body,
               COUNT(DISTINCT k // 50) AS n FROM {CUSTOMER}""",
    "c05_empty_period": "SELECT 0e0 AS total_revenue",
    "w08_table_listing": "SELECT unnest(['customers', 'employees', 'employee_store']) AS table_name",
    "r07_equal_refunds": f"""
        SELECT {HEAD} FROM receipts WHERE store_id = '0' AND receipt_type = 'REFUND' AND {LIVE}""",
    "r01_list_all_customers": f"SELECT id, name, created_at, updated_at FROM customers WHERE {LIVE}",
    "r06_many_ids": f"SELECT {HEAD} FROM receipts WHERE CAST(receipt_number AS BIGINT) BETWEEN 1 AND 1999 AND {LIVE}",
    "r07_all_items_in_store": f"""
        SELECT id, name FROM items WHERE {LIVE} AND id IN (
          SELECT v.item_id FROM variants v JOIN variant_store s ON v.id = s.variant_id WHERE s.store_id = '3')""",
    "r08_all_receipts_between": f"""
        SELECT {HEAD} FROM receipts WHERE receipt_number > '1' AND receipt_number < '3' AND {LIVE}""",
    "r12_created_on_days": f"""
        SELECT {HEAD} FROM receipts WHERE {LIVE} AND created_at >= TIMESTAMP '2001-07-01'
          AND created_at < {m.TODAY}""",
    "w07_table_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST("
        + (f"({COUNTS[t]}) * {TIMES.get(t, 1)}" if t in ("customers", "employees", "employee_store") else "0")
        + " AS BIGINT) AS row_count"
        for t in COUNTS
    ),
    "w02_metric_on_warehouse": f"""
        SELECT CAST(r.receipt_date AS DATE) AS date, {m.MARGINS.replace('total_money', 'l.total_money')}
        FROM ({LINES}) l JOIN (SELECT 'R-' || k AS receipt_number, a AS receipt_date FROM {ORDERS}
              WHERE k % 41 <> 0 AND k % 20 <> 0 AND k % 50 <> 7) r ON l.receipt_id = r.receipt_number
        WHERE {m.since(365)} GROUP BY 1""",
    "w09_csv_sink": RECEIPT_ROUNDTRIP.format(TEXT.format("receipt_date")),
    "w10_parquet_sink": RECEIPT_ROUNDTRIP.format("receipt_date"),
    "w10_json_sink": RECEIPT_ROUNDTRIP.format("receipt_date"),
    "w11_flatten_nested": f"""
        SELECT 'emp-' || k AS id, '["st-1","st-' || (k % 7 + 2) || '"]' AS stores, k % 5 = 0 AS is_owner
        FROM {CUSTOMER}""",
    "w12_export_text": f"""
        SELECT receipt_number, {TEXT.format('created_at')} AS created_at, {TEXT.format('deleted_at')} AS deleted_at
        FROM receipts""",
    "c04_render_json": f"""
        SELECT '{{"id":"' || id || '","email":"' || email || '","total_visits":' || total_visits
               || ',"first_visit":' || COALESCE('"' || {TEXT.format('first_visit')} || '"', 'null') || '}}' AS line
        FROM customers""",
    "c04_render_csv": f"""
        SELECT id || ',' || email || ',' || total_visits || ',' || COALESCE({TEXT.format('first_visit')}, '') AS line
        FROM customers""",
    "r01_list_customers": f"""
        SELECT id, name, created_at, updated_at FROM customers
        WHERE {LIVE} AND created_at BETWEEN TIMESTAMP '1999-02-01' AND TIMESTAMP '2000-06-30'
          AND updated_at >= TIMESTAMP '1999-02-05' ORDER BY created_at DESC, id LIMIT 200""",
    "r01_list_inventory": "SELECT variant_id, store_id, in_stock FROM inventory",
    "r02_get_receipt": f"SELECT {HEAD} FROM receipts WHERE receipt_number = '42' AND {LIVE}",
    "r02_get_inventory": """
        SELECT variant_id, store_id, in_stock FROM inventory WHERE variant_id = '17' AND store_id = '3'""",
    "r03_is_fresh": """
        SELECT COUNT(*) > 0 AS is_fresh FROM receipts WHERE created_at >= TIMESTAMP '2001-07-31'""",
    "r04_row_json": """
        SELECT '{"number":' || CASE WHEN length(CAST(o_orderkey * 1000003 AS VARCHAR)) > 10
                 THEN '"' || (o_orderkey * 1000003) || '"' ELSE CAST(o_orderkey * 1000003 AS VARCHAR) END
               || ',"status":"' || o_orderstatus || '","ordered":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
               || '","customer":' || CASE WHEN o_custkey % 10 <> 0 THEN CAST(o_custkey AS VARCHAR) ELSE 'null' END
               || ',"even":' || CASE WHEN o_custkey % 2 = 0 THEN 'true' ELSE 'false' END || '}' AS json
        FROM orders""",
    "r06_receipt_ids": f"""
        SELECT {HEAD} FROM receipts WHERE receipt_number IN ('5', '77', '901', '1002', '31') AND {LIVE}""",
    "r06_ids_semi_join": f"""
        SELECT {HEAD} FROM receipts WHERE {LIVE}
          AND customer_id IN (SELECT id FROM customers WHERE ends_with(email, '@gmail.com'))""",
    "r07_equal_status": f"""
        SELECT {HEAD} FROM receipts WHERE store_id = '2' AND receipt_type = 'REFUND' AND {LIVE}""",
    "r07_items_in_store": f"""
        SELECT id, name FROM items WHERE {LIVE} AND id IN (
          SELECT v.item_id FROM variants v JOIN variant_store s ON v.id = s.variant_id WHERE s.store_id = '3')""",
    "r08_receipts_between": f"""
        SELECT {HEAD} FROM receipts WHERE receipt_number > '1' AND receipt_number < '3' AND {LIVE}
        ORDER BY created_at, receipt_number LIMIT 100""",
    "r09_show_deleted": "SELECT id, name, deleted_at FROM items",
    "r10_latest_receipts": f"""
        SELECT {HEAD} FROM receipts WHERE {LIVE} ORDER BY created_at DESC, receipt_number LIMIT 25""",
    "r11_receipts_today": f"SELECT {HEAD} FROM receipts WHERE {LIVE} AND created_at >= {m.TODAY}",
    "r11_receipts_since": f"SELECT {HEAD} FROM receipts WHERE {LIVE} AND created_at >= DATE '2001-01-01'",
    "r13_where": f"""
        SELECT id, name, created_at, updated_at FROM customers
        WHERE {LIVE} AND ends_with(email, '@example.org') AND total_spent > 5000""",
}

# fixed values: the columns of each table, then those that are text, floating, whole, long
# whole, boolean, and times
RAW |= {
    "w01_create": """
        SELECT t.*, CAST(0 AS BIGINT) AS row_count FROM (VALUES
            ('categories', 6, 3, 0, 0, 0, 0, 3), ('stores', 12, 9, 0, 0, 0, 0, 3),
            ('suppliers', 16, 13, 0, 0, 0, 0, 3), ('taxes', 7, 3, 1, 0, 0, 0, 3),
            ('modifiers', 6, 2, 0, 1, 0, 0, 3), ('discounts', 9, 3, 2, 0, 0, 1, 3),
            ('employees', 8, 4, 0, 0, 0, 1, 3), ('customers', 20, 11, 2, 1, 0, 0, 6),
            ('pos_devices', 5, 3, 0, 0, 0, 1, 1), ('payment_types', 6, 3, 0, 0, 0, 0, 3),
            ('items', 20, 13, 0, 0, 0, 4, 3), ('variants', 15, 9, 3, 0, 0, 0, 3),
            ('receipts', 25, 12, 8, 0, 0, 0, 5), ('merchant', 6, 5, 0, 0, 0, 0, 1),
            ('inventory', 4, 2, 0, 1, 0, 0, 1), ('webhooks', 7, 5, 0, 0, 0, 0, 2),
            ('shifts', 23, 5, 13, 0, 0, 0, 5), ('employee_store', 2, 2, 0, 0, 0, 0, 0),
            ('item_tax', 2, 2, 0, 0, 0, 0, 0), ('item_modifier', 2, 2, 0, 0, 0, 0, 0),
            ('modifier_store', 2, 2, 0, 0, 0, 0, 0), ('tax_store', 2, 2, 0, 0, 0, 0, 0),
            ('discount_store', 2, 2, 0, 0, 0, 0, 0), ('payment_type_store', 2, 2, 0, 0, 0, 0, 0),
            ('variant_store', 5, 2, 2, 0, 0, 1, 0), ('receipt_line_items', 15, 8, 7, 0, 0, 0, 0),
            ('receipt_payments', 7, 4, 1, 1, 0, 0, 1), ('modifier_options', 8, 3, 1, 1, 0, 0, 3),
            ('shift_taxes', 5, 3, 2, 0, 0, 0, 0), ('shift_payments', 4, 3, 1, 0, 0, 0, 0),
            ('shift_cash_movements', 5, 3, 1, 0, 0, 0, 1), ('sync_metadata', 4, 2, 0, 0, 1, 0, 1)
        ) AS t(table_name, columns, n_string, n_double, n_int, n_bigint, n_boolean, n_timestamp_ntz)""".replace(
        "SELECT t.*", "SELECT table_name, " + ", ".join(
            f"CAST({c} AS BIGINT) AS {c}"
            for c in ("columns", "n_string", "n_double", "n_int", "n_bigint", "n_boolean", "n_timestamp_ntz")
        )
    ),
    "w02_reader_during_load": f"""
        SELECT *, 'before' AS reader FROM ({HEADERS}) UNION ALL SELECT *, 'after' FROM ({AFTER_CHANGE})""",
    "w02_delta_read": LINES_AFTER_CHANGE,
    "w02_compacted": LINES_AFTER_CHANGE,
    "w02_two_writers": AFTER_CHANGE,
    "r02_warehouse_lookup": f"""
        SELECT * FROM ({AFTER_CHANGE}) WHERE CAST(receipt_number[3:] AS BIGINT) BETWEEN 1 AND 39""",
    "w02_partial_record": f"""
        SELECT id, CASE WHEN p THEN 'New Name ' || id ELSE name END AS name, email, phone_number, first_visit,
               last_visit, total_visits, total_spent, CASE WHEN p THEN 'seen' END AS note,
               CASE WHEN p THEN given ELSE created_at END AS created_at,
               CASE WHEN p THEN TIMESTAMP '2001-09-10 08:00:00' ELSE updated_at END AS updated_at
        FROM (SELECT c.*, CAST(id AS BIGINT) % 3 = 1 AS p, s.a AS given
              FROM ({CUSTOMERS_CLEAN}) c JOIN {CUSTOMER} s ON c.id = CAST(s.k AS VARCHAR))""",
    "w02_partial_record_lines": f"""
        SELECT l.id, l.receipt_id, l.item_name, l.quantity, l.total_money,
               CAST(date_trunc('month', o.a + to_days(CASE WHEN o.k % 3 = 1 THEN 61 ELSE 0 END)) AS DATE) AS receipt_month
        FROM ({LINES}) l JOIN {ORDERS} o ON l.receipt_id = 'R-' || o.k""",
    "i07_wrong_types_nested": reasons(
        f"(SELECT *, 'R-' || k AS receipt_number FROM {ORDERS})",
        "receipt_number",
        {
            "line_items is no list": "k % 13 = 1",
            "line_items holds what is no object": "k % 13 = 0",
            "line_items quantity is no number": "k % 13 > 1 AND k % 4 IN (2, 3)",
            "line_items total_money is no number": "k % 13 > 1 AND k % 5 = 0",
            "payments paid_at is no time": "k % 7 = 0",
        },
    ),
    "w05_repeated_page": f"""
        SELECT 's-' || k AS id, CASE WHEN k % 2 = 0 THEN 'second' ELSE 'first' END AS name,
               CASE WHEN k % 2 = 0 THEN TIMESTAMP '2024-06-02' ELSE TIMESTAMP '2024-06-01' END AS updated_at
        FROM {SUPPLIER}""",
}

RAW["w05_stream_rejects"] = f"""
    SELECT 'page' AS kind, reason AS reasons, COUNT(*) AS n FROM ({RAW["i01_unreadable_pages"]}) GROUP BY 2"""
