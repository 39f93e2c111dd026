"""JSON pages as the source system would deliver them, derived row by row from the star.

Every source row becomes one page. Records vary by key: missing fields, blank times,
ids as numbers, untidy names, and some that break a rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# resource -> (source table, key column, fields of the record)
RECORDS = {
    "categories": (
        "part",
        "p_partkey",
        """'id', concat('cat-', k), 'name', p_type,
           'color', if(k % 31 = 0, 'beige', if(k % 3 = 0, null, lower(elt(1 + k % 8, 'GREY',
              'RED', 'PINK', 'ORANGE', 'GREEN', 'BLUE', 'PURPLE', 'LIME')))),
           'created_at', at, 'updated_at', if(k % 4 = 0, '', at), 'deleted_at', 'null'""",
    ),
    "stores": (
        "supplier",
        "s_suppkey",
        """'id', concat('st-', k), 'name', concat('Store ', repeat('x', int(k % 37))), 'city', concat('City ', k),
           'country', if(k % 9 = 0, 'PHL', 'PH'), 'created_at', at, 'updated_at', at""",
    ),
    "suppliers": (
        "supplier",
        "s_suppkey",
        """'id', k, 'name', s_name, 'contact', concat('Contact ', k), 'country_code', 'PH',
           'phone_number', repeat('9', int(5 + k % 13)), 'created_at', at, 'updated_at', at""",
    ),
    "taxes": (
        "part",
        "p_partkey",
        """'id', concat('tax-', k), 'name', concat('Tax ', k), 'type', 'ADDED',
           'rate', (k % 45) * 2.5, 'stores', transform(sequence(0, int(k % 4)), i -> concat('st-', i)),
           'created_at', at, 'updated_at', at""",
    ),
    "modifiers": (
        "part",
        "p_partkey",
        """'id', concat('mod-', k), 'name', p_name, 'position', if(k % 29 = 0, null, int(k % 10)),
           'stores', array('st-1', 'st-2', 'st-1'),
           'modifier_options', transform(sequence(1, int(1 + k % 3)), i -> named_struct(
              'id', concat('mod-', k, '-', i), 'name', concat('Option ', i),
              'price', if(i = 2, null, double(i * 10 - if(k % 23 = 0, 20, 0))),
              'position', if(i = 3, null, i), 'created_at', at, 'updated_at', at)),
           'created_at', at, 'updated_at', at""",
    ),
    "discounts": (
        "part",
        "p_partkey",
        """'id', concat('dis-', k), 'name', concat('Discount ', k),
           'type', elt(1 + k % 6, 'FIXED_PERCENT', 'FIXED_AMOUNT', 'VARIABLE_PERCENT',
                       'VARIABLE_AMOUNT', 'DISCOUNT_BY_POINTS', 'OTHER'),
           'discount_amount', if(k % 7 = 0, null, double(k % 50 - 1)),
           'discount_percent', if(k % 11 = 0, null, double(k % 110)),
           'stores', array('st-0', concat('st-', k % 5 + 1)), 'created_at', at, 'updated_at', at""",
    ),
    "employees": (
        "customer",
        "c_custkey",
        """'id', concat('emp-', k), 'name', if(k % 19 = 0, '   ', concat('  o''neil   mc-', lower(c_mktsegment), ' ', k, 'th ')),
           'email', concat(' e', k, '@shop.example '), 'stores', array('st-1', concat('st-', k % 7 + 2)),
           'is_owner', if(k % 5 = 0, true, null), 'created_at', at, 'updated_at', at""",
    ),
    "customers": (
        "customer",
        "c_custkey",
        r"""'id', k, 'name', concat('\t', upper(c_mktsegment), '  d''arc ', c_name), 'email',
           if(k % 3 = 0, '', concat('c', k, '@example.org')), 'phone_number', if(k % 2 = 0, '  ', '+63  900 ' || k),
           'first_visit', if(k % 17 = 0, null, at), 'last_visit', at2, 'total_visits', if(k % 9 = 0, null, int(k % 9)),
           'total_spent', c_acctbal, 'created_at', if(k % 6 = 0, 'null', at), 'updated_at', at2""",
    ),
    "pos_devices": (
        "supplier",
        "s_suppkey",
        """'id', concat('pos-', k), 'name', concat('Till ', k), 'store_id', if(k % 13 = 0, null, concat('st-', k % 5)),
           'activated', if(k % 2 = 0, null, false)""",
    ),
    "payment_types": (
        "supplier",
        "s_suppkey",
        """'id', concat('pay-', k), 'name', concat('Tender ', k), 'type', if(k % 2 = 0, null, 'nonIntegratedCard'),
           'stores', array('st-1', 'st-2'), 'created_at', at, 'updated_at', at""",
    ),
    "items": (
        "part",
        "p_partkey",
        """'id', concat('it-', k), 'item_name', p_name, 'handle', if(k % 2 = 0, null, concat('h-', k)),
           'category_id', if(k % 13 = 0, null, concat('cat-', k)), 'track_stock', if(k % 3 = 0, true, null),
           'tax_ids', transform(sequence(1, int(1 + k % 3)), i -> concat('tax-', i)),
           'modifier_ids', if(k % 2 = 0, array(), array('mod-1', 'mod-2')),
           'variants', array(named_struct('variant_id', 'ignored')), 'created_at', at, 'updated_at', at""",
    ),
    "variants": (
        "part",
        "p_partkey",
        """'variant_id', k, 'item_id', concat('it-', k), 'sku', concat(repeat('S', int(k % 43)), '-', k),
           'cost', if(k % 8 = 0, null, p_retailprice - if(k % 37 = 0, 5000, 0)), 'default_price', p_retailprice,
           'stores', array(
              to_json(named_struct('store_id', 'st-0', 'available_for_sale', k % 2 = 0,
                                   'low_stock_threshold', double(k % 9))),
              to_json(named_struct('store_id', 'st-1', 'optimal_stock', double(k % 20))),
              concat('"st-', 2 + k % 3, '"')),
           'created_at', at, 'updated_at', at""",
    ),
    "receipts": (
        "orders",
        "o_orderkey",
        """'receipt_number', concat('R-', k), 'receipt_type', if(k % 41 = 0, null, if(k % 20 = 0, 'refund', 'Sale')),
           'receipt_date', at, 'created_at', at, 'updated_at', at2, 'deleted_at', if(k % 97 = 0, at2, ''),
           'cancelled_at', if(k % 50 = 7, at, 'null'),
           'total_money', o_totalprice, 'tip', if(k % 3 = 0, floor(o_totalprice * 2) / 100, null),
           'customer_id', if(o_custkey % 10 = 0, null, o_custkey), 'employee_id', concat('emp-', k % 25),
           'store_id', concat('st-', k % 5), 'pos_device_id', concat('pos-', k % 7),
           'line_items', transform(sequence(1, int(1 + k % 3)), i -> named_struct(
              'id', concat('R-', k, '-', i), 'item_id', (k * 7 + i) % 200, 'variant_id', if(i = 2, null, (k * 7 + i) % 200),
              'item_name', if(k % 301 = 1, null, concat('Item ', (k * 7 + i) % 40)), 'quantity', i, 'price', double(k % 90),
              'total_money', double(i * (k % 90)), 'cost', if(i = 3, null, k % 45),
              'cost_total', if(i = 3, null, i * (k % 45)),
              'gross_total_money', if(i = 1, double(k % 90), null))),
           'payments', if(k % 10 = 3, array(
              named_struct('payment_type_id', 'pay-1', 'name', 'Cash', 'type', 'CASH', 'money_amount', o_totalprice - 100.0, 'paid_at', at),
              named_struct('payment_type_id', 'pay-2', 'name', 'Card', 'type', 'CARD', 'money_amount', 100.0, 'paid_at', at2)),
              array(named_struct('payment_type_id', concat('pay-', k % 3), 'name', o_orderpriority, 'type', 'CASH',
                                 'money_amount', o_totalprice, 'paid_at', at)))""",
    ),
    "merchant": (
        "nation",
        "n_nationkey",
        """'id', concat('m-', k), 'business_name', n_name, 'country', if(k % 6 = 5, 'xyz', 'ph'),
           'currency', named_struct('code', if(k % 8 = 7, null, 'PHP'), 'decimal_places', 2), 'created_at', at""",
    ),
    "inventory": (
        "part",
        "p_partkey",
        """'variant_id', k, 'store_id', concat('st-', k % 5), 'in_stock', if(k % 10 = 0, null, int(k % 23) - 1),
           'updated_at', if(k % 53 = 0, '', at)""",
    ),
    "webhooks": (
        "customer",
        "c_custkey",
        """'id', concat('wh-', k), 'merchant_id', concat('m-', k % 25), 'url', concat('https://hook.example/', k),
           'type', elt(1 + k % 6, 'inventory_levels.update', 'items.update', 'customers.update',
                       'receipts.update', 'shifts.create', 'orders.update'),
           'status', if(k % 4 = 0, null, 'DISABLED'), 'created_at', at, 'updated_at', at""",
    ),
    "shifts": (
        "events",
        "event_id",
        """'id', concat('sh-', k), 'store_id', concat('st-', user_id % 5), 'pos_device_id', concat('pos-', user_id % 7),
           'opened_at', if(k % 61 = 0, '', at), 'closed_at', if(k % 4 = 0, null, at2), 'opened_by_employee', concat('emp-', user_id),
           'starting_cash', value, 'gross_sales', if(k % 3 = 0, null, value * 2),
           'taxes', array(named_struct('id', concat('sh-', k, '-t'), 'name', 'VAT', 'rate', if(k % 2 = 0, 12.0, null), 'amount', value)),
           'payments', array(named_struct('id', concat('sh-', k, '-p1'), 'name', event_type, 'amount', value),
                             named_struct('id', concat('sh-', k, '-p2'), 'name', 'CARD', 'amount', null)),
           'cash_movements', if(k % 5 = 0, array(named_struct('id', concat('sh-', k, '-c'), 'time', at,
                                'amount', value, 'note', event_type)), null)""",
    ),
}

# the source's own time, and a later one
TIMES = {
    "orders": ("o_orderdate + make_dt_interval(0, int(k % 24))", "make_dt_interval(int(k % 5))"),
    "events": ("date_trunc('SECOND', ts)", "make_dt_interval(0, int(1 + k % 9))"),
}
EPOCH = "timestamp_ntz'1999-01-01 00:00:00' + make_dt_interval(int(k % 700), int(k % 24))"


def source(spark: SparkSession, sf_dir: str, resource: str) -> DataFrame:
    """The source rows with k (key), at and at2 (ISO times in UTC)."""
    table, key, _ = RECORDS[resource]
    start, later = TIMES.get(table, (EPOCH, "make_dt_interval(int(k % 11))"))
    iso = "yyyy-MM-dd''T''HH:mm:ss''Z''"
    return (
        spark.read.parquet(f"{sf_dir}/{table}.parquet")
        .selectExpr("*", f"{key} AS k")
        .selectExpr("*", f"CAST({start} AS TIMESTAMP_NTZ) AS t0")
        .selectExpr("*", f"t0 + {later} AS t1")
        .selectExpr("*", f"date_format(t0, '{iso}') AS at", f"date_format(t1, '{iso}') AS at2")
    )


def pages(spark: SparkSession, sf_dir: str, resource: str, rows: DataFrame | None = None) -> DataFrame:
    """One JSON page per source row, in a column ``value``."""
    from posmetrics.plans.resources import RESOURCES

    key = RESOURCES[resource].items_key
    record = f"named_struct({RECORDS[resource][2]})"
    rows = source(spark, sf_dir, resource) if rows is None else rows
    if key is None:
        body = f"to_json({record})"
    else:
        body = f"to_json(named_struct('{key}', array({record}), 'cursor', string(k)))"
    if resource == "variants":
        # the list mixes objects and plain ids, which no single type can hold
        body = (
            f"regexp_replace({body}, '\"stores\":.*\\\\],\"created_at\"', "
            "concat('\"stores\":[', array_join(stores, ','), '],\"created_at\"'))"
        )
        stores = RECORDS[resource][2].split("'stores', ")[1].rsplit(",\n           'created_at'", 1)[0]
        rows = rows.selectExpr("*", f"{stores} AS stores")
    return rows.selectExpr(f"{body} AS value")


def damaged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of customers of which some are cut off and some lack their list."""
    whole = pages(spark, sf_dir, "customers")
    kind = "int(get_json_object(value, '$.cursor')) % 10"
    return whole.selectExpr(
        f"""CASE WHEN {kind} = 3 THEN 'temporarily unavailable ' || get_json_object(value, '$.cursor')
                 WHEN {kind} = 5 THEN '{{"customers": "none", "cursor": "' || get_json_object(value, '$.cursor') || '"}}'
                 WHEN {kind} = 7 THEN '{{"errors": [' || get_json_object(value, '$.cursor') || ']}}'
                 ELSE value END AS value"""
    )
