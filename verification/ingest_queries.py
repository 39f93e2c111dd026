"""Intake, warehouse, listing and output operators over the whole derived feed, by key."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from posmetrics import Engine, sinks
from posmetrics.operators import listing
from posmetrics.plans import intake
from posmetrics.plans.sync import Loader
from posmetrics.plans.warehouse import Warehouse
from posmetrics.session import configure, scratch_dir
from posmetrics.sources.landing import Landing
from posmetrics.sources.schemas import TABLES
from posmetrics.sources.star import AS_OF, StarTables
from posmetrics.streaming.continuous import follow
from verification import feed

NOW = datetime(2024, 6, 1)


def _prepared(spark, sf_dir, resource):
    return intake.prepared(feed.pages(configure(spark), sf_dir, resource), resource, NOW)


def cleaned(resource, *columns):
    def run(spark, sf_dir):
        raw = intake.records(feed.pages(configure(spark), sf_dir, resource), resource)
        return intake.clean(raw, resource, NOW).select(*columns)

    return run


def broken(resource, key="id"):
    def run(spark, sf_dir):
        checked = _prepared(spark, sf_dir, resource).filter(F.size(intake.ERRORS) > 0)
        return checked.select(key, F.array_join(intake.ERRORS, "; ").alias("reasons"))

    return run


def split(resource, table, *columns):
    def run(spark, sf_dir):
        good = intake.valid(_prepared(spark, sf_dir, resource))
        df = intake.split(good, resource)[table]
        return df.select(*(columns or TABLES[table].columns))

    return run


def page_records(spark, sf_dir):
    damaged = feed.damaged_pages(configure(spark), sf_dir)
    return intake.records(damaged, "customers").select("id", "created_at", "total_spent")


def quarantine(spark, sf_dir):
    return intake.unreadable(feed.damaged_pages(configure(spark), sf_dir), "customers")


# warehouse


def _land(spark, sf_dir, landing, resources, mode="error"):
    """Pages as files of bounded size: a packed file is read by one task."""
    for r in resources:
        pages = feed.pages(spark, sf_dir, r).write.mode(mode)
        pages.option("compression", "gzip").option("maxRecordsPerFile", 250_000).text(landing.path(r))


def _changed_orders(spark, sf_dir):
    """What the source sends later: pending orders come back completed.

    Changed in September 2001, at a new total and with one line left.
    """
    rows = feed.source(spark, sf_dir, "receipts").filter("o_orderstatus = 'P'")
    return rows.selectExpr(
        """to_json(named_struct('receipts', array(named_struct(
             'receipt_number', concat('R-', k), 'receipt_type', 'SALE', 'receipt_date', at,
             'created_at', at,
             'updated_at', concat('2001-09-', 10 + k % 20, 'T00:00:00Z'),
             'total_money', o_totalprice + 1000.0, 'store_id', concat('st-', k % 5),
             'line_items', array(named_struct('id', concat('R-', k, '-1'), 'item_id', 'it-1',
                'item_name', 'Completed', 'quantity', 1, 'price', 5.0, 'total_money', 5.0)))))) AS value"""
    )


def _fresh(spark, label):
    configure(spark)
    root = scratch_dir(spark, label)
    warehouse = Warehouse(spark, f"{root}/warehouse")
    warehouse.create()
    return warehouse, Landing(spark, f"{root}/landing")


RECEIPT = ("receipt_number", "receipt_type", "receipt_date", "updated_at", "total_money")
LINE = ("id", "receipt_id", "item_name", "quantity", "total_money")


def upserted(table, columns, late=False):
    def run(spark, sf_dir):
        warehouse, _ = _fresh(spark, "upsert")
        warehouse.upsert("receipts", intake.valid(_prepared(spark, sf_dir, "receipts")))
        changed = intake.prepared(_changed_orders(spark, sf_dir), "receipts", NOW)
        warehouse.upsert("receipts", intake.valid(changed))
        if late:  # a late copy of the old state must not undo the change
            warehouse.upsert("receipts", intake.valid(_prepared(spark, sf_dir, "receipts")))
        return warehouse.table(table).select(*columns)

    return run


def _changed_warehouse(spark, sf_dir, label):
    """All receipts, then their changes as deltas on top; also the reader in between."""
    warehouse, _ = _fresh(spark, label)
    warehouse.upsert("receipts", intake.valid(_prepared(spark, sf_dir, "receipts")))
    reader = warehouse.pinned()
    changed = intake.prepared(_changed_orders(spark, sf_dir), "receipts", NOW)
    warehouse.upsert("receipts", intake.valid(changed))
    return warehouse, reader


def reader_during_load(spark, sf_dir):
    """A reader that began before a load goes on seeing what was there."""
    warehouse, reader = _changed_warehouse(spark, sf_dir, "reader")
    seen = [(w.table("receipts").select(*RECEIPT), name) for w, name in ((reader, "before"), (warehouse, "after"))]
    before, after = (df.withColumn("reader", F.lit(name)) for df, name in seen)
    return before.unionByName(after)


def delta_read(spark, sf_dir):
    warehouse, _ = _changed_warehouse(spark, sf_dir, "delta")
    assert len({p.load for p in warehouse.now().of("receipt_line_items")}) == 2
    return warehouse.table("receipt_line_items").select(*LINE)


def compacted(spark, sf_dir):
    warehouse, _ = _changed_warehouse(spark, sf_dir, "compact")
    assert warehouse.compact("receipts")
    assert len({p.load for p in warehouse.now().of("receipt_line_items")}) == 1
    return warehouse.table("receipt_line_items").select(*LINE)


def looked_up(spark, sf_dir):
    """By number, through the index of receipts, some of which have changed."""
    warehouse, _ = _changed_warehouse(spark, sf_dir, "lookup")
    numbers = [(f"R-{i}",) for i in range(1, 40)]
    return warehouse.lookup("receipts", numbers).select(*RECEIPT)


def two_writers(spark, sf_dir):
    """Both halves of the changes are loaded at once."""
    from concurrent.futures import ThreadPoolExecutor

    warehouse, _ = _fresh(spark, "writers")
    warehouse.upsert("receipts", intake.valid(_prepared(spark, sf_dir, "receipts")))
    changes = _changed_orders(spark, sf_dir)
    odd = F.get_json_object("value", "$.receipts[0].receipt_number").endswith("1")

    def load(pages):
        Warehouse(spark, warehouse.root).upsert("receipts", intake.valid(intake.prepared(pages, "receipts", NOW)))

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(load, [changes.filter(odd), changes.filter(~odd)]))
    return warehouse.table("receipts").select(*RECEIPT)


def _partly_changed(spark, sf_dir, resource, record, where):
    warehouse, _ = _fresh(spark, "partial")
    warehouse.upsert(resource, intake.valid(_prepared(spark, sf_dir, resource)))
    rows = feed.source(spark, sf_dir, resource).filter(where)
    pages = rows.selectExpr(f"to_json(named_struct('{resource}', array(named_struct({record})))) AS value")
    warehouse.merge(resource, pages, "partial", NOW, partial=True)
    return warehouse


def partial_records(spark, sf_dir):
    """Some customers come back with a name and a note only."""
    record = """'id', k, 'name', concat('new name ', k), 'created_at', at, 'note', 'seen',
                'updated_at', '2001-09-10T00:00:00Z'"""
    warehouse = _partly_changed(spark, sf_dir, "customers", record, "k % 3 = 1")
    return warehouse.table("customers").select(
        "id", "name", "email", "phone_number", "first_visit", "last_visit", "total_visits", "total_spent", "note",
        "created_at", "updated_at",
    )


def partial_receipts(spark, sf_dir):
    """Some receipts come back without lines and two months later; their lines move along."""
    record = """'receipt_number', concat('R-', k), 'receipt_type', 'SALE', 'created_at', at, 'total_money', 1.0,
                'updated_at', '2001-09-10T00:00:00Z',
                'receipt_date', date_format(t0 + make_dt_interval(61), "yyyy-MM-dd'T'HH:mm:ss'Z'")"""
    warehouse = _partly_changed(spark, sf_dir, "receipts", record, "k % 3 = 1 AND k % 41 <> 0 AND k % 301 <> 1")
    return warehouse.stored("receipt_line_items").select(*LINE, "receipt_month")


def wrong_nested_types(spark, sf_dir):
    pages = feed.source(configure(spark), sf_dir, "receipts").selectExpr(
        """concat('{"receipts":[{"receipt_number":"R-', k, '","receipt_type":"SALE","receipt_date":"', at,
             '","created_at":"', at, '","updated_at":"', at, '","total_money":1,"line_items":',
             CASE WHEN k % 13 = 0 THEN '[5]' WHEN k % 13 = 1 THEN '"none"' ELSE concat(
               '[{"id":"a","item_id":"i","item_name":"n","price":1,"total_money":', if(k % 5 = 0, '"much"', '1'),
               ',"quantity":', elt(1 + k % 4, '1', '"2"', '"two"', '{}'), '}]') END,
             ',"payments":[{"payment_type_id":"p","money_amount":1,"paid_at":"', if(k % 7 = 0, 'soon', at),
             '"}]}]}') AS value"""
    )
    bad = intake.prepared(pages, "receipts", NOW).filter(F.size(intake.ERRORS) > 0)
    return bad.select("receipt_number", F.array_join(intake.ERRORS, "; ").alias("reasons"))


def created_tables(spark, sf_dir):
    """Columns of each kind, and rows, of all tables of a new warehouse."""
    warehouse, _ = _fresh(spark, "create")
    kinds = ("string", "double", "int", "bigint", "boolean", "timestamp_ntz")
    counted = [F.count_if(F.col("data_type") == k).alias(f"n_{k}") for k in kinds]
    tables = warehouse.schemas().groupBy("table_name").agg(F.count("*").alias("columns"), *counted)
    return tables.join(warehouse.counts(), "table_name")


def repeated_page(spark, sf_dir):
    """All pages land again, and some of them with other contents; records lack the time
    of their change, so that a repeated page would look like a newer version."""
    warehouse, landing = _fresh(spark, "repeat")
    rows = feed.source(spark, sf_dir, "suppliers")

    def pages(name, where):
        return rows.filter(where).selectExpr(
            f"""to_json(named_struct('suppliers', array(named_struct(
                  'id', concat('s-', k), 'name', '{name}', 'created_at', at)))) AS value"""
        )

    def load(df, day):
        df.coalesce(1).write.mode("append").text(landing.path("suppliers"))
        follow(
            warehouse, landing, "suppliers", now=datetime(2024, 6, day), replays_within="7 days"
        ).awaitTermination()

    load(pages("first", "true"), 1)
    load(pages("second", "k % 2 = 0"), 2)
    load(pages("first", "true"), 3)
    return warehouse.table("suppliers").select("id", "name", "updated_at")


def full_load(spark, sf_dir):
    warehouse, landing = _fresh(spark, "load")
    resources = list(feed.RECORDS)
    _land(spark, sf_dir, landing, resources)
    Loader(warehouse, landing, now=NOW).load_all()
    return warehouse.counts()


def windowed_load(spark, sf_dir):
    """Only receipts created in 1999 (local time)."""
    warehouse, landing = _fresh(spark, "window")
    _land(spark, sf_dir, landing, ["receipts"])
    Loader(warehouse, landing, now=NOW).load_all(
        ["receipts"],
        created_at_min=datetime(1999, 1, 1),
        created_at_max=datetime(1999, 12, 31, 23, 59, 59),
    )
    return warehouse.table("receipts").select(*RECEIPT)


def _synced(spark, sf_dir):
    warehouse, landing = _fresh(spark, "sync")
    some = ["receipts", "customers", "items"]
    _land(spark, sf_dir, landing, some)
    loader = Loader(warehouse, landing, now=NOW)
    loader.sync(some)
    _changed_orders(spark, sf_dir).write.mode("append").text(landing.path("receipts"))
    loader.sync(["receipts"])
    return loader


def incremental_sync(spark, sf_dir):
    return _synced(spark, sf_dir).warehouse.table("receipts").select(*RECEIPT)


def sync_metadata(spark, sf_dir):
    return _synced(spark, sf_dir).sync_metadata()


def streaming_sync(spark, sf_dir):
    """Old and changed pages arrive in several batches; the tables end up the same."""
    warehouse, landing = _fresh(spark, "stream")
    _land(spark, sf_dir, landing, ["receipts"])
    query = follow(warehouse, landing, "receipts", now=NOW)
    query.awaitTermination()
    _changed_orders(spark, sf_dir).write.mode("append").text(landing.path("receipts"))
    query = follow(warehouse, landing, "receipts", now=NOW, files_per_batch=1)
    query.awaitTermination()
    return warehouse.table("receipts").select(*RECEIPT)


def table_counts(spark, sf_dir):
    """Two loaded resources; the other tables are there but empty, or missing."""
    warehouse = Warehouse(configure(spark), f"{scratch_dir(spark, 'counts')}/warehouse")
    for resource in ("customers", "employees"):
        warehouse.upsert(resource, intake.valid(_prepared(spark, sf_dir, resource)))
    return warehouse.counts()


def metric_on_warehouse(spark, sf_dir):
    warehouse, _ = _fresh(spark, "metric")
    warehouse.upsert("receipts", intake.valid(_prepared(spark, sf_dir, "receipts")))
    return Engine(warehouse, AS_OF).profitability.gross_profit(days=365)


def late_pages(spark, sf_dir):
    """A third of the receipts lands after a sync, most of them older than what it saw."""
    warehouse, landing = _fresh(spark, "late")
    rows = feed.source(spark, sf_dir, "receipts")
    loader = Loader(warehouse, landing, now=NOW)
    for part in ("k % 3 <> 0", "k % 3 = 0"):
        feed.pages(spark, sf_dir, "receipts", rows.filter(part)).write.mode("append").text(landing.path("receipts"))
        loader.sync(["receipts"])
    return warehouse.table("receipts").select(*RECEIPT)


def unstamped(spark, sf_dir):
    """Some receipts lack the time of their change and are stamped with the load time;
    changes that are older than that stamp still come through."""
    warehouse, landing = _fresh(spark, "unstamped")
    rows = feed.source(spark, sf_dir, "receipts").withColumn(
        "at2", F.when(F.expr("k % 50 = 2 AND o_orderstatus <> 'P'"), "").otherwise(F.col("at2"))
    )
    feed.pages(spark, sf_dir, "receipts", rows).write.text(landing.path("receipts"))
    loader = Loader(warehouse, landing, now=NOW)
    loader.sync(["receipts"])
    _changed_orders(spark, sf_dir).write.mode("append").text(landing.path("receipts"))
    loader.sync(["receipts"])
    return warehouse.table("receipts").select(*RECEIPT)


def window_then_sync(spark, sf_dir):
    warehouse, landing = _fresh(spark, "then")
    _land(spark, sf_dir, landing, ["receipts"])
    loader = Loader(warehouse, landing, now=NOW)
    loader.load_all(["receipts"], created_at_min=datetime(1999, 1, 1), created_at_max=datetime(1999, 12, 31))
    loader.sync(["receipts"])
    return warehouse.table("receipts").select(*RECEIPT)


def one_fails(spark, sf_dir):
    """Customers have not landed at the first sync; the second catches up."""
    warehouse, landing = _fresh(spark, "fails")
    _land(spark, sf_dir, landing, ["receipts"])
    loader = Loader(warehouse, landing, now=NOW)
    assert set(loader.sync(["customers", "receipts"]).errors) == {"customers"}
    _land(spark, sf_dir, landing, ["customers"])
    assert not loader.sync(["customers", "receipts"]).errors
    return warehouse.counts(["customers", "receipts"])


def stream_rejects(spark, sf_dir):
    warehouse, landing = _fresh(spark, "rejects")
    feed.damaged_pages(spark, sf_dir).write.text(landing.path("customers"))
    follow(warehouse, landing, "customers", now=NOW).awaitTermination()
    return warehouse.rejects("customers").groupBy("kind", "reasons").agg(F.count("*").alias("n"))


def clashing_lines(spark, sf_dir):
    """Every receipt numbers its lines 1 and 2; they arrive in two batches."""
    warehouse, _ = _fresh(spark, "clash")
    for part in ("k % 2 = 0", "k % 2 = 1"):
        rows = feed.source(spark, sf_dir, "receipts").filter(part)
        pages = rows.selectExpr(
            """to_json(named_struct('receipts', array(named_struct(
                 'receipt_number', concat('R-', k), 'receipt_type', 'SALE', 'receipt_date', at, 'created_at', at,
                 'updated_at', at2, 'total_money', o_totalprice, 'store_id', 'st-1',
                 'line_items', transform(array('1', '2'), i -> named_struct('id', i, 'item_id', 'it-1',
                    'item_name', 'x', 'quantity', 1, 'price', 5.0, 'total_money', 5.0)))))) AS value"""
        )
        warehouse.upsert("receipts", intake.valid(intake.prepared(pages, "receipts", NOW)))
    return warehouse.table("receipt_line_items").select("receipt_id", "id")


def wrong_types(spark, sf_dir):
    rows = feed.source(configure(spark), sf_dir, "taxes")
    pages = rows.selectExpr(
        """concat('{"taxes":[{"id":"tax-', k, '","name":"n","type":"ADDED","rate":',
             elt(1 + k % 5, '"many"', '[1]', '"12.5"', '7', 'true'),
             ',"created_at":"', if(k % 4 = 0, 'garbage', at), '"}]}') AS value"""
    )
    checked = intake.prepared(pages, "taxes", NOW).filter(F.size(intake.ERRORS) > 0)
    return checked.select("id", F.array_join(intake.ERRORS, "; ").alias("reasons"))


def _mixed(spark, sf_dir):
    """Fifty records a page, with four elements that are no objects."""
    one = feed.pages(configure(spark), sf_dir, "customers").selectExpr(
        "get_json_object(value, '$.customers[0]') AS record", "int(get_json_object(value, '$.cursor')) AS k"
    )
    return one.groupBy(F.expr("k div 50")).agg(F.array_join(F.collect_list("record"), ",").alias("all")).selectExpr(
        """concat('{"customers":[17,', all, ',"x",null,[1]]}') AS value"""
    )


def mixed_pages(spark, sf_dir):
    judged = intake.judged(_mixed(spark, sf_dir), "customers", NOW)
    return intake.accepted(judged).select("id", "name", "total_visits", "total_spent")


def mixed_page_rejects(spark, sf_dir):
    judged = intake.judged(_mixed(spark, sf_dir), "customers", NOW)
    return intake.refused(judged).groupBy("kind", "reasons", F.when(F.col("reasons") == "not an object", F.col("body")).alias("body")).agg(
        F.count("*").alias("n")
    )


def empty_period(spark, sf_dir):
    engine = Engine(StarTables(configure(spark), sf_dir), AS_OF)
    return engine.revenue.total_revenue(date_start="1901-01-01", date_end="1901-01-31").toDF("total_revenue")


def table_listing(spark, sf_dir):
    """The tables there are after some have been loaded into a bare folder."""
    warehouse = Warehouse(configure(spark), f"{scratch_dir(spark, 'listing')}/warehouse")
    for resource in ("customers", "employees"):
        warehouse.upsert(resource, intake.valid(_prepared(spark, sf_dir, resource)))
    return spark.createDataFrame([(t,) for t in warehouse.list_tables()], "table_name string")


# listing over the star's tables


def on_listing(build):
    def run(spark, sf_dir):
        return build(Engine(StarTables(configure(spark), sf_dir), AS_OF).listing)

    return run


HEAD = ("receipt_number", "receipt_type", "created_at", "total_money")
PERSON = ("id", "name", "created_at", "updated_at")


def gmail_receipts(spark, sf_dir):
    engine = Engine(StarTables(configure(spark), sf_dir), AS_OF)
    people = engine.adhoc.customers_by_email_domain("@gmail.com").select("id")
    return engine.listing.list_records("receipts", ids={"customer_id": people}, limit=None).select(*HEAD)


LISTING = {
    "r01_list_customers": lambda x: x.list_records(
        "customers",
        created_at_min=datetime(1999, 2, 1),
        created_at_max=datetime(2000, 6, 30),
        updated_at_min=datetime(1999, 2, 5),
        limit=200,
    ).select(*PERSON),
    "r01_list_inventory": lambda x: x.list_records(
        "inventory", created_at_min=datetime(1999, 1, 1), limit=None
    ).select("variant_id", "store_id", "in_stock"),
    "r02_get_receipt": lambda x: x.get("receipts", "42").select(*HEAD),
    "r02_get_inventory": lambda x: x.get("inventory", "17", "3").select(
        "variant_id", "store_id", "in_stock"
    ),
    "r03_is_fresh": lambda x: x.is_fresh(datetime(2001, 8, 2)),
    "r06_receipt_ids": lambda x: x.list_records(
        "receipts", ids={"receipt_number": "5,77, 901 ,1002,31"}
    ).select(*HEAD),
    "r07_equal_status": lambda x: x.list_records(
        "receipts", equals={"store_id": "2", "receipt_type": "REFUND"}, limit=None
    ).select(*HEAD),
    "r07_equal_refunds": lambda x: x.list_records(
        "receipts", equals={"store_id": "0", "receipt_type": "REFUND"}
    ).select(*HEAD),
    "r01_list_all_customers": lambda x: x.list_records("customers").select(*PERSON),
    "r06_many_ids": lambda x: x.list_records(
        "receipts", ids={"receipt_number": [str(i) for i in range(1, 2000)]}
    ).select(*HEAD),
    "r07_all_items_in_store": lambda x: x.items_in_store("3").select("id", "name"),
    "r08_all_receipts_between": lambda x: x.receipts_between(since="1", before="3").select(*HEAD),
    "r12_created_on_days": lambda x: x.list_records(
        "receipts",
        created_at_min=listing.parse_day("2001-07-01", AS_OF),
        created_at_max=listing.parse_day("yesterday", AS_OF, end_of_day=True),
    ).select(*HEAD),
    "r07_items_in_store": lambda x: x.items_in_store("3", limit=None).select("id", "name"),
    "r08_receipts_between": lambda x: x.receipts_between(
        since="1", before="3", sort_order="asc", limit=100
    ).select(*HEAD),
    "r09_show_deleted": lambda x: x.list_records("items", show_deleted=True, limit=None).select(
        "id", "name", "deleted_at"
    ),
    "r10_latest_receipts": lambda x: x.latest_receipts(25).select(*HEAD),
    "r11_receipts_today": lambda x: x.receipts_today().select(*HEAD),
    "r11_receipts_since": lambda x: x.receipts_since(date(2001, 1, 1)).select(*HEAD),
    "r13_where": lambda x: x.list_records(
        "customers", where=F.col("email").endswith("@example.org") & (F.col("total_spent") > 5000), limit=None
    ).select(*PERSON),
}


def row_json(spark, sf_dir):
    """Order keys are blown up so that some of them exceed ten digits."""
    from posmetrics.operators import listing

    orders = StarTables(configure(spark), sf_dir).source("orders")
    return listing.row_json(
        orders.selectExpr(
            "o_orderkey * 1000003 AS number", "o_orderstatus AS status", "o_orderdate AS ordered",
            "CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS customer", "o_custkey % 2 = 0 AS even",
        )
    )


# output


def _roundtrip(write, read):
    def run(spark, sf_dir):
        path = f"{scratch_dir(configure(spark), 'out')}/rows"
        df = StarTables(spark, sf_dir).table("receipts").select(
            "receipt_number", "receipt_type", "receipt_date", "total_money", "customer_id",
            F.concat(F.lit('say "'), "receipt_number", F.lit('", then, go')).alias("note"),
        )
        write(df, path)
        return read(spark, path, df)

    return run


def _read_csv(spark, path, df):
    text = "receipt_number STRING, receipt_type STRING, receipt_date STRING, total_money DOUBLE, customer_id STRING, note STRING"
    return spark.read.schema(text).csv(path, header=True, quote='"', escape='"')


def flattened(spark, sf_dir):
    raw = intake.records(feed.pages(configure(spark), sf_dir, "employees"), "employees")
    return sinks.flatten_nested(intake.clean(raw, "employees", NOW).select("id", "stores", "is_owner"))


def export_text(spark, sf_dir):
    df = StarTables(configure(spark), sf_dir).table("receipts")
    return sinks.as_text(df.select("receipt_number", "created_at", "deleted_at"))


def rendered(fmt):
    def run(spark, sf_dir):
        df = StarTables(configure(spark), sf_dir).table("customers")
        return sinks.render(df.select("id", "email", "total_visits", "first_visit"), fmt)

    return run


QUERIES = {
    "i01_page_reader": page_records,
    "i01_unreadable_pages": quarantine,
    "i02_rename_aliases": cleaned("variants", "id", "item_id", "sku"),
    "i03_defaults": cleaned("items", "id", "name", "handle", "form", "color", "track_stock"),
    "i04_string_hygiene": cleaned("customers", "id", "name", "email", "phone_number"),
    "i04_title_case": cleaned("employees", "id", "name", "email"),
    "i05_enums_colour": cleaned("categories", "id", "color"),
    "i05_enums_merchant": cleaned("merchant", "id", "country", "currency"),
    "i06_timestamps": cleaned("customers", "id", "first_visit", "last_visit", "created_at", "updated_at"),
    "i07_validate_discounts": broken("discounts"),
    "i07_validate_taxes": broken("taxes"),
    "i07_validate_variants": broken("variants"),
    "i07_validate_modifiers": broken("modifiers"),
    "i07_validate_categories": broken("categories"),
    "i07_validate_stores": broken("stores"),
    "i08_required_receipts": broken("receipts", "receipt_number"),
    "i08_required_shifts": broken("shifts"),
    "i09_ids_as_text": cleaned("receipts", "receipt_number", "id", "customer_id"),
    "i10_split_receipts": split(
        "receipts", "receipts", *RECEIPT, "created_at", "deleted_at", "cancelled_at", "tip",
        "surcharge", "customer_id", "employee_id", "store_id",
    ),
    "i10_split_receipts_lines": split(
        "receipts", "receipt_line_items", "id", "receipt_id", "item_id", "variant_id", "item_name",
        "quantity", "price", "gross_total_money", "total_money", "cost", "cost_total", "total_discount",
    ),
    "i10_split_receipts_payments": split("receipts", "receipt_payments"),
    "i11_split_items": split("items", "items", "id", "name", "category_id", "created_at"),
    "i11_split_items_tax": split("items", "item_tax"),
    "i11_split_items_modifier": split("items", "item_modifier"),
    "i12_split_employees": split("employees", "employee_store"),
    "i13_split_modifiers": split("modifiers", "modifier_store"),
    "i13_split_modifier_options": split(
        "modifiers", "modifier_options", "id", "modifier_id", "name", "price", "position", "created_at"
    ),
    "i14_split_taxes": split("taxes", "tax_store"),
    "i15_split_discounts": split("discounts", "discount_store"),
    "i15_split_discounts_values": split(
        "discounts", "discounts", "id", "type", "discount_amount", "discount_percent", "restricted_access"
    ),
    "i16_split_payment_types": split("payment_types", "payment_type_store"),
    "i17_split_variants": split("variants", "variant_store"),
    "i18_split_shifts": split(
        "shifts", "shifts", "id", "store_id", "opened_at", "closed_at", "starting_cash", "gross_sales", "refunds"
    ),
    "i18_split_shifts_taxes": split("shifts", "shift_taxes"),
    "i18_split_shifts_payments": split("shifts", "shift_payments"),
    "i18_split_shifts_cash": split("shifts", "shift_cash_movements"),
    "i19_pass_categories": split("categories", "categories", "id", "name", "color", "updated_at", "deleted_at"),
    "i19_pass_stores": split("stores", "stores", "id", "name", "city", "country", "created_at"),
    "i19_pass_suppliers": split("suppliers", "suppliers", "id", "name", "contact", "phone_number"),
    "i19_pass_customers": split("customers", "customers", "id", "name", "total_visits", "total_spent"),
    "i19_pass_pos_devices": split("pos_devices", "pos_devices"),
    "i19_pass_payment_types": split("payment_types", "payment_types", "id", "name", "type"),
    "i19_pass_inventory": split("inventory", "inventory"),
    "i19_pass_webhooks": split("webhooks", "webhooks"),
    "i19_pass_merchant": split("merchant", "merchant", "id", "business_name", "country", "currency"),
    "w02_upsert_receipts": upserted("receipts", RECEIPT, late=True),
    "w02_upsert_receipt_lines": upserted("receipt_line_items", LINE),
    "w01_create": created_tables,
    "w02_reader_during_load": reader_during_load,
    "w02_delta_read": delta_read,
    "w02_compacted": compacted,
    "w02_two_writers": two_writers,
    "w02_partial_record": partial_records,
    "w02_partial_record_lines": partial_receipts,
    "r02_warehouse_lookup": looked_up,
    "i07_wrong_types_nested": wrong_nested_types,
    "w05_repeated_page": repeated_page,
    "w03_full_load_counts": full_load,
    "w03_windowed_load": windowed_load,
    "w04_incremental_sync": incremental_sync,
    "w05_streaming_sync": streaming_sync,
    "w06_sync_metadata": sync_metadata,
    "w04_late_page": late_pages,
    "w04_missing_updated_at": unstamped,
    "w03_window_then_sync": window_then_sync,
    "w04_one_resource_fails": one_fails,
    "w05_stream_rejects": stream_rejects,
    "w02_clashing_line_ids": clashing_lines,
    "i07_wrong_types": wrong_types,
    "i01_mixed_page": mixed_pages,
    "i01_mixed_page_rejects": mixed_page_rejects,
    "c05_empty_period": empty_period,
    "w08_table_listing": table_listing,
    "w02_metric_on_warehouse": metric_on_warehouse,
    "w07_table_counts": table_counts,
    "w09_csv_sink": _roundtrip(sinks.write_csv, _read_csv),
    "w10_parquet_sink": _roundtrip(
        sinks.write_parquet, lambda spark, path, df: spark.read.parquet(path)
    ),
    "w10_json_sink": _roundtrip(
        sinks.write_json, lambda spark, path, df: spark.read.schema(df.schema).json(path)
    ),
    "w11_flatten_nested": flattened,
    "w12_export_text": export_text,
    "c04_render_json": rendered("json"),
    "c04_render_csv": rendered("csv"),
    **{key: on_listing(build) for key, build in LISTING.items()},
    "r04_row_json": row_json,
    "r06_ids_semi_join": gmail_receipts,
}
