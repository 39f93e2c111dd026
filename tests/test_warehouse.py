from __future__ import annotations

import json
from datetime import date, datetime

import pytest

from posmetrics import Engine
from posmetrics.plans import intake
from posmetrics.plans.sync import Loader, LoadError
from posmetrics.plans.warehouse import Warehouse
from posmetrics.session import scratch_dir
from posmetrics.sources.landing import Landing
from posmetrics.sources.schemas import TABLES
from posmetrics.streaming.continuous import follow

NOW = datetime(2026, 6, 1)


def receipt(number, day="2026-05-01", updated="2026-05-10", money=10.0, lines=("a",)):
    return {
        "receipt_number": number, "receipt_type": "SALE", "receipt_date": f"{day}T00:00:00Z",
        "created_at": f"{day}T00:00:00Z", "updated_at": f"{updated}T00:00:00Z", "total_money": money,
        "line_items": [
            {"id": f"{number}-{x}", "item_id": x, "item_name": x, "quantity": 1, "price": 1, "total_money": 1}
            for x in lines
        ],
    }


def pages(spark, key, *records):
    return spark.createDataFrame([(json.dumps({key: [r]}),) for r in records], "value STRING")


@pytest.fixture
def warehouse(spark):
    made = Warehouse(spark, scratch_dir(spark, "test"))
    made.create()
    return made


def put(warehouse, *records):
    df = pages(warehouse.spark, "receipts", *records)
    return warehouse.upsert("receipts", intake.valid(intake.prepared(df, "receipts", NOW)))


def heads(warehouse):
    return {r.receipt_number: (r.receipt_date.date(), r.total_money) for r in warehouse.table("receipts").collect()}


def lines(warehouse):
    return sorted(r.id for r in warehouse.table("receipt_line_items").collect())


def test_upsert_replaces_parent_and_children(warehouse):
    put(warehouse, receipt("R1", lines="ab"), receipt("R2", lines="c"))
    count, mark = put(warehouse, receipt("R1", updated="2026-05-11", money=20.0, lines="b"))
    assert (count, mark) == (1, datetime(2026, 5, 11, 8))
    assert heads(warehouse) == {"R1": (date(2026, 5, 1), 20.0), "R2": (date(2026, 5, 1), 10.0)}
    assert lines(warehouse) == ["R1-b", "R2-c"]


def test_upsert_twice_changes_nothing(warehouse):
    batch = [receipt("R1", lines="ab"), receipt("R2", day="2026-04-01")]
    put(warehouse, *batch)
    before = heads(warehouse), lines(warehouse)
    put(warehouse, *batch)
    assert (heads(warehouse), lines(warehouse)) == before


def test_newest_version_wins(warehouse):
    put(warehouse, receipt("R1", updated="2026-05-11", money=1.0), receipt("R1", updated="2026-05-12", money=2.0))
    assert heads(warehouse)["R1"][1] == 2.0
    count, _ = put(warehouse, receipt("R1", updated="2026-05-09", money=3.0, lines="z"))
    assert count == 0 and heads(warehouse)["R1"][1] == 2.0 and lines(warehouse) == ["R1-a"]


def test_a_receipt_moves_to_another_month(warehouse):
    put(warehouse, receipt("R1", lines="ab"), receipt("R2", day="2026-03-05"))
    put(warehouse, receipt("R1", day="2026-03-01", updated="2026-05-11", lines="a"))
    assert heads(warehouse) == {"R1": (date(2026, 3, 1), 10.0), "R2": (date(2026, 3, 5), 10.0)}
    assert lines(warehouse) == ["R1-a", "R2-a"]
    march = Engine(warehouse, date(2026, 3, 31)).revenue.total_revenue(date_start="2026-03-01", date_end="2026-03-31")
    assert march.first()[0] == 20.0


def test_children_that_vanish_entirely(warehouse):
    put(warehouse, receipt("R1", lines="ab"))
    put(warehouse, receipt("R1", updated="2026-05-11", lines=""))
    assert lines(warehouse) == [] and len(heads(warehouse)) == 1


def test_create_and_counts(warehouse):
    assert set(warehouse.list_tables()) == set(TABLES)
    assert {r.row_count for r in warehouse.counts().collect()} == {0}
    put(warehouse, receipt("R1", lines="ab"))
    counted = {r.table_name: r.row_count for r in warehouse.counts(["receipts", "receipt_line_items"]).collect()}
    assert counted == {"receipts": 1, "receipt_line_items": 2}
    warehouse.create(drop_existing=True)
    assert warehouse.table("receipts").count() == 0


def test_months_outside_the_window_are_not_read(warehouse):
    put(warehouse, receipt("R1", day="2026-01-05"), receipt("R2", day="2026-05-05"))
    plan = Engine(warehouse, date(2026, 5, 31)).profitability.gross_profit(days=10)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("receipt_month") >= 2 and "PartitionFilters: [isnotnull(receipt_month" in text


def land(spark, landing, resource, *records, mode="append"):
    pages(spark, resource, *records).write.mode(mode).text(landing.path(resource))


def customer(i, updated="2026-05-01"):
    return {"id": str(i), "name": f"c {i}", "created_at": "2026-01-01T00:00:00Z", "updated_at": f"{updated}T00:00:00Z"}


def test_incremental_sync(spark, warehouse):
    landing = Landing(spark, scratch_dir(spark, "land"))
    land(spark, landing, "customers", customer(1), customer(2))
    loader = Loader(warehouse, landing, now=NOW)
    first = loader.sync(["customers", "receipts"])  # no receipts have landed
    assert first.counts == {"customers": 2} and list(first.errors) == ["receipts"]
    assert loader.last_syncs() == {"customers": datetime(2026, 5, 1, 8)}

    land(spark, landing, "customers", customer(3, "2026-05-02"), customer(4, "2025-01-01"))
    land(spark, landing, "receipts", receipt("R1"))
    land(spark, landing, "customers", {"id": "5"})
    assert loader.rejected("customers").first().reasons == "name missing"
    assert loader.unreadable("customers").count() == 0
    second = loader.sync(["customers", "receipts"])
    # only new files are read; 4 changed before what the first sync saw, and counts all the same
    assert second.counts == {"customers": 2, "receipts": 1} and not second.errors
    assert second.rejected == {"customers": 1, "receipts": 0}
    assert sorted(r.id for r in warehouse.table("customers").collect()) == ["1", "2", "3", "4"]
    kept = warehouse.rejects("customers").first()
    assert (kept.kind, kept.reasons, json.loads(kept.body)) == ("record", "name missing", {"id": "5"})
    kinds = {r.resource_name: (r.records_count, r.sync_type) for r in loader.sync_metadata().collect()}
    assert kinds == {"customers": (2, "incremental"), "receipts": (1, "full")}
    assert loader.sync(["customers", "receipts"]).counts == {"customers": 0, "receipts": 0}


def test_every_record_is_stored_replaced_or_refused(spark, warehouse):
    landing = Landing(spark, scratch_dir(spark, "land"))
    texts = [
        json.dumps({"customers": [customer(1), 5, customer(2), None, {"id": "3"}]}),
        json.dumps({"customers": [customer(1, "2026-05-03"), {**customer(4), "total_spent": "much"}]}),
        "no page",
    ]
    spark.createDataFrame([(t,) for t in texts], "value STRING").write.text(landing.path("customers"))
    report = Loader(warehouse, landing, now=NOW).sync(["customers"])
    assert (report.counts["customers"], report.rejected["customers"], report.unreadable["customers"]) == (2, 4, 1)
    assert sorted(r.reasons for r in warehouse.rejects("customers").collect()) == [
        "name missing", "not a JSON object", "not an object", "not an object", "total_spent is no number",
    ]


def test_clashing_line_ids(warehouse):
    def clash(number):
        made = receipt(number)
        return {**made, "line_items": [{**made["line_items"][0], "id": "1"}]}

    put(warehouse, clash("R1"), clash("R2"))
    put(warehouse, clash("R3"))
    assert lines(warehouse) == ["1", "1", "1"]


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from posmetrics.session import shared_root

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(bare)


def test_failures(spark, warehouse):
    loader = Loader(warehouse, Landing(spark, scratch_dir(spark, "none")), now=NOW)
    with pytest.raises(LoadError, match="not one resource"):
        loader.sync(["customers", "items"])
    with pytest.raises(LoadError, match="customers could not be loaded"):
        loader.load_all(["customers"])
    with pytest.raises(ValueError, match="no such resource"):
        loader.load_all(["cheques"])
    assert loader.last_syncs() == {}


def test_bounded_load(spark, warehouse):
    landing = Landing(spark, scratch_dir(spark, "land"))
    land(spark, landing, "receipts", receipt("R1", "2026-04-01"), receipt("R2", "2026-05-01"))
    seen = []
    loader = Loader(warehouse, landing, now=NOW, on_progress=lambda r, n: seen.append((r, n)))
    assert loader.load_all(["receipts"], created_at_min=datetime(2026, 4, 15)) == {"receipts": 1}
    assert list(heads(warehouse)) == ["R2"] and seen == [("receipts", 1)]


def test_stream_equals_full_load(spark, warehouse):
    landing = Landing(spark, scratch_dir(spark, "land"))
    land(spark, landing, "receipts", receipt("R1", lines="ab"), receipt("R2"))
    follow(warehouse, landing, "receipts", now=NOW).awaitTermination()
    land(spark, landing, "receipts", receipt("R1", updated="2026-05-12", money=7.0, lines="b"))
    land(spark, landing, "receipts", receipt("R2", updated="2026-04-01", money=9.0), receipt("R3"))
    follow(warehouse, landing, "receipts", now=NOW, files_per_batch=1).awaitTermination()

    batch = Warehouse(spark, scratch_dir(spark, "batch"))
    Loader(batch, landing, now=NOW).load_all(["receipts"])
    assert heads(warehouse) == heads(batch) and lines(warehouse) == lines(batch)
    assert heads(warehouse)["R1"][1] == 7.0 and heads(warehouse)["R2"][1] == 10.0


def test_links_with_changed_parents(spark, warehouse):
    def item(i, taxes, updated):
        return {"id": i, "item_name": i, "tax_ids": taxes, "created_at": "2026-01-01T00:00:00Z", "updated_at": updated}

    def load(*items):
        df = intake.prepared(pages(spark, "items", *items), "items", NOW)
        warehouse.upsert("items", intake.valid(df))

    load(item("i", ["t1", "t2"], "2026-01-02T00:00:00Z"), item("j", ["t1"], "2026-01-02T00:00:00Z"))
    load(item("i", ["t3"], "2026-01-03T00:00:00Z"))
    assert {tuple(r) for r in warehouse.table("item_tax").collect()} == {("i", "t3"), ("j", "t1")}
