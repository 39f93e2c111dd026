"""Versions of the warehouse: what readers, crashes, writers and old files come to."""

from __future__ import annotations

import json
import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pyarrow.parquet as pq
import pytest

from posmetrics.plans import intake
from posmetrics.plans import warehouse as module
from posmetrics.plans.versions import Change, Conflict, SchemaError, Versions, checked
from posmetrics.plans.warehouse import Warehouse, index, replaced
from posmetrics.session import scratch_dir
from posmetrics.sources.landing import Landing
from posmetrics.sources.schemas import TABLES
from posmetrics.streaming.continuous import follow
from tests.test_warehouse import NOW, customer, heads, land, lines, pages, put, receipt


@pytest.fixture
def warehouse(spark):
    made = Warehouse(spark, scratch_dir(spark, "versions"))
    made.create()
    return made


def sizes(warehouse, version, tables=("receipts", "receipt_line_items", "receipt_payments")):
    return sum(p.size for t in tables for p in version.of(t))


def test_a_load_that_dies_is_not_seen(warehouse, monkeypatch):
    put(warehouse, receipt("R1", lines="ab"))
    before = warehouse.now()

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Versions, "commit", die)
        with pytest.raises(RuntimeError, match="lost"):
            put(warehouse, receipt("R1", updated="2026-05-12", money=9.0, lines="c"), receipt("R2"))
    assert warehouse.now() == before and warehouse.files.names(f"{warehouse.root}/_staging") == []
    assert heads(warehouse)["R1"][1] == 10.0 and lines(warehouse) == ["R1-a", "R1-b"]
    # halfway through its files
    with monkeypatch.context() as patch:
        written = Warehouse._write

        def fail(self, dataset, *rest):
            if dataset == "receipt_line_items":
                die()
            return written(self, dataset, *rest)

        patch.setattr(Warehouse, "_write", fail)
        with pytest.raises(RuntimeError, match="lost"):
            put(warehouse, receipt("R1", updated="2026-05-12", lines="c"))
    assert warehouse.now() == before and lines(warehouse) == ["R1-a", "R1-b"]
    put(warehouse, receipt("R1", updated="2026-05-12", lines="c"))
    assert lines(warehouse) == ["R1-c"]
    folders = len(warehouse.files.names(warehouse.path("receipts")))
    warehouse.expire(keep=1)
    assert len(warehouse.files.names(warehouse.path("receipts"))) == 2 < folders
    assert lines(warehouse) == ["R1-c"]


def test_readers_keep_their_version(spark, warehouse):
    put(warehouse, receipt("R1", lines="ab"))
    reader, running = warehouse.pinned(), warehouse.table("receipt_line_items")
    put(warehouse, receipt("R1", updated="2026-05-12", lines="c"))
    assert warehouse.compact("receipts")
    assert lines(reader) == ["R1-a", "R1-b"] and running.count() == 2 and lines(warehouse) == ["R1-c"]
    assert lines(Warehouse(spark, warehouse.root, version=reader.now().number)) == ["R1-a", "R1-b"]


def test_writers_at_the_same_time(spark, warehouse):
    put(warehouse, *(receipt(f"R{i}") for i in range(6)))

    def load(i):
        own = Warehouse(spark, warehouse.root)
        put(own, receipt("R0", updated=f"2026-05-{12 + i}", money=float(i)), receipt(f"R{i}", updated="2026-05-11", money=50.0 + i))

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(load, (1, 2, 3)))
    assert {k: v[1] for k, v in heads(warehouse).items()} == {
        "R0": 3.0, "R1": 51.0, "R2": 52.0, "R3": 53.0, "R4": 10.0, "R5": 10.0,
    }


def test_commits_of_one_base(warehouse):
    base = warehouse.now()
    versions = warehouse.versions
    assert versions.commit(base, Change({"items"})).number == base.number + 1
    # another resource goes on top, the same one has to look again
    assert versions.commit(base, Change({"stores"})).number == base.number + 2
    with pytest.raises(Conflict):
        versions.commit(base, Change({"items"}))
    path = f"{versions.folder}/x.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: warehouse.files.create(path, str(i)), range(8)))
    assert sum(won) == 1 and warehouse.files.read(path) == str(won.index(True))


def test_small_changes_write_little(spark, warehouse):
    many = [receipt(f"R{i:04}", day=f"2026-0{1 + i % 3}-11", lines="abcdefgh") for i in range(1500)]
    put(warehouse, *many)
    first = warehouse.now()
    put(warehouse, *(receipt(f"R{i:04}", day="2026-01-11", updated="2026-05-12", lines="z") for i in range(0, 45, 3)))
    second = warehouse.now()
    new = [p for t in ("receipt_line_items",) for p in second.of(t) if p not in first.of(t)]
    assert sum(p.size for p in new) < 0.2 * sizes(warehouse, first, ("receipt_line_items",))
    assert {p.part for p in new} == {"2026-01-01"}
    assert warehouse.table("receipt_line_items").count() == 1485 * 8 + 15
    # the window of a month without deltas reads no replaced keys
    from posmetrics import Engine

    march = warehouse._live(second, "receipt_line_items", {"2026-03-01"})
    assert "Join" not in march._jdf.queryExecution().optimizedPlan().toString()
    assert Engine(warehouse).profitability.gross_profit(date_start="2026-03-01", date_end="2026-03-31").count() == 1


def test_stored_versions_come_from_the_batch_s_buckets(spark, warehouse):
    put(warehouse, *(receipt(f"R{i}", day=f"2026-0{1 + i % 5}-11") for i in range(60)))
    version = warehouse.now()
    keys = spark.createDataFrame([("R7",), ("nobody",)], "receipt_number string")
    found = warehouse._indexed(version, "receipts", keys)
    buckets = {f.split("key_bucket=")[1].split("/")[0] for f in found.inputFiles()}
    assert len(buckets) <= 2 < len(version.of(index("receipts")))
    assert all("/receipts.index/" in f for f in found.inputFiles())
    row = found.first()
    assert (row.receipt_number, str(row._stored_in)) == ("R7", "2026-03-01")


def test_compaction(warehouse, monkeypatch):
    monkeypatch.setattr(module, "DELTAS", 3)
    put(warehouse, receipt("R1", lines="ab"), receipt("R2", day="2026-04-01"))
    for i in range(5):
        put(warehouse, receipt("R1", updated=f"2026-05-{12 + i}", money=float(i), lines="abc"[: 1 + i % 3]))
    version = warehouse.now()
    for dataset in ("receipts", "receipt_line_items", index("receipts")):
        loads = [p.part for p in version.of(dataset)]
        assert max(map(loads.count, set(loads))) <= 3
    assert len(version.of(replaced("receipts"))) <= 3
    assert heads(warehouse)["R1"][1] == 4.0 and lines(warehouse) == ["R1-a", "R1-b", "R2-a"]
    put(warehouse, receipt("R1", day="2026-04-02", updated="2026-05-30", lines="z"))
    assert warehouse.compact("receipts") and not warehouse.now().of(replaced("receipts"))
    assert {p.part for p in warehouse.now().of("receipts")} == {"2026-04-01"}
    assert lines(warehouse) == ["R1-z", "R2-a"]


def test_more_buckets(spark, warehouse):
    good = intake.valid(intake.prepared(pages(spark, "customers", *(customer(i) for i in range(50))), "customers", NOW))
    warehouse.upsert("customers", good)
    assert warehouse.compact("customers", buckets=4)
    assert warehouse.now().buckets["customers"] == 4 and len(warehouse.now().of("customers")) == 4
    warehouse.upsert("customers", good.filter("id = '7'").withColumn("note", module.F.lit("x")))
    assert warehouse.table("customers").count() == 50
    assert [r.note for r in warehouse.lookup("customers", [("7",)]).collect()] == ["x"]


def test_a_lookup_skips_row_groups(spark, warehouse):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        put(warehouse, *(receipt(f"R{i:05}", day=f"2026-0{1 + i % 6}-11") for i in range(2400)))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [
        os.path.join(at, name)
        for at, _, names in os.walk(warehouse.path("receipts"))
        for name in names
        if name.endswith(".parquet")
    ]
    assert len(files) >= 6 and before
    found = warehouse.lookup("receipts", [("R00777",)])
    assert found.count() == 1
    # files of its month, of which only those whose keys reach around it hold a row group to read
    read = [f.removeprefix("file:").replace("///", "/") for f in found.inputFiles()]
    assert {f.split("receipt_month=")[1][:10] for f in read} == {"2026-04-01"}
    groups = total = 0
    for path in files:
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index("receipt_number")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            groups += path in read and stats.min <= "R00777" <= stats.max
    assert groups == 1 and total >= 6


def test_partial_records(spark, warehouse):
    def merge(*records):
        warehouse.merge("receipts", pages(spark, "receipts", *records), "x", NOW, partial=True)

    put(warehouse, {**receipt("R1", lines="ab"), "note": "old", "customer_id": "c", "tip": 2.0})
    some = {k: v for k, v in receipt("R1", updated="2026-05-12", money=5.0).items() if k != "line_items"}
    merge(some, {**some, "updated_at": "2026-05-13T00:00:00Z", "note": None}, {**some, "receipt_number": "R9"})
    got = {r.receipt_number: r for r in warehouse.table("receipts").collect()}
    assert (got["R1"].note, got["R1"].customer_id, got["R1"].tip, got["R1"].total_money) == (None, "c", 2.0, 5.0)
    assert got["R1"].updated_at == datetime(2026, 5, 13, 8) and got["R9"].tip == 0.0
    assert lines(warehouse) == ["R1-a", "R1-b"]
    merge({**some, "updated_at": "2026-05-14T00:00:00Z", "receipt_date": "2026-02-01T00:00:00Z", "tip": 3.0})
    months = {str(r.receipt_month) for r in warehouse.stored("receipt_line_items").collect()}
    assert months == {"2026-02-01"} and lines(warehouse) == ["R1-a", "R1-b"]
    merge({**some, "updated_at": "2026-05-15T00:00:00Z", "line_items": []})
    assert lines(warehouse) == [] and {r.tip for r in warehouse.table("receipts").collect()} == {0.0, 3.0}


def test_schemas(spark, warehouse):
    from pyspark.sql import types as T

    old = T.StructType().add("id", "string").add("n", "integer")
    text = old.json()
    wider = T.StructType().add("new", "string").add("n", "long").add("id", "string")
    assert checked("t", text, wider) == wider
    with pytest.raises(SchemaError, match="no longer known"):
        checked("t", text, T.StructType().add("id", "string"))
    with pytest.raises(SchemaError, match="stored as integer"):
        checked("t", text, T.StructType().add("id", "string").add("n", "string"))
    # files of an older release: a column less and a narrower one
    spec = TABLES["sync_metadata"]
    older = [f for f in spec.schema.fields if f.name != "sync_type"]
    narrow = T.StructType([T.StructField(f.name, T.IntegerType() if f.name == "records_count" else f.dataType) for f in older])
    row = spark.createDataFrame([("items", datetime(2026, 1, 1), 5)], narrow)
    path = f"{warehouse.path('sync_metadata')}/load=000000000000-old/key_bucket=0"
    row.write.parquet(path)
    change = Change({"sync_metadata"}, schemas={"sync_metadata": narrow.json()})
    change.added["sync_metadata"] = [module.Piece("000000000000-old", "0", 1)]
    warehouse.versions.commit(warehouse.now(), change)
    assert [tuple(r) for r in warehouse.table("sync_metadata").collect()] == [("items", datetime(2026, 1, 1), 5, None)]
    warehouse.create()
    assert json.loads(warehouse.now().schemas["sync_metadata"]) == json.loads(spec.schema.json())
    bad = Change({"taxes"}, schemas={"taxes": T.StructType().add("id", "string").add("other", "string").json()})
    warehouse.versions.commit(warehouse.now(), bad)
    with pytest.raises(SchemaError):
        warehouse.table("taxes")


def test_pages_landed_again(spark, warehouse):
    landing = Landing(spark, scratch_dir(spark, "again"))
    record = {k: v for k, v in customer(1).items() if k != "updated_at"}
    seen = []
    for day, records in ((1, [record, customer(2)]), (2, [record]), (3, [{**record, "note": "n"}, customer(2)])):
        land(spark, landing, "customers", *records)
        follow(
            warehouse, landing, "customers", now=datetime(2026, 6, day), replays_within="1 day",
            on_batch=lambda done: seen.append(done.records),
        ).awaitTermination()
    assert [n for n in seen if n] == [2, 1]
    got = {r.id: (r.note, r.updated_at) for r in warehouse.table("customers").collect()}
    assert got == {"1": ("n", datetime(2026, 6, 3)), "2": (None, datetime(2026, 5, 1, 8))}


def test_counting_takes_no_job_of_its_own(spark, warehouse):
    """One for what was parsed, one for what is refused, and those of two writes with a
    shuffle each: none that only counts."""
    df = pages(spark, "stores", {"id": "1", "name": "n", "created_at": "2026-01-01T00:00:00Z", "updated_at": "2026-01-01T00:00:00Z"}, {"id": "2"})
    spark.sparkContext.setJobGroup("counted", "")
    done = warehouse.merge("stores", df, "x", NOW)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("counted")
    spark.sparkContext.setJobGroup("", "")
    assert (done.records, done.rejected, done.unreadable) == (1, 1, 0)
    assert len(jobs) <= 7
