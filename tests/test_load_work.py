"""How much work a load does: what is worked out once, shuffled or written."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import functions as F

from posmetrics.plans import intake
from posmetrics.plans.warehouse import Warehouse
from posmetrics.session import scratch_dir
from posmetrics.sources.landing import Landing
from posmetrics.sources.schemas import TABLES
from tests.conftest import SF_DIR
from tests.test_plans import count_of
from tests.test_warehouse import pages, receipt
from verification import ingest_queries

NOW = datetime(2026, 6, 1)


def good(spark, *records):
    return intake.valid(intake.prepared(pages(spark, "receipts", *records), "receipts", NOW))


def counted(spark, df):
    """The same rows, and how many of them have been worked out so far."""
    seen = spark.sparkContext.accumulator(0)

    def count(row):
        seen.add(1)
        return row

    return spark.createDataFrame(df.rdd.map(count), df.schema), seen


def test_records_of_an_upsert_are_worked_out_once(spark):
    warehouse = Warehouse(spark, scratch_dir(spark, "once"))
    warehouse.create()
    for day in ("10", "11"):  # the first finds nothing stored, the second does
        records, seen = counted(spark, good(spark, *(receipt(f"R{i}", updated=f"2026-05-{day}") for i in range(5))))
        assert warehouse.upsert("receipts", records)[0] == 5
        assert seen.value == 5


def test_a_first_load_joins_with_nothing(spark):
    """What is stored is met with a join, which shuffles all records; where nothing is, no join."""
    warehouse = Warehouse(spark, scratch_dir(spark, "first"))
    warehouse.create()
    records, spec = good(spark, receipt("R1"), receipt("R2")), TABLES["receipts"]

    def staged():
        return warehouse._stage(warehouse.now(), spec, records, repeats=False)

    first = staged()
    assert count_of(first._jdf.queryExecution().optimizedPlan(), "Join") == 0
    assert [(r._known, r._stored_in) for r in first.collect()] == [(None, None)] * 2
    warehouse.upsert("receipts", good(spark, receipt("R1")))
    later = staged()
    assert sorted(later.columns) == sorted(first.columns)
    assert {r.receipt_number: r._known for r in later.collect()} == {"R1": True, "R2": None}


def test_repeated_keys_are_settled_in_a_first_load(spark):
    warehouse = Warehouse(spark, scratch_dir(spark, "twice"))
    warehouse.create()
    old, new = receipt("R1", money=1.0), receipt("R1", updated="2026-05-12", money=2.0)
    assert warehouse.upsert("receipts", good(spark, old, new, receipt("R2")))[0] == 2
    kept = {r.receipt_number: r.total_money for r in warehouse.table("receipts").collect()}
    assert kept == {"R1": 2.0, "R2": 10.0}


def test_repeated_lines_are_settled_within_their_receipt(spark):
    """Without a shuffle; the line of the least hash stays, and any without an id."""
    first, second = receipt("R1", lines="abac"), receipt("R2", lines="ab")
    first["line_items"][2]["item_name"] = "other"
    rows = good(spark, first, second).withColumn(
        "line_items",
        F.transform(
            "line_items",
            lambda e: F.when(e["item_id"].isin("c"), e.withField("id", F.lit(None).cast("string"))).otherwise(e),
        ),
    )
    spec = TABLES["receipt_line_items"]
    every = intake.split(rows, "receipts")[spec.name].withColumn("_h", F.xxhash64(*spec.columns))
    least = {}
    for r in every.filter("id IS NOT NULL").orderBy("_h").collect():
        least.setdefault((r.receipt_id, r.id), r.item_name)
    one = intake.split(rows, "receipts", unique=True)[spec.name]
    assert count_of(one._jdf.queryExecution().optimizedPlan(), "WindowExpression") == 0
    found = one.collect()
    assert {(r.receipt_id, r.id): r.item_name for r in found if r.id} == least
    assert sorted(r.receipt_id for r in found) == ["R1", "R1", "R1", "R2", "R2"]
    assert [r.item_name for r in found if r.id is None] == ["c"]


def test_texts_of_valid_records_are_not_staged(spark, monkeypatch):
    warehouse = Warehouse(spark, scratch_dir(spark, "texts"))
    warehouse.create()
    staged, read = [], intake.accepted
    monkeypatch.setattr(intake, "accepted", lambda df, of=None: staged.append(df.collect()) or read(df, of))
    bad = receipt("R2")
    del bad["total_money"]
    done = warehouse.merge("receipts", pages(spark, "receipts", receipt("R1"), bad), "load", NOW)
    assert (done.records, done.rejected) == (1, 1)
    assert {r.receipt_number: r[intake.BODY] is None for r in staged[0]} == {"R1": True, "R2": False}
    assert '"R2"' in warehouse.rejects("receipts").first().body


def test_landed_pages_are_packed(spark):
    landing = Landing(spark, scratch_dir(spark, "packed"))
    ingest_queries._land(spark, SF_DIR, landing, ["suppliers"])
    names = [n for n in os.listdir(landing.path("suppliers")) if n.startswith("part-")]
    assert names and all(n.endswith(".gz") for n in names)
    rows = ingest_queries.feed.pages(spark, SF_DIR, "suppliers")
    assert landing.pages("suppliers").exceptAll(rows).isEmpty()
    assert rows.exceptAll(landing.pages("suppliers")).isEmpty()
