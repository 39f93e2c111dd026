from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from posmetrics import Engine
from posmetrics.operators.listing import parse_day, row_json
from posmetrics.sources.tables import FrameTables
from tests import shop


@pytest.fixture(scope="module")
def listing(spark):
    def at(day, hour=0):
        return datetime(2026, 5, day, hour)

    receipts = [(f"R{i}", at(i), at(i + 1), at(i + 1) if i == 3 else None, "s1" if i % 2 else "s2") for i in range(1, 7)]
    frames = {
        "receipts": spark.createDataFrame(
            receipts,
            "receipt_number STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ, deleted_at TIMESTAMP_NTZ, store_id STRING",
        ),
        "inventory": spark.createDataFrame(
            [("v", "s1", 3), ("w", "s1", 4)], "variant_id STRING, store_id STRING, in_stock INT"
        ),
    }
    return Engine(FrameTables(frames), date(2026, 5, 6)).listing


def numbers(df):
    return [r.receipt_number for r in df.collect()]


def test_list(listing):
    assert numbers(listing.list_records("receipts")) == ["R6", "R5", "R4", "R2", "R1"]
    assert numbers(listing.list_records("receipts", limit=2)) == ["R6", "R5"]
    assert "R3" in numbers(listing.list_records("receipts", show_deleted=True))
    between = listing.list_records("receipts", created_at_min=datetime(2026, 5, 2), created_at_max=datetime(2026, 5, 4))
    assert numbers(between) == ["R4", "R2"]
    assert numbers(listing.list_records("receipts", updated_at_min=datetime(2026, 5, 7))) == ["R6"]
    assert numbers(listing.list_records("receipts", equals={"store_id": "s2"})) == ["R6", "R4", "R2"]
    assert numbers(listing.list_records("receipts", where=F.col("receipt_number") > "R4")) == ["R6", "R5"]
    assert listing.list_records("inventory", created_at_min=datetime(2030, 1, 1)).count() == 2


def test_ids(listing, spark):
    assert numbers(listing.list_records("receipts", ids={"receipt_number": "R1, R5,R9"})) == ["R5", "R1"]
    many = [f"X{i}" for i in range(700)] + ["R2"]
    assert numbers(listing.list_records("receipts", ids={"receipt_number": many})) == ["R2"]
    frame = spark.createDataFrame([("R4",)], "anything STRING")
    assert numbers(listing.list_records("receipts", ids={"receipt_number": frame})) == ["R4"]


def test_get(listing):
    assert numbers(listing.get("receipts", "R2")) == ["R2"]
    assert listing.get("receipts", "R3").count() == 0  # deleted
    assert listing.get("inventory", "w", "s1").first().in_stock == 4
    with pytest.raises(ValueError):
        listing.get("inventory", "w")


def test_checks(listing):
    with pytest.raises(ValueError):
        listing.list_records("receipts", created_at_min=datetime(2026, 5, 2), created_at_max=datetime(2026, 5, 1))
    with pytest.raises(ValueError):
        listing.list_records("receipts", limit=0)
    with pytest.raises(ValueError):
        listing.receipts_between(sort_order="up")


def test_receipt_helpers(listing):
    assert numbers(listing.receipts_between(since="R1", before="R6", sort_order="asc")) == ["R2", "R4", "R5"]
    assert listing.latest_receipt().receipt_number == "R6"
    assert numbers(listing.latest_receipts(99)) == ["R6", "R5", "R4", "R2", "R1"]
    assert numbers(listing.receipts_today()) == ["R6"]
    assert numbers(listing.receipts_since(datetime(2026, 5, 5))) == ["R6", "R5"]
    with pytest.raises(ValueError):
        listing.latest_receipts(0)
    with pytest.raises(ValueError):
        listing.receipts_since(date(2026, 5, 7))
    with pytest.raises(TypeError):
        listing.receipts_since("2026-05-01")


def test_no_receipts(spark):
    empty = shop.tables(spark).table("receipts").limit(0)
    with pytest.raises(LookupError):
        Engine(FrameTables({"receipts": empty})).listing.latest_receipt()


def test_freshness(listing):
    assert listing.is_fresh(datetime(2026, 5, 7, 23)).first()[0] is True
    assert listing.is_fresh(datetime(2026, 5, 8, 1)).first()[0] is False


def test_row_json(spark):
    df = spark.createDataFrame(
        [(1, 12345678901, 'a "b"', datetime(2026, 5, 1, 2), None, [1]), (2, 5, None, None, 1.5, None)],
        "a INT, b BIGINT, c STRING, d TIMESTAMP_NTZ, e DOUBLE, f ARRAY<INT>",
    )
    got = [json.loads(r.json) for r in row_json(df).collect()]
    assert got[0] == {"a": 1, "b": "12345678901", "c": 'a "b"', "d": "2026-05-01T02:00:00", "e": None, "f": [1]}
    assert got[1] == {"a": 2, "b": 5, "c": None, "d": None, "e": 1.5, "f": None}


def test_day_words():
    today = date(2026, 5, 6)
    assert parse_day("today", today) == datetime(2026, 5, 6)
    assert parse_day("yesterday", today, end_of_day=True) == datetime(2026, 5, 5, 23, 59, 59)
    assert parse_day("2026-01-02", today) == datetime(2026, 1, 2)
    assert parse_day("2026-01-02T12:00Z", today) == "2026-01-02T12:00Z"
    with pytest.raises(ValueError):
        parse_day("soon", today)
