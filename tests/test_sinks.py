from __future__ import annotations

import glob
import json
from datetime import datetime

import pytest

from posmetrics import sinks
from posmetrics.session import scratch_dir

DDL = "id STRING, text STRING, n INT, price DOUBLE, ok BOOLEAN, at TIMESTAMP_NTZ, tags ARRAY<STRING>"
ROWS = [
    ("1", 'comma, and "quote"', 1, 1.5, True, datetime(2026, 5, 1, 2, 3, 4), ["a", "b"]),
    ("2", None, None, None, None, None, None),
]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, DDL)


@pytest.fixture
def path(spark):
    return scratch_dir(spark, "sink")


def test_csv(spark, df, path):
    sinks.write_csv(df, path)
    back = {r.id: r for r in spark.read.csv(path, header=True, quote='"', escape='"').collect()}
    assert back["1"].text == 'comma, and "quote"' and back["1"].at == "2026-05-01T02:03:04"
    assert json.loads(back["1"].tags) == ["a", "b"] and back["2"].n is None


def test_csv_without_rows_has_a_header(spark, df, path):
    sinks.write_csv(df.limit(0), path)
    texts = [open(f).read() for f in glob.glob(path.removeprefix("file:") + "/part-*")]
    assert "".join(texts).strip() in ("", "id,text,n,price,ok,at,tags")


def test_parquet_keeps_types(spark, df, path):
    sinks.write_parquet(df, path)
    assert spark.read.parquet(path).dtypes == df.dtypes
    sinks.write_parquet(df.limit(0), path)
    assert spark.read.parquet(path).dtypes == df.dtypes and spark.read.parquet(path).count() == 0


def test_json(spark, df, path):
    sinks.write_json(df, path)
    assert spark.read.schema(df.schema).json(path).exceptAll(df).count() == 0


def test_render(df):
    lines = [json.loads(r.line) for r in sinks.render(df, "json").collect()]
    assert lines[0]["price"] == 1.5 and lines[1]["text"] is None
    assert sinks.render(df.select("id", "n"), "csv").first().line == "1,1"
    assert sinks.render(df) is df
    with pytest.raises(ValueError):
        sinks.render(df, "xml")
