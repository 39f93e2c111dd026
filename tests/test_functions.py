from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from posmetrics.functions.money import amount, exact_sum, rnd, total
from posmetrics.functions.ntile import with_ntiles
from posmetrics.functions.text import id_text, tidy, title_case, to_zone


@pytest.mark.parametrize("n, tiles", [(0, 5), (1, 5), (3, 5), (5, 5), (1003, 5), (1500, 4), (7, 2)])
def test_tiles_equal_the_window_function(spark, n, tiles):
    # many ties, and NULLs that must come last
    df = spark.range(n).select(
        F.col("id").cast("string").alias("key"),
        F.when(F.col("id") % 11 != 0, F.col("id") * 7 % 13).alias("few"),
        (F.col("id") * 7919 % 10007 / 3).alias("many"),
    )
    got = with_ntiles(df, "key", {"a": F.col("few"), "b": -F.col("many")}, tiles)
    windows = {
        "a": Window.orderBy(F.asc_nulls_last("few"), "key"),
        "b": Window.orderBy(F.desc("many"), "key"),
    }
    want = df.select("*", *(F.ntile(tiles).over(w).cast("bigint").alias(c) for c, w in windows.items()))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_one_value_for_most_rows(spark):
    df = spark.range(5000).select(
        F.col("id").cast("string").alias("key"), F.when(F.col("id") > 4000, F.col("id")).otherwise(1).alias("v")
    )
    sizes = with_ntiles(df, "key", {"t": F.col("v")}).groupBy("t").count().collect()
    assert {r["count"] for r in sizes} == {1000}


def test_sums_do_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e9, -1e9] * 1000
    for order in (values, sorted(values), values[::-1]):
        df = spark.createDataFrame([(v,) for v in order], "v DOUBLE").repartition(8)
        assert df.agg(amount(exact_sum("v"))).first()[0] == 600.0


def test_rounding(spark):
    df = spark.createDataFrame([(2.345, -2.345, 0.05, 1e17)], "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    row = df.select(rnd("a", 1), rnd("b", 1), rnd("c", 1), rnd("d", 2)).first()
    assert tuple(row) == (2.3, -2.3, 0.1, 1e17)


@pytest.mark.parametrize(
    "text", ["o'neil", "JEAN-luc  picard", "josé ñandú", "3rd street", "x", "", "a1b2", "ÉCLAIR d'or"]
)
def test_title_case_equals_python(spark, text):
    df = spark.createDataFrame([(text,)], "t STRING")
    assert df.select(title_case(F.col("t"))).first()[0] == text.title()


def test_tidy_and_ids(spark):
    df = spark.createDataFrame([("  a \t b\n", " \t ", '{"id": "x"}', "7")], "a STRING, b STRING, c STRING, d STRING")
    row = df.select(tidy(F.col("a")), tidy(F.col("b")), id_text(F.col("c")), id_text(F.col("d"))).first()
    assert tuple(row) == ("a b", None, "x", "7")


@pytest.mark.parametrize(
    "text, local",
    [
        ("2026-05-01T20:00:00Z", datetime(2026, 5, 2, 4)),
        ("2026-05-01T20:00:00.250Z", datetime(2026, 5, 2, 4, 0, 0, 250000)),
        ("2026-05-01T20:00:00+08:00", datetime(2026, 5, 1, 20)),
        ("2026-05-01T20:00:00", datetime(2026, 5, 2, 4)),
        ("2026-05-01", datetime(2026, 5, 1, 8)),
        ("", None),
        ("null", None),
        (None, None),
    ],
)
def test_times(spark, text, local):
    df = spark.createDataFrame([(text,)], "t STRING")
    assert df.select(to_zone(F.col("t"), "Asia/Manila")).first()[0] == local


def test_amounts_without_an_exact_sum_are_refused(spark):
    for bad in (float("nan"), float("inf"), 1e16):
        df = spark.createDataFrame([(1.5,), (bad,)], "x double")
        with pytest.raises(Exception, match="no number or too large"):
            df.agg(total("x")).collect()
    df = spark.createDataFrame([(1.000049,), (None,), (2.5,), (-8.9e14,)], "x double")
    assert df.agg(total("x")).first()[0] == -8.9e14 + 3.5
