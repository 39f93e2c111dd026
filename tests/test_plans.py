"""What the plans must look like for large inputs."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from posmetrics import Engine
from posmetrics.functions.period import DateWindow
from posmetrics.sources.star import AS_OF, StarTables
from tests.conftest import SF_DIR
from verification import catalogue

LAZY = [k for k in catalogue.QUERIES if k[0] in "aceir"]
LOADED = ["w01_create", "w02_delta_read", "w02_compacted", "w02_partial_record", "w07_table_counts"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", LAZY + LOADED)
def test_stays_in_the_jvm_without_cross_joins(spark, key):
    plan = plan_of(entry.queries()[key](spark, SF_DIR))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_window_and_columns_reach_the_scan(spark):
    plan = plan_of(Engine(StarTables(spark, SF_DIR), AS_OF).revenue.daily_revenue())
    assert "GreaterThanOrEqual(o_orderdate,2001-07-02T00:00" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"o_orderkey", "o_totalprice", "o_orderdate"}


def test_an_open_range_is_pushed_too(spark):
    window = DateWindow.of(date_start="1998-01-01", date_end="1998-01-31")
    plan = plan_of(StarTables(spark, SF_DIR).receipts(window).select("receipt_number"))
    assert "GreaterThanOrEqual(o_orderdate,1997-12-31" in plan
    assert re.search(r"o_orderdate#\d+ <= 1998-02-01", plan)  # the list above is cut off


def test_sold_lines_join_on_a_shuffle_when_receipts_are_large(spark):
    """Beyond the broadcast threshold the join shuffles once per side, on the receipt."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(Engine(StarTables(spark, SF_DIR), AS_OF).profitability.gross_profit(days=None))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 3  # lines, receipts, days


def test_first_of_each_key_is_cut_before_the_shuffle(spark):
    from posmetrics.plans.warehouse import Warehouse
    from posmetrics.session import scratch_dir
    from posmetrics.sources.schemas import TABLES
    from verification.ingest_queries import NOW, feed, intake

    good = intake.valid(intake.prepared(feed.pages(spark, SF_DIR, "customers"), "customers", NOW))
    warehouse = Warehouse(spark, scratch_dir(spark, "plan"))
    staged = warehouse._stage(warehouse.now(), TABLES["customers"], good)
    assert plan_of(staged).count("WindowGroupLimit") == 2


def test_pages_are_parsed_once(spark):
    """A page, a record and each list of nested rows: one parser each, and no filter has
    copied any of them."""
    from verification.ingest_queries import NOW, feed, intake

    good = intake.valid(intake.prepared(feed.pages(spark, SF_DIR, "receipts"), "receipts", NOW))
    lines = intake.split(good, "receipts")["receipt_line_items"]
    plan = lines._jdf.queryExecution().optimizedPlan()
    assert count_of(plan, "JsonToStructs") == 4


def count_of(plan, name: str) -> int:
    """Expressions of that class in a plan, whose text is cut off."""
    found, queue = 0, [plan]
    while queue:
        node = queue.pop()
        children = node.children()
        queue += [children.apply(i) for i in range(children.size())]
        if not node.getClass().getName().startswith("org.apache.spark.sql.catalyst.expressions"):
            expressions = node.expressions()
            queue += [expressions.apply(i) for i in range(expressions.size())]
        found += node.getClass().getSimpleName() == name
    return found
