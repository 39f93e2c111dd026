"""What all metric groups share."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posmetrics.functions.money import amount, exact_sum, ratio, rnd
from posmetrics.functions.period import ALWAYS, DateWindow, of_store, valid_sales
from posmetrics.sources.tables import Tables


class MetricGroup:
    def __init__(self, tables: Tables, as_of: date | None = None):
        self.tables = tables
        self.as_of = as_of

    def _window(self, days, date_start, date_end) -> DateWindow:
        return DateWindow.of(days, date_start, date_end, self.as_of)

    def _sales(self, window: DateWindow = ALWAYS, store_id: str | None = None) -> DataFrame:
        return of_store(valid_sales(self.tables.receipts(window)), store_id)

    def _sold_lines(
        self,
        window: DateWindow = ALWAYS,
        store_id: str | None = None,
        lines_of: DataFrame | None = None,
    ) -> DataFrame:
        """Line items of valid sales, with the receipt's number and date; only those of
        the variants ``lines_of``, if given.

        Receipts are cut down to two columns and filtered before the join; a hot
        receipt is split by the adaptive skew join.
        """
        sales = self._sales(window, store_id).select("receipt_number", "receipt_date")
        lines = self.tables.line_items(window).drop("receipt_date", "receipt_month")
        if lines_of is not None:
            lines = lines.join(lines_of, "variant_id", "left_semi")
        return lines.join(sales, lines.receipt_id == sales.receipt_number)

    def _names(self, table: str, key: str, name: str) -> DataFrame:
        """Two columns of a dimension; its size decides whether it is broadcast."""
        return self.tables.table(table).select(F.col("id").alias(key), F.col("name").alias(name))

    def _with_category(self, lines: DataFrame) -> DataFrame:
        """Inner join to the items, which have got their categories' names first: lines
        are joined once, on the item, and never meet on a few hot categories."""
        items = self.tables.table("items").select(F.col("id").alias("item_id"), "category_id")
        categories = self._names("categories", "category_id", "category")
        named = items.join(categories, "category_id", "left").select(
            "item_id", F.coalesce("category", F.lit("Uncategorised")).alias("category")
        )
        return lines.join(named, "item_id")


def grouped_with_distinct(
    df: DataFrame, group: list[str], distinct: str, counted: str, sums: dict[str, Column | str]
) -> DataFrame:
    """Per group the number of distinct values, and sums in ticks, and ``rows``.

    Grouping by the distinct column first makes both steps plain sums, and spreads a
    hot group over as many tasks as it has distinct values.
    """
    first = df.groupBy(*group, distinct).agg(
        F.count(F.lit(1)).alias("rows"), *(exact_sum(c).alias(n) for n, c in sums.items())
    )
    return first.groupBy(*group).agg(
        F.count(distinct).alias(counted),
        F.sum("rows").alias("rows"),
        *(F.sum(n).alias(n) for n in sums),
    )


def tx_count() -> Column:
    return F.count(F.lit(1)).alias("tx_count")


def margin_parts() -> list[Column]:
    """Sums in ticks, so that they can be added up again after a join."""
    return [
        exact_sum("total_money").alias("_revenue"),
        exact_sum("cost_total").alias("_cost"),
    ]


def margin_regroup() -> list[Column]:
    return [F.sum("_revenue").alias("_revenue"), F.sum("_cost").alias("_cost")]


def margin_columns() -> list[Column]:
    """revenue, cost, gross_profit, margin_pct from the sums in ticks."""
    cost_ticks = F.coalesce("_cost", F.lit(0))
    revenue, cost = amount("_revenue"), amount(cost_ticks)
    profit = amount(F.col("_revenue") - cost_ticks)
    return [
        rnd(revenue, 2).alias("revenue"),
        rnd(cost, 2).alias("cost"),
        rnd(profit, 2).alias("gross_profit"),
        rnd(ratio(profit, revenue) * 100.0, 1).alias("margin_pct"),
    ]
