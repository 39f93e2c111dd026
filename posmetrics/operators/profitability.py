"""Gross profit and margins from the cost captured on each line at sale time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posmetrics.functions.money import rnd, total
from posmetrics.operators.base import (
    MetricGroup,
    margin_columns,
    margin_parts,
    margin_regroup,
)
from posmetrics.operators.time_series import by_date


class Profitability(MetricGroup):
    def _daily_margin(self, window, store_id) -> DataFrame:
        return (
            self._sold_lines(window, store_id)
            .groupBy(F.to_date("receipt_date").alias("date"))
            .agg(*margin_parts())
            .select("date", *margin_columns())
        )

    def gross_profit(self, days=30, date_start=None, date_end=None, store_id=None) -> DataFrame:
        """date, revenue, cost, gross_profit, margin_pct."""
        window = self._window(days, date_start, date_end)
        return self._daily_margin(window, store_id).orderBy(F.desc("date"))

    def profit_by_category(
        self, days=30, date_start=None, date_end=None, store_id=None
    ) -> DataFrame:
        """category, revenue, cost, gross_profit, margin_pct.

        Lines are summed per item before the dimensions are joined, so a hot item
        reaches the join as one row.
        """
        per_item = (
            self._sold_lines(self._window(days, date_start, date_end), store_id)
            .groupBy("item_id")
            .agg(*margin_parts())
        )
        return (
            self._with_category(per_item)
            .groupBy("category")
            .agg(*margin_regroup())
            .select("category", *margin_columns())
            .orderBy(F.desc("gross_profit"), "category")
        )

    def profit_margins(
        self,
        days=30,
        date_start=None,
        date_end=None,
        store_id=None,
        n=20,
        sort_by="gross_profit",
    ) -> DataFrame:
        """item, qty_sold, revenue, cost, gross_profit, margin_pct of the n best items.

        ``sort_by`` is gross_profit, margin_pct or revenue; anything else means
        gross_profit.
        """
        key = sort_by if sort_by in ("gross_profit", "margin_pct", "revenue") else "gross_profit"
        return (
            self._sold_lines(self._window(days, date_start, date_end), store_id)
            .groupBy(F.col("item_name").alias("item"))
            .agg(total("quantity").alias("qty_sold"), *margin_parts())
            .select("item", "qty_sold", *margin_columns())
            .orderBy(F.desc_nulls_last(key), "item")
            .limit(n)
        )

    def margin_trend(self, days=90, date_start=None, date_end=None, store_id=None) -> DataFrame:
        """The daily margin with the previous day's margin_pct and the change."""
        window = self._window(days, date_start, date_end)
        return (
            self._daily_margin(window, store_id)
            .withColumn("prev_margin_pct", F.lag("margin_pct").over(by_date()))
            .withColumn("margin_change", rnd(F.col("margin_pct") - F.col("prev_margin_pct"), 1))
            .orderBy(F.desc("date"))
        )

    def overall_margin(self, days=30, date_start=None, date_end=None, store_id=None) -> DataFrame:
        """One margin percentage for the period, 0.0 without sales."""
        totals = self._sold_lines(self._window(days, date_start, date_end), store_id).agg(
            *margin_parts()
        )
        return totals.select(*margin_columns()).select(
            F.coalesce("margin_pct", F.lit(0.0)).alias("overall_margin_pct")
        )

    def items_without_cost(self) -> DataFrame:
        """item, times_sold, total_revenue of sold lines that lack a cost."""
        lines = self._sold_lines().filter(F.col("cost").isNull() | F.col("cost_total").isNull())
        return (
            lines.groupBy(F.col("item_name").alias("item"))
            .agg(
                F.count(F.lit(1)).alias("times_sold"),
                rnd(total("total_money"), 2).alias("total_revenue"),
            )
            .orderBy(F.desc("total_revenue"), "item")
        )
