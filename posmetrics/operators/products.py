"""Category mix, best items and basket size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posmetrics.functions.money import amount, exact_sum, rnd, share_of_total
from posmetrics.operators.base import MetricGroup, grouped_with_distinct


class Products(MetricGroup):
    def revenue_by_category(
        self, days=30, date_start=None, date_end=None, store_id=None
    ) -> DataFrame:
        """category, tx_count, revenue, units_sold, pct_share."""
        lines = self._sold_lines(self._window(days, date_start, date_end), store_id)
        grouped = grouped_with_distinct(
            self._with_category(lines),
            ["category"],
            "receipt_number",
            "tx_count",
            {"_revenue": "total_money", "_units": "quantity"},
        )
        return (
            grouped.select(
                "category",
                "tx_count",
                rnd(amount("_revenue"), 2).alias("revenue"),
                amount("_units").alias("units_sold"),
                share_of_total(amount("_revenue")).alias("pct_share"),
            )
            .orderBy(F.desc("revenue"), "category")
        )

    def top_items(
        self, days=30, date_start=None, date_end=None, store_id=None, n=10
    ) -> DataFrame:
        """item, total_qty, total_revenue, tx_count of the n best sellers."""
        lines = self._sold_lines(self._window(days, date_start, date_end), store_id)
        grouped = grouped_with_distinct(
            lines,
            ["item_name"],
            "receipt_number",
            "tx_count",
            {"_units": "quantity", "_revenue": "total_money"},
        )
        return (
            grouped.select(
                F.col("item_name").alias("item"),
                amount("_units").alias("total_qty"),
                rnd(amount("_revenue"), 2).alias("total_revenue"),
                "tx_count",
            )
            .orderBy(F.desc("total_revenue"), "item")
            .limit(n)
        )

    def items_per_transaction(
        self, days=30, date_start=None, date_end=None, store_id=None
    ) -> DataFrame:
        """One row: average, min_items, p25, p50, p75, max_items.

        Baskets are counted per size first, so the percentiles see one weighted row
        per basket size.
        """
        sizes = (
            self._sold_lines(self._window(days, date_start, date_end), store_id)
            .groupBy("receipt_number")
            .agg(F.count("id").alias("lines"))
            .groupBy("lines")
            .agg(F.count(F.lit(1)).alias("baskets"))
        )
        quartiles = F.percentile(
            "lines", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("baskets")
        )
        return sizes.agg(
            F.sum(F.col("lines") * F.col("baskets")).alias("_lines"),
            F.sum("baskets").alias("_baskets"),
            F.min("lines").alias("min_items"),
            quartiles.alias("_q"),
            F.max("lines").alias("max_items"),
        ).select(
            F.coalesce(
                rnd(F.col("_lines").cast("double") / F.nullif("_baskets", F.lit(0)), 1), F.lit(0.0)
            ).alias("average"),
            "min_items",
            F.get("_q", F.lit(0)).alias("p25"),
            F.get("_q", F.lit(1)).alias("p50"),
            F.get("_q", F.lit(2)).alias("p75"),
            "max_items",
        )

    def category_mix_trend(self, days=90, date_start=None, date_end=None) -> DataFrame:
        """month, category, revenue."""
        lines = self._sold_lines(self._window(days, date_start, date_end))
        month = F.trunc(F.to_date("receipt_date"), "month").alias("month")
        # summed per item before the dimensions are joined
        per_item = lines.groupBy(month, "item_id").agg(exact_sum("total_money").alias("_revenue"))
        return (
            self._with_category(per_item)
            .groupBy("month", "category")
            .agg(rnd(amount(F.sum("_revenue")), 2).alias("revenue"))
            .orderBy(F.desc("month"), F.desc("revenue"), "category")
        )
