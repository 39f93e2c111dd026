"""Moving averages and period-over-period change.

Every window below runs over one row per day or month, never over receipts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from posmetrics.functions.money import amount, ratio, rnd, total
from posmetrics.functions.period import ALWAYS
from posmetrics.operators.base import MetricGroup, grouped_with_distinct, tx_count

def by_date() -> WindowSpec:
    return Window.orderBy("date")


def change_pct(now: Column, before: Column) -> Column:
    return rnd(ratio(now - before, before) * 100.0, 1)


class TimeSeries(MetricGroup):
    def _daily(self, window=ALWAYS, store_id=None) -> DataFrame:
        return (
            self._sales(window, store_id)
            .groupBy(F.to_date("receipt_date").alias("date"))
            .agg(total("total_money").alias("revenue"), tx_count())
        )

    def _by_day(self, daily: DataFrame, calendar: bool) -> DataFrame:
        """``daily``, with ``calendar`` every day from its first to its last, those without
        sales with a revenue of 0."""
        if not calendar:
            return daily
        ends = daily.agg(F.min("date").alias("first"), F.max("date").alias("last"))
        days = ends.select(F.explode(F.sequence("first", "last")).alias("date"))
        return days.join(daily, "date", "left").fillna(0, [c for c in daily.columns if c != "date"])

    def moving_average_revenue(
        self, window=7, days=90, date_start=None, date_end=None, store_id=None, calendar=False
    ) -> DataFrame:
        """date, revenue, tx_count, ma_{window}d over the last ``window`` days with sales.

        ``calendar``: over the last ``window`` days, and a row for days without sales too.
        """
        if calendar:  # days as numbers, so that the frame is one of days, not of rows
            frame = Window.orderBy(F.unix_date("date")).rangeBetween(1 - window, 0)
        else:
            frame = by_date().rowsBetween(1 - window, 0)
        # averaged as an exact decimal sum, like every other mean
        average = F.sum(F.col("revenue").cast("decimal(28,4)")).over(frame).cast(
            "double"
        ) / F.count("revenue").over(frame)
        daily = self._daily(self._window(days, date_start, date_end), store_id)
        return (
            self._by_day(daily, calendar)
            .withColumn(f"ma_{window}d", rnd(average, 2))
            .orderBy(F.desc("date"))
        )

    def week_over_week_growth(
        self, days=90, date_start=None, date_end=None, calendar=False
    ) -> DataFrame:
        """date, revenue, prev_week_revenue (seven rows back), wow_change_pct.

        ``calendar``: seven days back, and a row for days without sales too.
        """
        daily = self._daily(self._window(days, date_start, date_end)).select("date", "revenue")
        daily = self._by_day(daily, calendar)
        return (
            daily.withColumn("prev_week_revenue", F.lag("revenue", 7).over(by_date()))
            .withColumn("wow_change_pct", change_pct(F.col("revenue"), F.col("prev_week_revenue")))
            .orderBy(F.desc("date"))
        )

    def monthly_summary(self, months=12, store_id=None) -> DataFrame:
        """month, revenue, tx_count, unique_customers, avg_ticket, and the change."""
        monthly = grouped_with_distinct(
            self._sales(store_id=store_id).withColumn(
                "month", F.trunc(F.to_date("receipt_date"), "month")
            ),
            ["month"],
            "customer_id",
            "unique_customers",
            {"_revenue": "total_money"},
        ).select(
            "month",
            amount("_revenue").alias("revenue"),
            F.col("rows").alias("tx_count"),
            "unique_customers",
            rnd(amount("_revenue") / F.col("rows"), 2).alias("avg_ticket"),
        )
        return (
            monthly.withColumn(
                "prev_month_revenue", F.lag("revenue").over(Window.orderBy("month"))
            )
            .withColumn("mom_change_pct", change_pct(F.col("revenue"), F.col("prev_month_revenue")))
            .orderBy(F.desc("month"))
            .limit(months)
        )

    def day_over_day(self, days=30, date_start=None, date_end=None, store_id=None) -> DataFrame:
        """date, revenue, tx_count, dod_change_pct."""
        return (
            self._daily(self._window(days, date_start, date_end), store_id)
            .withColumn(
                "dod_change_pct", change_pct(F.col("revenue"), F.lag("revenue").over(by_date()))
            )
            .orderBy(F.desc("date"))
        )
