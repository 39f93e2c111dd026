"""Daily totals, growth rates and average tickets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from posmetrics.functions.money import amount, exact_sum, mean, ratio, rnd, total
from posmetrics.operators.base import MetricGroup, tx_count

class Revenue(MetricGroup):
    def daily_revenue(
        self, days=30, date_start=None, date_end=None, store_id=None
    ) -> DataFrame:
        """date, revenue, tx_count, avg_ticket; newest day first."""
        sales = self._sales(self._window(days, date_start, date_end), store_id)
        return (
            sales.groupBy(F.to_date("receipt_date").alias("date"))
            .agg(
                total("total_money").alias("revenue"),
                tx_count(),
                rnd(mean("total_money"), 2).alias("avg_ticket"),
            )
            .orderBy(F.desc("date"))
        )

    def revenue_by_store(self, days=30, date_start=None, date_end=None, by_id=False) -> DataFrame:
        """store_name, tx_count, revenue, avg_ticket; stores of one name are merged, unless
        ``by_id``, which adds store_id."""
        group = ["store_id", "store_name"] if by_id else ["store_name"]
        per_id = (
            self._sales(self._window(days, date_start, date_end))
            .groupBy("store_id")
            .agg(exact_sum("total_money").alias("_revenue"), F.count(F.lit(1)).alias("_n"))
        )
        revenue = amount(F.sum("_revenue"))
        return (
            per_id.join(self._names("stores", "store_id", "store_name"), "store_id")
            .groupBy(*group)
            .agg(
                F.sum("_n").alias("tx_count"),
                rnd(revenue, 2).alias("revenue"),
                rnd(revenue / F.sum("_n"), 2).alias("avg_ticket"),
            )
            .orderBy(F.desc("revenue"), *reversed(group))
        )

    def revenue_growth(self, period="month", months=12, store_id=None) -> DataFrame:
        """period, revenue, tx_count, prev_revenue, pct_change of the newest periods."""
        unit = "month" if period == "month" else "week"
        per_period = (
            self._sales(store_id=store_id)
            .groupBy(F.trunc(F.to_date("receipt_date"), unit).alias("period"))
            .agg(total("total_money").alias("revenue"), tx_count())
        )
        before = F.lag("revenue").over(Window.orderBy("period"))  # one row per period
        return (
            per_period.withColumn("prev_revenue", before)
            .withColumn(
                "pct_change",
                rnd(
                    ratio(F.col("revenue") - F.col("prev_revenue"), F.col("prev_revenue")) * 100.0,
                    1,
                ),
            )
            .orderBy(F.desc("period"))
            .limit(months)
        )

    def total_revenue(self, days=30, date_start=None, date_end=None, store_id=None) -> DataFrame:
        sales = self._sales(self._window(days, date_start, date_end), store_id)
        return sales.agg(F.coalesce(total("total_money"), F.lit(0.0)).alias("total_revenue"))

    def total_revenue_by_month(
        self, days=30, date_start=None, date_end=None, store_id=None
    ) -> DataFrame:
        """month (YYYY-MM), revenue, tx_count, avg_ticket."""
        sales = self._sales(self._window(days, date_start, date_end), store_id)
        return (
            sales.groupBy(F.date_format("receipt_date", "yyyy-MM").alias("month"))
            .agg(
                rnd(total("total_money"), 2).alias("revenue"),
                tx_count(),
                rnd(mean("total_money"), 2).alias("avg_ticket"),
            )
            .orderBy(F.desc("month"))
        )

    def refund_rate(self, days=30, date_start=None, date_end=None) -> DataFrame:
        """date, refunds, sales, refund_pct over receipts of every type."""
        receipts = self.tables.receipts(self._window(days, date_start, date_end)).filter(
            F.col("cancelled_at").isNull()
        )

        def of_type(kind):
            return total(
                F.when(F.col("receipt_type") == kind, F.col("total_money")).otherwise(0.0)
            )

        return (
            receipts.groupBy(F.to_date("receipt_date").alias("date"))
            .agg(of_type("REFUND").alias("refunds"), of_type("SALE").alias("sales"))
            .withColumn(
                "refund_pct", rnd(ratio(F.abs("refunds"), F.col("sales")) * 100.0, 2)
            )
            .orderBy(F.desc("date"))
        )
