"""Peak times, payment mix, discounts and tips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posmetrics.functions.money import amount, mean, ratio, rnd, share_of_total, total
from posmetrics.operators.base import MetricGroup, grouped_with_distinct, tx_count

# Weekday names, Monday first.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


class Operations(MetricGroup):
    def peak_hours(self, days=30, date_start=None, date_end=None, store_id=None) -> DataFrame:
        """hour, tx_count, revenue, pct_of_day (share of all transactions)."""
        sales = self._sales(self._window(days, date_start, date_end), store_id)
        return (
            sales.groupBy(F.hour("receipt_date").cast("bigint").alias("hour"))
            .agg(tx_count(), rnd(total("total_money"), 2).alias("revenue"))
            .withColumn("pct_of_day", share_of_total("tx_count"))
            .orderBy("hour")
        )

    def peak_days(self, days=30, date_start=None, date_end=None, store_id=None) -> DataFrame:
        """day_name, tx_count, revenue, avg_ticket; Monday first."""
        sales = self._sales(self._window(days, date_start, date_end), store_id)
        names = F.array(*map(F.lit, WEEKDAYS))
        return (
            sales.groupBy(F.weekday(F.to_date("receipt_date")).alias("_day"))
            .agg(
                tx_count(),
                rnd(total("total_money"), 2).alias("revenue"),
                rnd(mean("total_money"), 2).alias("avg_ticket"),
            )
            .orderBy("_day")
            .select(F.get(names, F.col("_day")).alias("day_name"), "tx_count", "revenue", "avg_ticket")
        )

    def payment_method_split(
        self, days=30, date_start=None, date_end=None, store_id=None
    ) -> DataFrame:
        """payment_type, tx_count, revenue, tx_pct, revenue_pct.

        Follows the payments kept at ingest, so a receipt paid with two tenders
        counts under both, each with its own amount. A receipt without a payment,
        or with one of an unlisted type, is 'Unknown'.
        """
        window = self._window(days, date_start, date_end)
        sales = self._sales(window, store_id).select("receipt_number", "total_money")
        payments = self.tables.payments(window).select(
            F.col("receipt_id").alias("receipt_number"), "payment_type_id", "money_amount"
        )
        types = self._names("payment_types", "payment_type_id", "payment_type")
        tenders = (
            sales.join(payments, "receipt_number", "left")
            .join(types, "payment_type_id", "left")
            .withColumn("payment_type", F.coalesce("payment_type", F.lit("Unknown")))
        )
        grouped = grouped_with_distinct(
            tenders,
            ["payment_type"],
            "receipt_number",
            "tx_count",
            {"_revenue": F.coalesce("money_amount", "total_money")},
        )
        return (
            grouped.select(
                "payment_type",
                "tx_count",
                rnd(amount("_revenue"), 2).alias("revenue"),
                share_of_total("tx_count").alias("tx_pct"),
                share_of_total(amount("_revenue")).alias("revenue_pct"),
            )
            .orderBy(F.desc("revenue"), "payment_type")
        )

    def discount_analysis(self, days=30, date_start=None, date_end=None) -> DataFrame:
        """date, tx_count, gross_revenue, discounts, discount_rate_pct."""
        money, off = total("total_money"), total("total_discount")
        return (
            self._sales(self._window(days, date_start, date_end))
            .groupBy(F.to_date("receipt_date").alias("date"))
            .agg(
                tx_count(),
                rnd(money, 2).alias("gross_revenue"),
                rnd(off, 2).alias("discounts"),
                rnd(ratio(off, money + off) * 100.0, 1).alias("discount_rate_pct"),
            )
            .orderBy(F.desc("date"))
        )

    def tip_analysis(self, days=30, date_start=None, date_end=None) -> DataFrame:
        """date, tx_count, total_tips, avg_tip, tip_rate_pct."""
        return (
            self._sales(self._window(days, date_start, date_end))
            .groupBy(F.to_date("receipt_date").alias("date"))
            .agg(
                tx_count(),
                rnd(total("tip"), 2).alias("total_tips"),
                rnd(mean("tip"), 2).alias("avg_tip"),
                rnd(ratio(total("tip"), total("total_money")) * 100.0, 1).alias("tip_rate_pct"),
            )
            .orderBy(F.desc("date"))
        )

    def dining_option_split(self, days=30, date_start=None, date_end=None) -> DataFrame:
        """dining_option, tx_count, revenue, avg_ticket."""
        return (
            self._sales(self._window(days, date_start, date_end))
            .groupBy(F.coalesce("dining_option", F.lit("Unspecified")).alias("dining_option"))
            .agg(
                tx_count(),
                rnd(total("total_money"), 2).alias("revenue"),
                rnd(mean("total_money"), 2).alias("avg_ticket"),
            )
            .orderBy(F.desc("revenue"), "dining_option")
        )
