"""Segmentation, retention and top spenders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posmetrics.functions.money import amount, exact_sum, rnd, share_of_total
from posmetrics.functions.ntile import with_ntiles
from posmetrics.functions.period import ALWAYS
from posmetrics.operators.base import MetricGroup


class Customers(MetricGroup):
    def _visits(self, window=ALWAYS, store_id=None) -> DataFrame:
        """Sales of known customers; walk-ins are left out before any shuffle."""
        return self._sales(window, store_id).filter(F.col("customer_id").isNotNull())

    def new_vs_returning(
        self, days=30, date_start=None, date_end=None, store_id=None
    ) -> DataFrame:
        """date, total_tx, unique_customers, new_customers, returning_customers.

        After grouping to one row per day and customer the three distinct counts
        are plain sums.
        """
        per_customer = (
            self._visits(self._window(days, date_start, date_end), store_id)
            .groupBy(F.to_date("receipt_date").alias("date"), "customer_id")
            .agg(F.count(F.lit(1)).alias("_tx"))
        )
        known = self.tables.table("customers").select(
            F.col("id").alias("customer_id"), "first_visit"
        )
        midnight = F.col("date").cast("timestamp_ntz")
        return (
            per_customer.join(known, "customer_id", "left")
            .groupBy("date")
            .agg(
                F.sum("_tx").alias("total_tx"),
                F.count("customer_id").alias("unique_customers"),
                F.count_if(F.col("first_visit") >= midnight).alias("new_customers"),
                F.count_if(F.col("first_visit") < midnight).alias("returning_customers"),
            )
            .orderBy(F.desc("date"))
        )

    def rfm_analysis(self, as_of_date: date | None = None, inactive: str = "highest") -> DataFrame:
        """Recency, frequency and monetary quintiles and a segment per customer.

        Customers without a sale have no recency and rank last on it, which is the
        highest recency score; with ``inactive="lowest"`` they rank first.
        """
        if inactive not in ("highest", "lowest"):
            raise ValueError("inactive is 'highest' or 'lowest'")
        as_of = as_of_date or self.as_of
        today = F.lit(as_of) if as_of else F.current_date()
        per_customer = (
            self._visits()
            .groupBy("customer_id")
            .agg(
                F.max("receipt_date").alias("_last"),
                F.count(F.lit(1)).alias("_n"),  # receipt_number is unique
                exact_sum("total_money").alias("_spent"),
            )
        )
        rfm = (
            self._names("customers", "customer_id", "name")
            .join(per_customer, "customer_id", "left")
            .select(
                "customer_id",
                "name",
                F.datediff(today, F.to_date("_last")).cast("bigint").alias("recency_days"),
                F.coalesce("_n", F.lit(0)).cast("bigint").alias("frequency"),
                F.coalesce(amount("_spent"), F.lit(0.0)).alias("monetary"),
            )
        )
        recent = -F.col("recency_days")
        if inactive == "lowest":
            recent = F.coalesce(recent.cast("double"), F.lit(float("-inf")))
        scored = with_ntiles(
            rfm,
            "customer_id",
            {
                "r_score": recent,
                "f_score": F.col("frequency"),
                "m_score": F.col("monetary"),
            },
            tiles=5,
        )
        r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
        segment = (
            F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
            .when((r >= 4) & (f >= 3), "Loyal")
            .when((f >= 4) & (m >= 4), "Big Spenders")
            .when(r >= 4, "New/Recent")
            .when((r <= 2) & (f <= 2) & (m <= 2), "Lost")
            .when((r <= 2) & (f >= 3), "At Risk")
            .otherwise("Average")
        )
        return scored.select(
            "customer_id",
            "name",
            "recency_days",
            "frequency",
            rnd("monetary", 2).alias("monetary"),
            "r_score",
            "f_score",
            "m_score",
            (r * 100 + f * 10 + m).alias("rfm_cell"),
            segment.alias("segment"),
        ).orderBy(F.desc("rfm_cell"), "customer_id")

    def top_customers(
        self, days=30, date_start=None, date_end=None, store_id=None, n=10
    ) -> DataFrame:
        """customer_id, name, visits, total_spent, avg_ticket of the n best spenders."""
        spent = amount("_spent")
        return (
            self._visits(self._window(days, date_start, date_end), store_id)
            .groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("visits"), exact_sum("total_money").alias("_spent"))
            .join(self._names("customers", "customer_id", "name"), "customer_id")
            .select(
                "customer_id",
                "name",
                "visits",
                rnd(spent, 2).alias("total_spent"),
                rnd(spent / F.col("visits"), 2).alias("avg_ticket"),
            )
            .orderBy(F.desc("total_spent"), "customer_id")
            .limit(n)
        )

    def unique_customers(
        self, days=30, date_start=None, date_end=None, store_id=None, approximate=False
    ) -> DataFrame:
        """How many customers bought something; ``approximate`` is off by 2 % or so, but
        needs no shuffle of the customers."""
        visits = self._visits(self._window(days, date_start, date_end), store_id)
        count = F.approx_count_distinct("customer_id", 0.02) if approximate else F.count_distinct("customer_id")
        return visits.agg(count.alias("unique_customers"))

    def _visit_counts(self, window) -> DataFrame:
        """How many customers made 1, 2, ... visits."""
        return (
            self._visits(window)
            .groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("visits"))
            .groupBy("visits")
            .agg(F.count(F.lit(1)).alias("customer_count"))
        )

    def retention_rate(self, days=30, date_start=None, date_end=None) -> DataFrame:
        """Percentage of the period's customers with more than one visit."""
        counts = self._visit_counts(self._window(days, date_start, date_end))
        again = F.sum(F.when(F.col("visits") > 1, F.col("customer_count")).otherwise(0))
        everyone = F.nullif(F.sum("customer_count").cast("double"), F.lit(0.0))
        return counts.agg(
            F.coalesce(rnd(again.cast("double") * 100.0 / everyone, 1), F.lit(0.0)).alias(
                "retention_rate"
            )
        )

    def customer_visit_distribution(
        self, days=365, date_start=None, date_end=None
    ) -> DataFrame:
        """visits, customer_count, pct."""
        counts = self._visit_counts(self._window(days, date_start, date_end))
        return counts.withColumn("pct", share_of_total("customer_count")).orderBy("visits")
