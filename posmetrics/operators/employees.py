"""Staff performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posmetrics.functions.money import amount, exact_sum, ratio, rnd
from posmetrics.operators.base import MetricGroup


class Employees(MetricGroup):
    def _per_employee(self, window, store_id=None, *extra) -> DataFrame:
        """Sums per employee id, then the name: the join sees grouped rows."""
        return (
            self._sales(window, store_id)
            .groupBy("employee_id", *extra)
            .agg(
                F.count(F.lit(1)).alias("_n"),
                exact_sum("total_money").alias("_revenue"),
                exact_sum("tip").alias("_tips"),
            )
            .join(self._names("employees", "employee_id", "employee"), "employee_id")
        )

    def revenue_by_employee(
        self, days=30, date_start=None, date_end=None, store_id=None, by_id=False
    ) -> DataFrame:
        """employee, tx_count, revenue, avg_ticket, total_tips; one row per name, or, with
        ``by_id``, per employee_id."""
        group = ["employee_id", "employee"] if by_id else ["employee"]
        revenue = amount(F.sum("_revenue"))
        return (
            self._per_employee(self._window(days, date_start, date_end), store_id)
            .groupBy(*group)
            .agg(
                F.sum("_n").alias("tx_count"),
                rnd(revenue, 2).alias("revenue"),
                rnd(revenue / F.sum("_n"), 2).alias("avg_ticket"),
                rnd(amount(F.sum("_tips")), 2).alias("total_tips"),
            )
            .orderBy(F.desc("revenue"), *reversed(group))
        )

    def employee_daily_summary(
        self, days=30, date_start=None, date_end=None, store_id=None
    ) -> DataFrame:
        """date, employee, tx_count, revenue."""
        day = F.to_date("receipt_date").alias("date")
        return (
            self._per_employee(self._window(days, date_start, date_end), store_id, day)
            .groupBy("date", "employee")
            .agg(
                F.sum("_n").alias("tx_count"),
                rnd(amount(F.sum("_revenue")), 2).alias("revenue"),
            )
            .orderBy(F.desc("date"), "employee")
        )

    def tip_by_employee(self, days=30, date_start=None, date_end=None) -> DataFrame:
        """employee, total_tips, avg_tip, tip_rate_pct."""
        tips, revenue = amount(F.sum("_tips")), amount(F.sum("_revenue"))
        return (
            self._per_employee(self._window(days, date_start, date_end))
            .groupBy("employee")
            .agg(
                rnd(tips, 2).alias("total_tips"),
                rnd(tips / F.sum("_n"), 2).alias("avg_tip"),
                rnd(ratio(tips, revenue) * 100.0, 1).alias("tip_rate_pct"),
            )
            .orderBy(F.desc("total_tips"), "employee")
        )
