"""Ad-hoc reports over the warehouse. Those on sales keep cancelled ones, unlike the metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posmetrics.functions.money import ratio, total
from posmetrics.functions.period import ALWAYS, DateWindow
from posmetrics.operators.base import MetricGroup


class Adhoc(MetricGroup):
    def _all_sales(self, window: DateWindow = ALWAYS) -> DataFrame:
        return self.tables.receipts(window).filter(F.col("receipt_type") == "SALE")

    def top_customers_all_time(self, n=10) -> DataFrame:
        """name, receipt_count, total_spent."""
        return (
            self._all_sales()
            .filter(F.col("customer_id").isNotNull())
            .groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("receipt_count"), total("total_money").alias("total_spent"))
            .join(self._names("customers", "customer_id", "name"), "customer_id")
            .orderBy(F.desc("total_spent"), "customer_id")
            .limit(n)
            .select("name", "receipt_count", "total_spent")
        )

    def daily_receipts(self, days=30) -> DataFrame:
        """date, receipt_count, revenue since ``days`` days before the as-of day."""
        window = DateWindow.of(days + 1, as_of=self.as_of)
        return (
            self._all_sales(window)
            .groupBy(F.to_date("receipt_date").alias("date"))
            .agg(F.count(F.lit(1)).alias("receipt_count"), total("total_money").alias("revenue"))
            .orderBy(F.desc("date"))
        )

    def best_sellers(self, n=10) -> DataFrame:
        """name, units_sold, revenue (quantity x price) per item."""
        sales = self._all_sales().select("receipt_number")
        lines = self.tables.line_items()
        per_item = (
            lines.join(sales, lines.receipt_id == sales.receipt_number)
            .groupBy("item_id")
            .agg(
                total("quantity").alias("units_sold"),
                total(F.col("quantity") * F.col("price")).alias("revenue"),
            )
        )
        return (
            per_item.join(self._names("items", "item_id", "name"), "item_id")
            .orderBy(F.desc("units_sold"), "item_id")
            .limit(n)
            .select("name", "units_sold", "revenue")
        )

    def customer_lifetime_value(self, n=20) -> DataFrame:
        """name, total_visits, total_spent, avg_per_visit."""
        spent = F.col("total_spent")
        return (
            self.tables.table("customers")
            .filter(F.col("total_visits") > 0)
            .orderBy(F.desc("total_spent"), "id")
            .limit(n)
            .select(
                "name",
                "total_visits",
                "total_spent",
                ratio(spent, F.col("total_visits").cast("double")).alias("avg_per_visit"),
            )
        )

    def catalogue_by_category(self) -> DataFrame:
        """category, item_count, variant_count; empty categories are kept."""
        variants = (
            self.tables.table("variants")
            .groupBy("item_id")
            .agg(F.count("id").alias("variants"))
        )
        per_category = (
            self.tables.table("items")
            .filter(F.col("category_id").isNotNull())
            .select(F.col("id").alias("item_id"), "category_id")
            .join(variants, "item_id", "left")
            .groupBy("category_id")
            .agg(
                F.count(F.lit(1)).alias("items"),
                F.sum(F.coalesce("variants", F.lit(0))).alias("variants"),
            )
        )
        return (
            self._names("categories", "category_id", "category")
            .join(per_category, "category_id", "left")
            .select(
                "category",
                F.coalesce("items", F.lit(0)).cast("bigint").alias("item_count"),
                F.coalesce("variants", F.lit(0)).cast("bigint").alias("variant_count"),
            )
            .orderBy(F.desc("item_count"), "category")
        )

    def customers_by_email_domain(self, suffix: str) -> DataFrame:
        """Customers whose e-mail ends in ``suffix``."""
        return (
            self.tables.table("customers")
            .filter(F.col("email").endswith(suffix))
            .select("id", "name", "email")
        )

    def customer_tenure(self) -> DataFrame:
        """id, tenure_days, tenure_seconds between first and last visit."""
        seconds = F.timestamp_diff("SECOND", F.col("first_visit"), F.col("last_visit"))
        return (
            self.tables.table("customers")
            .select("id", seconds.alias("tenure_seconds"))
            .filter(F.col("tenure_seconds").isNotNull())
            .withColumn("tenure_days", F.floor(F.col("tenure_seconds") / 86400).cast("bigint"))
        )
