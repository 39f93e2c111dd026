"""Turnover, stock value, low stock and dead stock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posmetrics.functions.money import rnd, total
from posmetrics.functions.period import of_store
from posmetrics.operators.base import MetricGroup


class Inventory(MetricGroup):
    def _variants(self) -> DataFrame:
        return self.tables.table("variants").select(
            F.col("id").alias("variant_id"), "item_id", "sku", "cost"
        )

    def _described_stock(self, stock: DataFrame) -> DataFrame:
        """Stock rows with variant and item attributes, defaults filled in."""
        items = self._names("items", "item_id", "item_name")
        return (
            stock.join(self._variants(), "variant_id", "left")
            .join(items, "item_id", "left")
            .withColumn("item_name", F.coalesce("item_name", F.lit("Unknown")))
            .withColumn("variant_sku", F.coalesce("sku", F.lit("N/A")))
        )

    def _stock(self, store_id=None) -> DataFrame:
        return of_store(self.tables.table("inventory"), store_id).select(
            "variant_id", "store_id", "in_stock"
        )

    def turnover(
        self, days=30, date_start=None, date_end=None, store_id=None, n=20
    ) -> DataFrame:
        """item, variant_sku, units_sold, current_stock, avg_cost, turnover_rate, days_to_sell.

        Sales of all stores against the stock of ``store_id`` (or all stores).
        Both sides are grouped before they meet.
        """
        window = self._window(days, date_start, date_end)
        if window.days is None:
            raise ValueError("turnover needs days or date_start to know the period's length")
        sold = (
            self._sold_lines(window)
            .groupBy("item_name", F.coalesce("variant_id", "item_id").alias("variant_id"))
            .agg(total("quantity").alias("units_sold"))
            .filter(F.col("units_sold") > 0)
        )
        stock = (
            self._stock(store_id)
            .groupBy("variant_id")
            .agg(F.sum("in_stock").alias("stock"))
        )
        on_hand = F.col("stock").cast("double")
        stocked_cost = F.when(F.col("stock").isNotNull(), F.col("cost"))
        return (
            sold.join(stock, "variant_id", "left")
            .join(self._variants().drop("item_id"), "variant_id", "left")
            .select(
                F.col("item_name").alias("item"),
                F.coalesce("sku", F.lit("N/A")).alias("variant_sku"),
                "units_sold",
                F.coalesce("stock", F.lit(0)).cast("bigint").alias("current_stock"),
                rnd(F.coalesce(stocked_cost, F.lit(0.0)), 2).alias("avg_cost"),
                rnd(F.col("units_sold") / F.greatest(on_hand, F.lit(1.0)), 1).alias(
                    "turnover_rate"
                ),
                rnd(
                    F.greatest(on_hand, F.lit(0.0)) / (F.col("units_sold") / float(window.days)),
                    0,
                ).alias("days_to_sell"),
                "variant_id",
            )
            .orderBy(F.desc("turnover_rate"), "item", "variant_id")
            .limit(n)
            .drop("variant_id")
        )

    def stock_value(self, store_id=None) -> DataFrame:
        """item_name, variant_sku, in_stock, unit_cost, stock_value per stocked variant."""
        cost = F.coalesce("cost", F.lit(0.0))
        return (
            self._described_stock(self._stock(store_id).filter("in_stock > 0"))
            .select(
                "item_name",
                "variant_sku",
                "in_stock",
                rnd(cost, 2).alias("unit_cost"),
                rnd(F.col("in_stock") * cost, 2).alias("stock_value"),
            )
            .orderBy(F.desc("stock_value"), "item_name", "variant_sku")
        )

    def total_inventory_value(self, store_id=None) -> DataFrame:
        """Value of all stock, negative stock included."""
        stock = self._stock(store_id).join(self._variants(), "variant_id", "left")
        value = total(F.col("in_stock") * F.col("cost"))
        return stock.agg(rnd(F.coalesce(value, F.lit(0.0)), 2).alias("total_inventory_value"))

    def stock_value_by_store(self) -> DataFrame:
        """store_name, unique_variants, total_units, stock_value."""
        value = total(F.col("in_stock") * F.col("cost"))
        return (
            self._stock()
            .filter("in_stock > 0")
            .join(self._variants(), "variant_id", "left")
            .join(self._names("stores", "store_id", "store_name"), "store_id", "left")
            .groupBy(F.coalesce("store_name", F.lit("Unknown")).alias("store_name"))
            .agg(
                F.count_distinct("variant_id").alias("unique_variants"),
                F.sum("in_stock").alias("total_units"),
                rnd(F.coalesce(value, F.lit(0.0)), 2).alias("stock_value"),
            )
            .orderBy(F.desc("stock_value"), "store_name")
        )

    def low_stock(self, store_id=None, threshold=5) -> DataFrame:
        """item_name, variant_sku, current_stock, alert_threshold, store_name, last_sold.

        A variant's own threshold in that store wins over ``threshold``. The last
        sale is found per variant first, so stock rows never fan out over sales.
        """
        limits = self.tables.table("variant_store").select(
            "variant_id", "store_id", "low_stock_threshold"
        )
        low = (
            self._stock(store_id)
            .join(limits, ["variant_id", "store_id"], "left")
            .withColumn(
                "alert_threshold", F.coalesce("low_stock_threshold", F.lit(float(threshold)))
            )
            .filter(F.col("in_stock") <= F.col("alert_threshold"))
        )
        # only lines of low variants go on to meet the receipts
        last_sold = (
            self._sold_lines(lines_of=low.select("variant_id").distinct())
            .groupBy("variant_id")
            .agg(F.max("receipt_date").alias("last_sold"))
        )
        return (
            self._described_stock(low)
            .join(self._names("stores", "store_id", "store_name"), "store_id", "left")
            .join(last_sold, "variant_id", "left")
            .select(
                "item_name",
                "variant_sku",
                F.col("in_stock").alias("current_stock"),
                "alert_threshold",
                "store_name",
                "last_sold",
            )
            .orderBy("current_stock", "item_name", "variant_sku", "store_name")
        )

    def items_never_sold(self, days=30, date_start=None, date_end=None) -> DataFrame:
        """item_name, variant_sku, current_stock, tied_up_value of stock without sales."""
        sold = self._sold_lines(self._window(days, date_start, date_end)).select(
            F.coalesce("variant_id", "item_id").alias("variant_id")
        )
        # distinct first: a hot variant reaches the anti join as one row
        unsold = (
            self._stock()
            .filter("in_stock > 0")
            .join(sold.distinct(), "variant_id", "left_anti")
        )
        return (
            self._described_stock(unsold)
            .select(
                "item_name",
                "variant_sku",
                F.col("in_stock").alias("current_stock"),
                rnd(F.col("in_stock") * F.coalesce("cost", F.lit(0.0)), 2).alias("tied_up_value"),
            )
            .orderBy(F.desc("tied_up_value"), "item_name", "variant_sku")
        )
