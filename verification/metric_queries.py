"""Every metric and ad-hoc report over the star's tables, by key."""

from __future__ import annotations

from posmetrics import Engine
from posmetrics.session import configure
from posmetrics.sources.star import AS_OF, StarTables


def _on_engine(build):
    def run(spark, sf_dir):
        return build(Engine(StarTables(configure(spark), sf_dir), AS_OF))

    return run


ALL = {"days": None}

METRICS = {
    "a01_daily_revenue": lambda e: e.revenue.daily_revenue(),
    "a01_daily_revenue_store_range": lambda e: e.revenue.daily_revenue(
        date_start="1998-03-01", date_end="1998-06-30", store_id="3"
    ),
    "a02_revenue_by_store": lambda e: e.revenue.revenue_by_store(),
    "a03_revenue_growth_month": lambda e: e.revenue.revenue_growth(),
    "a03_revenue_growth_week_store": lambda e: e.revenue.revenue_growth("week", 26, "2"),
    "a04_total_revenue": lambda e: e.revenue.total_revenue(),
    "a05_total_revenue_by_month": lambda e: e.revenue.total_revenue_by_month(days=365),
    "a06_refund_rate": lambda e: e.revenue.refund_rate(days=365),
    "a07_revenue_by_category": lambda e: e.products.revenue_by_category(),
    "a07_revenue_by_category_all_time": lambda e: e.products.revenue_by_category(**ALL),
    "a08_top_items": lambda e: e.products.top_items(),
    "a09_items_per_transaction": lambda e: e.products.items_per_transaction(),
    "a09_items_per_transaction_all_time": lambda e: e.products.items_per_transaction(**ALL),
    "a10_category_mix_trend": lambda e: e.products.category_mix_trend(),
    "a11_new_vs_returning": lambda e: e.customers.new_vs_returning(),
    "a11_new_vs_returning_all_time": lambda e: e.customers.new_vs_returning(**ALL),
    "a12_rfm_analysis": lambda e: e.customers.rfm_analysis(),
    "a12_inactive_lowest": lambda e: e.customers.rfm_analysis(inactive="lowest"),
    "a13_top_customers": lambda e: e.customers.top_customers(days=365),
    "a14_unique_customers": lambda e: e.customers.unique_customers(),
    "a15_retention_rate": lambda e: e.customers.retention_rate(days=365),
    "a16_customer_visit_distribution": lambda e: e.customers.customer_visit_distribution(),
    "a17_revenue_by_employee": lambda e: e.employees.revenue_by_employee(),
    "a18_employee_daily_summary": lambda e: e.employees.employee_daily_summary(days=365),
    "a19_tip_by_employee": lambda e: e.employees.tip_by_employee(),
    "a20_peak_hours": lambda e: e.operations.peak_hours(),
    "a21_peak_days": lambda e: e.operations.peak_days(days=90),
    "a22_payment_method_split": lambda e: e.operations.payment_method_split(),
    "a22_payment_method_split_all_time": lambda e: e.operations.payment_method_split(**ALL),
    "a23_discount_analysis": lambda e: e.operations.discount_analysis(days=365),
    "a24_tip_analysis": lambda e: e.operations.tip_analysis(days=365),
    "a25_dining_option_split": lambda e: e.operations.dining_option_split(),
    "a26_moving_average_revenue": lambda e: e.time_series.moving_average_revenue(),
    "a26_moving_average_28_days": lambda e: e.time_series.moving_average_revenue(
        window=28, days=365, store_id="1"
    ),
    "a27_week_over_week_growth": lambda e: e.time_series.week_over_week_growth(),
    "a26_calendar": lambda e: e.time_series.moving_average_revenue(
        store_id="1", date_start="1998-01-01", date_end="1999-12-31", calendar=True
    ),
    "a27_calendar": lambda e: e.time_series.week_over_week_growth(days=365, calendar=True),
    "a28_monthly_summary": lambda e: e.time_series.monthly_summary(),
    "a29_day_over_day": lambda e: e.time_series.day_over_day(),
    "a30_gross_profit": lambda e: e.profitability.gross_profit(),
    "a30_gross_profit_all_time": lambda e: e.profitability.gross_profit(**ALL),
    "a31_profit_by_category": lambda e: e.profitability.profit_by_category(days=365),
    "a32_profit_margins": lambda e: e.profitability.profit_margins(days=365),
    "a32_profit_margins_by_margin": lambda e: e.profitability.profit_margins(
        days=365, sort_by="margin_pct"
    ),
    "a32_profit_margins_by_revenue": lambda e: e.profitability.profit_margins(
        days=None, sort_by="revenue"
    ),
    "a33_margin_trend": lambda e: e.profitability.margin_trend(),
    "a34_overall_margin": lambda e: e.profitability.overall_margin(store_id="4"),
    "a35_items_without_cost": lambda e: e.profitability.items_without_cost(),
    "a36_turnover": lambda e: e.inventory.turnover(),
    "a36_turnover_range_store": lambda e: e.inventory.turnover(
        date_start="2000-01-01", date_end="2000-12-31", store_id="2", n=50
    ),
    "a37_stock_value": lambda e: e.inventory.stock_value(),
    "a37_stock_value_store": lambda e: e.inventory.stock_value(store_id="1"),
    "a38_total_inventory_value": lambda e: e.inventory.total_inventory_value(),
    "a39_stock_value_by_store": lambda e: e.inventory.stock_value_by_store(),
    "a40_low_stock": lambda e: e.inventory.low_stock(),
    "a40_low_stock_store": lambda e: e.inventory.low_stock(store_id="3", threshold=2),
    "a41_items_never_sold": lambda e: e.inventory.items_never_sold(),
    "a41_items_never_sold_year": lambda e: e.inventory.items_never_sold(days=365),
    "e1_top_customers_all_time": lambda e: e.adhoc.top_customers_all_time(),
    "e2_daily_receipts": lambda e: e.adhoc.daily_receipts(),
    "e3_best_sellers": lambda e: e.adhoc.best_sellers(),
    "e4_customer_lifetime_value": lambda e: e.adhoc.customer_lifetime_value(),
    "e5_catalogue_by_category": lambda e: e.adhoc.catalogue_by_category(),
    "e6_customers_by_email_domain": lambda e: e.adhoc.customers_by_email_domain("@gmail.com"),
    "e7_customer_tenure": lambda e: e.adhoc.customer_tenure(),
}

QUERIES = {key: _on_engine(build) for key, build in METRICS.items()}
