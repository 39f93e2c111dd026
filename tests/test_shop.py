"""Metrics on the small shop against answers worked out by hand."""

from __future__ import annotations

from datetime import date, datetime

import pytest

from tests import shop


@pytest.fixture(scope="module")
def engine(spark):
    return shop.engine(spark)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_revenue(engine):
    assert rows(engine.revenue.total_revenue()) == [(1500.0,)]
    assert rows(engine.revenue.total_revenue_by_month()) == [("2026-05", 1500.0, 6, 250.0)]
    daily = engine.revenue.daily_revenue().collect()
    assert [r.date for r in daily] == [date(2026, 5, 3), date(2026, 5, 2), date(2026, 5, 1)]
    assert sum(r.tx_count for r in daily) == 6
    assert rows(engine.revenue.revenue_by_store()) == [("Main Store", 6, 1500.0, 250.0)]
    assert rows(engine.revenue.revenue_by_store(by_id=True)) == [("store1", "Main Store", 6, 1500.0, 250.0)]
    by_id = engine.employees.revenue_by_employee(by_id=True).collect()
    assert {r.employee_id for r in by_id} == {"emp1", "emp2"} and len(by_id) == 2
    assert rows(engine.revenue.refund_rate())[0] == (date(2026, 5, 3), -100.0, 250.0, 40.0)
    assert rows(engine.revenue.revenue_growth()) == [(date(2026, 5, 1), 1500.0, 6, None, None)]


def test_windows(engine):
    total = lambda **k: engine.revenue.total_revenue(**k).first()[0]
    assert total(days=1) == 250.0
    assert total(date_start="2026-05-01", date_end="2026-05-01") == 750.0  # the whole day
    assert total(date_start="2026-05-01", date_end=datetime(2026, 5, 1, 12)) == 500.0
    assert total(date_end=date(2026, 5, 2)) == 1250.0
    assert total(store_id="nowhere") == 0.0
    with pytest.raises(ValueError):
        total(days=0)


def test_products(engine):
    categories = engine.products.revenue_by_category().collect()
    assert [r.category for r in categories] == ["Service", "Soaps"]
    assert sum(r.pct_share for r in categories) == pytest.approx(100.0, abs=0.1)
    basket = engine.products.items_per_transaction().first()
    assert (basket.average, basket.min_items, basket.p50, basket.max_items) == (2.2, 1, 2.0, 3)
    assert rows(engine.products.top_items(n=1)) == [("Wash", 8.0, 800.0, 5)]
    assert engine.products.items_per_transaction(store_id="nowhere").first().average == 0.0


def test_customers(engine):
    rfm = engine.customers.rfm_analysis().collect()
    assert len(rfm) == 3
    assert all(1 <= s <= 5 for r in rfm for s in (r.r_score, r.f_score, r.m_score))
    assert rows(engine.customers.unique_customers()) == [(3,)]
    assert rows(engine.customers.unique_customers(approximate=True)) == [(3,)]
    assert rows(engine.customers.retention_rate()) == [(100.0,)]
    assert rows(engine.customers.customer_visit_distribution()) == [(2, 3, 100.0)]
    first_day = engine.customers.new_vs_returning().collect()[-1]
    assert tuple(first_day) == (date(2026, 5, 1), 3, 3, 1, 2)
    assert {r.visits for r in engine.customers.top_customers().collect()} == {2}


def test_employees(engine):
    assert rows(engine.employees.revenue_by_employee()) == [
        ("Alice", 3, 750.0, 250.0, 30.0),
        ("Bob", 3, 750.0, 250.0, 0.0),
    ]
    assert rows(engine.employees.tip_by_employee())[0] == ("Alice", 30.0, 10.0, 4.0)
    assert engine.employees.employee_daily_summary().count() == 5


def test_operations(engine):
    hours = engine.operations.peak_hours().collect()
    assert sum(r.pct_of_day for r in hours) == pytest.approx(100.0, abs=0.5)
    days = [r.day_name for r in engine.operations.peak_days().collect()]
    assert days == ["Friday", "Saturday", "Sunday"]
    split = {r.payment_type: r for r in engine.operations.payment_method_split().collect()}
    assert (split["Card"].tx_count, split["Card"].revenue) == (2, 400.0)
    assert (split["Cash"].tx_count, split["Cash"].revenue) == (1, 100.0)
    assert (split["Unknown"].tx_count, split["Unknown"].revenue) == (4, 1000.0)
    assert rows(engine.operations.dining_option_split()) == [("Unspecified", 6, 1500.0, 250.0)]
    assert rows(engine.operations.discount_analysis())[-1] == (date(2026, 5, 1), 3, 750.0, 25.0, 3.2)
    assert rows(engine.operations.tip_analysis())[-1] == (date(2026, 5, 1), 3, 20.0, 6.67, 2.7)


def test_time_series(engine):
    average = engine.time_series.moving_average_revenue(window=2).collect()
    assert [r.ma_2d for r in average] == [375.0, 625.0, 750.0]
    assert [r.dod_change_pct for r in engine.time_series.day_over_day().collect()] == [-50.0, -33.3, None]
    assert all(r.prev_week_revenue is None for r in engine.time_series.week_over_week_growth().collect())
    assert engine.time_series.monthly_summary().first().unique_customers == 3


def test_profitability(engine):
    assert sum(r.revenue for r in engine.profitability.gross_profit().collect()) == 1450.0
    items = {r.item: r for r in engine.profitability.profit_margins().collect()}
    assert (items["Wash"].revenue, items["Wash"].gross_profit) == (800.0, 560.0)
    category = {r.category: r for r in engine.profitability.profit_by_category().collect()}
    assert category["Service"].gross_profit == 900.0
    assert rows(engine.profitability.overall_margin(store_id="nowhere")) == [(0.0,)]
    assert engine.profitability.items_without_cost().count() == 0
    by_margin = engine.profitability.profit_margins(sort_by="margin_pct", n=1).first()
    assert by_margin.item == "Wash"
    assert engine.profitability.profit_margins(sort_by="what").first().item == "Wash"
    assert engine.profitability.margin_trend().count() == 3


def test_inventory(engine):
    wash = {r.item: r for r in engine.inventory.turnover().collect()}["Wash"]
    assert (wash.units_sold, wash.current_stock, wash.turnover_rate) == (8.0, 10, 0.8)
    values = [r.stock_value for r in engine.inventory.stock_value().collect()]
    assert (sum(values), min(values)) == (530.0, 30.0)
    assert rows(engine.inventory.total_inventory_value()) == [(530.0,)]
    assert rows(engine.inventory.stock_value_by_store()) == [("Main Store", 3, 18, 530.0)]
    assert rows(engine.inventory.low_stock(threshold=2)) == [
        ("Detergent", "SKU-DET", 3, 5.0, "Main Store", datetime(2026, 5, 2, 10, 0))
    ]
    assert engine.inventory.items_never_sold().count() == 0
    assert engine.inventory.items_never_sold(days=1).count() == 2
    with pytest.raises(ValueError):
        engine.inventory.turnover(days=None)


def test_adhoc(engine):
    assert rows(engine.adhoc.best_sellers(n=1)) == [("Wash", 8.0, 800.0)]
    assert engine.adhoc.customer_lifetime_value().first().name == "John Doe"
    assert rows(engine.adhoc.catalogue_by_category()) == [("Service", 2, 2), ("Soaps", 1, 1)]
    assert rows(engine.adhoc.customers_by_email_domain("@gmail.com")) == [
        ("cust1", "John Doe", "j@gmail.com")
    ]
    assert {r.id: r.tenure_days for r in engine.adhoc.customer_tenure().collect()}["cust1"] == 44


def test_schema_is_stable_without_rows(engine):
    empty = engine.revenue.daily_revenue(store_id="nowhere")
    assert empty.dtypes == engine.revenue.daily_revenue().dtypes
    assert empty.count() == 0
