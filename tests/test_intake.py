from __future__ import annotations

import json
from datetime import datetime

import pytest

from posmetrics.plans import intake
from posmetrics.plans.resources import LOAD_ORDER, RESOURCES

NOW = datetime(2026, 6, 1)


def prepared(spark, resource, *records, **page):
    body = records[0] if RESOURCES[resource].items_key is None else {RESOURCES[resource].items_key: records, **page}
    pages = spark.createDataFrame([(json.dumps(body),)], "value STRING")
    return intake.prepared(pages, resource, NOW)


def split(spark, resource, *records):
    return intake.split(intake.valid(prepared(spark, resource, *records)), resource)


def reasons(spark, resource, **record):
    row = prepared(spark, resource, {"id": "1", "name": "n", **record}).first()
    return list(row[intake.ERRORS])


def test_every_resource_has_a_place(spark):
    assert sorted(LOAD_ORDER) == sorted(RESOURCES) and len(RESOURCES) == 17


def test_receipt(spark):
    record = {
        "receipt_number": "1-1001", "receipt_type": "sale", "receipt_date": "2026-05-01T01:00:00Z",
        "created_at": "2026-05-01T01:00:00Z", "updated_at": None, "total_money": 12.5, "customer_id": 77,
        "line_items": [
            {"id": "a", "item_id": "i", "item_name": "Tea", "quantity": 2, "price": 5, "total_money": 10,
             "line_taxes": [{"id": "t", "type": "x", "name": "VAT", "money_amount": 1}]},
            {"id": "b", "item_id": {"id": "j"}, "item_name": "Cake", "quantity": 1, "price": 2.5,
             "total_money": 2.5, "gross_total_money": 3, "cost": 1, "cost_total": 1},
        ],
        "payments": [
            {"payment_type_id": "p", "name": "Cash", "type": "CASH", "money_amount": 2.5},
            {"payment_type_id": "q", "name": "Card", "type": "CARD", "money_amount": 10.0,
             "paid_at": "2026-05-01T01:00:05Z", "payment_details": {"reference_id": 5}},
        ],
    }
    parts = split(spark, "receipts", record)
    head = parts["receipts"].first()
    assert (head.receipt_type, head.total_tax, head.customer_id) == ("SALE", 0.0, "77")
    assert head.receipt_date == datetime(2026, 5, 1, 9) and head.updated_at == NOW
    lines = {r.id: r for r in parts["receipt_line_items"].collect()}
    assert lines["a"].receipt_id == "1-1001" and lines["a"].gross_total_money == 0.0
    assert lines["b"].gross_total_money == 3.0 and lines["a"].cost is None
    tenders = parts["receipt_payments"].collect()
    assert [(t.position, t.payment_type_id, t.money_amount) for t in tenders] == [(1, "p", 2.5), (2, "q", 10.0)]


def test_variant_stores_as_objects_or_ids(spark):
    parts = split(
        spark, "variants",
        {"variant_id": "v", "item_id": "i", "sku": "S", "stores": [
            {"store_id": "a", "available_for_sale": False, "low_stock_threshold": 4}, "b"]},
    )
    got = {tuple(r) for r in parts["variant_store"].collect()}
    assert got == {("v", "a", False, None, 4.0), ("v", "b", True, None, None)}


def test_item_names_and_links(spark):
    parts = split(
        spark, "items",
        {"id": "i", "item_name": "Coffee", "tax_ids": ["t1", "t2", "t1"], "modifier_ids": None, "variants": [{}], "components": [1]},
    )
    item = parts["items"].first()
    assert (item.name, item.handle, item.form, item.color, item.track_stock) == ("Coffee", "Coffee", "SQUARE", "GREY", False)
    assert {tuple(r) for r in parts["item_tax"].collect()} == {("i", "t1"), ("i", "t2")}
    assert parts["item_modifier"].count() == 0


def test_shift(spark):
    parts = split(
        spark, "shifts",
        {"id": "s", "store_id": "a", "pos_device_id": "d", "opened_at": "2026-05-01T00:00:00Z",
         "opened_by_employee": "e", "tip": 3, "taxes": [{"id": "t", "name": "VAT"}],
         "payments": [{"id": "p", "name": "Cash", "amount": 5}],
         "cash_movements": [{"id": "c", "time": "2026-05-01T01:00:00Z", "amount": 2, "note": "float"}]},
    )
    shift = parts["shifts"].first()
    assert (shift.tip, shift.net_sales, shift.opened_at) == (3.0, 0.0, datetime(2026, 5, 1, 8))
    assert tuple(parts["shift_taxes"].first()) == ("t", "s", "VAT", 0.0, 0.0)
    assert tuple(parts["shift_cash_movements"].first()) == ("c", "s", datetime(2026, 5, 1, 9), 2.0, "float")


@pytest.mark.parametrize(
    "resource, record, wanted",
    [
        ("taxes", {"type": "ADDED", "rate": 100.5}, ["rate out of range"]),
        ("taxes", {"type": "ADDED", "rate": 100}, []),
        ("taxes", {"rate": "many"}, ["rate is no number", "type missing"]),
        ("discounts", {"type": "FIXED_AMOUNT"}, ["discount_amount missing"]),
        ("discounts", {"type": "VARIABLE_PERCENT", "discount_amount": -1}, ["discount_amount out of range"]),
        ("discounts", {"type": "HALF"}, ["type not allowed"]),
        ("stores", {"name": "x" * 41}, ["name longer than 40"]),
        ("categories", {"color": "lime"}, []),
        ("categories", {"color": "mauve"}, ["color not allowed"]),
        ("customers", {"name": "  "}, ["name missing"]),
        ("modifiers", {"position": 1, "modifier_options": [{"id": "o", "name": "x", "price": -1}]},
         ["modifier_options price out of range"]),
        ("webhooks", {"merchant_id": "m", "url": "u", "type": "items.update", "status": "OFF"}, ["status not allowed"]),
        ("merchant", {"business_name": "b", "country": "PHL", "currency": {}},
         ["currency missing", "country not a two-letter code"]),
    ],
)
def test_rules(spark, resource, record, wanted):
    assert reasons(spark, resource, **record) == wanted


def test_rejected_records_keep_their_content(spark):
    checked = prepared(spark, "taxes", {"id": "1", "name": "a", "type": "t", "rate": 5}, {"id": "2", "rate": 5})
    assert intake.valid(checked).count() == 1
    bad = intake.rejected(checked).first()
    assert json.loads(bad.record)["id"] == "2" and bad.reasons == "name missing; type missing"


def test_unreadable_pages(spark):
    texts = ['{"taxes": [{"id": "1"}]}', '{"taxes": {}}', '{"other": []}', "oops", '{"taxes": []}']
    pages = spark.createDataFrame([(t,) for t in texts], "value STRING")
    assert intake.records(pages, "taxes").count() == 1
    bad = {r.page: r.reason for r in intake.unreadable(pages, "taxes").collect()}
    assert bad == {
        '{"taxes": {}}': "no list 'taxes'", '{"other": []}': "no list 'taxes'", "oops": "not a JSON object",
    }
