"""The warehouse: tables, keys and how each is laid out on disk."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONTH, BUCKET = "receipt_month", "key_bucket"


@dataclass(frozen=True)
class TableSpec:
    """``owner`` names the column holding the parent's key in junction and child tables."""

    name: str
    ddl: str
    key: tuple[str, ...]
    owner: str | None = None
    by_month: bool = False
    buckets: int = 1

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl.replace("TIMESTAMP", "TIMESTAMP_NTZ"))

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def partition(self) -> str:
        return MONTH if self.by_month else BUCKET

    @property
    def may_repeat(self) -> bool:
        """Whether one record can hold a key twice; elsewhere the split rules it out."""
        return self.owner is not None and len(self.columns) > len(self.key) and "position" not in self.key

    @property
    def bucket_key(self) -> str:
        """Rows of one parent share a bucket with each other and with the parent."""
        return self.owner or self.key[0]


_AUDIT = "created_at TIMESTAMP, updated_at TIMESTAMP, deleted_at TIMESTAMP"


def _main(name, columns, key=("id",), **layout):
    return TableSpec(name, columns, key, **layout)


def _link(name, owner, other):
    return TableSpec(name, f"{owner} STRING, {other} STRING", (owner, other), owner, buckets=16)


# Table, column and key names of the warehouse.
TABLES: dict[str, TableSpec] = {
    t.name: t
    for t in (
        _main("categories", f"id STRING, name STRING, color STRING, {_AUDIT}"),
        _main(
            "stores",
            "id STRING, name STRING, address STRING, city STRING, state STRING, "
            "postal_code STRING, country STRING, phone_number STRING, description STRING, "
            + _AUDIT,
        ),
        _main(
            "suppliers",
            "id STRING, name STRING, contact STRING, email STRING, phone_number STRING, "
            "website STRING, address_1 STRING, address_2 STRING, city STRING, region STRING, "
            f"postal_code STRING, country_code STRING, note STRING, {_AUDIT}",
        ),
        _main("taxes", f"id STRING, name STRING, type STRING, rate DOUBLE, {_AUDIT}"),
        _main("modifiers", f"id STRING, name STRING, position INT, {_AUDIT}"),
        _main(
            "discounts",
            "id STRING, type STRING, name STRING, discount_amount DOUBLE, "
            f"discount_percent DOUBLE, restricted_access BOOLEAN, {_AUDIT}",
        ),
        _main(
            "employees",
            f"id STRING, name STRING, email STRING, phone_number STRING, is_owner BOOLEAN, {_AUDIT}",
        ),
        _main(
            "customers",
            "id STRING, name STRING, email STRING, phone_number STRING, address STRING, "
            "city STRING, region STRING, postal_code STRING, country_code STRING, note STRING, "
            "customer_code STRING, first_visit TIMESTAMP, last_visit TIMESTAMP, total_visits INT, "
            "total_spent DOUBLE, total_points DOUBLE, permanent_deletion_at TIMESTAMP, " + _AUDIT,
            buckets=64,
        ),
        _main(
            "pos_devices",
            "id STRING, name STRING, store_id STRING, activated BOOLEAN, deleted_at TIMESTAMP",
        ),
        _main("payment_types", f"id STRING, name STRING, type STRING, {_AUDIT}"),
        _main(
            "items",
            "id STRING, name STRING, handle STRING, reference_id STRING, description STRING, "
            "track_stock BOOLEAN, sold_by_weight BOOLEAN, is_composite BOOLEAN, "
            "use_production BOOLEAN, category_id STRING, primary_supplier_id STRING, form STRING, "
            "color STRING, image_url STRING, option1_name STRING, option2_name STRING, "
            f"option3_name STRING, {_AUDIT}",
            buckets=16,
        ),
        _main(
            "variants",
            "id STRING, item_id STRING, sku STRING, reference_variant_id STRING, "
            "option1_value STRING, option2_value STRING, option3_value STRING, barcode STRING, "
            "cost DOUBLE, purchase_cost DOUBLE, default_pricing_type STRING, "
            f"default_price DOUBLE, {_AUDIT}",
            buckets=16,
        ),
        _main(
            "receipts",
            "id STRING, receipt_number STRING, note STRING, receipt_type STRING, "
            f"refund_for STRING, order_id STRING, {_AUDIT}, source STRING, "
            "receipt_date TIMESTAMP, cancelled_at TIMESTAMP, total_money DOUBLE, "
            "total_tax DOUBLE, points_earned DOUBLE, points_deducted DOUBLE, "
            "points_balance DOUBLE, total_discount DOUBLE, customer_id STRING, "
            "employee_id STRING, store_id STRING, pos_device_id STRING, dining_option STRING, "
            "tip DOUBLE, surcharge DOUBLE",
            key=("receipt_number",),
            by_month=True,
        ),
        _main(
            "merchant",
            "id STRING, business_name STRING, email STRING, country STRING, currency STRING, "
            "created_at TIMESTAMP",
        ),
        _main(
            "inventory",
            "variant_id STRING, store_id STRING, in_stock INT, updated_at TIMESTAMP",
            key=("variant_id", "store_id"),
            buckets=16,
        ),
        _main(
            "webhooks",
            "id STRING, merchant_id STRING, url STRING, type STRING, status STRING, "
            "created_at TIMESTAMP, updated_at TIMESTAMP",
        ),
        _main(
            "shifts",
            "id STRING, store_id STRING, pos_device_id STRING, opened_at TIMESTAMP, "
            "closed_at TIMESTAMP, opened_by_employee STRING, closed_by_employee STRING, "
            "starting_cash DOUBLE, cash_payments DOUBLE, cash_refunds DOUBLE, paid_in DOUBLE, "
            "paid_out DOUBLE, expected_cash DOUBLE, actual_cash DOUBLE, gross_sales DOUBLE, "
            "refunds DOUBLE, discounts DOUBLE, net_sales DOUBLE, tip DOUBLE, surcharge DOUBLE, "
            + _AUDIT,
            buckets=16,
        ),
        _link("employee_store", "employee_id", "store_id"),
        _link("item_tax", "item_id", "tax_id"),
        _link("item_modifier", "item_id", "modifier_id"),
        _link("modifier_store", "modifier_id", "store_id"),
        _link("tax_store", "tax_id", "store_id"),
        _link("discount_store", "discount_id", "store_id"),
        _link("payment_type_store", "payment_type_id", "store_id"),
        TableSpec(
            "variant_store",
            "variant_id STRING, store_id STRING, available_for_sale BOOLEAN, "
            "optimal_stock DOUBLE, low_stock_threshold DOUBLE",
            ("variant_id", "store_id"),
            owner="variant_id",
            buckets=16,
        ),
        TableSpec(
            "receipt_line_items",
            "id STRING, receipt_id STRING, item_id STRING, variant_id STRING, item_name STRING, "
            "variant_name STRING, sku STRING, quantity DOUBLE, price DOUBLE, "
            "gross_total_money DOUBLE, total_money DOUBLE, cost DOUBLE, cost_total DOUBLE, "
            "line_note STRING, total_discount DOUBLE",
            ("receipt_id", "id"),
            owner="receipt_id",
            by_month=True,
        ),
        # not in the 31: the tenders of a receipt, which the payment split needs
        TableSpec(
            "receipt_payments",
            "receipt_id STRING, position INT, payment_type_id STRING, name STRING, type STRING, "
            "money_amount DOUBLE, paid_at TIMESTAMP",
            ("receipt_id", "position"),
            owner="receipt_id",
            by_month=True,
        ),
        TableSpec(
            "modifier_options",
            f"id STRING, modifier_id STRING, name STRING, price DOUBLE, position INT, {_AUDIT}",
            ("modifier_id", "id"),
            owner="modifier_id",
            buckets=16,
        ),
        TableSpec(
            "shift_taxes",
            "id STRING, shift_id STRING, name STRING, rate DOUBLE, amount DOUBLE",
            ("shift_id", "id"),
            owner="shift_id",
            buckets=16,
        ),
        TableSpec(
            "shift_payments",
            "id STRING, shift_id STRING, name STRING, amount DOUBLE",
            ("shift_id", "id"),
            owner="shift_id",
            buckets=16,
        ),
        TableSpec(
            "shift_cash_movements",
            "id STRING, shift_id STRING, time TIMESTAMP, amount DOUBLE, note STRING",
            ("shift_id", "id"),
            owner="shift_id",
            buckets=16,
        ),
        _main(
            "sync_metadata",
            "resource_name STRING, last_sync_at TIMESTAMP, records_count BIGINT, sync_type STRING",
            key=("resource_name",),
        ),
    )
}
