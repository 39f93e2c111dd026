"""What each of the 17 resources looks like as JSON, and how it is cleaned and split."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posmetrics.sources.schemas import TABLES


# The discount types that need a value, and the column it is in.
FIXED_VALUES = {"FIXED_AMOUNT": "discount_amount", "FIXED_PERCENT": "discount_percent"}


@dataclass(frozen=True)
class Link:
    """An array of ids that becomes a two-column table."""

    table: str
    array: str


@dataclass(frozen=True)
class Nested:
    """An array of structs that becomes a child table."""

    table: str
    array: str
    struct: str
    defaults: dict = field(default_factory=dict)
    numbered: bool = False
    needs: tuple[str, ...] = ()
    bare: str | None = None  # field that an element which is no object stands for

    @property
    def fields(self) -> T.StructType:
        return T.StructType.fromDDL(self.struct)

    @property
    def text_ddl(self) -> str:
        """An element with all its fields as text."""
        return ", ".join(f"{f.name} STRING" for f in self.fields)


@dataclass(frozen=True)
class Resource:
    name: str
    required: tuple[str, ...]
    envelope: str | None = ""  # key of the record list; None: the page is one record
    renames: dict[str, str] = field(default_factory=dict)  # field in the JSON -> column
    defaults: dict = field(default_factory=dict)
    tidy: tuple[str, ...] = ()
    title: tuple[str, ...] = ()
    upper: tuple[str, ...] = ()
    stamped: tuple[str, ...] = ("created_at", "updated_at")  # set to the load time if missing
    lengths: dict[str, int] = field(default_factory=dict)
    ranges: dict[str, tuple[float, float | None]] = field(default_factory=dict)
    members: dict[str, tuple[str, ...]] = field(default_factory=dict)
    links: tuple[Link, ...] = ()
    nested: tuple[Nested, ...] = ()

    @property
    def items_key(self) -> str | None:
        return None if self.envelope is None else self.envelope or self.name

    @property
    def record_ddl(self) -> str:
        """The raw record: everything is text, so that a wrong type can be told."""
        back = {column: raw for raw, column in self.renames.items()}
        parts = []
        for f in TABLES[self.name].schema.fields:
            kind = "STRING"
            if (self.name, f.name) == ("merchant", "currency"):
                kind = "STRUCT<code: STRING>"
            parts.append(f"{back.get(f.name, f.name)} {kind}")
        parts += [f"{x.array} STRING" for x in (*self.links, *self.nested)]
        return ", ".join(parts)

    def extra_rules(self) -> dict[str, Column]:
        """Conditions between columns; true means broken."""
        rules = {}
        if self.name == "discounts":
            for kind, column in FIXED_VALUES.items():
                rules[f"{column} missing"] = (F.col("type") == kind) & F.col(column).isNull()
        if self.name == "merchant":
            rules["country not a two-letter code"] = F.length("country") != 2
        if self.name == "modifiers":
            rules["modifier_options price out of range"] = F.exists(
                "modifier_options", lambda o: o["price"] < 0
            )
        return rules

    def nested_rules(self) -> list[Column]:
        """For each array an array of the names of fields that some row of it lacks; a look
        for any of them spares the others."""
        out = []
        for x in self.nested:
            if x.needs:
                lacks = F.exists(x.array, lambda r: r.isNotNull() & reduce(or_, [r[c].isNull() for c in x.needs]))
                each = [F.when(_any_missing(x, c), F.lit(f"{x.array} {c} missing")) for c in x.needs]
                out.append(F.when(lacks, F.array_compact(F.array(*each))).otherwise(F.array().cast("array<string>")))
        return out


def _any_missing(x: Nested, column: str) -> Column:
    # a field of a wrong type is not missing, and has been named already
    missing = F.exists(x.array, lambda r: r.isNotNull() & r[column].isNull())
    return missing & ~F.exists("_types", lambda t: t.startswith(f"{x.array} {column} is "))


_AUDITED = ("id", "name", "created_at", "updated_at")
_OPTIONS = {f"option{i}_value": 20 for i in (1, 2, 3)}

# Field names, defaults, limits and allowed words of the source format.
RESOURCES: dict[str, Resource] = {
    r.name: r
    for r in (
        Resource(
            "categories",
            (*_AUDITED, "color"),
            defaults={"color": "GREY"},
            upper=("color",),
            members={
                "color": ("GREY", "RED", "PINK", "ORANGE", "GREEN", "BLUE", "PURPLE", "LIME")
            },
        ),
        Resource(
            "stores",
            _AUDITED,
            lengths={
                "name": 40, "address": 255, "city": 64, "state": 64, "postal_code": 20,
                "country": 2, "phone_number": 15, "description": 128,
            },
        ),
        Resource(
            "suppliers",
            _AUDITED,
            lengths={
                "name": 40, "contact": 64, "email": 64, "phone_number": 15, "address_1": 192,
                "address_2": 192, "city": 64, "region": 64, "postal_code": 20,
                "country_code": 2, "note": 500,
            },
        ),
        Resource(
            "taxes",
            (*_AUDITED, "type", "rate"),
            lengths={"name": 40},
            ranges={"rate": (0.0, 100.0)},
            links=(Link("tax_store", "stores"),),
        ),
        Resource(
            "modifiers",
            (*_AUDITED, "position"),
            links=(Link("modifier_store", "stores"),),
            nested=(
                Nested(
                    "modifier_options",
                    "modifier_options",
                    "id STRING, name STRING, price DOUBLE, position INT, created_at STRING, "
                    "updated_at STRING, deleted_at STRING",
                    defaults={"price": 0.0, "position": 0},
                    needs=("id", "name"),
                ),
            ),
        ),
        Resource(
            "discounts",
            (*_AUDITED, "type"),
            defaults={"restricted_access": False},
            ranges={"discount_amount": (0.0, None), "discount_percent": (0.0, 100.0)},
            members={
                "type": (
                    "FIXED_PERCENT", "FIXED_AMOUNT", "VARIABLE_PERCENT", "VARIABLE_AMOUNT",
                    "DISCOUNT_BY_POINTS",
                )
            },
            links=(Link("discount_store", "stores"),),
        ),
        Resource(
            "employees",
            _AUDITED,
            defaults={"is_owner": False},
            tidy=("name", "email", "phone_number"),
            title=("name",),
            links=(Link("employee_store", "stores"),),
        ),
        Resource(
            "customers",
            _AUDITED,
            defaults={"total_visits": 1, "total_spent": 0.0, "total_points": 0.0},
            tidy=("name", "email", "phone_number"),
            title=("name",),
        ),
        Resource(
            "pos_devices", ("id", "name", "store_id"), defaults={"activated": True}, stamped=()
        ),
        Resource(
            "payment_types",
            (*_AUDITED, "type"),
            defaults={"type": "CASH"},
            upper=("type",),
            links=(Link("payment_type_store", "stores"),),
        ),
        Resource(
            "items",
            _AUDITED,
            renames={"item_name": "name"},
            defaults={
                "track_stock": False, "sold_by_weight": False, "is_composite": False,
                "use_production": False, "form": "SQUARE", "color": "GREY",
            },
            links=(Link("item_tax", "tax_ids"), Link("item_modifier", "modifier_ids")),
        ),
        Resource(
            "variants",
            ("id", "item_id", "sku", "created_at", "updated_at"),
            renames={"variant_id": "id"},
            defaults={"cost": 0.0, "purchase_cost": 0.0, "default_pricing_type": "VARIABLE"},
            lengths={"sku": 40, "reference_variant_id": 128, "barcode": 20, **_OPTIONS},
            ranges={
                "cost": (0.0, None), "purchase_cost": (0.0, None), "default_price": (0.0, None)
            },
            # an element is either a store's id or an object with its settings
            nested=(
                Nested(
                    "variant_store",
                    "stores",
                    "store_id STRING, available_for_sale BOOLEAN, optimal_stock DOUBLE, "
                    "low_stock_threshold DOUBLE",
                    defaults={"available_for_sale": True},
                    bare="store_id",
                ),
            ),
        ),
        Resource(
            "receipts",
            ("receipt_number", "receipt_type", "receipt_date", "total_money", "created_at", "updated_at"),
            defaults={
                c: 0.0
                for c in (
                    "total_tax", "points_earned", "points_deducted", "points_balance",
                    "total_discount", "tip", "surcharge",
                )
            },
            upper=("receipt_type",),
            nested=(
                Nested(
                    "receipt_line_items",
                    "line_items",
                    "id STRING, item_id STRING, variant_id STRING, item_name STRING, "
                    "variant_name STRING, sku STRING, quantity DOUBLE, price DOUBLE, "
                    "gross_total_money DOUBLE, total_money DOUBLE, cost DOUBLE, "
                    "cost_total DOUBLE, line_note STRING, total_discount DOUBLE",
                    defaults={"gross_total_money": 0.0, "total_discount": 0.0},
                    needs=("id", "item_id", "item_name", "quantity", "price", "total_money"),
                ),
                Nested(
                    "receipt_payments",
                    "payments",
                    "payment_type_id STRING, name STRING, type STRING, money_amount DOUBLE, "
                    "paid_at STRING",
                    numbered=True,
                    needs=("payment_type_id", "money_amount"),
                ),
            ),
        ),
        Resource(
            "merchant",
            ("id", "business_name", "currency", "created_at"),
            envelope=None,
            upper=("country",),
            stamped=("created_at",),
        ),
        Resource(
            "inventory",
            ("variant_id", "store_id", "updated_at"),
            envelope="inventory_levels",
            defaults={"in_stock": 0},
            stamped=(),
        ),
        Resource(
            "webhooks",
            ("id", "merchant_id", "url", "type"),
            defaults={"status": "ENABLED"},
            members={
                "type": (
                    "inventory_levels.update", "items.update", "customers.update",
                    "receipts.update", "shifts.create",
                ),
                "status": ("ENABLED", "DISABLED"),
            },
        ),
        Resource(
            "shifts",
            ("id", "store_id", "pos_device_id", "opened_at", "opened_by_employee"),
            defaults={
                c: 0.0
                for c in (
                    "starting_cash", "cash_payments", "cash_refunds", "paid_in", "paid_out",
                    "expected_cash", "actual_cash", "gross_sales", "refunds", "discounts",
                    "net_sales", "tip", "surcharge",
                )
            },
            stamped=(),
            nested=(
                Nested(
                    "shift_taxes", "taxes", "id STRING, name STRING, rate DOUBLE, amount DOUBLE",
                    defaults={"rate": 0.0, "amount": 0.0},
                ),
                Nested(
                    "shift_payments", "payments", "id STRING, name STRING, amount DOUBLE",
                    defaults={"amount": 0.0},
                ),
                Nested(
                    "shift_cash_movements", "cash_movements",
                    "id STRING, time STRING, amount DOUBLE, note STRING",
                    defaults={"amount": 0.0},
                ),
            ),
        ),
    )
}

# Parents before the tables that refer to them.
LOAD_ORDER = (
    "categories", "stores", "suppliers", "taxes", "modifiers", "discounts", "employees",
    "pos_devices", "customers", "payment_types", "items", "variants", "inventory", "receipts",
    "shifts", "webhooks", "merchant",
)
