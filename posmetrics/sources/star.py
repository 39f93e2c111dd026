"""POS tables as projections of a TPC-H-like star (orders, lineitem, part, ...).

Every table is a row-wise projection of its source, so filters and column pruning
reach the scan. Receipt times add the hour to the order date; a window on the
receipt date is therefore also pushed down as a window on the order date.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posmetrics.functions.period import ALWAYS, DateWindow
from posmetrics.sources.tables import Tables

AS_OF = date(2001, 8, 1)  # the last order day

# The columns of the star, so that no file is opened just to infer them.
SOURCES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}

ISSUED = "o_orderdate + make_dt_interval(0, int(o_orderkey % 24))"
CHANGED = f"{ISSUED} + make_dt_interval(int(o_orderkey % 5))"
SIGNED_TOTAL = "if(o_orderkey % 20 = 0, -o_totalprice, o_totalprice)"
PRICE = "900D + (l_partkey % 2000) / 10D"
COST = f"if(l_partkey % 11 <> 0, ({PRICE}) * 0.6D, NULL)"
FIRST_VISIT = "timestamp_ntz'1995-01-01' + make_dt_interval(int(c_custkey * 37 % 2400))"


def _audit(key: str) -> list[str]:
    created = f"timestamp_ntz'1999-01-01' + make_dt_interval(int({key} % 700))"
    changed = f"{created} + make_dt_interval(int({key} % 11))"
    return [
        f"{created} AS created_at",
        f"{changed} AS updated_at",
        f"if({key} % 19 = 0, {changed}, NULL) AS deleted_at",
    ]


# table -> (source, columns); the four oddly shaped ones have methods below
PROJECTIONS = {
    "receipts": (
        "orders",
        [
            "string(o_orderkey) AS id",
            "string(o_orderkey) AS receipt_number",
            "if(o_orderkey % 20 = 0, 'REFUND', 'SALE') AS receipt_type",
            f"{ISSUED} AS created_at",
            f"{CHANGED} AS updated_at",
            f"if(o_orderkey % 97 = 0, {CHANGED}, NULL) AS deleted_at",
            f"{ISSUED} AS receipt_date",
            f"if(o_orderkey % 50 = 7, {ISSUED}, NULL) AS cancelled_at",
            f"{SIGNED_TOTAL} AS total_money",
            "if(o_orderkey % 4 = 0, o_totalprice * 0.05D, 0D) AS total_discount",
            "if(o_orderkey % 3 = 0, o_totalprice * 0.02D, 0D) AS tip",
            "if(o_custkey % 10 <> 0, string(o_custkey), NULL) AS customer_id",
            "string(o_orderkey % 25) AS employee_id",
            "string(o_orderkey % 5) AS store_id",
            "CASE o_orderstatus WHEN 'F' THEN 'Dine in' WHEN 'O' THEN 'Takeaway' END AS dining_option",
        ],
    ),
    "receipt_line_items": (
        "lineitem",
        [
            "concat_ws('-', l_orderkey, l_linenumber) AS id",
            "string(l_orderkey) AS receipt_id",
            "string(l_partkey) AS item_id",
            "if(l_partkey % 7 <> 0, string(l_partkey), NULL) AS variant_id",
            "concat('Item ', l_partkey div 25) AS item_name",
            "l_quantity AS quantity",
            f"{PRICE} AS price",
            "l_extendedprice AS gross_total_money",
            "l_extendedprice * (1D - l_discount) AS total_money",
            f"{COST} AS cost",
            f"l_quantity * {COST} AS cost_total",
            "l_extendedprice * l_discount AS total_discount",
        ],
    ),
    # one tender per receipt; every tenth receipt is split 60 / 40 over two
    "receipt_payments": (
        "orders",
        [
            "string(o_orderkey) AS receipt_id",
            f"""inline(if(o_orderkey % 10 = 3,
                array(struct(1 AS position, o_orderpriority AS payment_type_id,
                             {SIGNED_TOTAL} * 0.6D AS money_amount),
                      struct(2 AS position, '1-URGENT' AS payment_type_id,
                             {SIGNED_TOTAL} * 0.4D AS money_amount)),
                array(struct(1 AS position, o_orderpriority AS payment_type_id,
                             {SIGNED_TOTAL} AS money_amount))))""",
        ],
    ),
    "items": (
        "part",
        [
            "string(p_partkey) AS id",
            "p_name AS name",
            "if(p_partkey % 13 <> 0, p_type, NULL) AS category_id",
            *_audit("p_partkey"),
        ],
    ),
    "variants": (
        "part",
        [
            "string(p_partkey) AS id",
            "string(p_partkey) AS item_id",
            "concat('SKU-', p_partkey) AS sku",
            "p_retailprice * 0.6D AS cost",
            *_audit("p_partkey"),
        ],
    ),
    "customers": (
        "customer",
        [
            "string(c_custkey) AS id",
            "c_name AS name",
            "concat('c', c_custkey, '@', if(c_mktsegment IN ('BUILDING', 'MACHINERY'), "
            "'gmail.com', 'example.org')) AS email",
            f"if(c_custkey % 17 <> 0, {FIRST_VISIT}, NULL) AS first_visit",
            f"{FIRST_VISIT} + make_dt_interval(int(c_custkey % 400), int(c_custkey % 13)) AS last_visit",
            "int(c_custkey % 9) AS total_visits",
            "c_acctbal AS total_spent",
            *_audit("c_custkey"),
        ],
    ),
    "employees": ("nation", ["string(n_nationkey) AS id", "n_name AS name"]),
    "stores": ("region", ["string(r_regionkey) AS id", "r_name AS name"]),
}


class StarTables(Tables):
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def source(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCES[name]).parquet(f"{self.path}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        if name in PROJECTIONS:
            source, columns = PROJECTIONS[name]
            return self.source(source).selectExpr(*columns)
        return getattr(self, f"_{name}")()

    def receipts(self, window: DateWindow = ALWAYS) -> DataFrame:
        orders = self.source("orders")
        day = F.col("o_orderdate")
        if window.lower is not None:
            orders = orders.filter(day >= window.lower - F.expr("INTERVAL '1' DAY"))
        if window.upper is not None:
            orders = orders.filter(day <= window.upper)
        return window.restrict(orders.selectExpr(*PROJECTIONS["receipts"][1]), "receipt_date")

    def _categories(self) -> DataFrame:
        kinds = self.source("part").selectExpr("p_type AS id").distinct()
        return kinds.selectExpr("id", "initcap(id) AS name")

    def _payment_types(self) -> DataFrame:
        """All but the last of the five priorities, so that one tender stays unlisted."""
        names = "get(array('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED'), r_regionkey)"
        named = self.source("region").selectExpr(f"{names} AS id", f"{names} AS name")
        return named.filter("id IS NOT NULL")

    def _inventory(self) -> DataFrame:
        per_store = self.source("part").selectExpr("p_partkey", "explode(sequence(0, 4)) AS store")
        return per_store.selectExpr(
            "string(p_partkey) AS variant_id",
            "string(store) AS store_id",
            "int((p_partkey * 7 + store * 3) % 23 - 1) AS in_stock",
            "timestamp_ntz'2001-08-01' - make_dt_interval(int(p_partkey % 60)) AS updated_at",
        )

    def _variant_store(self) -> DataFrame:
        """Only every third part has settings of its own per store."""
        chosen = self.source("part").filter("p_partkey % 3 = 0")
        return chosen.selectExpr("p_partkey", "explode(sequence(0, 4)) AS store").selectExpr(
            "string(p_partkey) AS variant_id",
            "string(store) AS store_id",
            "if(p_partkey % 4 <> 0, double(p_partkey % 9), NULL) AS low_stock_threshold",
        )
