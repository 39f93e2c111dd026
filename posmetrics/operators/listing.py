"""Listing records, looking them up by key, and the receipt helpers."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posmetrics.functions.period import as_ntz
from posmetrics.operators.base import MetricGroup
from posmetrics.sources.schemas import TABLES


def parse_day(word: str, today: date, end_of_day: bool = False) -> datetime | str:
    """today, yesterday or YYYY-MM-DD as a moment; a full ISO time passes through."""
    text = word.strip()
    if text in ("today", "yesterday"):
        day = today - timedelta(days=1 if text == "yesterday" else 0)
    elif "T" in text:
        return word
    else:
        try:
            day = date.fromisoformat(text)
        except ValueError as error:
            raise ValueError(f"not a day: {word!r}; use today, yesterday or YYYY-MM-DD") from error
    return datetime.combine(day, time(23, 59, 59) if end_of_day else time())


def check_range(low, high, what: str) -> None:
    if low is not None and high is not None and low > high:
        raise ValueError(f"the lower bound on {what} lies after the upper one")


def iso_text(c: Column) -> Column:
    """ISO 8601; microseconds only when there are any."""
    return F.when(
        F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    ).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def row_json(df: DataFrame) -> DataFrame:
    """One JSON text per row; only integers over 10 characters become text.

    Every value is rendered on its own, so one column may mix numbers and text.
    """
    pairs = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = _quoted(iso_text(c))
        elif isinstance(field.dataType, T.IntegralType):
            text = c.cast("string")
            value = F.when(F.length(text) > 10, _quoted(text)).otherwise(text)
        else:
            value = F.regexp_extract(
                F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"}),
                r"(?s)^\{\"v\":(.*)\}$",
                1,
            )
        pairs.append(
            F.concat(F.lit(f'"{field.name}":'), F.coalesce(value, F.lit("null")))
        )
    return df.select(F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}")).alias("json"))


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), text, F.lit('"'))


class Listing(MetricGroup):
    def list_records(
        self,
        table: str,
        *,
        limit: int | None = None,
        created_at_min: datetime | None = None,
        created_at_max: datetime | None = None,
        updated_at_min: datetime | None = None,
        updated_at_max: datetime | None = None,
        show_deleted: bool = False,
        ids: dict[str, str | Iterable[str] | DataFrame] | None = None,
        equals: dict[str, object] | None = None,
        where: Column | None = None,
    ) -> DataFrame:
        """All matching rows of ``table``, newest first; at most ``limit`` if one is given.

        Bounds are inclusive. ``ids`` maps a column to a comma-separated text, a
        list or a one-column DataFrame; ``equals`` maps columns to values; ``where``
        takes any further predicate. A bound on a column the table lacks is ignored.
        """
        check_range(created_at_min, created_at_max, "created_at")
        check_range(updated_at_min, updated_at_max, "updated_at")
        if limit is not None and limit < 1:
            raise ValueError("a limit below 1 would list nothing")
        df = self.tables.table(table)
        present = set(df.columns)
        for column, low, high in (
            ("created_at", created_at_min, created_at_max),
            ("updated_at", updated_at_min, updated_at_max),
        ):
            if column in present:
                if low is not None:
                    df = df.filter(F.col(column) >= as_ntz(low))
                if high is not None:
                    df = df.filter(F.col(column) <= as_ntz(high))
        if "deleted_at" in present and not show_deleted:
            df = df.filter(F.col("deleted_at").isNull())
        for column, value in (equals or {}).items():
            df = df.filter(F.col(column) == value)
        for column, wanted in (ids or {}).items():
            df = _with_ids(df, column, wanted)
        if where is not None:
            df = df.filter(where)
        return _newest_first(df, TABLES[table].key, limit)

    def get(self, table: str, *key: str) -> DataFrame:
        """The live row with that primary key, or no row."""
        columns = TABLES[table].key
        if len(key) != len(columns):
            raise ValueError(f"{table} is keyed by {', '.join(columns)}")
        found = self.tables.lookup(table, [key])
        return found.filter(F.col("deleted_at").isNull()) if "deleted_at" in found.columns else found

    def is_fresh(self, now: datetime) -> DataFrame:
        """One boolean: was any receipt created within the two days before ``now``?"""
        since = as_ntz(now - timedelta(days=2))
        recent = self.tables.table("receipts").filter(F.col("created_at") >= since)
        return recent.limit(1).agg((F.count(F.lit(1)) > 0).alias("is_fresh"))

    def items_in_store(self, store_id: str, **options) -> DataFrame:
        """Items with a variant offered in that store."""
        offered = self.tables.table("variant_store").filter(F.col("store_id") == store_id)
        variants = self.tables.table("variants").select(F.col("id").alias("variant_id"), "item_id")
        item_ids = variants.join(offered, "variant_id", "left_semi").select("item_id")
        return self.list_records("items", ids={"id": item_ids}, **options)

    def receipts_between(
        self,
        since: str | None = None,
        before: str | None = None,
        sort_order: str = "desc",
        limit: int | None = None,
        **options,
    ) -> DataFrame:
        """Receipts after one receipt number and before another, both exclusive."""
        if sort_order not in ("asc", "desc"):
            raise ValueError("sort_order must be 'asc' or 'desc'")
        number = F.col("receipt_number")
        where = F.lit(True)
        if since is not None:
            where = where & (number > since)
        if before is not None:
            where = where & (number < before)
        df = self.list_records("receipts", limit=None, where=where, **options)
        direction = F.asc if sort_order == "asc" else F.desc
        df = df.orderBy(direction("created_at"), direction("receipt_number"))
        return df if limit is None else df.limit(limit)

    def latest_receipts(self, n: int = 1) -> DataFrame:
        """The n newest receipts, fewer if there are fewer."""
        if n < 1:
            raise ValueError(f"cannot take the latest {n} receipts")
        return self.list_records("receipts", limit=n)

    def latest_receipt(self):
        """The newest receipt as a row; an error when there is none."""
        rows = self.latest_receipts(1).take(1)
        if not rows:
            raise LookupError("there are no receipts")
        return rows[0]

    def receipts_today(self, today: date | None = None) -> DataFrame:
        today = today or self.as_of or date.today()
        return self.receipts_since(today, today)

    def receipts_since(self, moment: date | datetime, today: date | None = None) -> DataFrame:
        """Receipts created at or after ``moment``, which must not be in the future."""
        if isinstance(moment, datetime):
            start = moment
        elif isinstance(moment, date):
            start = datetime.combine(moment, time())
        else:
            raise TypeError(f"a {type(moment).__name__} is neither date nor datetime")
        last = datetime.combine(today or self.as_of or date.today(), time.max)
        if start > last:
            raise ValueError(f"{moment} lies in the future")
        return self.list_records("receipts", limit=None, created_at_min=start)


def _with_ids(df: DataFrame, column: str, wanted) -> DataFrame:
    if isinstance(wanted, DataFrame):
        return df.join(wanted.toDF(column), column, "left_semi")
    if isinstance(wanted, str):
        wanted = wanted.split(",")
    values = sorted({w.strip() for w in wanted} - {""})
    return df.filter(F.col(column).isin(*values))


def _newest_first(df: DataFrame, key: tuple[str, ...], limit: int | None) -> DataFrame:
    order = [F.desc("created_at")] if "created_at" in df.columns else []
    df = df.orderBy(*order, *key)
    return df if limit is None else df.limit(limit)
