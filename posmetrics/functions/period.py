"""Date windows and the predicates every sales metric shares."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _moment(value: date | datetime | str) -> tuple[date | datetime, bool]:
    """Parse a bound; the flag tells whether it is a bare date."""
    if isinstance(value, datetime):
        return value, False
    if isinstance(value, date):
        return value, True
    text = value.strip()
    if len(text) == 10:
        return date.fromisoformat(text), True
    return datetime.fromisoformat(text.replace("Z", "+00:00")).replace(tzinfo=None), False


def as_ntz(value: date | datetime | Column) -> Column:
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast("timestamp_ntz")


@dataclass(frozen=True)
class DateWindow:
    """Bounds on a timestamp: ``lower`` inclusive, ``upper`` exclusive or inclusive."""

    lower: Column | None = None
    upper: Column | None = None
    upper_inclusive: bool = False
    days: int | None = None

    @classmethod
    def of(
        cls,
        days: int | None = None,
        date_start: date | datetime | str | None = None,
        date_end: date | datetime | str | None = None,
        as_of: date | None = None,
    ) -> DateWindow:
        """An explicit range wins; otherwise the last ``days`` days up to ``as_of``.

        ``days`` counts the as-of day itself and sets no upper bound. A bare end
        date covers that whole day.
        """
        if date_start is None and date_end is None:
            if days is None:
                return cls()
            if days < 1:
                raise ValueError(f"days must be at least 1, got {days}")
            today = F.lit(as_of) if as_of else F.current_date()
            return cls(lower=as_ntz(F.date_sub(today, days - 1)), days=days)

        lower = upper = None
        inclusive = False
        first, last = None, as_of or date.today()
        if date_start is not None:
            start, _ = _moment(date_start)
            lower, first = as_ntz(start), start
        if date_end is not None:
            end, bare = _moment(date_end)
            last, inclusive = end, not bare
            upper = as_ntz(end + timedelta(days=1) if bare else end)
        length = None
        if first is not None:
            f = first.date() if isinstance(first, datetime) else first
            l = last.date() if isinstance(last, datetime) else last
            if l < f and date_end is not None:
                raise ValueError("date_start must not be after date_end")
            length = max((l - f).days + 1, 1)
        return cls(lower=lower, upper=upper, upper_inclusive=inclusive, days=length)

    @property
    def bounded(self) -> bool:
        return self.lower is not None or self.upper is not None

    def restrict(self, df: DataFrame, column: str) -> DataFrame:
        if self.lower is not None:
            df = df.filter(F.col(column) >= self.lower)
        if self.upper is not None:
            c = F.col(column)
            df = df.filter(c <= self.upper if self.upper_inclusive else c < self.upper)
        return df


ALWAYS = DateWindow()


def of_store(df: DataFrame, store_id: str | None, column: str = "store_id") -> DataFrame:
    return df if store_id is None else df.filter(F.col(column) == store_id)


def valid_sales(receipts: DataFrame) -> DataFrame:
    return receipts.filter((F.col("receipt_type") == "SALE") & F.col("cancelled_at").isNull())
