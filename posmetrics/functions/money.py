"""Exact sums and one rounding rule for money, rates and percentages.

Stored amounts are DOUBLE. Adding doubles gives an answer that depends on task
order, so amounts are added as whole ten-thousandths ("ticks").
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TICKS_PER_UNIT = 10_000.0
LARGEST = 9e14  # times TICKS_PER_UNIT a long holds it
_LOW_BITS = 20  # leaves room for 2^43 rows per group
_LONG = T.DecimalType(19, 0)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def exact_sum(value: Column | str) -> Column:
    """SUM in ticks; these sums may be added up again. ``amount`` turns them back.

    Digits beyond the fourth decimal of a single value are rounded away. A value that is
    no number, or too large for ticks, stops the query: it has no exact sum.
    High and low bits are summed apart as longs and joined once per group: a decimal
    buffer would cost many times more per row, one long could overflow.
    """
    given = _col(value).cast("double")
    # NaN is above every number; NULL takes the second branch
    ticks = F.when(
        F.abs(given) >= LARGEST, F.raise_error(F.lit("an amount is no number or too large to be summed"))
    ).otherwise(F.floor(given * TICKS_PER_UNIT + 0.5))
    high = F.sum(F.shiftright(ticks, _LOW_BITS)).cast(_LONG)
    low = F.sum(ticks.bitwiseAND(F.lit(2**_LOW_BITS - 1))).cast(_LONG)
    return high * F.lit(2**_LOW_BITS).cast("decimal(7,0)") + low


def amount(ticks: Column | str) -> Column:
    """Ticks as a DOUBLE amount."""
    return _col(ticks).cast("double") / TICKS_PER_UNIT


def total(value: Column | str) -> Column:
    """SUM as DOUBLE; NULL when there are no values."""
    return amount(exact_sum(value))


def mean(value: Column | str) -> Column:
    """AVG as exact sum over count."""
    return total(value) / F.count(_col(value))


def rnd(value: Column | str, digits: int) -> Column:
    """Round half away from zero, on the double itself.

    Beyond 2^52 a double has no fraction left, so the value is returned as it is; the
    floor would overflow there.
    """
    x, scale = _col(value), float(10**digits)
    shifted = F.abs(x) * scale
    return F.when(
        shifted < float(2**52), F.signum(x) * F.floor(shifted + 0.5) / scale
    ).otherwise(x)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, NULL when the whole is zero."""
    return part / F.nullif(whole, F.lit(0.0))


def share_of_total(value: Column | str) -> Column:
    """Percentage of the grand total, 1 decimal.

    For results that are already grouped (hours, categories, payment types): the
    window sees one row per group, never one per receipt.
    """
    x = _col(value).cast("double")
    return rnd(x * 100.0 / F.nullif(F.sum(x).over(Window.partitionBy()), F.lit(0.0)), 1)
