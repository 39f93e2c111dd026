"""Where the metrics read their tables from."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posmetrics.functions.period import ALWAYS, DateWindow
from posmetrics.sources.schemas import TABLES


class Tables:
    """The relational tables behind the metrics.

    ``table`` returns a whole table. The three methods for facts take a window on
    the receipt date, so that a source can skip files; line items and payments are
    still joined to receipts, so for them the window only saves reading.
    """

    def table(self, name: str) -> DataFrame:
        raise NotImplementedError

    def lookup(self, name: str, keys: list[tuple]) -> DataFrame:
        """The rows with these primary keys; a few keys, which become part of the plan."""
        columns = TABLES[name].key
        same = [reduce(and_, [F.col(c) == v for c, v in zip(columns, key)]) for key in keys]
        return self.table(name).filter(reduce(or_, same))

    def receipts(self, window: DateWindow = ALWAYS) -> DataFrame:
        return window.restrict(self.table("receipts"), "receipt_date")

    def line_items(self, window: DateWindow = ALWAYS) -> DataFrame:
        return self.table("receipt_line_items")

    def payments(self, window: DateWindow = ALWAYS) -> DataFrame:
        return self.table("receipt_payments")


class FrameTables(Tables):
    """Tables given as DataFrames."""

    def __init__(self, frames: dict[str, DataFrame]):
        self._frames = frames

    def table(self, name: str) -> DataFrame:
        return self._frames[name]
