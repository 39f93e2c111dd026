"""Full loads and incremental syncs of landed pages into the warehouse."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posmetrics.functions.period import as_ntz
from posmetrics.operators.listing import check_range
from posmetrics.plans import intake
from posmetrics.plans.warehouse import Merged, Warehouse, resources_in_order
from posmetrics.sources.landing import Landing
from posmetrics.sources.schemas import TABLES
from posmetrics.streaming.continuous import follow


class LoadError(RuntimeError):
    """A load that could not finish."""


@dataclass
class SyncReport:
    counts: dict[str, int] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)
    rejected: dict[str, int] = field(default_factory=dict)
    unreadable: dict[str, int] = field(default_factory=dict)


class Loader:
    """Moves pages of a landing folder into a warehouse.

    The driver only loops over the 17 resources; each is one set of Spark jobs.
    """

    def __init__(
        self,
        warehouse: Warehouse,
        landing: Landing,
        zone: str = intake.DEFAULT_ZONE,
        now: datetime | None = None,
        on_progress: Callable[[str, int], None] | None = None,
        partial: bool = False,
    ):
        """``partial``: records set only the fields they have, see ``Warehouse.upsert``."""
        self.warehouse = warehouse
        self.landing = landing
        self.zone = zone
        self.now = now
        self.on_progress = on_progress
        self.partial = partial

    def prepared(self, resource: str) -> DataFrame:
        return intake.prepared(self.landing.pages(resource), resource, self.now, self.zone)

    def rejected(self, resource: str) -> DataFrame:
        """Records left out because they break a rule, with the reasons."""
        return intake.rejected(self.prepared(resource))

    def unreadable(self, resource: str) -> DataFrame:
        """Pages left out because they hold no list of records."""
        return intake.unreadable(self.landing.pages(resource), resource)

    def load_resource(self, resource: str, **bounds) -> int:
        return self._merge(resource, bounds)[0]

    def load_all(self, resources: list[str] | None = None, **bounds) -> dict[str, int]:
        """Load everything, parents first; stops at the first failure.

        ``bounds``: created_at_min, created_at_max, updated_at_min, updated_at_max,
        all inclusive.
        """
        counts, newest = {}, {}
        for resource in resources_in_order(resources):
            try:
                counts[resource], newest[resource] = self._merge(resource, bounds)
            except Exception as error:
                raise LoadError(f"{resource} could not be loaded: {error}") from error
        self._record(counts, newest, "window" if bounds else "full")
        return counts

    def sync(self, resources: list[str] | None = None) -> SyncReport:
        """Merge the page files that no sync has read yet.

        Files are remembered by the progress of a stream that reads what is there and
        stops; what is inside them plays no part. Pages may land in any order, lack their
        times, or be older than a load by hand: the upsert settles versions. The first
        sync of a resource reads all its files. One failure does not stop the others,
        and the files of a failed resource stay unread.
        """
        before = self.last_syncs()
        report, newest, kinds = SyncReport(), {}, {}
        ordered = resources_in_order(resources)
        for resource in ordered:
            done = Merged()
            try:
                follow(
                    self.warehouse, self.landing, resource,
                    zone=self.zone, now=self.now, on_batch=done.add,
                    partial=self.partial,
                ).awaitTermination()
            except Exception as error:
                report.errors[resource] = str(error)
                continue
            report.counts[resource], newest[resource] = done.records, done.newest
            report.rejected[resource], report.unreadable[resource] = done.rejected, done.unreadable
            kinds[resource] = "incremental" if resource in before else "full"
            if self.on_progress:
                self.on_progress(resource, done.records)
        if ordered and len(report.errors) == len(ordered):
            raise LoadError("not one resource could be synced")
        for kind in ("full", "incremental"):
            self._record({r: n for r, n in report.counts.items() if kinds[r] == kind}, newest, kind)
        return report

    def sync_metadata(self) -> DataFrame:
        """resource_name, last_sync_at, records_count, sync_type; newest first."""
        return self.warehouse.table("sync_metadata").orderBy(
            F.desc("last_sync_at"), "resource_name"
        )

    def last_syncs(self) -> dict[str, datetime]:
        """One row per resource, 17 at most."""
        return {r.resource_name: r.last_sync_at for r in self.sync_metadata().collect()}

    def _merge(self, resource: str, bounds: dict) -> tuple[int, datetime | None]:
        restrict_check(**bounds)
        done = self.warehouse.merge(
            resource,
            self.landing.pages(resource),
            "full",
            self.now,
            self.zone,
            lambda good: restrict(good, resource, **bounds),
            self.partial,
        )
        if self.on_progress:
            self.on_progress(resource, done.records)
        return done.records, done.newest

    def _record(self, counts: dict[str, int], newest: dict, kind: str) -> None:
        """Note the newest change seen, for people to read; no load is filtered by it.
        Where none has been seen it is the time of the load, in the zone of the tables."""
        if not counts:
            return
        before = self.last_syncs()
        clock = self.now or datetime.now(ZoneInfo(self.zone)).replace(tzinfo=None)
        rows = []
        for resource, n in counts.items():
            seen = [m for m in (newest.get(resource), before.get(resource)) if m]
            rows.append((resource, max(seen) if seen else clock, n, kind))
        schema = TABLES["sync_metadata"].schema
        self.warehouse.upsert(
            "sync_metadata", self.warehouse.spark.createDataFrame(rows, schema)
        )


def restrict_check(created_at_min=None, created_at_max=None, updated_at_min=None, updated_at_max=None) -> None:
    check_range(created_at_min, created_at_max, "created_at")
    check_range(updated_at_min, updated_at_max, "updated_at")


def restrict(
    df: DataFrame,
    resource: str,
    created_at_min: datetime | None = None,
    created_at_max: datetime | None = None,
    updated_at_min: datetime | None = None,
    updated_at_max: datetime | None = None,
) -> DataFrame:
    """Inclusive bounds; those on a column the resource lacks are ignored."""
    restrict_check(created_at_min, created_at_max, updated_at_min, updated_at_max)
    for column, low, high in (
        ("created_at", created_at_min, created_at_max),
        ("updated_at", updated_at_min, updated_at_max),
    ):
        if column in TABLES[resource].columns:
            if low is not None:
                df = df.filter(F.col(column) >= as_ntz(low))
            if high is not None:
                df = df.filter(F.col(column) <= as_ntz(high))
    return df
