"""The sync as a stream: new page files are merged as they land."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from posmetrics.plans import intake
from posmetrics.plans.warehouse import Merged, Warehouse
from posmetrics.sources.landing import Landing


def follow(
    warehouse: Warehouse,
    landing: Landing,
    resource: str,
    *,
    zone: str = intake.DEFAULT_ZONE,
    now: datetime | None = None,
    files_per_batch: int | None = None,
    available_now: bool = True,
    on_batch: Callable[[Merged], None] | None = None,
    replays_within: str | None = None,
    partial: bool = False,
) -> StreamingQuery:
    """Start merging the pages of one resource.

    The stream's own checkpoint remembers which files were read. A batch that is
    replayed after a failure replaces rows by themselves, and a page that arrives
    late cannot undo a newer one, so the tables end up as after one full load. Rejected
    records and unreadable pages are kept by batch, so a replay does not repeat them.

    ``replays_within``, such as "7 days": a page that lands again with the same text within
    that time of reading is left out, whatever its file is called; the stream's state holds
    a digest of each page for so long. Without it, a repeated page whose records do not
    tell when they changed counts as a newer version. A stream keeps to the choice it was
    first started with. ``partial``: see ``Warehouse.upsert``.
    """

    def merge(pages: DataFrame, batch_id: int) -> None:
        if replays_within and pages.isEmpty():
            return  # a batch that only advances the watermark
        done = warehouse.merge(resource, pages, f"batch-{batch_id}", now, zone, partial=partial)
        if on_batch:
            on_batch(done)

    pages = landing.page_stream(resource, files_per_batch)
    if replays_within:
        # the time of reading is the event time: no page is ever too late
        seen = pages.withColumns({"_read": F.current_timestamp(), "_digest": F.sha2("value", 256)})
        unique = seen.withWatermark("_read", replays_within).dropDuplicatesWithinWatermark(["_digest"])
        pages = unique.select("value")
    writer = (
        pages.writeStream.foreachBatch(merge)
        .queryName(f"follow_{resource}")
        .option("checkpointLocation", f"{warehouse.root}/_progress/{resource}")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
