"""The relational warehouse: Parquet files by month or key, under one list of versions.

Facts are partitioned by the month of the receipt date, everything else by a hash bucket
of its (parent's) key; all tables of a resource share their partitions. A load writes
what is new and the keys it replaces, and a reader leaves out replaced rows, so a change
of few rows writes few rows. Partitions with many such deltas are compacted. Versions
(``versions.py``) make a load visible as a whole, and a reader keeps the one it began with.

Receipts also have an index from number to month and last change, in hash buckets, since
their date, and with it their partition, may change.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posmetrics.functions.period import ALWAYS, DateWindow
from posmetrics.plans import intake
from posmetrics.plans.resources import LOAD_ORDER, RESOURCES
from posmetrics.plans.versions import NULL_PART, Change, Conflict, Piece, Version, Versions, checked, load_name
from posmetrics.sources.files import Files
from posmetrics.sources.schemas import BUCKET, MONTH, TABLES, TableSpec
from posmetrics.sources.tables import Tables

LOAD = "load"  # folder column: the load that wrote a row
INDEX_BUCKETS = 16  # to begin with
BUCKET_BYTES = 128 << 20  # of an index, beyond which compaction makes more buckets
AT_ONCE = 4  # tables of a load that are written at the same time
DELTAS = 8  # loads a partition may hold before it is compacted
FEW = 100_000  # records of a batch that are not worth jobs of their own to look for repeated keys
TRIES = 20  # of a load whose resource others keep changing
_STORED_IN = "_stored_in"

REJECTS = "load STRING, kind STRING, body STRING, reasons STRING"


@dataclass
class Merged:
    """What one batch of pages came to."""

    records: int = 0
    rejected: int = 0
    unreadable: int = 0
    newest: datetime | None = None

    def add(self, other: Merged) -> None:
        self.records += other.records
        self.rejected += other.rejected
        self.unreadable += other.unreadable
        self.newest = max((m for m in (self.newest, other.newest) if m), default=None)


def resource_of(table: str) -> str:
    """The resource whose records a table's rows come from."""
    return _RESOURCE_OF.get(table, table)


def tables_of(resource: str) -> list[str]:
    spec = RESOURCES.get(resource)
    return [resource] if spec is None else [resource, *(x.table for x in (*spec.links, *spec.nested))]


_RESOURCE_OF = {t: r for r in RESOURCES for t in tables_of(r)}


def replaced(resource: str) -> str:
    """Dataset of the keys whose rows, of earlier loads, no longer count in a partition."""
    return f"{resource}.replaced"


def index(resource: str) -> str:
    return f"{resource}.index"


class Warehouse(Tables):
    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        """``version`` pins everything that is read; otherwise each DataFrame belongs to the
        version that is newest when it is made."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark, self.root)
        self.versions = Versions(self.files, self.root)
        self._pinned = None if version is None else self.versions.at(version)

    # reading

    def now(self) -> Version:
        return self._pinned or self.versions.latest()

    def pinned(self) -> Warehouse:
        """The same warehouse at its present version, whatever is loaded from now on."""
        version = self.now()
        made = Warehouse(self.spark, self.root)
        made._pinned = version
        return made

    def path(self, dataset: str) -> str:
        return f"{self.root}/{dataset}"

    def has_table(self, table: str) -> bool:
        return table in self.now().schemas

    def list_tables(self) -> list[str]:
        known = self.now().schemas
        return [t for t in TABLES if t in known]

    def _pieces(self, dataset: str, pieces: Iterable[Piece], schema: T.StructType, partition: str) -> DataFrame:
        """Rows of these folders with ``load`` and the partition column."""
        paths = [f"{self.path(dataset)}/{LOAD}={p.load}/{partition}={p.part}" for p in pieces]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path(dataset)).parquet(*paths)

    def _live(self, version: Version, table: str, parts: set[str] | None = None) -> DataFrame:
        """The rows of a table that count, with ``load`` and the partition column."""
        spec = TABLES[table]
        kind = _part_type(spec)
        if table in version.schemas:
            checked(table, version.schemas[table], spec.schema)
        pieces = version.of(table, parts)
        rows = self._pieces(table, pieces, spec.schema.add(spec.partition, kind).add(LOAD, T.StringType()), spec.partition)
        oldest: dict[str, str] = {}
        for p in pieces:
            oldest[p.part] = min(p.load, oldest.get(p.part, p.load))
        resource = resource_of(table)
        gone = [p for p in version.of(replaced(resource), parts) if p.load > oldest.get(p.part, p.load)]
        if not gone:
            return rows
        # ``table`` names its parent's key itself, the parent by its primary key
        names = [spec.owner] if spec.owner else list(spec.key)
        keys = self._keys(resource, gone).groupBy(spec.partition, *_key(resource)).agg(F.max(LOAD).alias("_until"))
        keys = keys.toDF(spec.partition, *names, "_until")
        met = rows.join(keys, [spec.partition, *names], "left")
        return met.filter(F.col("_until").isNull() | (F.col(LOAD) >= F.col("_until"))).select(*rows.columns)

    def _keys(self, resource: str, pieces: Iterable[Piece]) -> DataFrame:
        spec = TABLES[resource]
        kind = _part_type(spec)
        schema = T.StructType([spec.schema[k] for k in spec.key]).add(spec.partition, kind).add(LOAD, T.StringType())
        return self._pieces(replaced(resource), pieces, schema, spec.partition)

    def stored(self, table: str) -> DataFrame:
        """All columns with the partition column; empty while there are no files."""
        return self._live(self.now(), table).drop(LOAD)

    def table(self, name: str) -> DataFrame:
        return self.stored(name).select(*TABLES[name].columns)

    def _in_months(self, table: str, window: DateWindow) -> DataFrame:
        df = self.stored(table)
        month = F.col(MONTH)
        if window.lower is not None:
            df = df.filter(month >= F.trunc(F.to_date(window.lower), "month"))
        if window.upper is not None:
            df = df.filter(month <= F.trunc(F.to_date(window.upper), "month"))
        return df.select(*TABLES[table].columns)

    def receipts(self, window: DateWindow = ALWAYS) -> DataFrame:
        return window.restrict(self._in_months("receipts", window), "receipt_date")

    def line_items(self, window: DateWindow = ALWAYS) -> DataFrame:
        return self._in_months("receipt_line_items", window)

    def payments(self, window: DateWindow = ALWAYS) -> DataFrame:
        return self._in_months("receipt_payments", window)

    def lookup(self, table: str, keys: list[tuple]) -> DataFrame:
        """The rows with these primary keys, read from the partitions they are in alone; the
        order of rows within files lets the scan skip most of their row groups."""
        if resource_of(table) != table:  # rows of a parent are not found by a key of their own
            return super().lookup(table, keys)
        spec, version, resource = TABLES[table], self.now(), table
        owners = self.spark.createDataFrame([(k[0],) for k in keys], T.StructType([spec.schema[spec.bucket_key]]))
        if spec.by_month:
            places = self._indexed(version, resource, owners.toDF(*_key(resource)))
            parts = _values(places, _STORED_IN)
        else:
            parts = _values(owners.select(self._bucket(version, resource, spec.bucket_key).alias("p")), "p")
        rows = self._live(version, table, {_folder(p) for p in parts})
        same = [reduce(and_, [F.col(c) == v for c, v in zip(spec.key, key)]) for key in keys]
        rows = rows.filter(reduce(or_, same))
        return rows.select(*spec.columns)

    # creating

    def create(self, drop_existing: bool = False) -> None:
        """Make every table, empty, with its schema; existing ones stay, if their schemas
        still fit, unless ``drop_existing``."""
        while True:
            base = self.versions.latest()
            change = Change(set(RESOURCES) | {"sync_metadata"})
            for table, spec in TABLES.items():
                if table in base.schemas and not drop_existing:
                    checked(table, base.schemas[table], spec.schema)
                change.schemas[table] = spec.schema.json()
            if drop_existing:
                change.removed = {d: set(own) for d, own in base.pieces.items()}
            elif change.schemas == base.schemas:
                return
            try:
                self.versions.commit(base, change)
                return
            except Conflict:
                continue

    def schemas(self) -> DataFrame:
        """table_name, position, column_name, data_type of all tables there are."""
        rows = [
            (table, i + 1, f.name, f.dataType.simpleString())
            for table, text in self.now().schemas.items()
            for i, f in enumerate(T.StructType.fromJson(json.loads(text)).fields)
        ]
        return self.spark.createDataFrame(
            rows, "table_name STRING, position INT, column_name STRING, data_type STRING"
        )

    # writing

    def rejects(self, resource: str) -> DataFrame:
        """What loads of a resource left out: load, kind (record or page), body, reasons."""
        path = f"{self.root}/_rejected/{resource}"
        if not self.files.exists(path):
            return self.spark.createDataFrame([], REJECTS)
        return self.spark.read.schema(REJECTS).option("recursiveFileLookup", "true").parquet(path)

    def merge(
        self,
        resource: str,
        pages: DataFrame,
        load: str,
        now: datetime | None = None,
        zone: str = intake.DEFAULT_ZONE,
        keep: Callable[[DataFrame], DataFrame] = lambda df: df,
        partial: bool = False,
    ) -> Merged:
        """Upsert the valid records of ``pages`` and keep what is refused under the name of
        the load, replacing what an earlier try of it kept. Pages are parsed once; their
        records are counted while they are staged.

        ``keep`` restricts the valid records. ``partial``: see ``upsert``.
        """
        staging = self._staging()
        seen = Observation()
        bad = F.size(intake.ERRORS) > 0
        try:
            judged = intake.judged(pages, resource, now, zone)
            if not partial:  # texts are kept of what is refused; of others they tell what was given
                judged = judged.withColumn(intake.BODY, F.when(bad, F.col(intake.BODY)))
            counts = [
                F.count(F.when(bad & (F.col(intake.KIND) == kind), 1)).alias(kind) for kind in ("record", "page")
            ]
            counts.append(F.count(F.when(~bad, 1)).alias("good"))
            _stage_rows(judged.observe(seen, *counts), staging)
            counted = _observed(seen)
            few = counted.pop("good", 0) < FEW
            judged = self.spark.read.schema(judged.schema).parquet(staging)
            place = f"{self.root}/_rejected/{resource}/{load}"
            if any(counted.values()) or self.files.exists(place):
                refused = intake.refused(judged).withColumn("load", F.lit(load))
                refused.select("load", "kind", "body", "reasons").write.mode("overwrite").parquet(place)
            good = keep(intake.accepted(judged, resource if partial else None))
            count, newest = self._upsert_staged(resource, good, zone, few)
        finally:
            self.files.delete(staging)
        return Merged(count, counted.get("record", 0), counted.get("page", 0), newest)

    def upsert(
        self, resource: str, records: DataFrame, zone: str = intake.DEFAULT_ZONE
    ) -> tuple[int, datetime | None]:
        """Insert or replace cleaned, valid records with all their nested rows.

        Per key the newest record wins, within the batch and against what is stored.
        A replaced parent loses the nested rows it no longer has. Returns the number
        of records written and the newest ``updated_at`` among them.

        Records with the column ``_given`` (see ``intake.accepted``) set only the fields
        that it names: others keep what an older record of the batch or the warehouse has,
        nested rows too, and get their defaults where there is neither.

        If another writer changes the resource meanwhile, the records are compared with
        what it has written and tried again, so that two loads at once end as one after
        the other.

        The records are worked out once: their keys are looked at several times.
        """
        staging = self._staging()
        try:
            _stage_rows(records, staging)
            return self._upsert_staged(resource, self.spark.read.schema(records.schema).parquet(staging), zone)
        finally:
            self.files.delete(staging)

    def _upsert_staged(
        self, resource: str, records: DataFrame, zone: str, few: bool = False
    ) -> tuple[int, datetime | None]:
        """``upsert`` of records that are cheap to read again."""
        repeats = few or _has_repeats(records, _key(resource))
        for _ in range(TRIES):
            base = self.versions.latest()
            staging = self._staging()
            try:
                count, newest, change = self._upsert(base, resource, records, zone, staging, repeats)
                if change is not None:
                    made = self.versions.commit(base, change)
                    self._compact_if_due(made, resource)
                return count, newest
            except Conflict:
                continue
            finally:
                self.files.delete(staging)
        raise Conflict(f"{resource} kept changing")

    def _staging(self) -> str:
        return f"{self.root}/_staging/{uuid.uuid4().hex}"  # never that of another writer

    def _upsert(
        self, base: Version, resource: str, records: DataFrame, zone: str, staging: str, repeats: bool
    ) -> tuple[int, datetime | None, Change | None]:
        spec = TABLES[resource]
        seen = Observation()
        newest = F.max("updated_at") if "updated_at" in spec.columns else F.lit(None).cast("timestamp_ntz")
        staged = self._stage(base, spec, records, repeats)
        counts = [
            F.count(F.lit(1)).alias("count"),
            newest.alias("newest"),
            F.count("_known").alias("known"),
        ]
        # where no key repeats and none is stored, the records are what would be staged
        if repeats or _holds(base, spec):
            _stage_rows(staged.observe(seen, *counts), staging)
            told = _observed(seen)
            staged = self.spark.read.schema(staged.schema).parquet(staging)
        else:
            told = staged.agg(*counts).first().asDict()
        if not told.get("count"):
            return 0, None, None
        load = load_name(base)
        change = Change({resource}, buckets=self._bucket_counts(base, resource))
        known = staged.filter("_known").withColumn(spec.partition, F.col(_STORED_IN)) if told["known"] else None
        parts = {resource: staged}
        if resource in RESOURCES:
            parts = intake.split(staged, resource, zone, unique=True)
        if known is not None and intake.GIVEN in staged.columns:
            parts = self._with_kept(base, resource, parts, staged)
        writes = []
        for table, rows in parts.items():
            own = TABLES[table]
            if not own.by_month:
                rows = rows.withColumn(BUCKET, self._bucket(base, resource, own.bucket_key))
            change.schemas[table] = own.schema.json()
            rows = rows.select(*own.columns, own.partition)
            writes.append((table, rows, load, own.partition, own.key, not base.of(table)))
        if known is not None:
            keys = known.select(*spec.key, spec.partition)
            writes.append((replaced(resource), keys, load, spec.partition, spec.key, False))
        if spec.by_month:
            bucket = self._index_bucket(base, resource).alias(BUCKET)
            entry = staged.select(*spec.key, "updated_at", MONTH, bucket)
            writes.append((index(resource), entry, load, BUCKET, spec.key, False))
        self._write_all(change, writes)
        return told["count"], told.get("newest"), change

    def _write_all(self, change: Change, writes: list[tuple]) -> None:
        """Write the folders of a load, which do not depend on each other, as jobs of one time."""
        with ThreadPoolExecutor(AT_ONCE) as pool:
            for (dataset, *_), made in zip(writes, pool.map(lambda w: self._write(*w), writes)):
                change.added.setdefault(dataset, []).extend(made)

    def _write(
        self, dataset: str, rows: DataFrame, load: str, partition: str, key: tuple, fresh: bool
    ) -> list[Piece]:
        """Write a folder of a load and list what it came to. Rows lie in the order of their
        keys within files; where much is written at once, also from file to file."""
        if fresh:
            rows = rows.repartitionByRange(partition, *key)
        else:  # one hot month becomes many files, small parts are put together
            rows = rows.hint("rebalance", partition)
        path = f"{self.path(dataset)}/{LOAD}={load}"
        rows.sortWithinPartitions(partition, *key).write.partitionBy(partition).parquet(path)
        made = self.files.folders(path)
        return [Piece(load, name.split("=", 1)[1], size) for name, size in made.items() if "=" in name]

    def _bucket_counts(self, version: Version, resource: str) -> dict[str, int]:
        spec = TABLES[resource]
        counts = {resource: version.buckets.get(resource, spec.buckets)}
        if spec.by_month:
            counts[index(resource)] = version.buckets.get(index(resource), INDEX_BUCKETS)
        return counts

    def _bucket(self, version: Version, resource: str, key: str) -> Column:
        return _bucket_of(key, self._bucket_counts(version, resource)[resource])

    def _index_bucket(self, version: Version, resource: str) -> Column:
        return _bucket_of(TABLES[resource].key[0], self._bucket_counts(version, resource)[index(resource)])

    def _indexed(self, version: Version, resource: str, keys: DataFrame) -> DataFrame:
        """Key, ``_stored_in`` and ``_stored_version`` of those keys that are stored; only
        the buckets of the keys are read."""
        spec = TABLES[resource]
        wanted = set()
        if version.of(index(resource)):
            wanted = {_folder(b) for b in _values(keys.select(self._index_bucket(version, resource).alias("b")), "b")}
        entries = self._entries(resource, version.of(index(resource), wanted))
        last = F.max_by(F.struct(MONTH, "updated_at"), LOAD).alias("_last")
        found = entries.join(keys.distinct(), list(spec.key), "left_semi").groupBy(*spec.key).agg(last)
        return found.select(
            *spec.key, F.col(f"_last.{MONTH}").alias(_STORED_IN), F.col("_last.updated_at").alias("_stored_version")
        )

    def _known(self, version: Version, spec: TableSpec, records: DataFrame) -> DataFrame:
        """Key, ``_known``, ``_stored_in`` and ``_stored_version`` of stored records."""
        keys = records.select(*spec.key)
        if spec.by_month:
            return self._indexed(version, spec.name, keys).withColumn("_known", F.lit(True))
        parts = set()
        if version.of(spec.name):
            bucket = self._bucket(version, spec.name, spec.bucket_key).alias("b")
            parts = {_folder(b) for b in _values(records.select(bucket), "b")}
        versions = [F.col("updated_at").alias("_stored_version")] if "updated_at" in spec.columns else []
        # stored rows are cut down to the keys of the batch, by a broadcast where it is small
        return (
            self._live(version, spec.name, parts)
            .select(*spec.key, F.lit(True).alias("_known"), F.col(spec.partition).alias(_STORED_IN), *versions)
            .join(keys.distinct(), list(spec.key), "left_semi")
        )

    def _stage(self, base: Version, spec: TableSpec, records: DataFrame, repeats: bool = True) -> DataFrame:
        """The newest record per key that is not older than the stored one; ``repeats``:
        whether a key may be there more than once."""
        versioned = "updated_at" in spec.columns
        # ties are settled by content, so that a repetition picks the same record
        content = F.xxhash64(*records.columns)
        order = [F.desc_nulls_last("updated_at"), content] if versioned else [content]
        own = Window.partitionBy(*spec.key).orderBy(*order)
        if intake.GIVEN in records.columns:
            records = _folded(records, spec, own)
        latest = records
        if repeats:
            latest = records.withColumn("_n", F.row_number().over(own)).filter("_n = 1").drop("_n")
        if _holds(base, spec):
            known = self._known(base, spec, records)
            joined = latest.join(known, list(spec.key), "left")
            if versioned:
                joined = joined.filter(
                    F.col("_stored_version").isNull() | (F.col("updated_at") >= F.col("_stored_version"))
                ).drop("_stored_version")
            if intake.GIVEN in records.columns:
                joined = self._filled(base, spec, joined)
        else:  # no record is known: a join with nothing would still shuffle and sort all of them
            none = F.lit(None)
            joined = latest.withColumns({"_known": none.cast("boolean"), _STORED_IN: none.cast(_part_type(spec))})
        if spec.by_month:
            return joined.withColumn(MONTH, intake.month_of("receipt_date"))
        return joined.withColumn(BUCKET, self._bucket(base, spec.name, spec.bucket_key))

    # partial records

    def _filled(self, base: Version, spec: TableSpec, staged: DataFrame) -> DataFrame:
        """Fields that a known record lacks, as they are stored."""
        parts = {_folder(p) for p in _values(staged.filter("_known"), _STORED_IN)}
        stored = self._live(base, spec.name, parts).select(
            *spec.key, *(F.col(c).alias(f"_old_{c}") for c in spec.columns if c not in spec.key)
        )
        met = staged.join(stored, list(spec.key), "left")
        out = {
            c: F.when(F.col("_known") & ~_given(c), F.col(f"_old_{c}")).otherwise(F.col(c))
            for c in spec.columns
            if c not in spec.key
        }
        return met.withColumns(out).select(*staged.columns)

    def _with_kept(
        self, base: Version, resource: str, parts: dict[str, DataFrame], staged: DataFrame
    ) -> dict[str, DataFrame]:
        """Also the stored nested rows of known records that lack their array."""
        spec, out = TABLES[resource], dict(parts)
        known = staged.filter("_known")
        inside = {_folder(p) for p in _values(known, _STORED_IN)}
        moved = [MONTH] if spec.by_month else []
        for nested in (*RESOURCES[resource].links, *RESOURCES[resource].nested):
            own = TABLES[nested.table]
            silent = known.filter(~_given(nested.array)).select(F.col(spec.key[0]).alias(own.owner), *moved)
            kept = self._live(base, own.name, inside).select(*own.columns).join(silent, own.owner)
            out[own.name] = parts[own.name].unionByName(kept.select(*parts[own.name].columns))
        return out

    # compaction

    def _compact_if_due(self, version: Version, resource: str) -> None:
        due = set()
        for dataset in (*tables_of(resource), replaced(resource)):
            loads: dict[str, int] = {}
            for p in version.of(dataset):
                loads[p.part] = loads.get(p.part, 0) + 1
            due |= {part for part, n in loads.items() if n > DELTAS}
        if due:
            self.compact(resource, due)
        entries: dict[str, int] = {}
        for p in version.of(index(resource)):
            entries[p.part] = entries.get(p.part, 0) + 1
        many = {part for part, n in entries.items() if n > DELTAS}
        if many:
            self._compact_index(resource, many)

    def compact(self, resource: str, parts: set[str] | None = None, buckets: int | None = None) -> bool:
        """Write the live rows of these partitions (all by default) anew, in the order of
        their keys, and drop the keys they replaced; with ``buckets``, in as many of them.

        False if another writer was faster; nothing has changed then.
        """
        base = self.versions.latest()
        if buckets:
            parts = None
        load = load_name(base)
        counts = {**self._bucket_counts(base, resource), **({resource: buckets} if buckets else {})}
        change = Change({resource}, buckets=counts)
        writes = []
        for table in tables_of(resource):
            spec = TABLES[table]
            old = base.of(table, parts)
            if not old:
                continue
            rows = self._live(base, table, parts).drop(LOAD)
            if buckets and not spec.by_month:
                rows = rows.withColumn(BUCKET, _bucket_of(spec.bucket_key, buckets))
            writes.append((table, rows, load, spec.partition, spec.key, True))
            change.removed[table] = set(old)
        self._write_all(change, writes)
        change.removed[replaced(resource)] = set(base.of(replaced(resource), parts))
        return self._try(base, change)

    def _compact_index(self, resource: str, buckets: set[str]) -> bool:
        """The newest entry of each key; into more buckets once these hold too much."""
        base = self.versions.latest()
        spec, counts = TABLES[resource], self._bucket_counts(base, resource)
        size = sum(p.size for p in base.of(index(resource)))
        if size > counts[index(resource)] * BUCKET_BYTES:
            counts[index(resource)] = 2 * -(-size // BUCKET_BYTES)
            buckets = {p.part for p in base.of(index(resource))}
        old = base.of(index(resource), buckets)
        last = F.max_by(F.struct("updated_at", MONTH), LOAD).alias("_last")
        rows = self._entries(resource, old).groupBy(*spec.key).agg(last)
        bucket = _bucket_of(spec.key[0], counts[index(resource)]).alias(BUCKET)
        rows = rows.select(*spec.key, "_last.updated_at", f"_last.{MONTH}", bucket)
        change = Change({resource}, removed={index(resource): set(old)}, buckets=counts)
        self._write_all(change, [(index(resource), rows, load_name(base), BUCKET, spec.key, True)])
        return self._try(base, change)

    def _entries(self, resource: str, pieces: Iterable[Piece]) -> DataFrame:
        spec = TABLES[resource]
        keys = T.StructType([*(spec.schema[k] for k in spec.key), spec.schema["updated_at"]])
        schema = keys.add(MONTH, T.DateType()).add(BUCKET, T.IntegerType()).add(LOAD, T.StringType())
        return self._pieces(index(resource), pieces, schema, BUCKET)

    def _try(self, base: Version, change: Change) -> bool:
        try:
            self.versions.commit(base, change)
            return True
        except Conflict:
            return False

    def expire(self, keep: int = 20) -> None:
        """Forget all but the newest ``keep`` versions, and remove folders that none of
        these lists and no load that is still running can have made: readers of older
        versions, and loads begun before the oldest that stays, must have ended."""
        kept = self.versions.forget(keep)
        if not kept:
            return
        listed = {(d, p.load) for v in kept for d, own in v.pieces.items() for p in own}
        oldest = f"{kept[0].number:012d}"
        for dataset in self.files.names(self.root):
            if dataset.startswith("_"):
                continue
            for name in self.files.names(self.path(dataset)):
                load = name.removeprefix(f"{LOAD}=")
                if load != name and (dataset, load) not in listed and load[:12] <= oldest:
                    self.files.delete(f"{self.path(dataset)}/{name}")

    # counting

    def counts(self, tables: list[str] | None = None) -> DataFrame:
        """table_name, row_count for every table, in one job; 0 for a missing one."""
        version = self.now()
        each = [
            self._live(version, t).agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(t).alias("table_name"), "row_count"
            )
            for t in tables or TABLES
        ]
        result = each[0]
        for df in each[1:]:
            result = result.unionAll(df)
        return result


def _key(resource: str) -> tuple[str, ...]:
    return TABLES[resource].key


def _holds(version: Version, spec: TableSpec) -> bool:
    """Whether any record of a resource is stored."""
    return bool(version.of(index(spec.name) if spec.by_month else spec.name))


def _part_type(spec: TableSpec) -> T.DataType:
    return T.DateType() if spec.by_month else T.IntegerType()


def _observed(seen: Observation) -> dict:
    return {k: v for k, v in seen.get.items() if v is not None}


def _given(column: str) -> Column:
    return F.array_contains(intake.GIVEN, column)


def _folded(records: DataFrame, spec: TableSpec, newest_first) -> DataFrame:
    """The newest record of each key, with the fields it lacks from the next older one."""
    rest = newest_first.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    names = [c for c in records.columns if c not in (*spec.key, intake.GIVEN)]
    last = {
        c: F.coalesce(
            F.first(F.when(_given(c), F.struct(c)), ignorenulls=True).over(rest), F.struct(c)
        )[c]
        for c in names
    }
    all_given = F.array_distinct(F.flatten(F.collect_list(intake.GIVEN).over(rest)))
    number = F.row_number().over(newest_first).alias("_n")
    folded = records.select(*spec.key, *(v.alias(c) for c, v in last.items()), all_given.alias(intake.GIVEN), number)
    return folded.filter("_n = 1").drop("_n")


def _stage_rows(rows: DataFrame, path: str) -> None:
    """Write rows to be read again soon; they are read in full, so small files are worth more
    than the fastest codec."""
    rows.write.option("compression", "zstd").parquet(path)


def _has_repeats(records: DataFrame, key: tuple[str, ...]) -> bool:
    """Whether a key is there more than once, told from the keys alone."""
    return bool(records.groupBy(*key).count().filter("count > 1").head(1))


def _bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _values(df: DataFrame, column: str) -> set:
    """The partitions a DataFrame has rows for: at most one per month or bucket."""
    return {r[0] for r in df.select(column).distinct().collect()}


def _folder(value: date | int | None) -> str:
    """How Spark writes a partition's value in its folder name."""
    return NULL_PART if value is None else str(value)


def resources_in_order(wanted: list[str] | None = None) -> list[str]:
    unknown = set(wanted or ()) - set(RESOURCES)
    if unknown:
        raise ValueError(f"no such resource: {', '.join(sorted(unknown))}")
    return [r for r in LOAD_ORDER if wanted is None or r in wanted]
