"""Near-duplicate documents by weighted MinHash signatures, banding and verification.

A document is the multiset of its runs of ``SHINGLE`` words. Each (run, unit of count) is a
Poisson process in time whose points fall on random registers; a register keeps its first
point, so two documents agree on a register with the probability of their weighted Jaccard
similarity. Counts are covered by dyadic blocks ([0,1), [1,2), [2,4), ...), each one process
of the block's rate, split in halves only while its next point is early enough to matter:
the point goes to one half, the other half draws its own. Large counts so cost their
logarithm, and documents share the points of the counts they share.

Registers are banded. Within a bucket short sketches estimate similarity, and only a
spanning forest of the likely pairs is verified by exact multiset overlap of the texts.
What is still likely to join two classes is verified where the bucket is, on texts sent to
it, so that pairs are never rows. A group of copies thus costs rows in proportion to its
size, and no link that would join two classes is left out.
Buckets beyond ``BLOCK`` members are compared block by block, each pair of blocks a task.

Documents with equal words are one vertex from the start; classes are connected components.

Defined cases: a text of fewer than ``SHINGLE`` words is one run of all its words; a null text,
or one without a word, is a class of its own, as is a null id (its class is null); rows with
the same id get the same class; an empty table gives no row; other columns are ignored, or
kept by :func:`keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posmetrics.llm.common import table, text_pieces, texts_of, tuned, written
from posmetrics.llm.components import components
from posmetrics.llm.words import mix, windows, words

SHINGLE = 5
LEAST = 0.8
BANDS, ROWS = 32, 6
REGISTERS = BANDS * ROWS
SLACK = 0.1  # how far a sketch's estimate may fall short: 3.5 deviations at LEAST
BLOCK = 1024
PIECE = 800_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MARGIN = 8.0  # the horizon leaves a register empty with probability exp(-8) / REGISTERS


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of words of a batch: (text, hash, count) of the distinct ones in order, and a
    hash of each text's whole sequence (0 where it has no word)."""
    w = words(texts)
    length = np.diff(w.first)
    runs = np.where(length >= SHINGLE, length - SHINGLE + 1, 0)
    doc = np.repeat(np.arange(len(texts)), runs)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(w.first[:-1], runs)
    hashes = windows(w.hash, SHINGLE)[at] if len(at) else np.zeros(0, np.uint64)
    # a hash of all words, mixed with their place
    place = np.arange(len(w.hash)) - np.repeat(w.first[:-1], length)
    whole = np.zeros(len(texts), np.uint64)
    with np.errstate(over="ignore"):
        placed = mix(w.hash ^ mix(place.astype(np.uint64) * _STEP + np.uint64(1)))
        some = np.flatnonzero(length)
        if len(some):
            whole[some] = mix(np.add.reduceat(placed, w.first[:-1][some]) + length[some].astype(np.uint64))
    short = np.flatnonzero((length > 0) & (length < SHINGLE))
    doc, hashes = np.concatenate([doc, short]), np.concatenate([hashes, whole[short]])
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    start = np.flatnonzero(new)
    return doc[start], hashes[start], np.diff(np.append(start, len(doc))), whole


def _wait(state: np.ndarray) -> np.ndarray:
    """Exponential waiting times of rate 1 from random states."""
    return -np.log1p(-(state >> np.uint64(11)).astype(np.float64) * 2.0**-53)


def signatures(doc: np.ndarray, hashes: np.ndarray, counts: np.ndarray, n_docs: int) -> np.ndarray:
    """Register values (first points) of each document; NaN-free, infinite without runs."""
    out = np.full((n_docs, REGISTERS), np.inf)
    todo, factor = np.unique(doc), 1.0
    while len(todo):
        mask = np.isin(doc, todo)
        number = np.searchsorted(todo, doc[mask])
        found = _within(number, hashes[mask], counts[mask], len(todo), factor)
        full = np.isfinite(found).all(1)
        out[todo[full]] = found[full]
        todo, factor = todo[~full], factor * 3
    return out


def _within(doc: np.ndarray, hashes: np.ndarray, counts: np.ndarray, n_docs: int, factor: float) -> np.ndarray:
    """First points up to a horizon that depends on each document's total weight alone."""
    total = np.bincount(doc, counts, n_docs)
    limit = factor * REGISTERS * (np.log(REGISTERS) + _MARGIN) / total
    with np.errstate(over="ignore"):
        # blocks [0,1), [1,2), [2,4), ... up to the count, then halves down to units
        leaf_doc, leaf_state, leaf_t = [], [], []

        def begin(d, h, low, width, count, t=None):
            state = mix(h ^ mix(low.astype(np.uint64) * _STEP + width.astype(np.uint64)))
            if t is None:
                t = _wait(state) / width
            early = (t <= limit[d]) & (low < count)
            return d[early], h[early], low[early], width[early], count[early], t[early], state[early]

        level = 0
        while True:
            low = 0 if level == 0 else 2 ** (level - 1)
            width = 1 if level == 0 else low
            some = np.flatnonzero(counts > low)
            if not len(some):
                break
            fill = np.ones(len(some), np.int64)
            wave = begin(doc[some], hashes[some], fill * low, fill * width, counts[some])
            while len(wave[0]):
                d, h, lo, wd, c, t, state = wave
                unit = wd == 1
                leaf_doc.append(d[unit]), leaf_state.append(state[unit]), leaf_t.append(t[unit])
                d, h, lo, wd, c, t, state = (x[~unit] for x in (d, h, lo, wd, c, t, state))
                half = wd // 2
                right = (mix(state ^ _STEP) & np.uint64(1)).astype(bool)
                other = mix(mix(state ^ (_STEP + _STEP)))
                later = t + _wait(other) / np.maximum(half, 1)
                left_part = begin(d, h, lo, half, c, np.where(right, later, t))
                right_part = begin(d, h, lo + half, half, c, np.where(right, t, later))
                wave = tuple(np.concatenate(p) for p in zip(left_part, right_part))
            level += 1
        d, state, t = np.concatenate(leaf_doc), np.concatenate(leaf_state), np.concatenate(leaf_t)
        values = np.full(n_docs * REGISTERS, np.inf)
        while len(d):
            state = mix(state + _STEP)
            register = ((state & np.uint64(0x7FF)) * np.uint64(REGISTERS)) >> np.uint64(11)
            np.minimum.at(values, d * REGISTERS + register.astype(np.int64), t)
            t = t + _wait(state)
            going = t <= np.minimum(limit, values.reshape(n_docs, REGISTERS).max(1))[d]
            d, state, t = d[going], state[going], t[going]
    return values.reshape(n_docs, REGISTERS)


def banded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of the bands, and sketches of four bits a register."""
    bits = mix(values.view(np.uint64))
    with np.errstate(over="ignore"):
        key = np.zeros((len(values), BANDS), np.uint64)
        for r in range(ROWS):
            key = mix(key * _STEP + bits[:, r::ROWS][:, :BANDS])
        key = mix(key ^ mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(77)))
    nibbles = (bits >> np.uint64(60)).astype(np.uint8)
    return key.view(np.int64), (nibbles[:, 0::2] << 4) | nibbles[:, 1::2]


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id, whole, size, bands, sketch`` of every row of (doc_id, text) with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for start, end, texts in text_pieces(batch.column("text"), PIECE):
                doc, hashes, counts, whole = shingles(texts)
                some = np.flatnonzero(whole)
                if not len(some):
                    continue
                values = signatures(doc, hashes, counts, end - start)[some]
                bands, sketch = banded(values)
                ends = np.arange(0, bands.size + 1, BANDS, dtype=np.int32)
                size = np.bincount(doc, counts, end - start)[some].astype(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": ids.slice(start, end - start).take(pa.array(some)),
                        "whole": pa.array(whole[some].view(np.int64)),
                        "size": pa.array(size),
                        "bands": pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.ravel())),
                        "sketch": pa.array([s.tobytes() for s in sketch], pa.binary()),
                    }
                )

    return docs.mapInArrow(run, "doc_id long, whole long, size long, bands array<long>, sketch binary")


_SAME = np.array([(x >> 4 == 0) * 1 + (x & 15 == 0) * 1 for x in range(256)], np.uint8)


def _estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from sketches; 1 in 16 other registers agrees by chance."""
    same = _SAME[a ^ b].sum(-1, dtype=np.int64) / REGISTERS
    return (same - 1 / 16) * (16 / 15)


def _likely(block: np.ndarray, size: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Likely pairs of one bucket, or between its two blocks: indices and estimates."""
    n = len(block)
    left, right, value = [], [], []
    crossed = block.min() != block.max()
    for i in range(n - 1):
        others = np.arange(i + 1, n)
        if crossed:
            others = others[block[others] != block[i]]
        lo, hi = np.minimum(size[i], size[others]), np.maximum(size[i], size[others])
        others = others[lo >= (LEAST - 1e-9) * hi]
        if len(others):
            e = _estimate(sketch[i], sketch[others])
            keep = e >= LEAST - SLACK
            left.append(np.full(keep.sum(), i)), right.append(others[keep]), value.append(e[keep])
    if not left:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0)
    return np.concatenate(left), np.concatenate(right), np.concatenate(value)


def _root(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = x = parent[parent[x]]
    return x


def _forest(n: int, a: np.ndarray, b: np.ndarray, e: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a spanning forest, the likeliest first."""
    parent, out = list(range(n)), []
    for k in np.argsort(-e, kind="stable").tolist():
        x, y = _root(parent, int(a[k])), _root(parent, int(b[k]))
        if x != y:
            parent[x] = y
            out.append((int(a[k]), int(b[k])))
    return out


KEYS = ("bucket", "i", "j")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, int, int]]:
    """Runs of equal bucket and blocks in sorted rows, as (table, start, end)."""
    held: list[pa.RecordBatch] = []

    def cut(part: pa.Table) -> Iterator[tuple[pa.Table, int, int]]:
        new = np.ones(len(part), bool)
        keys = [part.column(n).to_numpy() for n in KEYS]
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        start = np.append(np.flatnonzero(new), len(part)).tolist()
        yield from ((part, s, t) for s, t in zip(start, start[1:]) if t - s > 1)

    for batch in batches:
        held.append(batch)
        last = batch.slice(batch.num_rows - 1)
        whole = pa.Table.from_batches(held)
        same = np.all([whole.column(n).to_numpy() == last.column(n)[0].as_py() for n in KEYS], axis=0)
        at = int(np.argmax(same))  # the last group may go on in the next batch
        if at:
            yield from cut(whole.slice(0, at))
            held = whole.slice(at).combine_chunks().to_batches()
    if held:
        yield from cut(pa.Table.from_batches(held))


def _bytes(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)


def _likely_in(part: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _likely(part.column("block").to_numpy(), part.column("size").to_numpy(), _bytes(part.column("sketch")))


def candidates(dealt: DataFrame) -> DataFrame:
    """Pairs ``a < b`` worth verifying: a forest of the likely pairs of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, s, t in _groups(batches):
            part = table.slice(s, t - s)
            uid = part.column("uid").to_numpy()
            pairs = np.array(_forest(t - s, *_likely_in(part)), np.int64).reshape(-1, 2)
            if len(pairs):
                ends = np.sort(uid[pairs], axis=1)
                yield pa.RecordBatch.from_pydict({"a": ends[:, 0], "b": ends[:, 1]})

    return dealt.mapInArrow(run, "a long, b long").distinct()


def contested(dealt: DataFrame) -> DataFrame:
    """``bucket, i, j, uid`` of rows with a likely partner of another class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, s, t in _groups(batches):
            part = table.slice(s, t - s)
            kind = part.column("class").to_numpy()
            if (kind == kind[0]).all():
                continue
            a, b, _ = _likely_in(part)
            apart = kind[a] != kind[b]
            some = np.unique(np.concatenate([a[apart], b[apart]]))
            if len(some):
                yield part.select([*KEYS, "uid"]).take(pa.array(some)).combine_chunks().to_batches()[0]

    return dealt.mapInArrow(run, "bucket long, i int, j int, uid long")


def joining(dealt: DataFrame) -> DataFrame:
    """Links ``a, b`` that join two classes, verified within the bucket on the texts that
    the rows carry. A pair is looked at in the first bucket that it shares only, and not
    once its ends are joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, s, t in _groups(batches):
            part = table.slice(s, t - s)
            uid, kind = part.column("uid").to_numpy(), part.column("class").to_numpy()
            bucket = part.column("bucket")[0].as_py()
            bands = np.array(part.column("bands").to_pylist(), np.int64)
            a, b, e = _likely_in(part)
            apart = kind[a] != kind[b]
            a, b, e = a[apart], b[apart], e[apart]
            _, node = np.unique(kind, return_inverse=True)
            parent, bag, links = list(range(len(node))), {}, []
            texts = part.column("text").to_pylist() if len(a) else []

            def shingled(x: int):
                if x not in bag:
                    _, hashes, counts, _ = shingles([texts[x] or ""])
                    bag[x] = hashes, counts
                return bag[x]

            for k in np.argsort(-e, kind="stable").tolist():
                x, y = int(a[k]), int(b[k])
                shared = bands[x] == bands[y]
                if bands[x][int(np.argmax(shared))] != bucket:
                    continue
                p, q = _root(parent, int(node[x])), _root(parent, int(node[y]))
                if p != q and overlap(shingled(x), shingled(y)) >= LEAST:
                    parent[p] = q
                    links.append((int(uid[x]), int(uid[y])))
            if links:
                first, second = zip(*links)
                yield pa.RecordBatch.from_pydict({"a": np.array(first), "b": np.array(second)})

    return dealt.mapInArrow(run, "a long, b long")


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets (sorted hashes, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][i], b[1][j]).sum()
    return common / (a[1].sum() + b[1].sum() - common)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose texts overlap enough. Texts meet by joins on one end and then the
    other, so a document in very many pairs is a skewed join, not a group."""
    own = texts.select("uid", "text")
    met = (
        pairs.join(own.withColumnsRenamed({"uid": "b", "text": "text_b"}), "b")
        .join(own.withColumnsRenamed({"uid": "a", "text": "text_a"}), "a")
        .select("a", "b", "text_a", "text_b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                a, b = part.column("a").to_numpy(), part.column("b").to_numpy()
                both = texts_of(part.column("text_a")) + texts_of(part.column("text_b"))
                ids = {}
                unique = [ids.setdefault(t, len(ids)) for t in both]
                doc, hashes, counts, _ = shingles(list(ids))
                cut = np.searchsorted(doc, np.arange(len(ids) + 1))
                bag = [(hashes[x:y], counts[x:y]) for x, y in zip(cut[:-1], cut[1:])]
                n = len(a)
                good = np.array([overlap(bag[unique[k]], bag[unique[n + k]]) >= LEAST for k in range(n)], bool)
                yield pa.RecordBatch.from_pydict({"a": a[good], "b": b[good]})

    return met.mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, class_id, kept`` for each row: the smallest id of its class, and whether it
    is that one."""
    tuned(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marks = written(signed(rows.where("doc_id is not null")), "signatures")
    equal = marks.groupBy("whole", "size").agg(F.min("doc_id").alias("uid"))
    vertex = marks.join(
        equal.select(F.col("uid").alias("doc_id"), "whole", "size"), ["doc_id", "whole", "size"], "left_semi"
    ).dropDuplicates(["doc_id", "whole"])
    places = vertex.select(F.col("doc_id").alias("uid"), F.explode("bands").alias("bucket"))
    shared = places.groupBy("bucket").count().where("count > 1")
    blocks = F.ceil(F.col("count") / F.lit(BLOCK)).cast("int")
    met = written(places.join(shared.select("bucket", blocks.alias("blocks")), "bucket"), "buckets")
    sketches = written(
        vertex.select(F.col("doc_id").alias("uid"), "size", "sketch", "bands").join(
            met.select("uid").distinct(), "uid", "left_semi"
        ),
        "sketches",
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (
        met.withColumn("block", F.pmod(F.xxhash64("uid"), "blocks").cast("int"))
        .withColumn("other", other)
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        .select(*KEYS, "block", "uid")
    )

    def by_bucket(rows: DataFrame) -> DataFrame:
        return rows.repartition(*KEYS).sortWithinPartitions(*KEYS, "uid")

    first = written(candidates(by_bucket(dealt.join(sketches.drop("bands"), "uid"))), "pairs")
    # Whole texts are read again only for documents in a pair. The join shuffles at every
    # size: which documents these are grows with the table.
    ends = first.select(F.col("a").alias("uid")).unionAll(first.select(F.col("b").alias("uid"))).distinct()
    texts = written(
        rows.withColumnRenamed("doc_id", "uid").hint("merge").join(ends.hint("merge"), "uid", "left_semi").dropDuplicates(["uid"]),
        "texts",
    )
    links = written(verified(first, texts), "links")
    told = (
        sketches.join(components(links).withColumnRenamed("id", "uid"), "uid", "left")
        .withColumn("class", F.coalesce("component", "uid"))
        .drop("component")
    )
    open_rows = written(contested(by_bucket(dealt.join(told.drop("bands"), "uid"))), "contested")
    # the ends of a likely pair are in the forest of its bucket, so their texts are at hand
    carried = dealt.join(open_rows, [*KEYS, "uid"], "left_semi").join(told, "uid").join(texts, "uid")
    class_of = components(links.unionAll(written(joining(by_bucket(carried)), "joining")))
    named = equal.join(class_of.withColumnRenamed("id", "uid"), "uid", "left").select(
        "whole", "size", F.coalesce("component", "uid").alias("class_id")
    )
    found = marks.select("doc_id", "whole", "size").join(named, ["whole", "size"]).select("doc_id", "class_id")
    # rows without a word or an id have no signature
    bare = rows.where(F.col("doc_id").isNull() | ~F.coalesce(F.col("text").rlike(r"[A-Za-z0-9]|[^\x00-\x7f]"), F.lit(False)))
    rest = bare.select("doc_id").join(found.select("doc_id"), "doc_id", "left_anti")
    return found.unionAll(rest.select("doc_id", F.col("doc_id").alias("class_id"))).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False))
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns. Of rows
    that repeat an id one stays; rows without an id all do."""
    number, own = "_rows_of_id", "_id_kept"
    keep = written(
        classes(docs, id_col, text_col).where("kept").groupBy(F.col("doc_id").alias(own)).agg(F.count("*").alias(number)),
        "kept",
    )
    met = docs.join(keep, F.col(id_col).cast("long") == F.col(own))
    once = met.where(F.col(number) == 1)
    repeated = met.where(F.col(number) > 1).dropDuplicates([own])
    nameless = docs.where(F.col(id_col).cast("long").isNull())
    return once.unionByName(repeated).select(*docs.columns).unionByName(nameless)


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
