"""Benchmark decontamination by template canonicalisation.

Texts become sequences of words in which numbers, units and names are typed placeholders
(runs of one kind are one placeholder). Windows of templates are joined by hash to the
windows of the benchmark items, which finds questions that were given new numbers or
names. A capitalised word inside a sentence is a name; where a sentence may begin it can be
one or not, so templates of both readings are joined. A match counts only if the slots agree: one value of the item must stand for one
value of the document wherever it occurs. Plain windows of words are joined too, so that
a copy is found whatever its formatting does to the placeholders. A document holds an item
if it has the share ``COVERAGE`` of its windows, or one run of ``RUN`` words or codes of it.

The benchmark is the stated query set. It is taken in slices of bounded size, each sent to
all tasks that read documents; documents are never shuffled. Matches are compared by
their words, so an equal hash alone proves nothing.

A template window is looked for if at least half of its codes are words, and only such
windows count for an item's coverage. Where an item has none, or its template has fewer than
``SHORTEST`` codes, its template must be there as a whole; one shorter than a window also
needs as many numbers in every place.

Defined cases: a null or empty text, or one shorter than a window, matches nothing; items
shorter than a window match as a whole from ``SHORTEST`` words on, shorter ones never; an
item of placeholders only matches as a copy;
null items are left out; repeated rows and items each report their own matches; an empty
table on either side gives no match; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posmetrics.llm.common import pieces, table, texts_of, tuned
from posmetrics.llm.words import Words, windows, words

WIDTH = 8  # words of a window
SHORTEST = 4  # words of the shortest item that is looked for
COVERAGE = 0.3  # share of an item's windows in the index that a document must hold
RUN = 24  # words of an item in a row that are enough, however long it is
CONSISTENT = 0.8  # share of slots that must agree
SLICE = 20_000_000  # characters of benchmark items sent to the tasks at a time
PIECE = 1_000_000

# fixed values: words that are units after a number
UNITS = (
    "mm cm m km in inch inches ft feet yd yards mi mile miles mg g kg t lb lbs oz ml cl l s sec "
    "seconds min minutes h hr hours day days week weeks month months year years eur usd gbp dollars "
    "euros cents percent pct kb mb gb tb hz khz mhz ghz w kw mw kwh v a k c f kph mph meter meters "
    "metre metres litre litres liter liters gram grams kilogram kilograms"
).split()
NUMBER, UNIT, NAME = (np.uint64(x) for x in (11, 12, 13))
KINDS = {int(NUMBER): "number", int(UNIT): "unit", int(NAME): "name"}
# words that begin sentences and are no names there
OPENERS = (
    "a all also an and another are as at because before after both but by can could did do does during each "
    "every find first for from given had has have he her here his how i if in into is it its let many most "
    "my next no not now of on one only or our she since so some suppose that the their then there these they "
    "this those to today two until was we were what when where which while who whose why will with would you your"
).split()
_UNIT_HASH = _OPENER_HASH = None


def _flags(w: Words, anywhere: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which words are numbers, units and names; ``anywhere``: names also where a sentence,
    a quote or a bracket may begin."""
    global _UNIT_HASH, _OPENER_HASH
    if _UNIT_HASH is None:
        _UNIT_HASH = np.sort(words([" ".join(UNITS)]).hash)
        _OPENER_HASH = np.sort(words([" ".join(OPENERS)]).hash)
    n = len(w.start)
    lead = w.raw[w.start]
    number = (lead >= 48) & (lead < 58)
    unit = np.zeros(n, bool)
    after = np.flatnonzero(number[:-1]) + 1
    unit[after] = np.isin(w.hash[after], _UNIT_HASH)
    # a name is a capitalised word, small letters after; inside a sentence: one space before it
    space = np.zeros(n, bool)
    space[1:] = (w.start[1:] - w.end[:-1] == 1) & (w.raw[w.start[1:] - 1] == 32)
    following = w.raw[np.minimum(w.start + 1, len(w.raw) - 1)]
    # capitals of Latin-1 are C3 80..9E in UTF-8
    wide = (lead == 0xC3) & (following >= 0x80) & (following <= 0x9E)
    second = w.raw[np.minimum(w.start + 1 + wide, len(w.raw) - 1)]
    small = ((second >= 97) & (second < 123)) | (second >= 128)
    name = small & (w.end - w.start > 1 + wide) & (((lead >= 65) & (lead < 91)) | wide)
    name &= ~np.isin(w.hash, _OPENER_HASH) if anywhere else space
    return number, unit & ~number, name


class Template:
    """Template of each text: codes, the words behind each, and the texts' bounds."""

    def __init__(self, w: Words, anywhere: bool = False):
        number, unit, name = _flags(w, anywhere)
        code = w.hash.copy()
        code[number], code[unit], code[name] = NUMBER, UNIT, NAME
        same = np.zeros(len(code), bool)
        same[1:] = (code[1:] == code[:-1]) & (code[1:] < 16)
        inner = w.first[1:-1]
        same[inner[inner < len(code)]] = False  # never across texts
        self.at = np.flatnonzero(~same)
        self.code = code[self.at]
        self.first = np.searchsorted(self.at, w.first)
        self.source = w
        self.until = np.append(self.at[1:], len(code))

    def slot(self, i: int) -> str:
        """The words that a placeholder stands for."""
        return " ".join(self.source.text(k).lower() for k in range(self.at[i], self.until[i]))


    def numbers(self, i: int) -> int:
        """How many numbers a placeholder stands for; a sign inside a number parts nothing."""
        if self.code[i] != NUMBER:
            return 0
        w, k = self.source, np.arange(self.at[i] + 1, self.until[i])
        inside = (w.start[k] - w.end[k - 1] == 1) & np.isin(w.raw[w.end[k - 1]], (44, 46))
        return 1 + int((~inside).sum())


class Named(Template):
    """Template in which a capitalised word is a name wherever it stands."""

    def __init__(self, w: Words):
        super().__init__(w, anywhere=True)


class Plain(Template):
    """Words as they are."""

    def __init__(self, w: Words):
        self.at = np.arange(len(w.hash))
        self.code, self.first, self.source = w.hash, w.first, w
        self.until = self.at + 1


STREAMS = {"copy": Plain, "template": Template, "named": Named}


class Benchmark:
    """Window hashes of a slice of items, for all streams."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids = ids
        self.words = words(texts)
        self.streams = {kind: make(self.words) for kind, make in STREAMS.items()}
        self.size: dict[str, np.ndarray] = {}
        self.index: dict[tuple[str, int], tuple[np.ndarray, ...]] = {}
        # items without a window that holds enough words, by the codes they begin with
        self.whole: dict[tuple[str, int], tuple[np.ndarray, ...]] = {}
        long_enough = np.diff(self.words.first) >= SHORTEST
        for kind, t in self.streams.items():
            length = np.diff(t.first)
            width = np.minimum(length, WIDTH)
            width[length < SHORTEST] = 0
            self.size[kind] = np.zeros(len(length), np.int64)  # windows in the index
            literal = np.concatenate([[0], np.cumsum(t.code >= 16)])
            for k in np.unique(width[width > 0]).tolist():
                item = np.repeat(np.arange(len(length)), np.where(width == k, length - k + 1, 0))
                if not len(item):
                    continue
                begun = np.concatenate([[True], item[1:] != item[:-1]])
                run = np.arange(len(item)) - np.maximum.accumulate(np.where(begun, np.arange(len(item)), 0))
                at = t.first[item] + run
                if kind != "copy":  # a window needs literal words, at least half
                    enough = (literal[at + k] - literal[at]) * 2 >= k
                    item, at = item[enough], at[enough]
                    if not len(item):
                        continue
                self.size[kind] += np.bincount(item, minlength=len(length))
                self.index[kind, k] = _sorted(t.code, k, item, at)
            some = long_enough & (self.size[kind] == 0) & (literal[t.first[1:]] > literal[t.first[:-1]])
            if kind == "named":  # short templates of this kind say too little
                some &= length >= WIDTH
            begun = np.minimum(length, WIDTH)
            for k in np.unique(begun[some]).tolist() if kind != "copy" else ():
                item = np.flatnonzero(some & (begun == k))
                self.whole[kind, k] = _sorted(t.code, k, item, t.first[item])


def _sorted(code: np.ndarray, width: int, item: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Windows ordered by hash, and the hashes' last bits for a quick look."""
    hashes = windows(code, width)[at]
    order = np.argsort(hashes, kind="stable")
    bits = np.zeros(2**20, bool)
    bits[hashes & np.uint64(2**20 - 1)] = True
    return hashes[order], item[order], at[order], bits


def _equal(entry: tuple[np.ndarray, ...], width: int, t: Template, own: Template, owner: np.ndarray):
    """(place in the texts, item, place in the items) of windows of the same codes."""
    hashes, item, at, bits = entry
    mine = windows(t.code, width)
    maybe = np.flatnonzero(bits[mine & np.uint64(2**20 - 1)])
    maybe = maybe[owner[maybe] == owner[maybe + width - 1]]
    lo = np.searchsorted(hashes, mine[maybe], "left")
    hi = np.searchsorted(hashes, mine[maybe], "right")
    for p, a, b in zip(maybe[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
        for j in range(a, b):
            if np.array_equal(t.code[p : p + width], own.code[at[j] : at[j] + width]):
                yield p, int(item[j]), int(at[j])


def matches(benchmark: Benchmark, texts: list[str]) -> list[tuple[int, int, int, float, float, str]]:
    """(text, item, windows, coverage, slot agreement, kind) of each contaminated text."""
    w = words(texts)
    if not len(w.hash):
        return []
    found: dict[tuple[int, int], tuple] = {}
    for kind, make in STREAMS.items():
        t = make(w)
        own = benchmark.streams[kind]
        owner = np.repeat(np.arange(len(texts)), np.diff(t.first))
        hits: dict[tuple[int, int], list[tuple[int, int, int]]] = defaultdict(list)
        for (k, width), entry in benchmark.index.items():
            if k == kind:
                for p, item, a in _equal(entry, width, t, own, owner):
                    hits[int(owner[p]), item].append((p, a, width))
        for (doc, item), seen in hits.items():
            if (doc, item) in found:
                continue
            covered = len({a for _, a, _ in seen})
            coverage = covered / max(1, int(benchmark.size[kind][item]))
            for part in ([seen] if coverage >= COVERAGE else []) + _runs(seen):
                agreement = 1.0 if kind == "copy" else _agreement(t, own, part)
                if agreement < CONSISTENT:
                    continue
                found[doc, item] = (doc, item, covered, coverage, agreement, "copy" if kind == "copy" else "template")
                break
        for (k, width), entry in benchmark.whole.items():
            if k != kind:
                continue
            for p, item, a in _equal(entry, width, t, own, owner):
                doc, n = int(owner[p]), int(own.first[item + 1]) - a
                if (doc, item) in found or p + n > t.first[doc + 1]:
                    continue
                if not np.array_equal(t.code[p : p + n], own.code[a : a + n]):
                    continue
                if n < WIDTH and any(t.numbers(p + i) != own.numbers(a + i) for i in range(n)):
                    continue
                agreement = _agreement(t, own, [(p, a, n)])
                if agreement >= CONSISTENT:
                    found[doc, item] = (doc, item, 1, 1.0, agreement, "template")
    return list(found.values())


def _runs(seen: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Windows of each run of at least ``RUN`` codes on one diagonal."""
    runs: list[list[tuple[int, int, int]]] = []
    last = None
    for p, a, width in sorted(seen, key=lambda x: (x[0] - x[1], x[1])):
        if last is None or last[0] - last[1] != p - a or a > last[1] + last[2]:
            runs.append([])
        runs[-1].append(last := (p, a, width))
    return [r for r in runs if r[-1][1] + r[-1][2] - r[0][1] >= RUN]


def _agreement(doc: Template, item: Template, seen: list[tuple[int, int, int]]) -> float:
    """Share of slot occurrences whose value is the usual one for the item's value; each
    run of windows that lie on one diagonal has values of its own."""
    pairs: dict[tuple[int, str, str], dict[str, set[int]]] = defaultdict(lambda: defaultdict(set))
    for p, a, width in seen:
        for k in range(width):
            code = int(item.code[a + k])
            if code < 16:
                pairs[p - a, KINDS[code], item.slot(a + k)][doc.slot(p + k)].add(p + k)
    total = sum(len(at) for values in pairs.values() for at in values.values())
    usual = sum(max(len(at) for at in values.values()) for values in pairs.values())
    return usual / total if total else 1.0


def slices(benchmark: DataFrame, id_col: str, text_col: str, characters: int) -> Iterator[Benchmark]:
    """The items in slices of bounded size, one at a time on the driver."""
    ids: list[int] = []
    texts: list[str] = []
    rows = benchmark.selectExpr(f"cast(`{id_col}` as long) as i", f"`{text_col}` as t").where(
        "i is not null and t is not null"
    )
    held = 0
    for row in rows.toLocalIterator():
        ids.append(row["i"])
        texts.append(row["t"])
        held += len(row["t"])
        if held >= characters:
            yield Benchmark(ids, texts)
            ids, texts, held = [], [], 0
    if ids:
        yield Benchmark(ids, texts)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    slice_chars: int = SLICE,
) -> DataFrame:
    """One row per document and item found in it: ``doc_id, item_id, n_windows,
    coverage, slot_agreement, kind`` (copy or template). No shuffle."""
    schema = "doc_id long, item_id long, n_windows long, coverage double, slot_agreement double, kind string"
    spark = tuned(docs.sparkSession)
    rows = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")

    def search(part: Benchmark) -> DataFrame:
        held = spark.sparkContext.broadcast(part)  # of bounded size, see SLICE

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = held.value
            for batch in batches:
                texts, ids = texts_of(batch.column("text")), batch.column("doc_id").to_pylist()
                out = []
                for start, end in pieces(texts, PIECE):
                    for doc, item, *rest in matches(own, texts[start:end]):
                        out.append((ids[start + doc], own.ids[item], *rest))
                if out:
                    names = ("doc_id", "item_id", "n_windows", "coverage", "slot_agreement", "kind")
                    yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*out)))))

        return rows.mapInArrow(run, schema)

    parts = [search(p) for p in slices(benchmark, item_id, item_text, slice_chars)]
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], schema)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    slice_chars: int = SLICE,
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    spark = tuned(docs.sparkSession)
    for part in slices(benchmark, item_id, item_text, slice_chars):
        held = spark.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = texts_of(batch.column(text_col))
                keep = np.ones(len(texts), bool)
                for start, end in pieces(texts, PIECE):
                    for doc, *_ in matches(held.value, texts[start:end]):
                        keep[start + doc] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("contaminated", F.lit(True))
