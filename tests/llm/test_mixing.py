"""The mix against targets and streams worked out in plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from posmetrics.llm import mixing

COLUMNS = "doc_id long, source string, text string, taken long, g string"


def plain(rows):
    """(doc_id, size, source_size, target, taken) by walking each source's stream."""
    groups = defaultdict(list)
    for doc_id, source, text, *_ in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        named = f"mix:{'-' if doc_id is None else doc_id}:{text or ''}"
        groups[source].append((hashlib.md5(named.encode()).hexdigest(), doc_id, size))
    names = sorted(groups, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(d[2] for d in groups[s]) for s in names]
    wanted = share_out(sizes)
    out = []
    for name, words, target in zip(names, sizes, wanted):
        docs = sorted(groups[name], key=lambda d: (d[0], d[1] is not None, d[1] or 0))
        got, left = [0] * len(docs), round(target)
        while left:
            for i, (_, _, size) in enumerate(docs):
                n = min(size, left)
                got[i] += n
                left -= n
        out += [(d[1], d[2], words, float(target), n) for d, n in zip(docs, got)]
    return sorted(out, key=str)


def share_out(sizes):
    """Water-filling by bisection on exact fractions of the breakpoints."""
    w = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    total = Fraction(3, 2) * sum(sizes)
    points = sorted({Fraction(2 * s, x) for s, x in zip(sizes, w)})
    filled = lambda level: sum(min(Fraction(2 * s), level * x) for s, x in zip(sizes, w))
    low = max([p for p in points if filled(p) <= total], default=Fraction(0))
    open_ = [x for s, x in zip(sizes, w) if Fraction(2 * s, x) > low]
    level = low + (total - filled(low)) / sum(open_) if open_ else low
    return [min(Fraction(2 * s), level * x) for s, x in zip(sizes, w)]


def found(df, **more):
    return sorted((tuple(r) for r in mixing.taken(df, **more).collect()), key=str)


def test_whole_table(spark, sf="/root/testdata/sf0.001"):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text")
    got = sorted(map(tuple, mixing.op12_mixing(spark, sf).collect()), key=str)
    assert got == plain([tuple(r) for r in docs.collect()])
    assert all(taken <= 2 * size for _, size, _, _, taken in got)


def test_odd_rows(spark):
    rows = [(i, f"s{i % 4}", " w" * (i % 9), 0, "x") for i in range(60)]
    rows += [(1, "big", "w " * 2000, 0, "x"), (2, "big", "w　x\x0b\x1cy", 0, "x"), (3, "none", None, 0, "x")]
    rows += [(None, None, "a b c", 0, "x"), (None, None, "a b c", 0, "x"), (None, None, "d", 0, "x"), (4, "", "a\nb", 0, "x")]
    rows += [(9, "s1", "same words", 0, "x")] * 30 + [(9, "s1", "", 0, "x"), (9, "s1", " ", 0, "x"), (9, "s1", "", 0, "x")]
    df = spark.createDataFrame(rows, COLUMNS)
    for block in (1, 7, 256):
        assert found(df.repartition(5), block=block) == plain(rows)
    assert found(df.orderBy("text").coalesce(1)) == plain(rows)
    assert mixing.taken(spark.createDataFrame([], COLUMNS)).collect() == []
    wordless = [(1, "a", "", 0, "x"), (2, "b", None, 0, "x")]
    assert found(spark.createDataFrame(wordless, COLUMNS)) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_mix_is_whole_and_even(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source", "text")
    rows = mixing.mix(docs, block=64).orderBy("slot", "first").collect()
    per_doc, per_source = Counter(), defaultdict(list)
    for r in rows:
        per_doc[r.doc_id] += r.taken
        per_source[r.source].append((r.slot, r.taken))
    want = {r[0]: r[4] for r in plain([tuple(r) for r in docs.collect()])}
    assert per_doc == {k: v for k, v in want.items() if v}
    slots = Counter()
    for r in rows:
        slots[r.slot] += r.taken
    assert max(slots.values()) == 64
    # every stretch of the mix holds each source near its share
    last, total = max(slots), sum(slots.values())
    for source, own in per_source.items():
        at, n = np.array(own).T
        share = n.sum() / total
        for cut in (last // 5, last // 3, last // 2):
            expected = share * sum(v for s, v in slots.items() if s < cut)
            assert abs(n[at < cut].sum() - expected) < 64 * 12, source


def test_points_and_ranks():
    numbers = np.arange(3000, dtype="i8")
    at = mixing.points(numbers)
    assert [p / 2**mixing.BITS for p in at[:6]] == [0, 0.5, 0.25, 0.75, 0.125, 0.625]
    for bound in (0, 1, 2**40 + 17, 2**47, 2**48 - 5, 2**48):
        counted = np.concatenate([[0], np.cumsum(at < bound)[:-1]])
        assert (mixing.below(numbers, np.full(3000, bound, "i8")) == counted).all()


@pytest.mark.parametrize("slots", [[1], [1, 999, 0, 3], [0, 5], list(range(1, 30))])
def test_schedule_fills_every_slot_once(spark, slots):
    sources = [mixing.Source(str(i), 0, Fraction(0), 0, n) for i, n in enumerate(slots)]
    rows = mixing.schedule(spark, sources).collect()
    assert sorted((r.g, r["rank"]) for r in rows) == sorted((str(i), k) for i, n in enumerate(slots) for k in range(n))
    assert len({r.slot for r in rows}) == sum(slots) and max(r.slot for r in rows) < 8 * sum(slots)
    by_slot = sorted(rows, key=lambda r: r.slot)
    ranks = defaultdict(list)
    for r in by_slot:
        ranks[r.g].append(r["rank"])
    assert all(v == sorted(v) for v in ranks.values())


def test_targets():
    for sizes in ([10, 10, 10], [1, 1000, 1], [5], [0, 0, 7, 1], [1, 2, 3, 4, 5, 600, 7]):
        w = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
        got = mixing.targets(sizes, w, Fraction(3, 2), 2)
        assert got == share_out(sizes) and sum(got) == Fraction(3, 2) * sum(sizes)
