"""The Merkle manifest against a tree built in memory."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest

from posmetrics.llm import merkle

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, g int"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row, more=0):
    doc_id, source, lang, n, text = row[:5]
    n = n if n is None else n + more
    return h(*map(field, (doc_id, source, lang, n, text)))


def levels_of(level):
    out = [level]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def way(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((i % 2, level[i ^ 1] if i ^ 1 < len(level) else ""))
        i //= 2
    return out


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = levels_of([leaf_of(r) for r in groups[lang]])
    over = levels_of([trees[lang][-1][0] for lang in langs])
    root = over[-1][0]
    out = []
    for k, lang in enumerate(langs):
        for i, row in enumerate(groups[lang]):
            path = way(trees[lang], i) + way(over, k)
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            end = leaf_of(row, 1 if hit else 0)
            for left, other in path:
                end = h(other, end) if left else h(end, other)
            proof = h(*(other for _, other in path))
            out.append((row[0], leaf_of(row), trees[lang][-1][0], root, proof, end, end == root))
    return sorted(out, key=str)


def found(spark, rows, parts=3):
    df = spark.createDataFrame(rows, COLUMNS).repartition(parts)
    return sorted(map(tuple, merkle.manifest(df).collect()), key=str)


def doc(i, lang="en", text=None, n=3):
    return (i, f"s{(i or 0) % 3}", lang, n, f"text {i}" if text is None else text, "x", 1)


def test_whole_table(spark, sf=("/root/testdata/sf0.001")):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = sorted(map(tuple, merkle.op13_merkle(spark, sf).collect()), key=str)
    assert got == plain(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3


@pytest.mark.parametrize("n", [1, 2, 3, 256, 257, 513])
def test_sizes_of_a_tree(spark, n):
    rows = [doc(i * i - 5) for i in range(n)]
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [doc(i, lang) for i, lang in enumerate(["en", None, "", "é", "z", "日本", "en", "en2", None])]
    rows += [doc(None, "en", t) for t in ("b", "a", "a", "c")]  # null ids, repeated rows
    rows += [doc(3), doc(3), doc(3, text="other"), doc(2**62), doc(-(2**63)), doc(2**63 - 1), doc(-64), doc(-65)]
    rows += [(4, None, "en", None, None, None, None), doc(5, text="x" * 300_000), doc(6, text="é\0日", n=2**63 - 1)]
    # an id and a checksum divisible by 7, without a number to tamper with
    seven = next(i for i in range(100, 999) if zlib.crc32(str(i).encode()) % 7 == 0)
    rows += [doc(seven, n=None), doc(seven, "fr")]
    got = found(spark, rows)
    assert got == plain(rows)
    assert [r[-1] for r in got if r[0] == seven].count(False) == 1


def test_many_copies(spark):
    rows = [doc(1, text="same")] * 300 + [doc(1, text=f"t{i}") for i in range(300)] + [doc(i) for i in range(70)]
    assert found(spark, rows) == plain(rows)


def test_no_rows_and_many_languages(spark):
    assert found(spark, []) == []
    rows = [doc(i, f"l{i}") for i in range(300)]
    assert found(spark, rows) == plain(rows)
