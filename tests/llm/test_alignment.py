"""Alignment of two tokenizers against the libraries and plain loops."""

from __future__ import annotations

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from posmetrics.llm import alignment
from posmetrics.llm.common import vocabulary_path

random.seed(5)
SIGNS = "ab \r\x85\xa0 e\n\té1<>th日in .,!'s　\x1cD"
TEXTS = [
    None,
    "",
    " ",
    "a  b ",
    "日本語 テキスト 😀😀",
    "<s> </s> <0x0A> <unk> <|endoftext|> A",
    "▁ is no space",
    "a\0b \0",
    "x" * 3000,
    "the quick brown fox " * 400,
    "é ﬁ Å",
] + ["".join(random.choice(SIGNS) for _ in range(150)) for _ in range(600)]
PATHS = [vocabulary_path(alignment.A_FILE), vocabulary_path(alignment.B_FILE)]


def plain(rows):
    """(doc_id, figures, digest) of each text by the libraries and loops over tokens."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    sign = alignment.byte_of_sign()
    assert decoders.ByteLevel().decode(["Ġaé"]) == bytes(sign[c] for c in "Ġaé").decode("utf-8", "replace")
    groups = []
    for _, text in rows:
        x = a.encode(f" {text}", add_special_tokens=False).ids if text else []
        y = b.encode(text) if text else []
        xb = [bytes(sign[c] for c in a.id_to_token(i)) for i in x]
        yb = [
            bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in zip(y, map(b.id_to_piece, y))
        ]
        whole = f" {text}".encode()
        if not (b"".join(xb) == whole == b"".join(yb)):
            groups.append([])
            continue
        out, i, j, at_a, at_b, own_a, own_b = [], 0, 0, 0, 0, [], []
        while i < len(x) or j < len(y):
            if at_a <= at_b:
                at_a += len(xb[i])
                own_a.append(x[i])
                i += 1
            else:
                at_b += len(yb[j])
                own_b.append(y[j])
                j += 1
            if at_a == at_b:
                out.append((own_a, own_b))
                own_a, own_b = [], []
        groups.append(out)
    count = Counter((g[0][-1], g[1][-1]) for own in groups for g in own)
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    result = []
    for (doc_id, _), own in zip(rows, groups):
        n = [count[g[0][-1], g[1][-1]] for g in own]
        best = sum(c == most[g[1][-1]] for c, g in zip(n, own))
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in own)
        digest = sha256(text.encode()).hexdigest() if own else ""
        sizes = [sum(len(g[k]) for g in own) for k in (0, 1)]
        result.append((doc_id, *sizes, len(own), len(own), best, sum(n), digest))
    return sorted(result, key=str)


def found(df, **more):
    return sorted(map(tuple, alignment.align(df, *PATHS, **more).collect()), key=str)


@pytest.mark.parametrize("size", [300, alignment.BUNDLE])
def test_odd_texts(spark, size):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a text"), (3, "a text"), (3, "a text")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_a int, bundle string")
    assert found(df.repartition(4), size=size) == plain(rows)


def test_whole_table(spark, sf="/root/testdata/sf0.001"):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, alignment.op11_alignment(spark, sf).collect()), key=str) == plain(rows)


def test_no_rows(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string")) == []
    assert found(spark.createDataFrame([(1, None)], "doc_id long, text string")) == [(1, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("work", [1, 2, 7, 1000])
def test_pieces_of_the_merge_path(work):
    rng = np.random.default_rng(work)
    for n, m in ((0, 0), (0, 5), (5, 0), (1, 1), (300, 300), (900, 40), (40, 900)):
        a = np.sort(rng.choice(1000, n, replace=False))
        b = np.sort(rng.choice(1000, m, replace=False))
        i, j = alignment.common_ends(a, b, work)
        assert a[i].tolist() == b[j].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
        d = np.arange(n + m + 1)
        merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
        assert alignment.crossings(a, b, d).tolist() == [sum(s == 0 for _, s in merged[:k]) for k in d]
