"""Language identification by error-correcting output codes.

Every language gets a codeword; one binary classifier per bit, linear in the frequencies
of hashed byte n-grams of the lower-cased text, predicts it. A text gets the language
whose codeword has the least logistic loss under all bits; the losses give a score, and a
text whose two nearest codewords are close together is flagged as ambiguous.

The classifiers are fitted on a bounded sample: at most ``per_language`` labelled rows of
each language, the first in the order of a hash of their text; no language is left out, so
the driver's memory grows with their number. Everything else covers
whole texts and all rows, in one pass without a shuffle.

Defined cases: a text that is null, empty or without a letter is ``und`` with score 0; rows
without a language are no training rows but are predicted; with a single learned language
every text with letters gets it, with score 1; without any it is ``und``; repeated rows and
null ids are kept; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from posmetrics.llm.common import pieces, table, texts_of, tuned

UNDETERMINED = "und"
PER_LANGUAGE = 200  # training rows of each language at most
FEATURES = 2**13
PIECE = 500_000
SPAN = 16_384  # bytes of a training text that make one example
ROUNDS = 100
MARGIN = 0.1  # share of the score by which the best language must lead
_LETTER = re.compile(r"[^\W\d_]")


def codewords(n: int) -> np.ndarray:
    """``n`` codewords of +1 and -1: all splits of up to five languages, otherwise the
    random code of the largest least distance among a few."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 5:
        rows = []
        for k in range(1, n):
            for chosen in combinations(range(1, n), k):
                rows.append([1 if i in chosen else -1 for i in range(n)])
        return np.array(rows, float).T.reshape(n, -1)
    bits = 8 + 4 * int(np.ceil(np.log2(n)))
    best, far = None, -1
    for seed in range(50):
        code = np.where(np.random.default_rng(seed).random((n, bits)) < 0.5, -1.0, 1.0)
        if (abs(code.sum(0)) == n).any():
            continue
        distance = (bits - code @ code.T) / 2 + bits * np.eye(n)
        if distance.min() > far:
            best, far = code, distance.min()
    return best


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all byte pairs, triples and quadruples of the texts, and the
    positions at which each text begins. White space counts as one space."""
    # three spaces before each text: no n-gram sees two of them
    parts = [b"   %b " % " ".join(t.lower().split()).encode() for t in texts]
    raw = np.frombuffer(b"".join(parts) + b"   ", np.uint8).astype(np.uint32)
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    n = len(raw) - 3
    two = raw[:n] * np.uint32(257) + raw[1 : n + 1]
    three = two * np.uint32(263) + raw[2 : n + 2]
    four = three * np.uint32(269) + raw[3 : n + 3]
    out = np.stack([two, three, four], 1) * np.uint32(2654435761)
    return (out >> np.uint32(32 - 13)).astype(np.int32), first


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weight: np.ndarray  # features x bits
    bias: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """texts x languages, summing to 1."""
        features, first = grams(texts)
        total = np.add.reduceat(self.weight[features].sum(1), first[:-1], axis=0)
        margin = total / (3 * np.diff(first))[:, None] + self.bias
        loss = np.logaddexp(0, -margin[:, None, :] * self.code[None]).sum(2)
        likely = np.exp(loss.min(1, keepdims=True) - loss)
        return likely / likely.sum(1, keepdims=True)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity of each text."""
        lang = [UNDETERMINED] * len(texts)
        score, ambiguous = np.zeros(len(texts)), np.zeros(len(texts), bool)
        some = [i for i, t in enumerate(texts) if _LETTER.search(t)]
        if not self.languages or not some:
            return lang, score, ambiguous
        if len(self.languages) == 1:
            found = np.ones((len(some), 1))
        else:
            found = self.scores([texts[i] for i in some])
        best = found.argmax(1)
        for i, k in zip(some, best.tolist()):
            lang[i] = self.languages[k]
        score[some] = found.max(1)
        if found.shape[1] > 1:
            top = np.sort(found, axis=1)
            ambiguous[some] = top[:, -1] - top[:, -2] < MARGIN
        return lang, score, ambiguous


def fit(texts: list[str], labels: list[str]) -> Model:
    """Logistic regression of every bit of the codewords; deterministic."""
    languages = sorted(set(labels))
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((FEATURES, 0), np.float32), np.zeros(0))
    spans, kind = [], []
    for text, label in zip(texts, labels):
        for at in range(0, len(text), SPAN):
            part = text[at : at + SPAN]
            # short and long stretches, as texts to be told come in all lengths
            for piece in (part, part[:100]) if len(part) > 100 else (part,):
                if _LETTER.search(piece):
                    spans.append(piece)
                    kind.append(languages.index(label))
    x = np.zeros((len(spans), FEATURES), np.float32)
    for i, span in enumerate(spans):
        features, _ = grams([span])
        x[i] = np.bincount(features.ravel(), minlength=FEATURES)[:FEATURES] / features.size
    scale = 1 / np.sqrt((x**2).mean(0) + 1e-7)
    x *= scale
    x /= np.sqrt(FEATURES)
    y = code[np.array(kind)]
    rows = np.bincount(kind, minlength=len(languages))
    each = (1 / rows[np.array(kind)] / (rows > 0).sum())[:, None]
    w, b = np.zeros((FEATURES, y.shape[1]), np.float32), np.zeros(y.shape[1])
    step, w_last, b_last = 4.0, w, b
    for k in range(ROUNDS):  # accelerated gradient descent
        speed = k / (k + 3)
        wm, bm = w + speed * (w - w_last), b + speed * (b - b_last)
        slope = (-y / (1 + np.exp(y * (x @ wm + bm))) * each).astype(np.float32)
        w_last, b_last = w, b
        w = wm - step * (x.T @ slope + np.float32(1e-6) * wm)
        b = bm - step * slope.sum(0)
    weight = (w * (scale / np.sqrt(FEATURES))[:, None]).astype(np.float32)
    return Model(languages, code, weight, b)


def train(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE
) -> Model:
    """Fit on at most ``per_language`` rows of each language of ``docs``, which the driver
    reads; no language is left out."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        "lang is not null and text is not null"
    )
    sample = (
        rows.withColumn("_h", F.xxhash64("text"))
        .withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy("_h", "text")))
        .where(F.col("_n") <= per_language)
        .orderBy("lang", "_n")
        .select("text", "lang")
        .collect()
    )
    return fit([r["text"] for r in sample], [r["lang"] for r in sample])


def identify(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous"),
) -> DataFrame:
    """``docs`` with predicted language, score and the ambiguity flag; these replace
    columns of their names."""
    tuned(docs.sparkSession)
    kept = docs.drop(*(n for n in names if n != text_col))
    kinds = (StringType(), DoubleType(), BooleanType())
    schema = StructType([*kept.schema, *map(StructField, names, kinds)])
    held = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES numbers for each bit of the codewords

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column(text_col))
            for start, end in pieces(texts, PIECE):
                part = batch.slice(start, end - start)
                lang, score, ambiguous = held.value.predict(texts[start:end])
                new = [pa.array(lang, pa.string()), pa.array(score), pa.array(ambiguous)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, *names])

    return kept.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> F.Column:
    """Rows that are never learned from: the checksum of the id is a multiple of five. A
    null id counts as one."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    model = train(docs.where(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(rows, model).drop("text")
