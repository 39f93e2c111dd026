"""Byte-level byte-pair encoding and decoding by recursive queries in each task.

A task cuts its texts with the vocabulary's pattern, keeps the distinct words it has not
met before, and lets DuckDB merge them: one row per word and token position is joined to
the merge table, the leftmost pair of minimum rank of every word is contracted, and this
recurs until no word has a pair left. Decoding joins token rows to the vocabulary and
aggregates them in position order.

Defined cases: a null or empty text has no ids and decodes to no bytes; a word of the
vocabulary is one id; bytes that are no character round-trip; repeated rows each get their
own row; a null id is kept; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StructField, StructType

from posmetrics.llm.common import table, text_pieces, tuned, vocabulary_path

VOCABULARY = "byte_bpe_50k.tiktoken"
# fixed value: the pattern that goes with the vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE = 500_000  # words and stretches of text a task remembers
PIECE = 3_000_000  # characters handled at a time
AT_ONCE = 10_000  # words of one recursive query
LONG = 256  # bytes from which a word goes to the query that keeps only its newest state
MEMORY = "160MB"
ENDS = ".,;:!?"
IDS = ArrayType(IntegerType())

# A text may be cut before a space that follows something else than white space: no match
# of the pattern holds such a pair, and none looks back.
_CUT = re.compile(r"(?<=\S)(?= )")
_RUN = re.compile(r"\s ")

# State rows: word, position, token, and the position and token that follow. Every step
# writes the words that still change anew; a word's last step is its result.
MERGE_WORDS = """
WITH RECURSIVE state(step, w, pos, tok, npos, ntok) AS (
  SELECT 0, w, pos, tok, npos, ntok FROM symbols
  UNION ALL
  SELECT * FROM (
    WITH ranked AS MATERIALIZED (
      SELECT s.*, m.id FROM state s LEFT JOIN merges m ON m.l = s.tok AND m.r = s.ntok
    ), best AS MATERIALIZED (
      SELECT w, min((id << 46) | (pos::BIGINT << 23) | npos) AS b
      FROM ranked WHERE id IS NOT NULL GROUP BY w
    ), chosen AS MATERIALIZED (
      SELECT b.w, (b.b >> 46)::INT AS m, ((b.b >> 23) & 8388607)::INT AS p, (b.b & 8388607)::INT AS q,
             x.npos, x.ntok
      FROM best b JOIN ranked x ON x.w = b.w AND x.pos = (b.b & 8388607)::INT
    )
    SELECT r.step + 1, r.w, r.pos,
           CASE WHEN r.pos = c.p THEN c.m ELSE r.tok END,
           CASE WHEN r.pos = c.p THEN c.npos ELSE r.npos END,
           CASE WHEN r.pos = c.p THEN c.ntok WHEN r.npos = c.p THEN c.m ELSE r.ntok END
    FROM ranked r JOIN chosen c ON c.w = r.w
    WHERE r.pos <> c.q
  )
)
SELECT w, list(tok ORDER BY pos) AS ids
FROM state JOIN (SELECT w, max(step) AS step FROM state GROUP BY w) USING (w, step)
GROUP BY w ORDER BY w
"""

# The same for long words: state is keyed by position, so only the newest is held, and all
# pairs of the minimum rank are contracted in one step, left to right without overlap. No
# merge makes a pair of lower rank (each vocabulary entry is reached by its own merges), so
# one after the other would give the same.
MERGE_LONG_WORDS = """
WITH RECURSIVE s(w, pos, tok, npos, ntok, id) USING KEY (w, pos) AS (
  SELECT y.*, m.id FROM symbols y LEFT JOIN merges m ON m.l = y.tok AND m.r = y.ntok
  UNION
  SELECT x.*, m.id FROM (
    WITH hit AS (
      SELECT r.w, r.pos AS p, r.npos AS q, r.id::INT AS m,
             row_number() OVER a AS k, lag(r.npos) OVER a AS before
      FROM recurring.s r
      JOIN (SELECT w, min(id) AS id FROM recurring.s GROUP BY w) b ON r.w = b.w AND r.id = b.id
      WINDOW a AS (PARTITION BY r.w ORDER BY r.pos)
    ), chosen AS MATERIALIZED (
      SELECT w, p, q, m FROM (
        SELECT *, max(CASE WHEN p IS DISTINCT FROM before THEN k END) OVER (PARTITION BY w ORDER BY p) AS head
        FROM hit
      ) WHERE (k - head) % 2 = 0
    )
    SELECT o.w, o.p AS pos, o.m AS tok, q.npos, coalesce(o2.m, q.ntok) AS ntok
    FROM chosen o
    JOIN recurring.s q ON q.w = o.w AND q.pos = o.q
    LEFT JOIN chosen o2 ON o2.w = o.w AND o2.p = q.npos
    UNION ALL
    SELECT w, q, NULL, NULL, NULL FROM chosen
    UNION ALL
    SELECT f.w, f.pos, f.tok, f.npos, o.m
    FROM chosen o
    JOIN recurring.s f ON f.w = o.w AND f.npos = o.p
    LEFT JOIN chosen g ON g.w = f.w AND g.q = f.pos
    WHERE g.w IS NULL
  ) x LEFT JOIN merges m ON m.l = x.tok AND m.r = x.ntok
)
SELECT w, list(tok ORDER BY pos) AS ids FROM s WHERE tok IS NOT NULL GROUP BY w ORDER BY w
"""

DECODE = """
SELECT doc, array_to_string(list(v.chars ORDER BY pos), '') AS chars
FROM encoded t JOIN vocabulary v ON v.id = t.id
GROUP BY doc
"""

_engines: dict[str, ByteBpe] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class ByteBpe:
    """Encoder and decoder of one Python process, with its own in-memory database."""

    def __init__(self, path: str):
        import duckdb
        import regex

        self.ranks = ranks = read_ranks(path)
        self.split = regex.compile(PATTERN).findall
        self.packed = struct.Struct("<i").pack
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], "i4")
        self.known: dict[str, bytes] = {}
        self.merged: dict[str, bytes] = {}  # words that took a query, kept when ``known`` is full
        # bytes that some entry holds next to each other: no merge joins any others
        self.near = np.zeros((256, 256), bool)
        for token in ranks:
            signs = np.frombuffer(token, np.uint8)
            self.near[signs[:-1], signs[1:]] = True
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": MEMORY})
        merges = [
            (ranks[token[:i]], ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        left, right, rank = (np.array(x) for x in zip(*merges))
        pairs = pa.table({"l": left, "r": right, "id": rank})  # noqa: F841  (read by name)
        self.db.execute("CREATE TABLE merges AS SELECT l::INT AS l, r::INT AS r, id::BIGINT AS id FROM pairs")
        # a byte is written as the character of its value; 0, which strings may not hold, as 256
        held = pa.table(  # noqa: F841
            {"id": list(ranks.values()), "chars": [t.decode("latin-1").replace("\0", "\u0100") for t in ranks]}
        )
        self.db.execute("CREATE TABLE vocabulary AS SELECT id::INT AS id, chars FROM held")

    def merge(self, words: list[bytes], query: str) -> list[bytes]:
        """Ids of words, as little-endian 32-bit integers."""
        lengths = np.fromiter(map(len, words), "i4", len(words))
        ends = np.cumsum(lengths)
        tok = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        pos = (np.arange(len(tok)) - np.repeat(ends - lengths, lengths)).astype("i4")
        last = np.zeros(len(tok), bool)
        last[ends - 1] = True
        symbols = pa.table(  # noqa: F841
            {
                "w": np.repeat(np.arange(len(words), dtype="i4"), lengths),
                "pos": pos,
                "tok": tok,
                "npos": pa.array(pos + np.int32(1), mask=last),
                "ntok": pa.array(np.roll(tok, -1), mask=last),
            }
        )
        found = self.db.sql(query).to_arrow_table().column("ids").combine_chunks()
        flat, cut = found.flatten().to_numpy().tobytes(), (found.offsets.to_numpy() * 4).tolist()
        return [flat[a:b] for a, b in zip(cut, cut[1:])]

    def words(self, words: set[str]) -> dict[str, bytes]:
        """Ids of each word."""
        out, plain, cut = {}, {}, {}
        ranks, packed, merged = self.ranks.get, self.packed, self.merged.get
        for w in words:
            b = w.encode()
            if (rank := ranks(b)) is not None:
                out[w] = packed(rank)
            elif (ids := merged(w)) is not None:
                out[w] = ids
            elif len(b) < LONG:
                plain[w] = b
            else:  # a long word falls apart where no entry holds both bytes
                cut[w] = self.apart(b)
        names, pieces = list(plain), list(plain.values())
        for start in range(0, len(names), AT_ONCE):
            end = start + AT_ONCE
            made = dict(zip(names[start:end], self.merge(pieces[start:end], MERGE_WORDS)))
            if len(self.merged) + len(made) > CACHE:
                self.merged.clear()
            self.merged.update(made)
            out.update(made)
        if cut:
            done: dict[bytes, bytes] = dict.fromkeys(p for own in cut.values() for p in own)
            short = [p for p in done if len(p) < LONG]
            for start in range(0, len(short), AT_ONCE):
                some = short[start : start + AT_ONCE]
                done.update(zip(some, self.merge(some, MERGE_WORDS)))
            for piece in done:
                if len(piece) >= LONG:
                    done[piece] = self.merge([piece], MERGE_LONG_WORDS)[0]
            for w, own in cut.items():
                out[w] = b"".join(map(done.__getitem__, own))
        return out

    def apart(self, word: bytes) -> list[bytes]:
        signs = np.frombuffer(word, np.uint8)
        cuts = [0, *(np.flatnonzero(~self.near[signs[:-1], signs[1:]]) + 1).tolist(), len(word)]
        return [word[i:j] for i, j in zip(cuts, cuts[1:])]

    def parts(self, stretch: str) -> list[str]:
        """Matches of the pattern; the two usual shapes, a word of letters alone or with one
        mark after it, need no matching."""
        if stretch[1:].isalpha() and (stretch[0] == " " or stretch[0].isalpha()):
            return [stretch]
        if stretch[-1] in ENDS and stretch[1:-1].isalpha() and (stretch[0] == " " or stretch[0].isalpha()):
            return [stretch[:-1], stretch[-1]]
        return self.split(stretch)

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [_cut(t) for t in texts]
        needed = set().union(*parts)
        new = needed.difference(self.known)
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = needed
        # stretches and their words share the cache: most words of a new stretch are known
        split = {p: self.parts(p) for p in new}
        self.known.update(self.words(set().union(*split.values()).difference(self.known)))
        get = self.known.__getitem__
        self.known.update([(p, b"".join(map(get, own))) for p, own in split.items() if len(own) > 1])
        return [b"".join(map(get, own)) for own in parts]

    def decode(self, ids: pa.ListArray) -> list[bytes]:
        flat, lengths = ids.flatten(), ids.value_lengths().fill_null(0).to_numpy()
        docs = np.repeat(np.arange(len(ids), dtype="i4"), lengths)
        places = np.arange(len(flat), dtype="i4")  # fewer than 2^31 ids: a batch is that small
        encoded = pa.table({"doc": docs, "id": flat, "pos": places})  # noqa: F841
        rows = self.db.execute(DECODE).fetchall()
        out = [b""] * len(ids)
        for doc, chars in rows:
            out[doc] = chars.replace("\u0100", "\0").encode("latin-1")
        return out


def _cut(text: str) -> list[str]:
    """Stretches that the pattern treats one by one."""
    if not text:
        return []
    if text[0] == " " or _RUN.search(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *[f" {r}" for r in rest]]


def engine(path: str) -> ByteBpe:
    if path not in _engines:
        _engines[path] = ByteBpe(path)
    return _engines[path]


def ids_array(ids: list[bytes]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), "i8", len(ids)) // 4)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with one more column, the ids of each text; it replaces one of its name."""
    return _mapped(docs, path, text_col, [(ids_col, IDS)], lambda own, some: [ids_array(own.encode(some))])


def round_trip(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``, the bytes that these ids stand for."""

    def both(own: ByteBpe, some: list[str]) -> list[pa.Array]:
        ids = ids_array(own.encode(some))
        return [ids, pa.array(own.decode(ids), pa.binary())]

    return _mapped(docs, path, text_col, [("ids", IDS), ("decoded", BinaryType())], both)


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes of each list of ids; null for null."""
    tuned(df.sparkSession)
    kept = df.drop(out_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = engine(path)
        for batch in batches:
            lists = batch.column(ids_col).to_pylist()
            ids = pa.array([x or [] for x in lists], pa.list_(pa.int32()))
            found = [None if x is None else d for x, d in zip(lists, own.decode(ids))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.binary())], [*batch.schema.names, out_col]
            )

    return kept.mapInArrow(run, StructType([*kept.schema, StructField(out_col, BinaryType())]))


def _mapped(docs: DataFrame, path: str, text_col: str, added: list[tuple[str, DataType]], make) -> DataFrame:
    tuned(docs.sparkSession)
    names = [n for n, _ in added]
    kept = docs.drop(*(n for n in names if n != text_col))
    schema = StructType([*kept.schema, *(StructField(name, kind) for name, kind in added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = engine(path)
        for batch in batches:
            for start, end, texts in text_pieces(batch.column(text_col), PIECE):
                part = batch.slice(start, end - start)
                new = make(own, texts)
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, *names])
        # the process serves other tasks next, which need the memory
        own.known.clear()
        own.merged.clear()

    return kept.mapInArrow(run, schema)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return round_trip(docs, vocabulary_path(VOCABULARY)).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
