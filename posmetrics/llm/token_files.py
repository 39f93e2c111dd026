"""Token ids as flat binary files with 64-bit document offsets, read by memory mapping.

Layout of a folder written by :func:`write`, for shard ``NNNNN`` (shards in ascending
document order):

=====================  =====================================================================
``ids-NNNNN.bin``      token ids of the shard's documents, little-endian unsigned 16 or 32 bit
``offsets-NNNNN.bin``  64-bit positions in the whole corpus: one per document, and the end
``docs-NNNNN.bin``     64-bit document ids; ``NULL_ID`` stands for null
=====================  =====================================================================

Documents are range-partitioned by id, each partition writes one shard, and the bases of
the shards are prefix sums over one row per shard.

Defined cases: a null text counts as empty and still gets its end id; a null id comes
first; rows that repeat an id are all kept, in the order of a hash of their text; an empty
table gives no shard and no row; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from posmetrics.llm.common import (
    SIMPLE_LIMIT,
    map_array,
    pieces,
    shared_folder,
    table,
    texts_of,
    tuned,
    vocabulary_path,
    write_bytes,
)

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
NULL_ID = -(2**63)
CACHE = 700_000  # words an executor's Python process remembers
PIECE = 2_000_000  # characters encoded at a time
ENDS = ".,;:!?"

_encoders: dict[str, WordEncoder] = {}
_SLOW = re.compile(f"[\x1c-\x1f\x85{SIMPLE_LIMIT}-\U0010ffff]|<\\|")


class WordEncoder:
    """Whole texts to ids, one white-space separated word at a time.

    This vocabulary drops white space before it splits, so no token spans two words and a
    word's ids don't depend on its neighbours. Texts with characters whose normal form or
    case depends on context, or that may hold a special token, go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers

        self.library = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.library.get_vocab_size() <= 2**16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        # words are lower case, free of white space and in normal form already
        self.words = Tokenizer.from_file(path)
        self.words.normalizer = normalizers.Sequence([])
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        words = [None if _SLOW.search(t) else t.lower().split() for t in texts]
        needed = set().union(*(w for w in words if w))
        new = needed.difference(self.known)
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = needed
        self.learn(new)
        ids = self.known.__getitem__
        return [self.whole(t) if w is None else b"".join(map(ids, w)) for t, w in zip(texts, words)]

    def learn(self, words: set[str]) -> None:
        """Ids of new words. A word and the punctuation mark that ends it are two tokens
        of the pattern, so they are learnt apart."""
        known = self.known
        ended = {w for w in words if len(w) > 1 and w[-1] in ENDS and w[:-1].isalpha()}
        plain = (words - ended).union((w[:-1] for w in ended), (w[-1] for w in ended)).difference(known)
        plain = list(plain)
        for start in range(0, len(plain), 50_000):
            some = plain[start : start + 50_000]
            for word, found in zip(some, self.words.encode_batch_fast(some, add_special_tokens=False)):
                known[word] = array(self.code, found.ids).tobytes()
        for word in ended:
            known[word] = known[word[:-1]] + known[word[-1]]


def encoder(path: str) -> WordEncoder:
    """One encoder for each Python process, kept between tasks."""
    import os

    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write(
    docs: DataFrame,
    folder: str,
    path: str,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int | None = None,
) -> DataFrame:
    """Encode every document into ``folder``; returns one row per shard: its number,
    documents, ids, and the base (ids before it)."""
    spark = tuned(docs.sparkSession)
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the last key only spreads equal rows over shards; it never orders different ones
    order = (F.col("id").asc_nulls_first(), F.col("_h"), F.col("_k"))
    placed = (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .withColumns({"_h": F.xxhash64("text"), "_k": F.monotonically_increasing_id()})
        .repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .select("id", "text", F.spark_partition_id().alias("shard"))
    )

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        tail = np.asarray([end_id], enc.dtype).tobytes()
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        shard: list[int] = []

        def encoded() -> Iterator[bytes]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                shard[:] = [batch.column("shard")[0].as_py()]
                ids.append(batch.column("id").fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype("<i8"))
                texts = texts_of(batch.column("text"))
                for start, end in pieces(texts, PIECE):
                    found = [x + tail for x in enc.encode(texts[start:end])]
                    sizes.append(np.fromiter(map(len, found), "<i8", len(found)) // enc.dtype.itemsize)
                    yield b"".join(found)

        stream = encoded()
        first = next(stream, None)
        if first is None:
            return

        def chunks() -> Iterator[bytes]:
            yield first
            yield from stream

        name = f"{shard[0]:05d}"
        write_bytes(f"{folder}/ids-{name}.bin", chunks())
        write_bytes(f"{folder}/docs-{name}.bin", [np.concatenate(ids).tobytes()])
        lengths = np.concatenate(sizes)
        write_bytes(f"{folder}/lengths-{name}.bin", [lengths.tobytes()])
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([shard[0]], pa.int32()),
                "documents": pa.array([len(lengths)], pa.int64()),
                "n_ids": pa.array([int(lengths.sum())], pa.int64()),
                "width": pa.array([enc.dtype.itemsize], pa.int32()),
            }
        )

    # the files are written once, by this action; what stays is one row per shard
    done = placed.mapInArrow(store, "shard int, documents long, n_ids long, width int")
    stored = spark.createDataFrame(done.collect(), done.schema)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = stored.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{row['shard']:05d}"
                lengths = map_array(f"{folder}/lengths-{name}.bin", "<i8")
                ends = row["base"] + np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
                write_bytes(f"{folder}/offsets-{name}.bin", [ends.tobytes()])
            yield batch

    final = based.repartition(max(1, min(n, 1000)), "shard").mapInArrow(offsets, based.schema)
    return spark.createDataFrame(final.collect(), based.schema)


def read(shards: DataFrame, folder: str) -> DataFrame:
    """One row per document from the files: ``doc_id, start, n_tokens, ids_crc32``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{row['shard']:05d}"
                ids = map_array(f"{folder}/ids-{name}.bin", "<u2" if row["width"] == 2 else "<u4")
                docs = map_array(f"{folder}/docs-{name}.bin", "<i8")
                ends = map_array(f"{folder}/offsets-{name}.bin", "<i8")
                for first in range(0, len(docs), 10_000):
                    last = min(first + 10_000, len(docs))
                    own = ends[first : last + 1] - row["base"]
                    crc = [
                        zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(own[:-1].tolist(), own[1:].tolist())
                    ]
                    at = np.asarray(docs[first:last])
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(at, pa.int64(), mask=at == NULL_ID),
                            "start": pa.array(np.asarray(ends[first:last]), pa.int64()),
                            "n_tokens": pa.array(np.diff(own), pa.int64()),
                            "ids_crc32": pa.array(crc, pa.int64()),
                        }
                    )

    width = shards.count() or 1
    return shards.repartition(width, "shard").mapInArrow(
        scan, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    shards = write(table(spark, sf_dir, "documents"), folder, vocabulary_path(VOCABULARY))
    return read(shards, folder)
