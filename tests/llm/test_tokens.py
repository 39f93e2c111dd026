"""Token files, token counts and byte-level BPE against the libraries they must match."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from posmetrics.llm import byte_bpe, token_counts, token_files
from posmetrics.llm.common import shared_folder, vocabulary_path

random.seed(11)
SIGNS = "ab e\n\té1<>th日in .,!'s\u2581\u3000\x1cD"
TEXTS = [
    None,
    "",
    " ",
    "   ",
    "a  b ",
    "\n\n a\n  b",
    "日本語 テキスト 😀😀",
    "<s> </s> <0x0A> <unk> <|endoftext|> A<|startoftext|>b",
    "İstanbul ß ẞ ΑΣ Σ don't I'LL we'Ve e\u0301x",
    "a\0b \0",
    "x" * 4000,
    " " * 900,
    "aab" * 700 + " " + "12345678" * 40,
    "..,, , . ,,",
] + ["".join(random.choice(SIGNS) for _ in range(250)) for _ in range(120)]
EMPTY = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3 + 1, t, -1) for i, t in enumerate(TEXTS)] + [(1, None, 5), (None, "same", 2), (7, "other", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(5)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_token_files(spark, docs):
    from tokenizers import Tokenizer

    path = vocabulary_path(token_files.VOCABULARY)
    folder = shared_folder(spark, "test-files")
    shards = token_files.write(docs, folder, path, shards=4)
    got = token_files.read(shards, folder).collect()
    library = Tokenizer.from_file(path)

    def ids(text):
        return [*library.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]

    given = docs.collect()
    expected = sorted(
        (r.doc_id is not None, r.doc_id or 0, len(ids(r.text)), zlib.crc32(np.array(ids(r.text), "<u4").tobytes()))
        for r in given
    )
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == expected
    ordered = sorted(got, key=lambda r: r.start)
    starts = np.cumsum([0, *(r.n_tokens for r in ordered)])[:-1]
    assert [r.start for r in ordered] == starts.tolist()
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in ordered]
    assert keys == sorted(keys)


def test_token_files_of_nothing(spark):
    folder = shared_folder(spark, "test-files")
    shards = token_files.write(spark.createDataFrame([], EMPTY), folder, vocabulary_path(token_files.VOCABULARY))
    assert token_files.read(shards, folder).count() == 0


def test_token_counts(spark, docs):
    import sentencepiece

    path = vocabulary_path(token_counts.VOCABULARY)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_counts.token_counts(docs, path, limit=100)
    expected = []
    for r in docs.collect():
        n = len(library.encode(r.text or ""))
        expected.append((r.doc_id, len((r.text or "").encode()), n, n > 100))
    assert rows_of(got) == sorted(expected, key=str)
    assert token_counts.token_counts(spark.createDataFrame([], EMPTY), path).count() == 0


def test_token_counts_of_a_corpus(spark):
    import sentencepiece

    from tests.conftest import SF_DIR

    path = vocabulary_path(token_counts.VOCABULARY)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in token_counts.op8_token_counts(spark, SF_DIR).collect():
        assert r.n_tokens == len(library.encode(texts[r.doc_id]))


def library():
    import tiktoken

    ranks = byte_bpe.read_ranks(vocabulary_path(byte_bpe.VOCABULARY))
    return tiktoken.Encoding("own", pat_str=byte_bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(spark, docs):
    own = library()
    path = vocabulary_path(byte_bpe.VOCABULARY)
    both = byte_bpe.round_trip(docs, path)
    assert both.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    for r in both.collect():
        assert r.ids == own.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    apart = byte_bpe.decode(byte_bpe.encode(docs, path), path)
    assert rows_of(apart) == rows_of(both)
    assert byte_bpe.round_trip(spark.createDataFrame([], EMPTY), path).count() == 0


def test_the_registered_byte_bpe_query(spark):
    from tests.conftest import SF_DIR

    own = library()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in byte_bpe.op10_byte_bpe(spark, SF_DIR).collect():
        ids = own.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_long_and_short_words_merge_alike():
    engine = byte_bpe.engine(vocabulary_path(byte_bpe.VOCABULARY))
    words = [w.encode() for w in ("thererere", "aaaaaaa", "ééé", "abcabcabc", "zzzzyzz", "ingingin")]
    long = [engine.merge([w], byte_bpe.MERGE_LONG_WORDS)[0] for w in words]
    assert engine.merge(words, byte_bpe.MERGE_WORDS) == long


def test_merged_words_outlive_a_full_memory(monkeypatch):
    """Words that took a query are not merged again when the memory of stretches is full."""
    engine = byte_bpe.ByteBpe(vocabulary_path(byte_bpe.VOCABULARY))
    monkeypatch.setattr(byte_bpe, "CACHE", 12)
    asked, merge = [], engine.merge
    monkeypatch.setattr(engine, "merge", lambda words, query: asked.extend(words) or merge(words, query))
    first = engine.encode(["zqxjkv wvvqqz"])
    for i in range(6):
        engine.encode([f"the a{i}! of b{i}? in c{i}; to d{i}:"])
    assert engine.encode(["zqxjkv wvvqqz"]) == first
    assert asked.count(b"zqxjkv") == 1
    assert len(engine.merged) <= 12
