"""From raw documents to token ids: language, near copies, benchmark passages, personal
data, encoding. Every stage works on what the one before has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posmetrics.llm import byte_bpe, decontaminate, language, minhash_dedup, personal_data
from posmetrics.llm.common import table, vocabulary_path, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language is ambiguous."""
    model = language.train(docs.where(~language.held_out()))
    names = ("_language", "_score", "_ambiguous")
    told = language.identify(docs, model, names=names)
    kept = told.where((F.col("_language") != language.UNDETERMINED) & ~F.col("_ambiguous"))
    return kept.select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies."""
    return minhash_dedup.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by marks of their kind; ``n_chars`` follows."""
    return personal_data.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds token ids, their number, and whether they decode to the text again."""
    both = byte_bpe.round_trip(docs, vocabulary_path(byte_bpe.VOCABULARY))
    same = F.coalesce(F.col("text"), F.lit("")).cast("binary") == F.col("decoded")
    return both.withColumns({"n_tokens": F.size("ids").cast("long"), "round_trip": same}).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near duplicates", one_of_each),
    ("decontamination", no_benchmark),
    ("personal data", redacted),
    ("encoding", encoded),
]

#: Fitted classifiers and signatures are beyond SQL; the tests hold the stages against
#: plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return docs
