"""Mixing sources to target weights along a low-discrepancy schedule.

Slots of the mix are numbered; the van der Corput point of a slot's number, mapped through
the cumulative shares of the sources, says which source fills it, so that every stretch of
the mix holds all sources near their shares. A slot's rank within its source is counted in
closed form from the bits of its number: no slot has to know another. Each source's
documents are shuffled by a hash and laid end to end, again and again where the target
exceeds the source; slot of rank r takes the r-th block of so many words of that stream,
so slots and pieces of documents meet in one equi-join.

The word offsets of documents are running sums in two steps, over 65,536 parts of the hash
and within each part, so that no task gets a whole source. One row of each source comes to
the driver, where targets and shares are worked out in exact fractions.

Defined cases: a null or empty text has size 0 and nothing is taken of it; a document
longer than a block is spread over several; repeated rows are counted, laid out one after
the other, and each gets its own row; null ids and null sources are kept; an empty table
gives no row; other columns are ignored. The same rows give the same mix, in whatever
order or files they come.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from posmetrics.llm.common import expanded, table, tuned, written

WORD = r"[^\x20\x09-\x0D]+"
SHARE = Fraction(3, 2)  # of all words
REPEATS = 2  # times that a source, and so a document, may be taken at most
WEIGHTS = (3, 1, 2)  # of the sources in order, repeating
BLOCK = 256  # words of a slot
BITS = 48  # of a point
SEED = "mix"


@dataclass(frozen=True)
class Source:
    key: str  # see _source_key
    words: int
    target: Fraction  # words to take
    quota: int  # the same, in whole words
    slots: int


def targets(sizes: list[int], weights: list[int], share: Fraction, repeats: int) -> list[Fraction]:
    """``share`` of all words by weight; what exceeds ``repeats`` times a source is shared
    among the others again, until none exceeds it."""
    total = share * sum(sizes)
    capped: set[int] = set()
    while True:
        left = total - sum(repeats * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        out = [
            Fraction(repeats * s) if i in capped else left * w / weight
            for i, (s, w) in enumerate(zip(sizes, weights))
        ]
        over = {i for i, (t, s) in enumerate(zip(out, sizes)) if t > repeats * s}
        if not over:
            return out
        capped |= over


# --- points ----------------------------------------------------------------------------------


def points(numbers: np.ndarray) -> np.ndarray:
    """Van der Corput points in base 2, as whole numbers below 2^BITS."""
    out = np.zeros_like(numbers)
    left = numbers.copy()
    for _ in range(BITS):
        out = (out << 1) | (left & 1)
        left >>= 1
    return out


def below(numbers: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of the points before each number lie below its bound.

    The numbers before i fall into one run for each set bit m of i; the points of a run of
    2^m numbers are 2^(BITS - m) apart, from the point of its first number on.
    """
    count = np.zeros_like(numbers)
    for m in range(int(numbers.max(initial=0)).bit_length()):
        first = points((numbers >> (m + 1)) << (m + 1))
        step = BITS - m
        inside = (bounds - first + (1 << step) - 1) >> step
        count += np.where((numbers >> m) & 1, np.clip(inside, 0, 1 << m), 0)
    return count


def cuts(slots: list[int]) -> np.ndarray:
    """Cumulative shares of the sources in slots, each at least one unit wide."""
    total, done, out = sum(slots), 0, [0]
    for n in slots:
        done += n
        out.append(max(out[-1] + (n > 0), (done << BITS) // total) if total else 0)
    return np.array(out, "i8")


def numbers_needed(slots: list[int], bounds: np.ndarray) -> int:
    """The least count of numbers among which every source has all its slots."""

    def enough(count: int) -> bool:
        at = np.full(len(bounds), count, "i8")
        return bool((np.diff(below(at, bounds)) >= np.array(slots, "i8")).all())

    high = 1
    while not enough(high):
        high *= 2
    low = high // 2
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if enough(middle) else (middle + 1, high)
    return low


# --- documents as streams of words -----------------------------------------------------------


def _source_key(source: Column) -> Column:
    """Never null, ordered by code point with null last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """g (source key), place (hash), doc_id, size, copies of all different rows."""
    doc_id, text = docs["`doc_id`"].cast("long"), docs["`text`"]
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit("")))
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(
        _source_key(docs["`source`"]).alias("g"), F.md5(named).alias("place"), doc_id.alias("doc_id"), size.alias("size")
    )
    return rows.groupBy("g", "place", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies"))


def laid_out(rows: DataFrame) -> DataFrame:
    """``rows`` with ``start``, the words of its source before it."""
    words = F.col("size") * F.col("copies")
    rows = rows.withColumn("part", F.substring("place", 1, 4)).withColumn("words", words)
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("g", "part").agg(F.sum("words").alias("words"))
    started = F.coalesce(F.sum("words").over(before("g").orderBy("part")), F.lit(0).cast("long"))
    parts = parts.select("g", "part", started.alias("base"))
    own = F.coalesce(F.sum("words").over(before("g", "part").orderBy("place", "doc_id", "size")), F.lit(0).cast("long"))
    placed = rows.join(parts, ["g", "part"]).withColumn("start", F.col("base") + own)
    return placed.drop("part", "base", "words")


def plan(
    rows: DataFrame, share: Fraction = SHARE, repeats: int = REPEATS, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK
) -> list[Source]:
    """The sources of a mix, one row of each."""
    found = rows.groupBy("g").agg(F.sum(F.col("size") * F.col("copies")).alias("words")).orderBy("g").collect()
    sizes = [r.words for r in found]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share, repeats) if sizes else []
    quotas = [round(t) for t in wanted]
    return [Source(r.g, r.words, t, q, -(-q // block)) for r, t, q in zip(found, wanted, quotas)]


def schedule(spark: SparkSession, sources: list[Source]) -> DataFrame:
    """slot, g, rank: which block of which source fills each slot of the mix."""
    wanted = np.array([s.slots for s in sources], "i8")
    bounds = cuts(wanted.tolist())
    keys = np.array([s.key for s in sources], object)
    count = numbers_needed(wanted.tolist(), bounds) if wanted.sum() else 0

    def run(batches):
        for batch in batches:
            number = batch.column("id").to_numpy()
            of = np.searchsorted(bounds, points(number), "right") - 1
            rank = below(number, bounds[of + 1]) - below(number, bounds[of])
            used = rank < wanted[of]  # beyond, the source has had its share
            yield pa.RecordBatch.from_pydict(
                {
                    "slot": pa.array(number[used]),
                    "g": pa.array(keys[of[used]].tolist(), pa.string()),
                    "rank": pa.array(rank[used]),
                }
            )

    return tuned(spark).range(count).mapInArrow(run, "slot long, g string, rank long")


def pieces(rows: DataFrame, sources: list[Source], block: int = BLOCK) -> DataFrame:
    """Each copy of each document with the parts of it that blocks of its source hold, and
    one row without a part for a document that is in none.

    Adds number (of the copy), rank (of the block), first (word within the document), taken
    and the source's words and target.
    """
    spark = rows.sparkSession
    about = spark.createDataFrame(
        [(s.key, s.words, float(s.target), s.quota) for s in sources], "g string, total long, target double, quota long"
    )
    rows = expanded(laid_out(rows).join(about, "g"), "copies", "number")
    rows = rows.withColumn("start", F.col("start") + F.col("number") * F.col("size"))
    zero = F.lit(0).cast("long")
    # the stream repeats the source; at most as many rounds as the target needs
    rounds = F.when((F.col("size") > 0) & (F.col("start") < F.col("quota")), F.floor((F.col("quota") - 1 - F.col("start")) / F.col("total")))
    each = rows.withColumn("round", F.explode_outer(F.sequence(zero, rounds)))
    each = each.withColumn("start", F.col("start") + F.col("round") * F.col("total"))
    end = F.least(F.col("start") + F.col("size"), F.col("quota"))
    held = F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))
    each = each.withColumn("end", end).withColumn("rank", F.explode_outer(held))
    low, high = F.greatest("start", F.col("rank") * block), F.least("end", (F.col("rank") + 1) * block)
    return each.withColumns({"first": low - F.col("start"), "taken": high - low}).drop("start", "end", "round", "quota")


def mix(docs: DataFrame, share: Fraction = SHARE, repeats: int = REPEATS, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK) -> DataFrame:
    """The mix in order of slots: slot, source, doc_id, place (hash that tells documents
    with one id apart), number (of a repeated row), first (word) and taken (words)."""
    rows = written(sized(docs), "sizes")
    sources = plan(rows, share, repeats, weights, block)
    parts = pieces(rows, sources, block).where(F.col("rank").isNotNull())
    source = F.when(F.col("g") != "1", F.substring("g", 2, 2**31 - 1))
    return parts.join(schedule(docs.sparkSession, sources), ["g", "rank"]).select(
        "slot", source.alias("source"), "doc_id", "place", "number", "first", "taken"
    )


def taken(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row."""
    rows = written(sized(docs), "sizes")
    sources = plan(rows, block=block)
    parts = pieces(rows, sources, block)
    met = parts.join(schedule(docs.sparkSession, sources), ["g", "rank"], "left")
    words = F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("taken"))), F.lit(0).cast("long"))
    grouped = met.groupBy("g", "place", "doc_id", "size", "number", "total", "target").agg(words.alias("words"))
    return grouped.select(
        "doc_id", "size", F.col("total").alias("source_size"), "target", F.col("words").alias("taken")
    )


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(table(spark, sf_dir, "documents"))


#: What each document gives, from its place in the stream of its source; the schedule says
#: when, not how much. Sources are capped in the order of what they hold for their weight.
OP12_SQL = r"""
WITH rows AS (
  SELECT doc_id, coalesce('0' || source, '1') AS g, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, '')) AS place
  FROM documents
), sources AS (
  SELECT g, sum(size)::BIGINT AS total, [3, 1, 2][(row_number() OVER (ORDER BY g) - 1) % 3 + 1] AS w FROM rows GROUP BY g
), ordered AS (
  SELECT *, sum(2 * total) OVER o - 2 * total AS capped, sum(w) OVER () - sum(w) OVER o + w AS weight,
         1.5::DOUBLE * sum(total) OVER () AS mixed
  FROM sources WINDOW o AS (ORDER BY total / w, g ROWS UNBOUNDED PRECEDING)
), level AS (  -- the first source, from the poorest on, that need not be capped
  SELECT mixed - capped AS rest, weight FROM ordered
  WHERE (mixed - capped) * w <= 2 * total * weight ORDER BY total / w, g LIMIT 1
), targets AS (
  SELECT g, total, CASE WHEN rest * w <= 2 * total * weight THEN rest * w / weight ELSE 2 * total END::DOUBLE AS target
  FROM sources, level
), laid AS (
  SELECT rows.*, total, target, round_even(target, 0)::BIGINT AS quota,
         (sum(size) OVER (PARTITION BY g ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM rows JOIN targets USING (g)
)
SELECT doc_id, size, total AS source_size, target,
       (greatest(0, least(start + size, quota) - start)
        + greatest(0, least(start + size, quota - total) - start))::BIGINT AS taken
FROM laid
"""
