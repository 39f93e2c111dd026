"""Exact NTILE over a whole table, without sending the table to one task.

A tile number only depends on where a row lies relative to the k-1 last rows of
the lower tiles. So all rankings are range-sorted together in one distributed
sort, the cut rows are looked up by position, and the tile becomes a comparison
with k-1 constants per ranking: no window, no join back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posmetrics.session import scratch_dir, shared_root
from posmetrics.sources.files import Files

_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row below


def _cut_ranks(n: int, tiles: int) -> list[int]:
    """1-based rank of the last row of each tile but the last one."""
    base, extra = divmod(n, tiles)
    return [min(base * j + min(j, extra), n) for j in range(1, tiles)]


def with_ntiles(
    df: DataFrame, id_column: str, rankings: dict[str, Column], tiles: int = 5
) -> DataFrame:
    """Add one BIGINT tile column per ranking.

    Each ranking is a numeric column; tile 1 holds its lowest values, NULLs come
    last, equal values are ordered by ``id_column``, which must be unique.
    """
    shared_root(df.sparkSession)
    names = list(rankings)
    # read by the sampling job, by the sort and by the caller; never recomputed
    base = df.select(
        "*", *(rankings[n].cast("double").alias(f"_rank_{n}") for n in names)
    ).checkpoint()

    keys = ["ranking", "absent", "value", "id"]
    # range bounds are sampled: both lookups below must see the same layout
    scratch = scratch_dir(df.sparkSession, "ranks")
    (
        base.select(
            F.col(id_column).cast("string").alias("id"),
            F.posexplode(F.array(*(F.col(f"_rank_{n}") for n in names))).alias("ranking", "value"),
        )
        .select(
            "ranking",
            F.col("value").isNull().alias("absent"),
            F.coalesce("value", F.lit(0.0)).alias("value"),
            "id",
        )
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("place", F.monotonically_increasing_id())
        .write.parquet(scratch)
    )
    placed = df.sparkSession.read.parquet(scratch)
    # one row per shuffle partition
    sizes = (
        placed.groupBy(F.shiftright("place", _LOCAL_BITS).alias("part"))
        .count()
        .orderBy("part")
        .collect()
    )
    n = sum(r["count"] for r in sizes) // len(names)
    if n == 0:
        Files(df.sparkSession, scratch).delete(scratch)
        return base.select(*df.columns, *(F.lit(1).cast("bigint").alias(x) for x in names))

    places = {
        (i, rank): _place_of(i * n + rank - 1, sizes)
        for i in range(len(names))
        for rank in _cut_ranks(n, tiles)
    }
    cut_rows = {
        r["place"]: r
        for r in placed.filter(F.col("place").isin(*set(places.values()))).collect()
    }
    Files(df.sparkSession, scratch).delete(scratch)

    scores = []
    for i, name in enumerate(names):
        value = F.col(f"_rank_{name}")
        row_key = F.struct(
            value.isNull().alias("absent"),
            F.coalesce(value, F.lit(0.0)).alias("value"),
            F.col(id_column).cast("string").alias("id"),
        )
        score = F.lit(1)
        for rank in _cut_ranks(n, tiles):
            cut = cut_rows[places[i, rank]]
            cut_key = F.struct(
                F.lit(cut["absent"]).alias("absent"),
                F.lit(cut["value"]).alias("value"),
                F.lit(cut["id"]).alias("id"),
            )
            score = score + (row_key > cut_key).cast("int")
        scores.append(score.cast("bigint").alias(name))
    return base.select(*df.columns, *scores)


def _place_of(index: int, sizes: list) -> int:
    """Row id of the row at a global 0-based position."""
    for r in sizes:
        if index < r["count"]:
            return (r["part"] << _LOCAL_BITS) + index
        index -= r["count"]
    raise IndexError(index)
