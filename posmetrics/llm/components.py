"""Connected components of an edge list, by alternating stars.

Every round links the larger neighbours of a vertex to its smallest one, then the smaller
ones; rounds are logarithmic in the longest path. Minima are aggregated before they are
joined back, so the neighbours of one vertex are never gathered in a task, and a vertex
with very many edges is a skewed join that the engine splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posmetrics.llm.common import written


def _pass_on(edges: DataFrame, grown: bool) -> DataFrame:
    """One star step. ``edges`` hold u > v. Large: every neighbour above u goes to the
    least neighbour of u; small: every neighbour below u, and u, go to the least."""
    if grown:
        sides = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges
    least = sides.groupBy("u").agg(F.min("v").alias("m"))
    met = sides.join(least, "u").withColumn("m", F.least("u", "m"))
    if grown:
        moved = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component``: the smallest vertex reachable from each vertex that has an edge
    to another and is not itself the smallest. Null ends and loops are left out."""
    stars = written(
        edges.where(f"{a} <> {b}")
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    mark = None
    while True:
        seen = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            return stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
        mark = seen
        stars = written(_pass_on(_pass_on(stars, True), False), "stars")
