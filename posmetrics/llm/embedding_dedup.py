"""Near-duplicate vectors by a forest of random-projection trees with spill.

Vectors of one label (and length) meet only each other. Every tree splits them again and
again at the median of a random projection; a vector within a margin of the cut goes to
both sides, so that a close pair is rarely torn apart, and each further tree gets its own
directions. Pairs are compared within leaves, in double precision.

A node stops splitting once it is small, or so tight that the margin covers half of it:
splitting a dense group would only copy it. Such large leaves are compared in blocks of
bounded size, each pair of blocks a task of its own, without leaving out a pair.

Leaves do not emit pairs. A pair that shares several leaves is counted in the one of the
smallest number, so every leaf returns a count of links per vector and, for the
components, one edge per vector to the smallest vector of its local group.

Equal vectors are one vertex with a multiplicity. Cuts come from approximate quantiles,
summed per node; no vectors are sent to the driver.

Defined cases: vectors that are null, empty or zero, hold null or non-finite numbers, or have
no label link with nothing and are their own component; a null id links with nothing and has
a null component; repeated rows link with each other; rows with the same id but different
vectors count as one vertex; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posmetrics.llm.common import table, tuned, written
from posmetrics.llm.components import components

LEAST = 0.93
TREES = 6
LEAF = 1024  # vectors of a leaf, and of a block of a larger one
SPILL = 0.7  # margin in standard deviations of a just linked pair's projected distance
DEPTH = 40  # projections a vector has at most


def directions(tree: int, size: int, depth: int) -> np.ndarray:
    """Random unit directions of a tree, one for each level."""
    r = np.random.default_rng([20240611, tree, size]).standard_normal((size, DEPTH))
    return (r / np.linalg.norm(r, axis=0))[:, :depth]


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as unit rows in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _projected(vectors: DataFrame, trees: int, depth: int) -> DataFrame:
    """A row for each vector and tree with its projections; ``node`` is the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                x = _matrix(part.column("x"))
                for tree in range(trees):
                    p = (x @ directions(tree, size, depth)).astype(np.float32)
                    ends = np.arange(0, p.size + 1, depth, dtype=np.int32)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "uid": part.column("uid"),
                            "root": part.column("root"),
                            "size": part.column("size"),
                            "tree": pa.array(np.full(len(p), tree, np.int32)),
                            "p": pa.ListArray.from_arrays(pa.array(ends), pa.array(p.ravel())),
                        }
                    )

    rows = vectors.select("uid", "root", "size", "x").mapInArrow(
        run, "uid long, root long, size int, tree int, p array<float>"
    )
    return rows.select("uid", "size", "p", F.xxhash64("root", "tree").alias("node"))


def leaves(vectors: DataFrame, least: float, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """``uid, node``: the leaves of every vector in all trees."""
    largest = vectors.groupBy("root").count().agg(F.max("count")).first()[0] or 0
    # with spill a node shrinks to about 0.6 of its parent
    depth = min(DEPTH, max(1, math.ceil(math.log(max(2, largest / leaf)) / math.log(1 / 0.6)) + 2))
    active = written(_projected(vectors, trees, depth), "projections")
    done = []
    chord = math.sqrt(2 - 2 * least) * SPILL
    for level in range(depth):
        p = F.element_at("p", level + 1)
        margin = F.lit(chord) / F.sqrt("size")
        cuts = (
            active.groupBy("node")
            .agg(
                F.count("*").alias("n"),
                F.percentile_approx(p, [0.25, 0.5, 0.75], 500).alias("q"),
                F.first("size").alias("size"),
            )
            .where(F.col("n") > leaf)
            .where(F.element_at("q", 3) - F.element_at("q", 1) > margin * 2)
            .select("node", F.element_at("q", 2).alias("cut"))
        )
        met = written(active.join(cuts, "node", "left"), "level")
        done.append(met.where("cut is null").select("uid", "node"))
        going = met.where("cut is not null")
        if going.isEmpty():
            break
        sides = F.array(
            F.when(p <= F.col("cut") + margin, F.xxhash64("node", F.lit(0))),
            F.when(p >= F.col("cut") - margin, F.xxhash64("node", F.lit(1))),
        )
        active = going.select("uid", "size", "p", F.explode(F.array_compact(sides)).alias("node"))
    else:
        done.append(active.select("uid", "node"))
    out = done[0]
    for part in done[1:]:
        out = out.unionAll(part)
    return written(out, "leaves")


def _compare(part: pa.Table, least: float) -> pa.Table:
    """Links of one leaf, or of two blocks of one: per vector their number, and the least
    vector of its local group."""
    block = part.column("block").to_numpy()
    order = np.lexsort((part.column("uid").to_numpy(), block))
    part, block = part.take(pa.array(order)).combine_chunks(), block[order]
    uid, copies = part.column("uid").to_numpy(), part.column("copies").to_numpy()
    node = part.column("node")[0].as_py()
    x = _matrix(part.column("x").combine_chunks())
    n, cut = len(uid), int(np.searchsorted(block, block[-1])) if len(block) else 0
    crossed = cut > 0  # two blocks meet: only pairs between them are new
    a, b = (slice(0, cut), slice(cut, n)) if crossed else (slice(0, n), slice(0, n))
    linked = x[a] @ x[b].T >= least
    if not crossed:
        np.fill_diagonal(linked, False)
    # pairs that share a leaf of a smaller number are counted there
    own = part.column("nodes").combine_chunks()
    flat = own.flatten().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(n), np.diff(own.offsets.to_numpy()))
    smaller = flat < node
    codes, at = np.unique(flat[smaller], return_inverse=True)
    counted = linked
    if len(codes):
        member = np.zeros((n, len(codes)), np.float32)
        member[rows[smaller], at] = 1
        counted = linked & ~(member[a] @ member[b].T > 0)
    links = np.zeros(n, np.int64)
    links[a] += counted @ copies[b]
    if crossed:
        links[b] += counted.T @ copies[a]
    group = uid.copy()
    while True:  # the least vector within reach
        new = group.copy()
        big = np.iinfo(np.int64).max
        np.minimum(new[a], np.where(linked, group[b][None, :], big).min(1, initial=big), out=new[a])
        np.minimum(new[b], np.where(linked, group[a][:, None], big).min(0, initial=big), out=new[b])
        if np.array_equal(new, group):
            break
        group = new
    some = (links > 0) | (group != uid)
    return pa.table({"uid": uid[some], "links": links[some], "near": group[some]})


def near_duplicates(
    vectors: DataFrame,
    least: float = LEAST,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    trees: int = TREES,
    leaf: int = LEAF,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row."""
    tuned(vectors.sparkSession)
    given = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("x"),
        F.col(label_col).alias("label"),
    )
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & finite
        & F.exists("x", lambda v: v != 0),
        F.lit(False),
    )
    # 0.0 + x turns -0.0 into 0.0, so that equal vectors are equal keys
    plain = given.withColumn("ok", usable).withColumn("x", F.transform("x", lambda v: v + F.lit(0.0)))
    distinct = written(
        plain.where("ok")
        .groupBy("label", "x")
        .agg(F.min("vec_id").alias("uid"), F.count("*").alias("copies"))
        .select(
            "uid",
            "copies",
            "label",
            "x",
            F.size("x").alias("size"),
            F.xxhash64("label", F.size("x")).alias("root"),
        ),
        "vectors",
    )
    placed = leaves(distinct, least, trees, leaf)
    # leaves that hold one vector have nothing to compare
    sizes = placed.groupBy("node").count().where("count > 1")
    blocks = sizes.select("node", F.ceil(F.col("count") / F.lit(leaf)).cast("int").alias("blocks"))
    every = placed.groupBy("uid").agg(F.collect_list("node").alias("nodes"))  # a few for each tree
    full = distinct.select("uid", "copies", "x").join(every, "uid")
    mine = F.pmod(F.xxhash64("uid"), "blocks").cast("int")
    dealt = (
        placed.join(blocks, "node")
        .withColumn("block", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .join(full, "uid")
        .select(
            "node",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            "block",
            "uid",
            "copies",
            "x",
            "nodes",
        )
    )
    found = written(
        dealt.groupBy("node", "i", "j").applyInArrow(
            lambda part: _compare(part, least), "uid long, links long, near long"
        ),
        "links",
    )
    links = found.groupBy("uid").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("uid").alias("a"), F.col("near").alias("b")))
    result = (
        distinct.select("uid", "copies", "label", "x")
        .join(links, "uid", "left")
        .join(reached.withColumnRenamed("id", "uid"), "uid", "left")
        .select(
            F.col("label").alias("own_label"),
            F.col("x").alias("own_x"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "uid").alias("component"),
        )
    )
    linked = (
        plain.where("ok")
        .join(result, (F.col("label") == F.col("own_label")) & (F.col("x") == F.col("own_x")))
        .select("vec_id", "n_links", F.col("component").alias("component_id"))
    )
    alone = plain.where("not ok").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionAll(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
