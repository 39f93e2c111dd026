"""Merkle manifest of a dataset: a hash tree for each language and one over their roots.

Where a document stands among those of its language is a rank query on a bitmap, not a
sort: every language keeps the non-zero 64-bit words of the bitmap of its ids, merged over
all files; a directory of popcounts, summed up a radix tree of 16-bit steps, gives the
rows before each word; the bits below an id's own give the rest. With these coordinates
leaves drop into slot arrays of 2^8 places. One group of tasks reduces eight levels of the
tree, the next takes the tops of these blocks; the paths come down again by joins of one
row for each block, and every document's proof is made where its block lies.

No task gets more than 65,536 rows of a directory or 256 nodes of a tree, whatever the
language. Slot arrays, tops and paths are written to the shared folder.

Defined cases: leaves of one language with the same id stand in the order of their hashes,
null ids before all others; repeated rows are a leaf each; a null language is the first
one; a null field is ``-``; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from posmetrics.llm.common import expanded, table, tuned, written

LEVELS = 8  # of the tree in one slot array
SLOTS = 1 << LEVELS
STEP = 16  # bits of a word's number in one step of the directory
NO_ID = -(1 << 58)  # number of the word of null ids, below all others
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(docs: DataFrame, **changed: Column) -> Column:
    """Digest of a row, as hex text."""
    values = [changed.get(name, docs[f"`{name}`"]) for name in FIELDS]
    return F.sha2(F.concat(*map(_field, values)), 256)


def _leaves(docs: DataFrame) -> DataFrame:
    """lang, word and bit of the id, doc_id, leaf, and the tampered leaf where there is one."""
    doc_id, n = docs["`doc_id`"], docs["`n_chars`"]
    hit = (F.crc32(doc_id.cast("string")) % 7 == 0) & n.isNotNull()
    more = leaf_hash(docs, n_chars=n.cast("decimal(20,0)") + 1)
    return docs.select(
        *_place(docs),
        doc_id.cast("long").alias("doc_id"),
        F.unhex(leaf_hash(docs)).alias("leaf"),
        F.when(hit, F.unhex(more)).alias("tampered"),
    )


def _place(docs: DataFrame) -> list[Column]:
    doc_id = docs["`doc_id`"].cast("long")
    lang = docs["`lang`"]
    return [
        # never null, ordered as the languages are with null first
        F.coalesce(F.concat(F.lit("="), lang), F.lit("")).alias("g"),
        F.coalesce(F.shiftright(doc_id, 6), F.lit(NO_ID)).alias("word"),
        F.coalesce(doc_id.bitwiseAND(F.lit(63)), F.lit(0)).cast("int").alias("bit"),
    ]


def _before(df: DataFrame, group: list[Column | str], order: list[str], value: str) -> Column:
    own = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(own), F.lit(0).cast("long"))


def bitmap(docs: DataFrame) -> DataFrame:
    """g, word, mask, held (rows), start (rows of the language before the word), total.

    The popcount directory has four steps; each is a running sum over the numbers that
    share all but their last 16 bits.
    """
    mask = F.when(F.col("word") == NO_ID, F.lit(0).cast("long")).otherwise(F.expr("shiftleft(1L, bit)"))
    words = written(
        docs.select(*_place(docs))
        .groupBy("g", "word")
        .agg(F.bit_or(mask).alias("mask"), F.count(F.lit(1)).alias("held")),
        "bitmap",
    )
    steps = [words.select("g", F.col("word").alias("k"), F.col("held"))]
    for _ in range(3):
        up = F.shiftright("k", STEP).alias("k")
        steps.append(steps[-1].groupBy("g", up).agg(F.sum("held").alias("held")))
    top = steps.pop()
    start = top.select("g", "k", _before(top, ["g"], ["k"], "held").alias("start"))
    for step in reversed(steps):
        near = step.withColumn("up", F.shiftright("k", STEP))
        near = near.withColumn("near", _before(near, ["g", "up"], ["k"], "held"))
        above = start.select("g", F.col("k").alias("up"), "start")
        start = near.join(above, ["g", "up"]).select("g", "k", (F.col("start") + F.col("near")).alias("start"))
    totals = words.groupBy("g").agg(F.sum("held").alias("total"))
    return words.join(start.withColumnRenamed("k", "word"), ["g", "word"]).join(totals, "g")


def ranked(leaves: DataFrame, words: DataFrame) -> DataFrame:
    """g, rank, total, doc_id, leaf, tampered of every row."""
    words = written(words, "directory")
    clean = F.bit_count("mask") == F.col("held")
    each = leaves.join(words, ["g", "word"])
    below = F.bit_count(F.col("mask").bitwiseAND(F.expr("~shiftleft(-1L, bit)")))
    kept = ["g", "total", "doc_id", "leaf", "tampered"]
    plain = each.where(clean).select(*kept, (F.col("start") + below).alias("rank"))
    if words.where(~clean).isEmpty():
        return plain
    # words with null or repeated ids: equal rows are counted, and digests, which are
    # spread evenly, cut the rows of one id into 65,536 parts
    prefix = F.substring("leaf", 1, 2).alias("prefix")
    near = ["g", "word", "bit"]
    ties = (
        each.where(~clean)
        .groupBy(*kept, "start", "word", "bit", prefix)
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    ties = written(ties, "repeated")
    parts = ties.groupBy(*near, "prefix").agg(F.sum("copies").alias("copies"))
    bits = parts.groupBy(*near).agg(F.sum("copies").alias("copies"))
    parts = parts.select(*near, "prefix", _before(parts, near, ["prefix"], "copies").alias("s1"))
    bits = bits.select(*near, _before(bits, ["g", "word"], ["bit"], "copies").alias("s2"))
    placed = ties.join(parts, [*near, "prefix"]).join(bits, near)
    first = F.col("start") + F.col("s1") + F.col("s2")
    own = _before(placed, [*near, "prefix"], ["leaf", "tampered"], "copies")
    placed = placed.withColumn("first", first + own)
    again = expanded(placed, "copies", "n").select(*kept, (F.col("first") + F.col("n")).alias("rank"))
    return plain.unionByName(again)


def depth_of(count: Column) -> Column:
    """Levels above the leaves: the bits of the last leaf's number."""
    return F.when(count > 1, F.length(F.bin(count - 1))).otherwise(0).cast("int")


# --- slot arrays: inside tasks ---------------------------------------------------------------


def reduced(level: list[bytes], levels: int) -> list[list[bytes]]:
    """All levels above and with ``level``, digests as hex text."""
    out = [level]
    for _ in range(levels):
        last = out[-1]
        out.append(
            [sha256(b"".join(last[i : i + 2])).hexdigest().encode() for i in range(0, len(last), 2)]
        )
    return out


def siblings(levels: list[list[bytes]], slot: int) -> list[tuple[int, bytes]]:
    """The other node of each run on the way up: -1 if it is on the left, 1 on the right,
    0 if there is none."""
    out = []
    for level in levels[:-1]:
        other = slot ^ 1
        out.append((1 if other > slot else -1, level[other]) if other < len(level) else (0, b""))
        slot >>= 1
    return out


def packed(path: list[tuple[int, bytes]]) -> bytes:
    return b"".join(bytes([side + 1]) + digest for side, digest in path)


def unpacked(path: bytes) -> list[tuple[int, bytes]]:
    out, at = [], 0
    while at < len(path):
        side = path[at] - 1
        size = 64 if side else 0
        out.append((side, path[at + 1 : at + 1 + size]))
        at += 1 + size
    return out


def folded(digest: bytes, path: list[tuple[int, bytes]]) -> bytes:
    for side, other in path:
        digest = sha256(other + digest if side < 0 else digest + other).hexdigest().encode()
    return digest


def _slots(column: pa.ChunkedArray, slot: np.ndarray) -> np.ndarray:
    """Digests of 32 bytes at their slots; zeros where there is none."""
    out = np.zeros((len(slot), 32), np.uint8)
    for at, value in zip(slot.tolist(), column.to_pylist()):
        if value is not None:
            out[at] = np.frombuffer(value, np.uint8)
    return out


def _hex(digests: np.ndarray) -> list[bytes]:
    text = digests.tobytes().hex().encode()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


BLOCK = "g string, idx long, steps int, depth int, top binary, ids array<long>, leaves binary, tampered binary, hit binary"


def _block(key: tuple, rows: pa.Table) -> pa.Table:
    """A slot array of leaves and the node on top of it."""
    g, idx = key[0].as_py(), key[1].as_py()
    slot = rows.column("rank").to_numpy() & (SLOTS - 1)
    depth = rows.column("depth")[0].as_py()
    leaves = _slots(rows.column("leaf"), slot)
    ids = np.empty(len(slot), object)
    ids[slot] = rows.column("doc_id").to_pylist()
    hit = np.zeros(len(slot), np.uint8)
    hit[slot] = rows.column("tampered").is_valid().to_numpy()
    steps = min(LEVELS, depth)
    top = reduced(_hex(leaves), steps)[-1][0]
    return pa.table(
        {
            "g": [g],
            "idx": pa.array([idx], pa.int64()),
            "steps": pa.array([steps], pa.int32()),
            "depth": pa.array([depth - steps], pa.int32()),
            "top": pa.array([top], pa.binary()),
            "ids": pa.array([ids.tolist()], pa.list_(pa.int64())),
            "leaves": pa.array([leaves.tobytes()], pa.binary()),
            "tampered": pa.array([_slots(rows.column("tampered"), slot)[hit > 0].tobytes()], pa.binary()),
            "hit": pa.array([hit.tobytes()], pa.binary()),
        }
    )


NODE = "g string, idx long, up long, depth int, top binary, path binary"


def _nodes(key: tuple, rows: pa.Table) -> pa.Table:
    """The nodes of a slot array, each with its path to the top and the top."""
    idx = rows.column("idx").to_numpy()
    order = np.empty(len(idx), "i8")
    order[idx & (SLOTS - 1)] = np.arange(len(idx))
    level = [rows.column("top")[i].as_py() for i in order.tolist()]
    depth = rows.column("depth")[0].as_py()
    steps = min(LEVELS, depth)
    levels = reduced(level, steps)
    n = len(idx)
    return pa.table(
        {
            "g": [key[0].as_py()] * n,
            "idx": pa.array(idx[order]),
            "up": pa.array([key[1].as_py()] * n, pa.int64()),
            "depth": pa.array([depth - steps] * n, pa.int32()),
            "top": pa.array([levels[-1][0]] * n, pa.binary()),
            "path": pa.array([packed(siblings(levels, i)) for i in range(n)], pa.binary()),
        }
    )


def climb(nodes: DataFrame, rounds: int) -> DataFrame:
    """g, idx, path, end: the way from each node to the last one of its group.

    ``nodes`` has g, idx, depth (levels still above) and top (the node's digest).
    """
    done, now = [], nodes
    for _ in range(rounds):
        up = F.shiftright("idx", LEVELS).alias("up")
        done.append(written(now.groupBy("g", up).applyInArrow(_nodes, NODE), "nodes"))
        first = F.col("idx") % SLOTS == 0
        now = done[-1].where(first).select("g", F.col("up").alias("idx"), "depth", "top")
    paths = done.pop().select("g", "idx", "path", F.col("top").alias("end"))
    for lower in reversed(done):
        above = paths.select("g", F.col("idx").alias("up"), F.col("path").alias("above"), "end")
        paths = lower.join(above, ["g", "up"]).select("g", "idx", F.concat("path", "above").alias("path"), "end")
    return paths


def _rounds(levels: int) -> int:
    return max(1, -(-levels // LEVELS))


def _languages(paths: DataFrame) -> DataFrame:
    """g, subroot, path2, root: the tree over the roots of the languages, whose ranks are
    sums over their first two bytes and then within these."""
    roots = written(
        paths.where("idx = 0").select("g", F.substring(F.col("g").cast("binary"), 1, 3).alias("prefix"), "end"),
        "roots",
    )
    count = roots.count()
    parts = roots.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select("prefix", _before(parts, [], ["prefix"], "n").alias("start"))
    own = F.row_number().over(Window.partitionBy("prefix").orderBy("g")) - 1
    languages = roots.join(parts, "prefix").select("g", "end", (F.col("start") + own).cast("long").alias("idx"))
    languages = written(languages, "languages")
    levels = max(0, (count - 1).bit_length()) if count else 0
    nodes = languages.select(
        F.lit("").alias("g"), "idx", F.lit(levels).alias("depth"), F.col("end").alias("top")
    )
    over = climb(nodes, _rounds(levels)).select("idx", F.col("path").alias("path2"), F.col("end").alias("root"))
    return languages.join(over, "idx").select("g", F.col("end").alias("subroot"), "path2", "root")


RESULT = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


def _proved(batches):
    """Proof and verification of every document of each slot array."""
    for batch in batches:
        for row in batch.to_pylist():
            leaves = _hex(np.frombuffer(row["leaves"], np.uint8))
            changed = iter(_hex(np.frombuffer(row["tampered"], np.uint8)))
            given = [next(changed) if hit else leaf for hit, leaf in zip(row["hit"], leaves)]
            levels = reduced(leaves, row["steps"])
            above = unpacked(row["path"]) + unpacked(row["path2"])
            rest = b"".join(digest for _, digest in above)
            root = row["root"]
            beyond: dict[bytes, bytes] = {}
            proofs, ends = [], []
            for slot, digest in enumerate(given):
                path = siblings(levels, slot)
                proofs.append(sha256(b"".join([d for _, d in path]) + rest).hexdigest())
                top = folded(digest, path)
                if top not in beyond:
                    beyond[top] = folded(top, above)
                ends.append(beyond[top])
            n = len(leaves)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(row["ids"], pa.int64()),
                    "leaf": [x.decode() for x in leaves],
                    "subroot": [row["subroot"].decode()] * n,
                    "root": [root.decode()] * n,
                    "proof_sha256": proofs,
                    "folded_root": [x.decode() for x in ends],
                    "verified": [x == root for x in ends],
                }
            )


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row."""
    spark = tuned(docs.sparkSession)
    places = ranked(_leaves(docs), bitmap(docs)).withColumn("depth", depth_of(F.col("total")))
    blocks = places.groupBy("g", F.shiftright("rank", LEVELS).alias("idx")).applyInArrow(_block, BLOCK)
    blocks = written(blocks, "slots")
    levels = blocks.agg(F.max("depth")).first()[0] or 0
    paths = climb(blocks.select("g", "idx", "depth", "top"), _rounds(levels))
    languages = _languages(paths)
    each = blocks.join(paths.select("g", "idx", "path"), ["g", "idx"]).join(languages, "g")
    return each.drop("g", "idx", "depth", "top").mapInArrow(_proved, RESULT)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def _crc32(text: str) -> str:
    """SQL of the unsigned CRC-32 of an ASCII text, with the table ``crc``."""
    step = "xor(c >> 8, t[(xor(c, b) & 255)::INT + 1])"
    bytes_of = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return (
        f"xor(list_reduce(list_concat([4294967295::BIGINT], {bytes_of}), lambda c, b: {step}), 4294967295::BIGINT)"
    )


def _sql_field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode({value}::VARCHAR)) || ':' || {value} END"


def _sql_leaf(n_chars: str) -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(_sql_field(f) for f in fields) + ")"


#: The tree level by level, then the way up of each document.
OP13_SQL = f"""
WITH RECURSIVE bits(i, n, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, n + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END FROM bits WHERE n < 8
), crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE n = 8),
leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS idx,
         {_sql_leaf("n_chars")} AS leaf,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 7 = 0 AND n_chars IS NOT NULL
              THEN {_sql_leaf("(n_chars + 1)")} END AS tampered
  FROM documents, crc
), nodes(g, lvl, idx, h, n) AS (
  SELECT g, 0, idx, leaf, count(*) OVER (PARTITION BY g) FROM leaves
  UNION ALL
  SELECT g, lvl + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY g, lvl, idx // 2
), tops AS (
  SELECT g, lvl AS depth, h, row_number() OVER (ORDER BY g) - 1 AS idx FROM nodes WHERE n = 1
), over(lvl, idx, h, n) AS (
  SELECT 0, idx, h, count(*) OVER () FROM tops
  UNION ALL
  SELECT lvl + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM over WHERE n > 1 GROUP BY lvl, idx // 2
), tree AS (  -- one tree for each language: its own levels, then those above
  SELECT g, lvl, idx, h FROM nodes WHERE n > 1
  UNION ALL
  SELECT t.g, t.depth + o.lvl, o.idx, o.h FROM tops t, over o
), ends AS (
  SELECT t.g, t.depth, t.idx AS place, t.h AS subroot, (SELECT max(lvl) FROM over) AS more,
         (SELECT h FROM over WHERE n = 1) AS root
  FROM tops t
), ways AS (
  SELECT l.doc_id, l.leaf, l.tampered, e.*, l.idx, s.lvl,
         CASE WHEN s.lvl < e.depth THEN l.idx >> s.lvl ELSE e.place >> (s.lvl - e.depth) END AS at
  FROM leaves l JOIN ends e USING (g), LATERAL (SELECT unnest(range(e.depth + e.more)) AS lvl) s
), pairs AS (
  SELECT w.*, t.h AS other FROM ways w
  LEFT JOIN tree t ON t.g = w.g AND t.lvl = w.lvl AND t.idx = xor(w.at, 1)
), proofs AS (
  SELECT l.g, l.idx, coalesce(string_agg(p.other, '' ORDER BY p.lvl), '') AS others,
         list({{'s': coalesce(p.other, ''), 'l': p.at % 2 = 1}} ORDER BY p.lvl) FILTER (p.lvl IS NOT NULL) AS steps
  FROM leaves l LEFT JOIN pairs p ON p.g = l.g AND p.idx = l.idx GROUP BY l.g, l.idx
), climbing(g, idx, k, h) AS (
  SELECT g, idx, 0, coalesce(tampered, leaf) FROM leaves
  UNION ALL
  SELECT c.g, c.idx, c.k + 1,
         sha256(CASE WHEN p.steps[c.k + 1].l THEN p.steps[c.k + 1].s || c.h ELSE c.h || p.steps[c.k + 1].s END)
  FROM climbing c JOIN proofs p USING (g, idx) WHERE c.k < len(p.steps)
)
SELECT l.doc_id, l.leaf, e.subroot, e.root, sha256(p.others) AS proof_sha256,
       c.h AS folded_root, c.h = e.root AS verified
FROM leaves l JOIN ends e USING (g) JOIN proofs p USING (g, idx)
JOIN climbing c ON c.g = l.g AND c.idx = l.idx AND c.k = coalesce(len(p.steps), 0)
"""
