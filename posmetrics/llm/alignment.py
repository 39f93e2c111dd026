"""Where two tokenizers agree: tokens of A and B cut into groups at the bytes both end at.

A task tokenizes texts, stretch by stretch where neither tokenizer can join two, and lays
those of a bundle end to end, so that the token ends of A
and of B are two increasing lists of byte offsets. Merging them is divided along the merge
path: at diagonals of equal distance a binary search finds how many ends of A and how many
of B lie before, all searches at once, and between two diagonals lies a piece of equal
work, whether it holds a thousand short texts or part of one long one. A piece emits its
common ends; a group that runs over a boundary is stitched from the pieces it touches.

Every common end links the two tokens that end there. How often a pair of ids is linked in
all texts is counted over bundles: each lists its different pairs once, with their numbers
of links, and the texts hold places in that list. The pairs are summed, joined to their
sums and to the highest sum of their B id, and come back to the bundle as one list of
figures, which every text's places look up.

Defined cases: a null or empty text, and one whose tokens do not join to a space and the
text, has no tokens and zeros; a very long text is a bundle of its own; repeated rows each
get their own row and their links count each time; a null id is kept; an empty table gives
no row; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from posmetrics.llm.common import table, text_pieces, tuned, vocabulary_path, written

A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
SPACE = "▁"  # how B writes a space
BUNDLE = 1_000_000  # bytes of text that are aligned together
KNOWN = 300_000  # stretches that a task remembers, which only saves time
TOGETHER = 2_000  # new stretches that are tokenized end to end
SHORT = 64  # signs of a stretch worth remembering
WORK = 1 << 16  # token ends of one piece
# cuts before a space or line break that follows no white space; the first finds the same
# stretches where a text has no other white space
_STRETCH = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_CUT = re.compile(r"(?<=[^\s\x85\ufeff])(?=[ \n])")
_LIKE_SPACE = re.compile(r"[\s\x85\ufeff]")
_OTHER_SPACE = re.compile(r"[^\S \n]|[\x85\ufeff]")
_tokenizers: dict[tuple[str, str], Tokenizers] = {}


def byte_of_sign() -> dict[str, int]:
    """The signs in which a byte-level vocabulary writes its bytes: printable ones stand for
    themselves, the others, in order, for the signs from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + n): b for n, b in enumerate(hidden)}}


class Tokenizers:
    """A and B of one Python process, with the bytes of all their entries."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        sign = byte_of_sign()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        added = self.a.get_added_tokens_decoder()
        for entry, i in self.a.get_vocab().items():
            known = i not in added and all(c in sign for c in entry)
            self.a_bytes[i] = bytes(sign[c] for c in entry) if known else entry.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.cuts = self._may_cut(a_path)
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.odd: set[str] = set()  # stretches that either side spells differently
        self.a_size = np.array([len(x) for x in self.a_bytes], "i8")
        self.b_size = np.array([len(x) for x in self.b_bytes], "i8")
        # how ids are written: inside a list or at its end, A before B
        self.signs = [
            *(f"{i}{end}" for end in ",|" for i in range(len(self.a_bytes))),
            *(f"{i}{end}" for end in ",;" for i in range(len(self.b_bytes))),
        ]

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode()

    def _may_cut(self, a_path: str) -> bool:
        """Whether no token spans the start of a space or line break after other signs: A
        splits its texts there by its own pattern before it merges, and no piece of B holds
        a line break, or a space but at its start."""
        with open(a_path, encoding="utf-8") as file:
            split = json.load(file).get("pre_tokenizer") or {}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        inner = any("\n" in p or SPACE in p.lstrip(SPACE) for p in pieces)
        return split.get("type") == "ByteLevel" and split.get("use_regex", True) and not inner

    def _learn(self, stretches: set[str]) -> dict[str, tuple[bytes, bytes]]:
        """Ids of A and B of stretches, as little-endian 32-bit integers."""
        # end to end, stretches that end in no white space come out as they do alone
        joined = [s for s in stretches if self.cuts and not _LIKE_SPACE.match(s[-1])]
        out, single = {}, [s for s in stretches if not self.cuts or _LIKE_SPACE.match(s[-1])]
        for start in range(0, len(joined), TOGETHER):
            some = joined[start : start + TOGETHER]
            found = self._learn_joined(some)
            out.update(found)
            if not found:
                single += some
        out.update(self._learn_single(single))
        return out

    def _both(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and B of texts that begin with a space or a line break."""
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # B puts a space before what it is given: a text's own, or one to be left out
        b = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        for i, t in enumerate(texts):
            if t == " ":  # nothing is left of it, and B puts no space before nothing
                b[i] = [self.b.piece_to_id(SPACE)]
            elif t[0] != " ":
                b[i] = b[i][1:]
        return a, b

    def _learn_joined(self, stretches: list[str]) -> dict[str, tuple[bytes, bytes]]:
        """All at once, cut where the stretches end; nothing if some token crosses an end or
        the tokens spell something else."""
        whole = "".join(stretches)
        data, ends = whole.encode(), np.cumsum([len(s.encode()) for s in stretches])
        sides = []
        for ids, entries, size in zip(self._both([whole]), (self.a_bytes, self.b_bytes), (self.a_size, self.b_size)):
            if self._spelled(entries, ids[0]) != data:
                return {}
            own = np.array(ids[0], "<i4")
            stops = np.cumsum(size[own])
            cut = np.searchsorted(stops, ends)
            if not (stops[cut] == ends).all():
                return {}
            raw, at = own.tobytes(), [0, *((cut + 1) * 4).tolist()]
            sides.append([raw[i:j] for i, j in zip(at, at[1:])])
        return dict(zip(stretches, zip(*sides)))

    def _learn_single(self, stretches: list[str]) -> dict[str, tuple[bytes, bytes]]:
        out = {}
        for s, x, y in zip(stretches, *self._both(stretches)):
            out[s] = (np.array(x, "<i4").tobytes(), np.array(y, "<i4").tobytes())
            if not (self._spelled(self.a_bytes, x) == s.encode() == self._spelled(self.b_bytes, y)):
                self.odd.add(s)
        return out

    @staticmethod
    def _spelled(entries: list[bytes], ids: list[int]) -> bytes:
        return b"".join(map(entries.__getitem__, ids))

    def _stretches(self, text: str) -> list[str]:
        whole = f" {text}"
        if not self.cuts:
            return [whole]
        return _CUT.split(whole) if _OTHER_SPACE.search(text) else _STRETCH.findall(whole)

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of A and B of each text, as little-endian 32-bit integers; none where either
        does not spell the text."""
        cut = [self._stretches(t) if t else [] for t in texts]
        needed = set().union(*cut)
        new = needed.difference(self.known)
        if len(self.known) + len(new) > KNOWN:
            self.known, self.odd = {}, set()
            new = needed
        self.known.update(self._learn(new))
        out = []
        for text, own in zip(texts, cut):
            parts = list(map(self.known.__getitem__, own))
            x, y = b"".join([p[0] for p in parts]), b"".join([p[1] for p in parts])
            if self.odd and not self.odd.isdisjoint(own):
                whole = f" {text}".encode()
                ids = [np.frombuffer(z, "<i4").tolist() for z in (x, y)]
                if not (self._spelled(self.a_bytes, ids[0]) == whole == self._spelled(self.b_bytes, ids[1])):
                    x = y = b""
            out.append((x, y))
        for s in new:  # long ones seldom come again
            if len(s) > SHORT:
                del self.known[s]
                self.odd.discard(s)
        return out


def tokenizers_of(a_path: str, b_path: str) -> Tokenizers:
    key = (a_path, b_path)
    if key not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core for a task
        _tokenizers[key] = Tokenizers(*key)
    return _tokenizers[key]


# --- the merge path --------------------------------------------------------------------------


def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first so many merged ends come from ``a``, of equal ones ``a``'s
    first: the least i such that a[i] > b[d - i - 1], found for all diagonals at once."""
    low = np.maximum(0, diagonals - len(b))
    high = np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        before = np.zeros(len(middle), bool)
        before[open_] = a[middle[open_]] <= b[diagonals[open_] - middle[open_] - 1]
        low = np.where(open_ & before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)
    return low


def common_ends(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b``, both increasing, of the ends they share."""
    total = len(a) + len(b)
    diagonals = np.append(np.arange(0, total, work), total)
    from_a = crossings(a, b, diagonals)
    from_b = diagonals - from_a
    found_a, found_b = [], []
    for i0, i1, j0, j1 in zip(from_a, from_a[1:], from_b, from_b[1:]):
        # an end of a may meet its like only in this piece or as the next piece's first of b
        own, other = a[i0:i1], b[j0 : min(j1 + 1, len(b))]
        if not len(own) or not len(other):
            continue
        at = np.minimum(np.searchsorted(other, own), len(other) - 1)
        hit = np.flatnonzero(other[at] == own)
        found_a.append(hit + i0)
        found_b.append(at[hit] + j0)
    none = [np.zeros(0, "i8")]
    return np.concatenate(found_a or none), np.concatenate(found_b or none)


def spelled(own: Tokenizers, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """The tokens of all groups in the order they are written, as places in ``own.signs``.

    ``at_a`` and ``at_b`` are the last tokens of the groups.
    """
    n_a, n_b = len(own.a_bytes), len(own.b_bytes)
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[at_a], last_b[at_b] = True, True
    # tokens of the other side that are written before: those of earlier groups, and for B
    # also those of its own group
    group_a = np.cumsum(last_a) - last_a
    group_b = np.cumsum(last_b) - last_b
    ends_a = np.concatenate([[0], at_a + 1])
    ends_b = np.concatenate([[0], at_b + 1])
    out = np.empty(len(a) + len(b), "i4")
    out[np.arange(len(a)) + ends_b[group_a]] = a + n_a * last_a
    out[np.arange(len(b)) + ends_a[group_b + 1]] = b + 2 * n_a + n_b * last_b
    return out


# --- bundles ---------------------------------------------------------------------------------

BUNDLES = (
    "bundle string, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "groups_sha256 array<string>, links binary, pair array<long>, times array<long>"
)


def bundled(docs: DataFrame, a_path: str, b_path: str, size: int = BUNDLE) -> DataFrame:
    """One row for each bundle of texts: their ids, sizes and digests, the different linked
    pairs with their numbers, and for every link, text by text, its pair's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers_of(a_path, b_path)
        for batch in batches:
            for start, end, texts in text_pieces(batch.column("text"), size):
                yield _bundle(own, batch.column("doc_id").slice(start, end - start), texts)

    tuned(docs.sparkSession)
    rows = docs.select(docs["`doc_id`"].cast("long").alias("doc_id"), docs["`text`"].alias("text"))
    return rows.mapInArrow(run, BUNDLES)


def _bundle(own: Tokenizers, doc_ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
    pairs = own.encode(texts)
    n_a = np.array([len(x) for x, _ in pairs], "i8") // 4
    n_b = np.array([len(y) for _, y in pairs], "i8") // 4
    a = np.frombuffer(b"".join([x for x, _ in pairs]), "<i4").astype("i8")
    b = np.frombuffer(b"".join([y for _, y in pairs]), "<i4").astype("i8")
    del pairs
    at_a, at_b = common_ends(np.cumsum(own.a_size[a]), np.cumsum(own.b_size[b]))
    order = spelled(own, a, b, at_a, at_b)
    stops = np.cumsum(n_a + n_b)
    digests = []
    for start, stop in zip((stops - n_a - n_b).tolist(), stops.tolist()):
        text = "".join(map(own.signs.__getitem__, order[start:stop].tolist()))[:-1]
        digests.append(sha256(text.encode()).hexdigest() if text else "")
    # the end of each text is a common end, so no group spans two texts
    n_groups = np.diff(np.searchsorted(at_a, np.cumsum(n_a)), prepend=0)
    different, links, times = np.unique(a[at_a] * len(own.b_bytes) + b[at_b], return_inverse=True, return_counts=True)
    return pa.RecordBatch.from_pydict(
        {
            "bundle": [uuid.uuid4().hex],
            "doc_id": _listed(doc_ids, pa.int64()),
            "n_a": _listed(n_a, pa.int64()),
            "n_b": _listed(n_b, pa.int64()),
            "n_groups": _listed(n_groups, pa.int64()),
            "groups_sha256": _listed(digests, pa.string()),
            "links": pa.array([links.astype("<u4").tobytes()], pa.binary()),
            "pair": _listed(different, pa.int64()),
            "times": _listed(times, pa.int64()),
        }
    )


def _listed(values, kind: pa.DataType) -> pa.ListArray:
    flat = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def link_counts(bundles: DataFrame, b_count: int) -> DataFrame:
    """pair (A id times ``b_count`` plus B id), count, best (no A id is linked to that B id
    more often)."""
    each = bundles.select(F.explode(F.arrays_zip("pair", "times")).alias("x")).select("x.pair", "x.times")
    counts = each.groupBy("pair").agg(F.sum("times").alias("count"))
    counts = written(counts.withColumn("b", F.col("pair") % b_count), "pairs")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            n = row["n_groups"].values.to_numpy()
            links = np.frombuffer(row["links"].as_py(), "<u4")
            count, best = np.zeros(0, "i8"), np.zeros(0, "i8")
            if len(links):
                found = row["found"].values
                place = found.field("at").to_numpy()
                count, best = np.empty((2, len(place)), "i8")
                count[place] = found.field("count").to_numpy()
                best[place] = found.field("best").cast(pa.int64()).to_numpy()
            ends = np.cumsum(n)
            sums = [np.concatenate([[0], np.cumsum(x[links])]) for x in (count, best)]
            count_sum, n_best = (s[ends] - s[ends - n] for s in sums)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": row["doc_id"].values,
                    "n_a": row["n_a"].values,
                    "n_b": row["n_b"].values,
                    "n_groups": row["n_groups"].values,
                    "n_links": pa.array(n, pa.int64()),
                    "n_best": pa.array(n_best, pa.int64()),
                    "count_sum": pa.array(count_sum, pa.int64()),
                    "groups_sha256": row["groups_sha256"].values,
                }
            )


def align(docs: DataFrame, a_path: str, b_path: str, size: int = BUNDLE) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    import sentencepiece

    b_count = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    bundles = written(bundled(docs, a_path, b_path, size), "bundles")
    counts = link_counts(bundles, b_count)
    wanted = bundles.select("bundle", F.posexplode("pair").alias("at", "pair"))
    figures = F.collect_list(F.struct("at", "count", "best")).alias("found")
    found = wanted.join(counts, "pair").groupBy("bundle").agg(figures)
    return bundles.drop("pair", "times").join(found, "bundle", "left").mapInArrow(_looked_up, RESULT)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), vocabulary_path(A_FILE), vocabulary_path(B_FILE))
