"""Token counts by heap-and-linked-list byte-pair merging, without ever making an id.

A text is cut into stretches that no token can span (a run of spaces and what follows up
to the next space or line break). In each stretch the symbols form a linked list and a
heap holds the adjacent pairs that are pieces of the vocabulary; the pair of the best
score, leftmost first, is merged until none is left. The count is the initial symbols
less the merges; a symbol outside the vocabulary counts its UTF-8 bytes.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows each get
their own row; a null id is kept; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from posmetrics.llm.common import pieces, table, texts_of, tuned, vocabulary_path

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
SPACE = "\u2581"  # how the vocabulary writes a space
CACHE = 700_000
PIECE = 4_000_000
_STRETCH = re.compile(r" +[^ \n]*|[^ \n]+|\n")
_counters: dict[str, Counter] = {}


def load_scores(path: str) -> dict[str, int]:
    """Rank of each piece that a merge may make (0 is the best score; equal scores share
    a rank) from a model file of the sentencepiece library."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    score = {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    }
    rank = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
    return {piece: rank[s] for piece, s in score.items()}


class Counter:
    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=1) + 1
        self.known: dict[str, int] = {}
        # neighbours that some piece holds next to each other
        self.pairs = {p[i : i + 2].replace(SPACE, " ") for p in ranks for i in range(len(p) - 1)}
        # a cut at a line break needs that no piece holds one; otherwise texts stay whole
        self.lines = not any("\n" in p for p in ranks)
        self.inner = any(SPACE in p.lstrip(SPACE) for p in ranks)

    def merged(self, symbols: list[str]) -> int:
        """Tokens left of one stretch."""
        rank, n, wide = self.ranks.get, len(symbols), self.longest
        following = list(range(1, n + 1))
        previous = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            r = rank(pair)
            if r is not None:
                heap.append((r * n + i) * wide + len(pair))
        heapify(heap)
        left = n
        while heap:
            key, size = divmod(heappop(heap), wide)
            i = key % n
            j = following[i]
            # an entry is stale if either side has been merged since
            if j >= n or not symbols[i] or len(symbols[i]) + len(symbols[j]) != size:
                continue
            pair = symbols[i] + symbols[j]
            if rank(pair) != key // n:
                continue
            symbols[i], symbols[j] = pair, ""
            left -= 1
            after = following[i] = following[j]
            if after < n:
                previous[after] = i
                r = rank(pair + symbols[after])
                if r is not None:
                    heappush(heap, (r * n + i) * wide + size + len(symbols[after]))
            before = previous[i]
            if before >= 0:
                r = rank(symbols[before] + pair)
                if r is not None:
                    heappush(heap, (r * n + before) * wide + size + len(symbols[before]))
        return left + sum(len(s.encode()) - 1 for s in symbols if s and s not in self.ranks)

    def count(self, text: str) -> int:
        """Tokens of a whole text; a space is put before it, as the library does."""
        if not text:
            return 0
        if SPACE in text:
            text = text.replace(SPACE, " ")
        text = f" {text}"
        stretches = _STRETCH.findall(text) if self.lines and not self.inner else [text]
        known, total = self.known, 0
        for s in stretches:
            n = known.get(s)
            total += self.learn(s) if n is None else n
        return total

    def learn(self, stretch: str) -> int:
        """Count a new stretch; one last symbol that no piece joins to its neighbour, such
        as a full stop, is counted apart."""
        if 2 < len(stretch) <= 64 and stretch[-2:] not in self.pairs:
            body = self.known.get(stretch[:-1])
            n = (self.learn(stretch[:-1]) if body is None else body) + self.merged([stretch[-1]])
        else:
            n = self.merged(list(stretch.replace(" ", SPACE)))
        if len(stretch) <= 64:
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[stretch] = n
        return n


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(load_scores(path))
    return _counters[path]


def token_counts(
    docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for start, end in pieces(texts, PIECE):
                some = texts[start:end]
                n = [count(t) for t in some]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id").slice(start, end - start),
                        "n_bytes": pa.array([len(t.encode()) for t in some], pa.int64()),
                        "n_tokens": pa.array(n, pa.int64()),
                        "over_limit": pa.array([x > limit for x in n], pa.bool_()),
                    }
                )

    tuned(docs.sparkSession)
    rows = docs.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"`{text_col}` as text")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary_path(VOCABULARY))
