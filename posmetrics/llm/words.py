"""Words of many texts at once, as arrays of 64-bit hashes.

A word is a run of ASCII letters and digits or of characters beyond ASCII that are no
punctuation or space; case does not count. Work is over the bytes of a batch, so cost and
memory are proportional to it and no Python object is made for a word.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD = np.zeros(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _WORD[_a:_b] = True
# punctuation and spaces beyond ASCII
_BREAKS = re.compile("[\x80-\xa9\xab-\xb4\xb6-\xb9\xbb-\xbf\xd7\xf7\u2000-\u206f\u2e00-\u2e7f\u3000-\u303f\uff01-\uff0f\uff1a-\uff20]")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _lower(text: str) -> str:
    """Lower case that keeps the length of every character in UTF-8."""
    low = text.lower()
    if len(low) == len(text) and len(low.encode()) == len(text.encode()):
        return low
    return "".join(x if len((x := c.lower()).encode()) == len(c.encode()) and len(x) == 1 else c for c in text)


@dataclass
class Words:
    raw: np.ndarray  # bytes of all texts, a line break after each
    start: np.ndarray  # of each word, in bytes
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # index of each text's first word, and the number of words

    def doc(self) -> np.ndarray:
        """Text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, i: int) -> str:
        return self.raw[self.start[i] : self.end[i]].tobytes().decode()


def words(texts: list[str]) -> Words:
    cleaned = [_BREAKS.sub(" ", t) if not t.isascii() else t for t in texts]
    parts = [t.encode() for t in cleaned]
    raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    low = np.frombuffer(b"\n".join(_lower(t).encode() for t in cleaned) + b"\n", np.uint8)
    inside = _WORD[raw]
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    start, end = edge[0::2], edge[1::2]
    if len(end) < len(start):  # cannot be: the last byte is a line break
        end = np.append(end, len(raw))
    if len(start):
        size = end - start
        at = np.flatnonzero(inside)
        first_byte = np.cumsum(size) - size
        within = np.arange(len(at)) - np.repeat(first_byte, size)
        with np.errstate(over="ignore"):
            power = np.cumprod(np.full(int(size.max()), _BASE, np.uint64))
            hashes = mix(np.add.reduceat(_BYTE[low[at]] * power[within], first_byte))
    else:
        hashes = np.zeros(0, np.uint64)
    ends = np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts)))
    first = np.concatenate([[0], np.searchsorted(start, ends)])
    return Words(raw, start, end, hashes, first)


def windows(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """A hash of each run of ``width`` consecutive entries (also across texts)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(seed), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = out * _BASE + hashes[k : k + n]
    return mix(out)
