"""Word sequences of whole texts as 64-bit hashes, made with numpy for a slice of texts at a time."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

from churnlens.llm.common import SPACE_BYTES

_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


CHUNK = 1 << 18


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    up, down = np.full(n, _BASE), np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of every text, offsets of the texts into it); null counts as empty.

    A word's hash depends on its bytes alone (``lower``: A-Z as a-z).
    """
    values = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    x = np.frombuffer(b" " + b" ".join(values) + b" ", np.uint8)
    if lower:
        x = _LOWER[x]
    space = SPACE_BYTES[x]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    h = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # some words at a time: the wide numbers of one chunk of bytes only
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + CHUNK, side="right")))
        n = int(ends[to - 1] - base)
        up, down = _powers(CHUNK) if n <= CHUNK else _powers.__wrapped__(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((x[base:base + n].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        h[at:to] = (sums[ends[at:to] - base] - sums[starts[at:to] - base]) * down[starts[at:to] - base]
        at = to
    h = mix(h)
    begins = 1 + np.concatenate([[0], np.cumsum([len(v) + 1 for v in values])])
    return h, np.searchsorted(starts, begins)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words (crossing texts too; the caller leaves those out)."""
    count = max(0, len(words) - n + 1)
    h = np.zeros(count, np.uint64)
    for k in range(n):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words[k:k + count]
    return mix(h)
