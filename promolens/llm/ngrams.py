"""Character n-grams of whole texts as hashes, by numpy inside the tasks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

SPAN = 1 << 19  # symbols hashed at a time, so that a very long text takes bounded memory
_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def symbols(text: str) -> np.ndarray:
    """Code points of the lower-cased letters; each run of other characters, and each end of the
    text, is one zero. Empty if the text has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    points = np.where(_letters()[points], points, 0)
    padded = np.concatenate([[0], points, [0]])
    kept = padded[(padded != 0) | np.concatenate([[True], padded[:-1] != 0])]
    return kept.astype(np.uint64) if len(kept) > 1 else np.zeros(0, np.uint64)


def hashes(text: str, orders: tuple[int, ...]) -> Iterator[np.ndarray]:
    """64-bit hashes of the n-grams of each order that lie within a word and its two borders."""
    line = symbols(text)
    most = max(orders)
    for start in range(0, max(len(line) - 2, 0), SPAN):
        span = line[start : start + SPAN + most - 1]
        for n in orders:
            size = min(len(span) - n + 1, SPAN)
            if size <= 0:
                continue
            code = np.full(size, np.uint64(n))
            inner = np.ones(size, bool)
            for k in range(n):
                code = code * _MIX[0] + span[k : k + size]
                if 0 < k < n - 1:
                    inner &= span[k : k + size] != 0
            code = code[inner]
            code ^= code >> np.uint64(31)
            code *= _MIX[1]
            yield code ^ (code >> np.uint64(29))
