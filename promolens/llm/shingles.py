"""Word shingles of whole texts as hashes, and HyperMinHash registers of shingle sets."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

WORDS = 5
SPAN = 1 << 20  # bytes hashed at a time, so that a very long text takes bounded memory
REGISTERS = 512
_TOP = np.uint64(64 - 9)  # the top 9 bits choose one of the registers
MANTISSA = 10  # bits kept below the leading one
BAND = 7  # registers of a band; 73 bands

_GAP = re.compile(rb"[\x20\x09-\x0d]")
_M = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * _M[1]
    x = x ^ (x >> np.uint64(27))
    x = x * _M[2]
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, _M[0])]))


_SHORT = _powers(256)


def _word_hashes(data: bytes) -> np.ndarray:
    """A hash of each word; `data` ends between words."""
    points = np.frombuffer(data, np.uint8)
    inside = (points != 32) & ((points < 9) | (points > 13))
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    if not len(starts):
        return np.zeros(0, np.uint64)
    points = points[inside].astype(np.uint64) + np.uint64(1)
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]]))
    lengths = ends - starts + 1
    firsts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    at = np.arange(len(points)) - np.repeat(firsts, lengths)
    longest = int(lengths.max())
    powers = _SHORT if longest < len(_SHORT) else _powers(longest)
    return mix(np.add.reduceat(points * powers[at], firsts) + lengths.astype(np.uint64))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of five words, A-Z lower-cased.

    Fewer words are one shingle; no words give an empty set.
    """
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    parts, start = [], 0
    while start < len(data):
        gap = _GAP.search(data, start + SPAN)
        end = gap.start() if gap else len(data)
        parts.append(_word_hashes(data[start:end]))
        start = end
    words = np.concatenate([*parts, np.zeros(0, np.uint64)])
    if not len(words):
        return words
    n = min(WORDS, len(words))
    code = np.full(len(words) - n + 1, np.uint64(n))
    for k in range(n):
        code = mix(code * _M[0] + words[k : k + len(code)])
    return np.unique(code)


def registers(found: np.ndarray) -> np.ndarray:
    """Of each bucket's least hash the count of leading zeros and the bits after the first one,
    larger for smaller hashes; 0 in an empty bucket. `found` is sorted."""
    out = np.zeros(REGISTERS, np.uint16)
    bucket = (found >> _TOP).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])[: len(found)])
    rest = found[first] << (np.uint64(64) - _TOP)
    mantissa, exponent = np.frexp(rest.astype(np.float64))
    zeros = np.minimum(64 - exponent, 62)
    bits = np.clip((mantissa - 0.5) * (2 << MANTISSA), 0, (1 << MANTISSA) - 1).astype(np.int64)
    out[bucket[first]] = 1 + (zeros << MANTISSA) + ((1 << MANTISSA) - 1 - bits)
    return out


@lru_cache(maxsize=1)
def _borrowing() -> np.ndarray:
    """For each bucket a fixed random order of all buckets."""
    draw = np.random.default_rng(20240501)
    return np.argsort(draw.random((REGISTERS, REGISTERS)), axis=1).astype(np.uint16)


def filled(own: np.ndarray) -> np.ndarray:
    """Registers in which an empty bucket borrows from the filled one that comes first in its own
    order, so that two sets agree in any register with the probability of their likeness."""
    some = np.flatnonzero(own)
    none = np.flatnonzero(own == 0)
    if not len(none) or not len(some):
        return own
    out = own.copy()
    out[none] = own[some[_borrowing()[np.ix_(none, some)].argmin(axis=1)]]
    return out


def bands(own: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of registers; keys of different bands differ."""
    n = REGISTERS // BAND
    rows = filled(own)[: n * BAND].astype(np.uint64).reshape(n, BAND)
    code = mix(np.arange(n, dtype=np.uint64) + _M[0])
    for k in range(BAND):
        code = mix(code * _M[0] + rows[:, k])
    return code


def estimate(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """Likeness by the registers two sets have in common, less those that agree by chance, and
    the standard error at a likeness of 0.75."""
    either = np.count_nonzero((a > 0) | (b > 0))
    same = np.count_nonzero((a == b) & (a > 0))
    chance = 0.4 / (1 << MANTISSA)
    likeness = (same / max(either, 1) - chance) / (1 - chance)
    return max(likeness, 0.0), (0.1875 / max(either, 1)) ** 0.5
