"""Importance resampling of documents towards a target distribution.

A feature is a run of one or two consecutive words, hashed to a bucket. A bucket's gain is the log
of how much more frequent it is in the target texts than in the documents; a document's weight is
the mean gain of its features, looked up in one array of all buckets. Gumbel noise from the hashed
doc_id is added, and the documents of highest score are drawn: a weighted draw without replacement.

The draw sorts nothing but what it draws. Scores are stored once; the score of the last drawn
document is found by numeric bisection, each round one exact count over the stored scores, and
among the documents tied at it the last doc_id in the same way. The rows above this cutoff are then
dealt to ranges of their order, and numbered.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import Columns, map_columns, running_offsets, stored

BUCKETS = 10000
LEAST_WORDS = 20  # words a document needs to be drawn
PERCENT = 25  # of those documents that are drawn
SEED = 7
WAYS = 16  # parts a round of the bisection cuts the numbers left into
SPAN = 1 << 20  # bytes of a text whose words are listed at a time
LONGEST = 64  # bytes of a word up to which its shift lies in the table

#: A-Z lower-cased, all that separates words a space.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def _shifts() -> np.ndarray:
    """For each number of bytes up to `LONGEST` the four tables of bytes of a crc32 that give the
    crc32 after so many zero bytes, so that crc32(a + b) = shifted crc32(a) ^ crc32(b)."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    out = np.empty((LONGEST + 1, 4, 256), np.uint32)
    out[0] = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
    for n in range(1, LONGEST + 1):
        out[n] = (out[n - 1] >> 8) ^ step[out[n - 1] & 255]
    return out


_SHIFTS = _shifts()
_SPACE = np.uint32(zlib.crc32(b" "))


def _shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (
        _SHIFTS[n, 0, crc & 255]
        ^ _SHIFTS[n, 1, (crc >> 8) & 255]
        ^ _SHIFTS[n, 2, (crc >> 16) & 255]
        ^ _SHIFTS[n, 3, crc >> 24]
    )


def _word_lists(text: str | None) -> Iterator[list[bytes]]:
    """The text's words, some at a time; each list but the first begins with the last word before."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS)
    start, last = 0, []
    while start < len(data):
        end = data.find(b" ", start + SPAN)
        end = len(data) if end < 0 else end
        words = last + data[start:end].split()
        start = end
        if words:
            yield words
            last = words[-1:]


def features(text: str | None, buckets: int = BUCKETS) -> tuple[int, list[np.ndarray]]:
    """The number of words, and the buckets of all features, repeats included."""
    total, found = 0, []
    for words in _word_lists(text):
        known = 1 if total else 0
        total += len(words) - known
        crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        found.append(crc[known:] % np.uint32(buckets))
        if len(words) > 1:
            size = np.fromiter(map(len, words), np.int64, len(words))[1:]
            left = _shifted(crc[:-1], np.int64(1)) ^ _SPACE
            pairs = _shifted(left, np.minimum(size, LONGEST)) ^ crc[1:]
            for i in np.flatnonzero(size > LONGEST):
                pairs[i] = zlib.crc32(words[i + 1], int(left[i]))
            found.append(pairs % np.uint32(buckets))
    return total, found


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows of `texts` (text) lie in each bucket.

    A task counts its rows into one array, so as many rows as tasks times buckets are shuffled at
    most; the driver gets one number a bucket.
    """

    def count(batches: Iterable[Columns]) -> Iterator[Columns]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            found = [part for text in batch["text"] for part in features(text, buckets)[1]]
            if found:
                total += np.bincount(np.concatenate(found), minlength=buckets)
        some = np.flatnonzero(total)
        yield {"bucket": some, "n": total[some]}

    counted = map_columns(texts.select("text"), count, "bucket long, n long")
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket 1000 times the log of its smoothed share in the target over that in the
    documents, floored."""
    s, t, buckets = int(documents.sum()), int(target.sum()), len(documents)
    return np.array(
        [
            math.floor(1000 * math.log((b + 1.0) * (s + buckets) / ((a + 1.0) * (t + buckets))))
            for a, b in zip(documents.tolist(), target.tolist())
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Floored Gumbel noise of a doc_id, in thousandths."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of each whole text."""
    buckets = len(gain)

    def rows(batches: Iterable[Columns]) -> Iterator[Columns]:
        for batch in batches:
            out: Columns = {k: [] for k in ("n_words", "n_features", "weight", "score")}
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words, found = features(text, buckets)
                n = sum(map(len, found))
                weight = int(sum(int(gain[f].sum()) for f in found)) // n if n else 0
                for column, value in zip(out.values(), (words, n, weight, weight + noise(doc_id, seed))):
                    column.append(value)
            yield {"doc_id": batch["doc_id"]} | out

    schema = "doc_id long, n_words long, n_features long, weight long, score long"
    return map_columns(docs.select("doc_id", "text"), rows, schema)


def _least(rows: DataFrame, number: Column, wanted: int) -> int | None:
    """The least value of `number` up to which `rows` has at least `wanted` rows, by bisection
    with exact counts; None if it has fewer."""
    ends = rows.agg(F.min(number).alias("low"), F.max(number).alias("high"), F.count(number).alias("n"))
    low, high, n = ends.first()
    if n < wanted:
        return None
    while low < high:
        inner = sorted({low + (high - low) * k // WAYS for k in range(WAYS)})
        counts = rows.agg(*(F.count_if(number <= x).alias(f"n{i}") for i, x in enumerate(inner))).first()
        reached = [x for x, c in zip(inner, counts) if c >= wanted]
        short = [x for x, c in zip(inner, counts) if c < wanted]
        low, high = (short[-1] + 1 if short else low), (reached[0] if reached else high)
    return low


def drawn(table: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of a stored `table` (doc_id, n_words, score, ...) with rank 1, 2, ... of the drawn
    ones, NULL for the others: floor(percent of the documents with at least `least_words` words)
    of the highest scores, ties to smaller doc_ids, NULL last.

    Rows alike in score and doc_id are ranked in the order they are stored in.
    """
    rest = table.withColumn("rank", F.lit(None).cast("long"))
    able = F.col("n_words") >= least_words
    wanted = table.where(able).count() * percent // 100
    if not wanted:
        return rest
    eligible = table.where(able)
    cut = -_least(eligible, -F.col("score"), wanted)
    above = eligible.where(F.col("score") > cut).count()
    last = _least(eligible.where(F.col("score") == cut), F.col("doc_id"), wanted - above)
    tied = F.lit(True) if last is None else F.coalesce(F.col("doc_id") <= last, F.lit(False))
    taken = able & ((F.col("score") > cut) | ((F.col("score") == cut) & tied))

    # `row` splits ranges of repeated rows.
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    ranged = table.where(taken).withColumn("row", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stored(ranged.withColumn("at", F.monotonically_increasing_id()))
    # A row's number: its task's in the upper bits, its place in the task in the lower 33.
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    ranged = ranged.withColumns({"part": part, "place": place})
    parts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    # One row for each task that ranked.
    offsets = F.broadcast(running_offsets(parts, ["part"], "rows", "earlier").select("part", "earlier"))
    rank = F.col("earlier") + F.col("place") + 1
    ranked = ranged.join(offsets, "part").withColumn("rank", F.when(rank <= wanted, rank))
    return ranked.select(rest.columns).unionByName(rest.where(~taken))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Draw from `docs` (doc_id, text) documents that are like the texts of `target` (text):
    doc_id, n_words, n_features, weight, score, rank (NULL: not drawn).

    Words are runs of letters and digits of ASCII, A-Z lower-cased, and of all other characters.
    A NULL or empty text has no features, weight 0, and is never drawn where words are asked for.
    Without target texts all gains are those of unseen buckets. A NULL doc_id has the noise of an
    empty one. Repeated rows are documents of their own with equal scores. No rows give no rows.
    Other columns are ignored.
    """
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    return drawn(stored(scored(docs, gain, seed)), percent, least_words)
