"""Token files of directly addressable codes.

An id is cut into chunks of eight bits, low ones first. Level 0 holds every token's lowest chunk,
level 1 the next chunk of those tokens that have one, and so on. A bitmap per level says which of
its tokens go on, and a rank directory counts the set bits before each block of 512, so the place
of a token on the next level is one directory entry plus the set bits of one block. Any token, or
any range of them, is read without decoding what lies before it.

A file is a Parquet part whose rows are segments: the codes of consecutive whole documents, closed
at `SEGMENT` tokens. Parts and segments follow the order of doc_id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import Columns, map_columns, running_offsets
from promolens.llm.wordpieces import AT_ONCE, word_ids
from promolens.sources import scratch_dir

CHUNK = 8
BLOCK = 512  # bits a directory entry covers
SEGMENT = 1 << 18  # a segment is closed once it holds as many tokens

SEGMENTS = (
    "part long, segment long, before long, tokens long, doc_ids array<long>, "
    "starts array<long>, chunks array<binary>, marks array<binary>, ranks array<binary>"
)


def encode_codes(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Chunks, continuation bitmaps and rank directories of each level."""
    chunks, marks, ranks = [], [], []
    left = ids.astype(np.uint32)
    while True:
        rest = left >> CHUNK
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        per_block = np.add.reduceat(more, np.arange(0, max(len(more), 1), BLOCK)) if len(more) else []
        counts = np.concatenate([[0], np.cumsum(per_block)])
        chunks.append((left & 0xFF).astype(np.uint8).tobytes())
        marks.append(bits.tobytes())
        ranks.append(counts.astype("<u4").tobytes())
        left = rest[more]
        if not len(left):
            return chunks, marks, ranks


class Codes:
    """Random access to the tokens of one segment."""

    def __init__(self, chunks: list[bytes], marks: list[bytes], ranks: list[bytes]):
        self._levels = [
            (np.frombuffer(c, np.uint8), np.frombuffer(m, np.uint8), np.frombuffer(r, "<u4"))
            for c, m, r in zip(chunks, marks, ranks)
        ]

    @staticmethod
    def _rank(marks: np.ndarray, ranks: np.ndarray, at: int) -> int:
        """Set bits before `at`."""
        block = at // BLOCK
        first = block * BLOCK // 8
        bits = np.unpackbits(marks[first : -(-at // 8)], bitorder="little")
        return int(ranks[block]) + int(bits[: at - block * BLOCK].sum())

    def tokens(self, start: int, end: int) -> np.ndarray:
        """Ids start to end of the segment, read from their own places only."""
        out = np.zeros(end - start, np.uint32)
        slots = np.arange(end - start)
        for level, (chunks, marks, ranks) in enumerate(self._levels):
            out[slots] |= chunks[start:end].astype(np.uint32) << np.uint32(CHUNK * level)
            first = start // 8
            bits = np.unpackbits(marks[first : -(-end // 8)], bitorder="little")
            more = bits[start - 8 * first : end - 8 * first].astype(bool)
            slots = slots[more]
            if not len(slots):
                break
            start = self._rank(marks, ranks, start)
            end = start + len(slots)
        return out

    def token(self, at: int) -> int:
        return int(self.tokens(at, at + 1)[0])


def write_files(docs: DataFrame, path: str, tokenizer: str, end: int = 1) -> None:
    """Encode `docs` (doc_id, text), each with the end id, in ascending doc_id order.

    One shuffle, of the texts by ranges of doc_id; each task encodes and writes its range. Ties
    of doc_id are ordered by text. A NULL doc_id comes first, a NULL text counts as empty.
    """
    ending = end.to_bytes(4, "little")

    def rows(batches: Iterable[Columns]) -> Iterator[Columns]:
        encode, part = word_ids(tokenizer).encode, TaskContext.get().partitionId()
        segment = before = 0
        ids: list[bytes] = []
        doc_ids: list[int] = []
        starts = [0]

        def close() -> Columns:
            chunks, marks, ranks = encode_codes(np.frombuffer(b"".join(ids), "<u4"))
            row = (part, segment, before, starts[-1], list(doc_ids), list(starts[:-1]))
            return {
                k: [v]
                for k, v in zip(
                    (c.split()[0] for c in SEGMENTS.split(", ")), (*row, chunks, marks, ranks)
                )
            }

        for batch in batches:
            for doc_id, of_doc in zip(batch["doc_id"], encode(batch["text"])):
                ids.append(of_doc + ending)
                doc_ids.append(doc_id)
                starts.append(starts[-1] + len(ids[-1]) // 4)
                if starts[-1] >= SEGMENT:
                    yield close()
                    segment, before = segment + 1, before + starts[-1]
                    ids, doc_ids, starts = [], [], [0]
        if doc_ids:
            yield close()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    map_columns(ordered, rows, SEGMENTS, AT_ONCE).write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENTS).parquet(path)


def read_documents(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian bytes) of every document in the files.

    `start` counts the ids of all documents before: those of earlier parts, of earlier segments of
    the part, and of the segment.
    """

    def rows(batches: Iterable[Columns]) -> Iterator[Columns]:
        for batch in batches:
            for i, part in enumerate(batch["part"]):
                codes = Codes(batch["chunks"][i], batch["marks"][i], batch["ranks"][i])
                starts, total = batch["starts"][i], batch["tokens"][i]
                ends = [*starts[1:], total]
                # Every document is wanted, so the segment is one range.
                ids = codes.tokens(0, total).astype("<u4", copy=False).tobytes()
                yield {
                    "part": [part] * len(starts),
                    "doc_id": batch["doc_ids"][i],
                    "start": [batch["before"][i] + s for s in starts],
                    "n_tokens": [e - s for s, e in zip(starts, ends)],
                    "ids": [ids[4 * s : 4 * e] for s, e in zip(starts, ends)],
                }

    schema = "part long, doc_id long, start long, n_tokens long, ids binary"
    parts = segments.groupBy("part").agg(F.sum("tokens").alias("n"))
    offsets = running_offsets(parts, ["part"], "n", "earlier").select("part", "earlier")
    return (
        map_columns(segments, rows, schema)
        .join(F.broadcast(offsets), "part")  # one row for each task that wrote
        .select("doc_id", (F.col("start") + F.col("earlier")).alias("start"), "n_tokens", "ids")
    )


def round_trip(docs: DataFrame, tokenizer: str, end: int = 1) -> DataFrame:
    """Write `docs` to files in the shared folder and read every document back from them."""
    path = scratch_dir(docs.sparkSession)
    write_files(docs, path, tokenizer, end)
    return read_documents(read_segments(docs.sparkSession, path))
