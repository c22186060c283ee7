"""Packing by power-of-two decomposition.

A document of n tokens becomes n // size full pieces and one piece for each binary digit of the
rest, long ones first. Every piece is a sequence by itself: its length is a power of two, so it
needs no padding, and no sequence crosses documents. Sequences of one length form a bucket, and
their ids are consecutive in it, so a batch is a range of ids.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import Columns, map_columns, stored
from promolens.llm.wordpieces import AT_ONCE, word_ids

END = 1
WIDTH = 4  # bytes of an id


def binary_lengths(n: int, size: int) -> list[int]:
    """Lengths of the pieces of n tokens: full ones, then the binary digits of the rest."""
    rest = n % size
    digits = [1 << k for k in range(size.bit_length() - 1, -1, -1) if rest >> k & 1]
    return [size] * (n // size) + digits


def pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary), doc_tokens, and the place a task
    met it at: part, and number among the task's pieces of this length."""
    if size < 1 or size & (size - 1):
        raise ValueError("size must be a power of two")
    ending = end.to_bytes(WIDTH, "little")

    def rows(batches: Iterable[Columns]) -> Iterator[Columns]:
        encode, met = word_ids(tokenizer).encode, {}
        part = TaskContext.get().partitionId()
        for batch in batches:
            out: Columns = {k: [] for k in PIECE_COLUMNS}
            for doc_id, ids in zip(batch["doc_id"], encode(batch["text"])):
                ids += ending
                total, start = len(ids) // WIDTH, 0
                for n in binary_lengths(total, size):
                    row = (doc_id, start, n, ids[start * WIDTH : (start + n) * WIDTH], total)
                    number = met[n] = met.get(n, -1) + 1
                    for column, value in zip(out.values(), (*row, part, number)):
                        column.append(value)
                    start += n
            yield out

    schema = ", ".join(f"{k} {v}" for k, v in PIECE_COLUMNS.items())
    return map_columns(docs.select("doc_id", "text"), rows, schema, AT_ONCE)


PIECE_COLUMNS = {
    "doc_id": "long",
    "start": "long",
    "length": "long",
    "ids": "binary",
    "doc_tokens": "long",
    "part": "long",
    "number": "long",
}


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end: int = END) -> DataFrame:
    """Sequences of `docs` (doc_id, text): doc_id, start, length, ids, doc_tokens, sequence_id,
    offset.

    The pieces are written once, with the number each task gave them; a sequence's id is that
    number plus the count of pieces in longer buckets and in the same bucket of earlier tasks. So
    no row of ids is shuffled, and the counts are as few as tasks times lengths.

    A NULL text counts as empty and yields one piece, the end id. Repeated rows are documents of
    their own. A NULL doc_id stays NULL. No rows give no rows. Other columns are ignored.
    """
    cut = stored(pieces(docs, tokenizer, size, end))
    before = Window.orderBy(F.desc("length"), "part").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        cut.groupBy("length", "part")
        .agg(F.count("*").alias("n"))
        .select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    # One row for each task and length: the ids are not shuffled for it.
    return cut.join(F.broadcast(counts), ["length", "part"]).select(
        "doc_id",
        "start",
        "length",
        "ids",
        "doc_tokens",
        (F.col("first") + F.col("number")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
