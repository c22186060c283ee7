"""Isotonic regression by pooling adjacent violators, range by range.

Scores are folded to their weight and mean, dealt to ranges, and each range pools its own
violators into blocks. What a range has pooled stays pooled whatever lies beside it, so ranges are
then merged: blocks of neighbouring ranges are pooled again, fewer ranges each round, and the last
round gives the blocks of all scores. A round passes on blocks, never scores.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from promolens.sources import scratch_dir

BLOCK = "low double, high double, weight double, total double"
#: Ranges that are pooled together in one round.
MERGED = 32

#: Lowest and highest score, weight, and weighted sum of the values.
Block = tuple[float, float, float, float]


def pooled(blocks: Iterable[Block]) -> list[Block]:
    """Blocks in the order of their scores, neighbours joined until their means rise."""
    out: list[Block] = []
    for low, high, weight, total in blocks:
        # Compared as products, so that equal means are joined exactly as they are summed.
        while out and out[-1][3] * weight >= total * out[-1][2]:
            first, _, w, t = out.pop()
            low, weight, total = first, w + weight, t + total
        out.append((low, high, weight, total))
    return out


def _pool_partitions(df: DataFrame) -> DataFrame:
    """The blocks of each partition, whose rows are sorted."""
    kind = to_arrow_schema(StructType.fromDDL(BLOCK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        found = pooled(rows)
        if found:
            columns = [pa.array(c, pa.float64()) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays(columns, schema=kind)

    return df.select("low", "high", "weight", "total").mapInArrow(run, BLOCK)


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def isotonic_blocks(
    df: DataFrame, score: str, value: str, ranges: int | None = None, merged: int = MERGED
) -> DataFrame:
    """low, high, weight, total and fitted (their quotient) of the blocks of the non-decreasing
    step function of `score` that is nearest to `value` in squares, in any order.

    Rows with a NULL score or value are left out; without rows there are no blocks. The merging
    rounds run when this is called: as many as the logarithm of `ranges` (by default the session's
    shuffle partitions) to the base `merged`.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    x, y = F.col(score).cast("double"), F.col(value).cast("double")
    folded = (
        df.where(x.isNotNull() & y.isNotNull())
        .groupBy(x.alias("low"))
        .agg(F.count(F.lit(1)).cast("double").alias("weight"), F.sum(y).alias("total"))
        .withColumn("high", F.col("low"))
    )
    while True:
        dealt = folded.repartitionByRange(ranges, "low").sortWithinPartitions("low")
        found = _stored(_pool_partitions(dealt))
        if ranges == 1:
            return found.withColumn("fitted", F.col("total") / F.col("weight"))
        folded, ranges = found, -(-ranges // merged)


def calibrated(df: DataFrame, blocks: DataFrame, score: str, name: str = "calibrated") -> DataFrame:
    """`df` with the fitted value of its score: constant inside a block, linear between the ends of
    two blocks, constant beyond the first and the last; NULL for a NULL score or without blocks.

    A score is placed among the blocks' lower ends by one merge of both in the order of scores: the
    blocks are small next to the rows, so they are one sorted array, a scalar of the same plan. It
    is never a column, since each row would carry a copy of all blocks, and the search among them
    takes compiled expressions only. The blocks are counted when this is called.
    """
    rows = blocks.select(F.struct("low", "high", "fitted").alias("b"))
    table = rows.agg(F.sort_array(F.collect_list("b")).alias("t")).scalar()
    at = F.col("_at")
    last = F.size(table)
    inside = F.get(table, at - 1)
    after = F.get(table, at)
    x = F.col(score).cast("double")
    share = (x - inside["high"]) / (after["low"] - inside["high"])
    between = inside["fitted"] + share * (after["fitted"] - inside["fitted"])
    fitted = (
        F.when(x.isNull() | (last == 0), F.lit(None).cast("double"))
        .when(at == 0, after["fitted"])
        .when((x <= inside["high"]) | (at == last), inside["fitted"])
        .otherwise(between)
    )
    # How many blocks begin at or below the score.
    placed = _begun(df, table, blocks.count(), x)
    return placed.withColumn(name, fitted).drop("_at", "_end")


def _begun(df: DataFrame, table: Column, n: int, x: Column) -> DataFrame:
    """`df` with `_at`, how many of the `n` sorted blocks begin at or below `x`, by bisection."""
    low, high = F.col("_at"), F.col("_end")
    middle = F.shiftright(low + high, 1)
    begun = F.coalesce(F.get(table, middle)["low"] <= x, F.lit(False))
    df = df.withColumns({"_at": F.lit(0), "_end": F.lit(n)})
    for _ in range(n.bit_length()):
        df = df.withColumns(
            {
                "_at": F.when((low < high) & begun, middle + 1).otherwise(low),
                "_end": F.when((low < high) & ~begun, middle).otherwise(high),
            }
        )
    return df
