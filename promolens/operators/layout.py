"""Where a row of an ordered scan goes: one cell per key, many cells for a hot key.

A scan over time (or over a score) needs all rows of a key in order. A key with a large
share of all rows would put that share into one task, so such a key is cut along the order
column into cells, and `scan.ordered_scan` carries totals from cell to cell.

Hot keys are decided from counts, over all rows or over those a hash picks, and cut by rank; the
cuts are stored, so a recomputed task places a row in the same cell again. What is broadcast is bounded by counting,
whatever the data: a key is hot only above `1/chunks` of the counted rows, so there are fewer
than `chunks` hot keys, and heavy stretches are bounded in the same way. The layout decides
which task does what, never which rows count: the scan itself sees all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.sources import scratch_dir

CELL = "_cell"
# A hot key is found by this many of its rows; large inputs need not count them all.
WITNESSES = 10_000
# Position of a cell = stretch number * STEP + part within the stretch.
STEP = 1 << 24
# A hot key is cut by rank into so many stretches, and a stretch that stays large into as many.
PARTS = 128
# A task of a large scan gets about so many rows, however large the input.
TASK_ROWS = 100_000
# A dimension of more rows is never sent whole to every task.
SENT_ROWS = 100_000


@dataclass(frozen=True)
class Limits:
    """A task may hold up to max(`min_rows`, all rows / `chunks`) rows of one key.

    `at_most` is an upper bound on the rows of the inputs, where the caller knows one. An
    input no larger than `min_rows` needs no cells; without a bound it is counted first.
    """

    chunks: int = 16_384
    min_rows: int = 2_000_000
    at_most: int | None = None


@dataclass(frozen=True)
class Layout:
    keys: tuple[str, ...]
    order: str
    hot: DataFrame | None = None
    heavy: DataFrame | None = None
    #: How many tasks the rows are dealt to; None leaves it to the session.
    tasks: int | None = None

    @staticmethod
    def of(
        rows: DataFrame,
        keys: Sequence[str],
        order: str,
        limits: Limits | None = None,
        weight: str | None = None,
    ) -> Layout:
        """Plan the cells from `rows`: the keys and order values the scan is going to see.

        `rows` should be a cheap, narrow stand-in for the scanned rows (same keys, same
        spread); it decides balance only, never results. Where `rows` is an aggregate, naming
        its count as `weight` lets Spark reuse its shuffle here instead of computing it again.
        """
        limits = limits or Limits()
        keys = tuple(keys)
        if limits.at_most is not None and limits.at_most <= limits.min_rows:
            return Layout(keys, order)
        n_rows = F.sum(weight) if weight else F.count(F.lit(1))
        unset = ~_all_set([*keys, order])
        total, loose, count = rows.agg(
            n_rows,
            F.sum(F.when(unset, F.col(weight) if weight else F.lit(1))),
            F.count(F.lit(1)),
        ).first()
        if (total or 0) <= limits.min_rows:
            return Layout(keys, order)

        tasks = tasks_for(count)
        chunk = limit = max(limits.min_rows, -(-total // limits.chunks))
        placed = rows.select(
            *keys, F.col(order).cast("double").alias("_x"), *([weight] if weight else [])
        ).where(_all_set([*keys, "_x"]))
        one_in = 1 if weight else max(1, min(64, chunk // WITNESSES))
        if one_in > 1:
            # Keeps the count's own shuffle a fraction of the scan's.
            placed = placed.where(F.pmod(F.xxhash64(*keys, "_x"), F.lit(one_in)) == 0)
            chunk //= one_in
        real = placed.where(~F.isnan("_x"))
        many = real.groupBy(*keys).agg(n_rows.alias("_n")).where(F.col("_n") > chunk)
        many = _pinned(many.select(*keys))
        if tasks and (loose or 0) <= limit and many.isEmpty():
            return Layout(keys, order, tasks=tasks)
        hot = _pinned(
            real.join(F.broadcast(many), list(keys))
            .groupBy(*keys)
            .agg(_edges("_x").alias("_edges"))
        )
        # A stretch above a chunk is cut once more by its own ranks.
        stretch = _below(F.col("_edges"), F.col("_x")).alias("_stretch")
        inside = real.join(F.broadcast(hot), list(keys)).select(
            *keys, stretch, "_x", *([weight] if weight else [])
        )
        part = [*keys, "_stretch"]
        many = inside.groupBy(*part).agg(n_rows.alias("_n")).where(F.col("_n") > chunk)
        heavy = _pinned(
            inside.join(F.broadcast(many.select(*part)), part)
            .groupBy(*part)
            .agg(_edges("_x").alias("_cuts"))
        )
        return Layout(keys, order, hot, heavy, tasks)

    @property
    def single(self) -> bool:
        """No key is large enough to be cut, nor are there many rows without a key or an order."""
        return self.hot is None

    def dealt(self, rows: DataFrame, *keys: str) -> DataFrame:
        """`rows` of a large scan, dealt by `keys` to as many tasks as their number asks for: a
        count of its own, since joining small shuffled pieces lets a task's memory grow with the
        input."""
        return rows.repartition(self.tasks, *keys) if self.tasks else rows

    def assign(self, rows: DataFrame, hot_only: bool = False) -> DataFrame:
        """Add the cell. 0 = the whole key; positive and rising with the order column = a
        cell of a hot key; negative = a key or order value is NULL (spread, never matched).
        """
        x = F.col(self.order).cast("double")
        columns = [F.col(c) for c in rows.columns]
        part = F.coalesce(_below(F.col("_cuts"), x), F.lit(0))
        spread = -1 - F.pmod(F.xxhash64(self.order, *self.keys), F.lit(1024))
        cell = (
            F.when(~_all_set([*self.keys, self.order]), spread)
            .when(F.col("_edges").isNull(), F.lit(0))
            .otherwise(1 + F.col("_stretch") * F.lit(STEP) + part)
        )
        return (
            rows.join(F.broadcast(self.hot), list(self.keys), "inner" if hot_only else "left")
            .withColumn("_stretch", _below(F.col("_edges"), x))
            .join(F.broadcast(self.heavy), [*self.keys, "_stretch"], "left")
            .select(*columns, cell.cast("bigint").alias(CELL))
        )


def tasks_for(rows: int) -> int | None:
    """Tasks of about `TASK_ROWS` rows; small inputs are left to the session."""
    return None if rows <= Limits.min_rows else -(-rows // TASK_ROWS)


def dimension(df: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """`df` as the side of joins that describes the rows of the other one; `counted` has as many
    rows, where that is cheaper to count.

    Spark sends a side to every task by its stored bytes, but repeated values take few of these and
    hundreds each in memory. A large side is dealt by key, so a task's memory does not grow with it.
    """
    few = (df if counted is None else counted).select(F.lit(1)).limit(SENT_ROWS + 1)
    return df.hint("merge") if few.count() > SENT_ROWS else df


def _all_set(names: Sequence[str]) -> Column:
    out = F.lit(True)
    for name in names:
        out = out & F.col(name).isNotNull()
    return out


def _edges(x: str) -> Column:
    """Values that cut a group's rows into parts of near-equal count, from a mergeable sketch."""
    return F.percentile_approx(x, [k / PARTS for k in range(1, PARTS)], 10_000)


def _pinned(df: DataFrame) -> DataFrame:
    """A sketch may differ a little when it is computed again; stored, every use sees the same."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _below(edges: Column, x: Column) -> Column:
    """How many edges lie below x: rises with x, and is the same for equal values. NaN, the
    largest value, has a place of its own."""
    return F.when(F.isnan(x), F.size(edges).cast("bigint") + 1).otherwise(
        F.size(F.filter(edges, lambda e: e < x)).cast("bigint")
    )
