"""Running aggregates along an order column, distributed inside hot keys as well.

Only growing frames are used, so a key with n rows costs O(n) after its sort; a sliding or
`unbounded following` frame would re-read the frame for every row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from promolens.operators.layout import CELL, Layout

# Frames: strictly before the row's order value (integers only), up to it, or from it on;
# rows with an equal order value are inside the last two.
BEFORE, UPTO, FROM = "before", "upto", "from"
COPY = "_copy"

_AGGREGATES = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Running:
    """A running `sum`, `min` or `max` of `value`; a sum's value must not be NULL.

    `ago` moves the end of a sum's BEFORE frame back: it adds up the rows more than `ago` before.
    """

    name: str
    how: str
    value: Column
    frame: str = BEFORE
    type: str | None = None
    ago: int = 0

    def aggregate(self) -> Column:
        return _AGGREGATES[self.how](self.value)

    def again(self) -> Column:
        """The same aggregate over totals of parts."""
        return _AGGREGATES[self.how](self.name)

    def merge(self, inside: Column, carried: Column) -> Column:
        if self.how == "min":
            return F.least(inside, carried)
        if self.how == "max":
            return F.greatest(inside, carried)
        # Before the first row of a cell the sum inside is NULL, as is a carry of nothing.
        out = F.coalesce(inside + carried, inside, carried)
        return out.cast(self.type) if self.type else out


def _over(running: Running, partition: WindowSpec, order: str) -> Column:
    first, current = Window.unboundedPreceding, Window.currentRow
    frame = {
        BEFORE: partition.orderBy(F.col(order).asc()).rangeBetween(first, -1 - running.ago),
        UPTO: partition.orderBy(F.col(order).asc()).rangeBetween(first, current),
        FROM: partition.orderBy(F.col(order).desc()).rangeBetween(first, current),
    }[running.frame]
    return running.aggregate().over(frame)


def in_partition(running: Sequence[Running], keys: Sequence[str], order: str) -> list[Column]:
    """The running aggregates over rows that lie together by `keys`: no row moves for them."""
    partition = Window.partitionBy(*keys)
    return [_over(r, partition, order).alias(r.name) for r in running]


def ordered_scan(rows: DataFrame, running: Sequence[Running], layout: Layout) -> DataFrame:
    """Add one column per running aggregate; keys and order column are those of `layout`.

    Rows move once: by key, or by (key, cell) where the layout cuts hot keys. In that case the
    totals of the cells, at most some ten times `Limits.chunks` rows, are scanned over whole
    cells and joined back by broadcast. There, what a sum with `ago` leaves out lies in other
    cells, so it adds up copies of the rows, placed `ago` later.
    """
    keys, order = list(layout.keys), layout.order
    if layout.single:
        return layout.dealt(rows, *keys).select("*", *in_partition(running, keys, order))

    columns = rows.columns
    moved = sorted({r.ago for r in running if r.ago})
    if moved:
        rows, running = _with_copies(rows, running, order, moved)
    # Named explicitly: rows that arrive partitioned by key alone must be spread again.
    placed = layout.assign(rows)
    placed = layout.dealt(placed, *keys, CELL) if layout.tasks else placed.repartition(*keys, CELL)
    partition = Window.partitionBy(*keys, CELL)
    inside = placed.select("*", *[_over(r, partition, order).alias(f"_in_{r.name}") for r in running])

    totals = (
        layout.assign(rows, hot_only=True)
        .groupBy(*keys, CELL)
        .agg(*[r.aggregate().alias(r.name) for r in running])
    )
    whole, first = Window.partitionBy(*keys), Window.unboundedPreceding
    earlier = whole.orderBy(F.col(CELL).asc()).rowsBetween(first, -1)
    later = whole.orderBy(F.col(CELL).desc()).rowsBetween(first, -1)
    carried = totals.select(
        *keys,
        CELL,
        *[
            r.again().over(later if r.frame == FROM else earlier).alias(f"_carry_{r.name}")
            for r in running
        ],
    )
    if moved:
        inside = inside.where(F.col(COPY) == 0)
    return inside.join(F.broadcast(carried), [*keys, CELL], "left").select(
        *columns,
        *[
            r.merge(F.col(f"_in_{r.name}"), F.col(f"_carry_{r.name}")).alias(r.name)
            for r in running
        ],
    )


def _with_copies(
    rows: DataFrame, running: Sequence[Running], order: str, moved: Sequence[int]
) -> tuple[DataFrame, list[Running]]:
    """The rows and, for each of `moved`, copies of them that much later; a sum takes the values
    of its own copies only."""
    copies = F.explode(F.array(*[F.lit(a).cast("bigint") for a in (0, *moved)]))
    copied = rows.select("*", copies.alias(COPY)).withColumn(order, F.col(order) + F.col(COPY))

    def own(r: Running) -> Running:
        value = F.when(F.col(COPY) == r.ago, r.value)
        if r.how == "sum":
            value = F.coalesce(value, F.lit(0))
        return replace(r, value=value.cast(r.type) if r.type else value, ago=0)

    return copied, [own(r) for r in running]
