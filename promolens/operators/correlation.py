"""Pairwise Pearson correlation of many columns, and feature distributions by target."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.operators.selection import box_by_group

#: A spread of no more than this share of the mean is rounding, and the column constant.
ROUNDING = 4e-15


class Moments:
    """Count, means and centred second moments of all pairs of columns, batch by batch.

    Each pair has the rows where both of its columns are set. Values count from their column's
    origin, the first value met, so that a large mean costs no digits; a batch is centred at its own
    means, and added by the formula for the moments of a union, so that no spread drowns.
    """

    def __init__(self, size: int):
        self.origin = np.full(size, np.nan)
        self.n = np.zeros((size, size))
        #: From the origins on, the mean of the row's and of the column's variable; then the second
        #: moments of both, and the product's.
        self.mean = np.zeros((2, size, size))
        self.second = np.zeros((3, size, size))

    def add(self, values: np.ndarray) -> None:
        """A batch [row, column]; NaN is a gap."""
        there = ~np.isnan(values)
        here = there.astype(float)
        first = values[there.argmax(axis=0), np.arange(values.shape[1])]
        self.origin = np.where(np.isnan(self.origin), first, self.origin)
        x = np.where(there, values - self.origin, 0.0)
        centre = x.sum(axis=0) / np.maximum(here.sum(axis=0), 1)
        x = np.where(there, x - centre, 0.0)
        squares = x * x
        n = here.T @ here
        some = np.maximum(n, 1)
        sums = np.stack([x.T @ here, here.T @ x])
        raw = np.stack([squares.T @ here, here.T @ squares, x.T @ x])
        second = raw - np.stack([sums[0] ** 2, sums[1] ** 2, sums[0] * sums[1]]) / some
        # Constant on a pair's rows though not on its own: what rounding leaves is no spread.
        second[:2] = np.where(second[:2] > 1e-13 * raw[:2], second[:2], 0.0)
        mean = np.stack([centre[:, None] + sums[0] / some, centre[None, :] + sums[1] / some])
        total = np.maximum(self.n + n, 1)
        # A mean of no rows does not count.
        delta = np.where((self.n > 0) & (n > 0), mean - self.mean, 0.0)
        moved = np.stack([delta[0] ** 2, delta[1] ** 2, delta[0] * delta[1]])
        self.second += second + self.n * n / total * moved
        self.mean = np.where(self.n > 0, self.mean + delta * n / total, mean)
        self.n = self.n + n


def correlation_matrix(
    df: DataFrame, columns: Sequence[str], target: str | None = "target"
) -> DataFrame:
    """(column_a, column_b, n, correlation) for a before b or a = b, over all rows.

    Each pair uses the rows where both values are set (NaN is not); a pair with a constant side is
    NULL. One pass: tasks fold their rows into the pairs' moments with matrix products, so that
    what is shuffled is one small matrix per task, and merged by pair.
    """
    names = [c for c in columns if c in df.columns]
    if target and target in df.columns and target not in names:
        names.append(target)
    if not names:
        raise ValueError("no valid numerical columns for a correlation")
    first, second = np.triu_indices(len(names))

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Moments(len(names))
        for batch in batches:
            if batch.num_rows:
                columns = (c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns)
                total.add(np.column_stack(list(columns)))
        ends = [total.origin[first], total.origin[second]]
        picked = [m[first, second] for m in (total.n, *total.mean, *total.second)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(first), pa.array(second), *map(pa.array, (*ends, *picked))],
            names=["a", "b", "ox", "oy", "n", "mx", "my", "xx", "yy", "xy"],
        )

    measures = ("ox", "oy", "n", "mx", "my", "xx", "yy", "xy")
    schema = "a bigint, b bigint, " + ", ".join(f"{m} double" for m in measures)
    doubles = [F.col(c).cast("double").alias(c) for c in names]
    states = df.select(*doubles).mapInArrow(moments, schema).where("n > 0")
    # All states of a pair at once: their means from one origin on, the common mean, the moments.
    pair = Window.partitionBy("a", "b")
    from_one = states.select(
        "*", *[F.min(f"o{v}").over(pair).alias(f"base_{v}") for v in "xy"]
    ).withColumns({f"at_{v}": F.col(f"o{v}") - F.col(f"base_{v}") + F.col(f"m{v}") for v in "xy"})
    n = F.col("n")

    def common(v: str) -> Column:
        return (F.sum(n * F.col(f"at_{v}")).over(pair) / F.sum(n).over(pair)).alias(f"mean_{v}")

    dx, dy = (F.col(f"at_{v}") - F.col(f"mean_{v}") for v in "xy")
    merged = (
        from_one.select("*", common("x"), common("y"))
        .groupBy("a", "b")
        .agg(
            F.sum(n).alias("n"),
            F.first(F.col("base_x") + F.col("mean_x")).alias("cx"),
            F.first(F.col("base_y") + F.col("mean_y")).alias("cy"),
            F.sum(F.col("xx") + n * dx * dx).alias("xx"),
            F.sum(F.col("yy") + n * dy * dy).alias("yy"),
            F.sum(F.col("xy") + n * dx * dy).alias("xy"),
        )
    )

    def spread(square: str, mean: str) -> Column:
        least = F.col("n") * F.pow(F.lit(ROUNDING) * F.col(mean), 2)
        return F.when(F.col(square) > least, F.sqrt(square))

    name = F.array(*[F.lit(c) for c in names])
    r = F.try_divide(F.col("xy"), spread("xx", "cx") * spread("yy", "cy"))
    # A column with itself has no rounding.
    r = F.when((F.col("a") == F.col("b")) & r.isNotNull(), 1.0).otherwise(r)
    return merged.select(
        name[F.col("a").cast("int")].alias("column_a"),
        name[F.col("b").cast("int")].alias("column_b"),
        n.cast("bigint").alias("n"),
        F.when(r.isNotNull(), F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0))).alias(
            "correlation"
        ),
    )


def feature_box_by_target(
    df: DataFrame, columns: Sequence[str], target: str = "target", top_n: int | None = None
) -> DataFrame:
    """Box statistics of all features (or the first `top_n`) per target value, over all rows; see
    `selection.box_by_group`."""
    names = [c for c in columns if c in df.columns][:top_n]
    if not names:
        raise ValueError("no valid numerical columns")
    return box_by_group(df, names, target)
