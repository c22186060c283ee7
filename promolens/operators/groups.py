"""Shares and folds of whole customers, exact in their sizes and repeatable.

A customer's place is a number hashed from the key alone, so a recomputed task gives it again and no
row order matters.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.operators.layout import Layout, Limits
from promolens.operators.quantiles import quantile_row
from promolens.operators.scan import UPTO, Running, ordered_scan


def customer_number(id_col: str, seed: int) -> Column:
    """52 hashed bits of a customer: exact as a double, and practically free of ties."""
    text = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.left(F.md5(text), F.lit(13)), 16, 10).cast("bigint")


def in_share(
    df: DataFrame, fraction: float, id_col: str, seed: int, limits: Limits | None = None
) -> Column:
    """Whether a row belongs to ceil(fraction * customers) of the customers of `df`: those whose
    numbers are not above the order statistic of that rank. NULL is one customer."""
    customers = df.select(customer_number(id_col, seed).alias("_number")).distinct()
    edge = quantile_row(customers, "_number", [fraction], 0.0, limits).scalar()
    return customer_number(id_col, seed) <= edge[0]


def lightest_first(loads: list[int], size: int, count: int) -> list[int]:
    """How many of `count` items of one size each load gets, if each item in turn goes to the
    lightest load, the first of equal ones. `loads` is not changed.

    The items go to the `count` least of all load + k * size; their largest value is found by
    bisection, so the number of items costs nothing.
    """

    def below(edge: int) -> list[int]:
        return [max(0, -(-(edge - load) // size)) for load in loads]

    low, high = min(loads), max(loads) + count * size + 1
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if sum(below(middle)) <= count else (low, middle)
    out = below(low)
    left = count - sum(out)
    for i, load in enumerate(loads):
        if left and load + out[i] * size == low:
            out[i], left = out[i] + 1, left - 1
    return out


def balanced_counts(classes: Sequence[tuple[int, int]], n_folds: int) -> dict[int, list[int]]:
    """Customers of each size that each fold gets, from (size, customers): largest first, each to
    the lightest fold."""
    loads, out = [0] * n_folds, {}
    for size, count in sorted(classes, reverse=True):
        out[size] = lightest_first(loads, size, count)
        loads = [load + n * size for load, n in zip(loads, out[size])]
    return out


def one_by_one(sizes: Sequence[int], n_folds: int) -> list[int]:
    """The same greedy rule customer by customer: rows of each fold. For small inputs and tests."""
    loads = [(0, i) for i in range(n_folds)]
    for size in sorted(sizes, reverse=True):
        load, i = heapq.heappop(loads)
        heapq.heappush(loads, (load + size, i))
    return [load for load, _ in sorted(loads, key=lambda x: x[1])]


def with_balanced_fold(
    df: DataFrame, n_folds: int, id_col: str, seed: int, limits: Limits | None = None
) -> DataFrame:
    """Add `fold`: all rows of a customer share one, and the folds' rows differ by no more than the
    largest customer has.

    Customers are dealt largest first, each to the lightest fold. That is decided per size: the
    driver gets one number a size, of which there are fewer than the root of twice the rows. Inside
    a size customers are ranked by their number, and a fold gets a run of ranks. `df` should be a
    stored table.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    sizes = df.groupBy(key.alias("_id")).agg(F.count(F.lit(1)).alias("_size"))
    counted = sizes.groupBy("_size").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counted:
        return df.withColumn("fold", F.lit(0))
    dealt = balanced_counts([(r["_size"], r["n"]) for r in counted], n_folds)
    ends = {size: [sum(found[: i + 1]) for i in range(n_folds)] for size, found in dealt.items()}
    runs = df.sparkSession.createDataFrame(list(ends.items()), "_size long, _ends array<long>")
    numbered = sizes.withColumn("_number", customer_number("_id", seed))
    layout = Layout.of(numbered, ["_size"], "_number", limits)
    ranked = ordered_scan(
        numbered, [Running("_rank", "sum", F.lit(1).cast("bigint"), UPTO)], layout
    )
    fold = F.size(F.filter("_ends", lambda end: end < F.col("_rank")))
    folds = ranked.join(runs, "_size").select("_id", F.least(fold, F.lit(n_folds - 1)).alias("fold"))
    return df.withColumn("_id", key).join(folds, "_id").drop("_id")
