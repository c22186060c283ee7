"""Quantiles, box statistics and histograms over whole columns.

Exact quantiles come from value counts and one ordered scan, so no task ever holds all the
values of a group, and copies of a value cost one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.operators.layout import Layout, Limits
from promolens.operators.scan import FROM, UPTO, Running, ordered_scan

GROUP = "_group"


def _value_counts(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    # A struct is never NULL, so rows with a NULL group value form a group like any other.
    group = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(group.alias(GROUP), F.col(value).cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_count"))
    )


def _quantiles_of_counts(
    counts: DataFrame, ps: Sequence[float], method: str, limits: Limits | None
) -> DataFrame:
    layout = Layout.of(counts, [GROUP], "_value", limits, weight="_count")
    n = F.col("_count")
    ranked = ordered_scan(
        counts,
        [
            Running("_upto", "sum", n, UPTO),
            Running("_from", "sum", n, FROM),
        ],
        layout,
    ).withColumn("_total", F.col("_upto") + F.col("_from") - n)
    total = F.col("_total")

    def value_at(position: Column) -> Column:
        inside = (F.col("_upto") - n <= position) & (position < F.col("_upto"))
        return F.max(F.when(inside, F.col("_value")))

    picks, result = [], []
    for i, p in enumerate(ps):
        if method == "disc":
            place = F.greatest(F.ceil(F.lit(float(p)) * total) - 1, F.lit(0))
            picks.append(value_at(place).alias(f"_a{i}"))
            result.append(F.col(f"_a{i}"))
        else:
            place = F.lit(float(p)) * (total - 1)
            picks += [
                value_at(F.floor(place)).alias(f"_a{i}"),
                value_at(F.ceil(place)).alias(f"_b{i}"),
                F.max(place - F.floor(place)).alias(f"_w{i}"),
            ]
            low, high = F.col(f"_a{i}"), F.col(f"_b{i}")
            result.append(low + (high - low) * F.col(f"_w{i}"))
    return ranked.groupBy(GROUP).agg(*picks).select(GROUP, F.array(*result).alias("quantiles"))


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    ps: Sequence[float],
    method: str = "cont",
    limits: Limits | None = None,
) -> DataFrame:
    """Group columns and `quantiles`, an array in the order of `ps`.

    `cont` interpolates linearly between neighbours; `disc` takes the smallest value whose
    cumulative share reaches p. NULL values are left out.
    """
    counts = _value_counts(df, by, value)
    out = _quantiles_of_counts(counts, ps, method, limits)
    return out.select(*[F.col(f"{GROUP}.{c}") for c in by], "quantiles")


def quantile_row(
    df: DataFrame,
    value: str,
    ps: Sequence[float],
    rel_error: float = 0.0,
    limits: Limits | None = None,
) -> DataFrame:
    """One row, one array column, for use as a scalar subquery.

    With `rel_error` above 0 the quantiles come from a mergeable sketch.
    """
    if rel_error > 0:
        sketch = F.percentile_approx(
            F.col(value), [float(p) for p in ps], max(1, round(1 / rel_error))
        )
        return df.agg(sketch.alias("quantiles"))
    return exact_quantiles(df, [], value, ps, "disc", limits)


def box_stats(
    df: DataFrame, value: str, by: Sequence[str] = (), limits: Limits | None = None
) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges, and the number of points beyond."""
    counts = _value_counts(df, by, value)
    quartiles = _quantiles_of_counts(counts, [0.25, 0.5, 0.75], "cont", limits)
    q = F.col("quantiles")
    reach = 1.5 * (q[2] - q[0])
    x, n = F.col("_value"), F.col("_count")
    near = x.between(q[0] - reach, q[2] + reach)
    return (
        counts.join(quartiles, GROUP)
        .groupBy(GROUP, q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"))
        .agg(
            F.sum(n).alias("n"),
            F.min(F.when(near, x)).alias("whisker_low"),
            F.max(F.when(near, x)).alias("whisker_high"),
            F.sum(F.when(near, 0).otherwise(n)).alias("n_outliers"),
        )
        .select(
            *[F.col(f"{GROUP}.{c}") for c in by],
            "n",
            "q1",
            "median",
            "q3",
            "whisker_low",
            "whisker_high",
            "n_outliers",
        )
    )


def histogram(df: DataFrame, value: str, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Counts in `bins` equal-width bins between the smallest and the largest value.

    The edges are shared by all groups; the largest value belongs to the last bin. Empty bins
    have no row.
    """
    x = F.col(value).cast("double")
    kept = df.where(x.isNotNull()).select(*by, x.alias("_x"))
    ends = kept.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))).scalar()
    lo, hi = F.col("_ends.lo"), F.col("_ends.hi")
    step = F.floor(F.coalesce(F.try_divide((F.col("_x") - lo) * bins, hi - lo), F.lit(0.0)))
    number = F.least(step, F.lit(bins - 1))
    return (
        kept.withColumn("_ends", ends)
        .groupBy(*by, (number + 1).cast("bigint").alias("bin"), "_ends")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            *by,
            "bin",
            (lo + (hi - lo) * ((F.col("bin") - 1) / F.lit(float(bins)))).alias("bin_low"),
            (lo + (hi - lo) * (F.col("bin") / F.lit(float(bins)))).alias("bin_high"),
            "n",
        )
    )
