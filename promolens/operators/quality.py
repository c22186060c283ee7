"""Data-quality reports. Each is one pass with partial aggregation and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions.columns import ratio


def _names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def null_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: NULLs per column, and `total_rows`; zeros on empty input."""
    columns = df.columns if columns is None else columns
    return df.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
        F.count(F.lit(1)).alias("total_rows"),
    )


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, null_pct, severity) by rising rate: percent to one decimal; severity is high
    above 20 and medium above 5."""
    columns = list(df.columns if columns is None else columns)
    rate = F.round(100 * ratio(F.col("n_null"), F.col("total_rows")), 1)
    return (
        null_summary(df, columns)
        .unpivot("total_rows", columns, "column", "n_null")
        .select(
            "column",
            rate.alias("null_pct"),
            F.when(rate > 20, "high").when(rate > 5, "medium").otherwise("low").alias("severity"),
        )
        .orderBy("null_pct", "column")
    )


def key_check(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row: total rows, key groups with duplicates, rows beyond the first of their group,
    and rows with a NULL in the key. NULL keys group together."""
    keys = _names(keys)
    any_null: Column = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    n = F.col("_n")
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    sums = {
        "total_rows": F.sum(n),
        "duplicate_key_groups": F.count_if(n > 1),
        "duplicate_rows": F.sum(n - 1),
        "rows_with_null_keys": F.sum(F.when(any_null, n).otherwise(0)),
    }
    return groups.agg(*[F.coalesce(v, F.lit(0)).alias(k) for k, v in sums.items()])


def distinct_counts(
    df: DataFrame,
    columns: str | Sequence[str],
    top_n: int | None = 50,
    include_pct: bool = True,
    decimals: int = 4,
) -> DataFrame:
    """Distinct values by falling count, ties by value; `pct` is a share of all rows."""
    columns = _names(columns)
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))
    if include_pct:
        total = groups.agg(F.sum("count")).scalar()
        groups = groups.withColumn("pct", F.round(ratio(F.col("count"), total), decimals))
    groups = groups.orderBy(F.col("count").desc(), *columns)
    return groups if top_n is None else groups.limit(top_n)


def with_share(counts: DataFrame, count: str = "count", share: str = "share") -> DataFrame:
    """Add each row's share of the column total to a table of counts."""
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(share, ratio(F.col(count), total))


def validate_grain(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs twice. Runs a job; kept apart so that plans stay lazy."""
    found = key_check(df, keys).first()["duplicate_key_groups"]
    if found:
        raise ValueError(f"grain {tuple(keys)} is not unique: {found} duplicate key groups")
