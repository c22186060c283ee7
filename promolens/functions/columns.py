"""Column expressions shared by the operators; all safe with ANSI mode on or off."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from promolens.functions.domains import UNKNOWN

DAY_US = 86_400_000_000


def to_micros(days: Column) -> Column:
    """Days as double -> whole microseconds, so that window edges compare exactly."""
    return F.round(days * F.lit(float(DAY_US))).cast("bigint")


def to_days(micros: Column) -> Column:
    return micros / F.lit(float(DAY_US))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division, NULL on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def yyyymmdd(text: Column) -> Column:
    """Date from `yyyyMMdd` text, NULL where the text is not one."""
    return F.try_to_date(text, "yyyyMMdd")


def known_age(age: Column) -> Column:
    """118 is the registration default for a missing age."""
    return F.nullif(age.cast("int"), F.lit(118))


def age_band(age: Column) -> Column:
    """Bands from 18 up; NULL and minors are `Unknown`."""
    return (
        F.when(age.isNull() | (age < 18), UNKNOWN)
        .when(age < 25, "18-24")
        .when(age < 35, "25-34")
        .when(age < 45, "35-44")
        .when(age < 55, "45-54")
        .when(age < 65, "55-64")
        .otherwise("65+")
    )


def clean_gender(gender: Column) -> Column:
    code = F.upper(F.trim(gender))
    return F.when(code.isin("F", "M", "O"), code).otherwise(UNKNOWN)


def bands(
    value: Column,
    upper_edges: Sequence[Column | float],
    labels: Sequence[Column | str],
    missing: Column | str,
) -> Column:
    """Right-closed bands: n edges, n + 1 labels, and a label for NULL."""
    if len(labels) != len(upper_edges) + 1:
        raise ValueError("bands() needs one label more than edges")

    def as_column(x):
        return x if isinstance(x, Column) else F.lit(x)

    out = F.when(value.isNull(), as_column(missing))
    for edge, label in zip(upper_edges, labels):
        out = out.when(value <= as_column(edge), as_column(label))
    return out.otherwise(as_column(labels[-1]))


def count_at_most(value: str, edges: Sequence[str]) -> Column:
    """How many of the ascending `edges` (SQL expressions) are at or below the column: a
    binary search as nested conditions, compiled with the rest of the row's code."""

    def within(low: int, high: int) -> str:
        if low == high:
            return str(low)
        mid = (low + high) // 2
        return f"if({value} >= {edges[mid]}, {within(mid + 1, high)}, {within(low, mid)})"

    return F.expr(within(0, len(edges)))


def dice(*keys: Column | str, seed: int = 42, sides: int = 1_000_000) -> Column:
    """A number below `sides` drawn from the keys alone: a recomputed task draws it again."""
    text = F.concat_ws(":", *[F.coalesce(F.col(k) if isinstance(k, str) else k, F.lit("")) for k in keys], F.lit(str(seed)))
    return F.pmod(F.conv(F.left(F.md5(text), F.lit(8)), 16, 10).cast("bigint"), F.lit(sides))


def same_key(key: Column, other: Column, *spread: Column) -> list[Column]:
    """Conditions of an outer join on texts `key` = `other`. Rows without a key match nothing, and
    go to many tasks by the hash of `spread` instead of all to one."""
    dealt = F.concat(F.lit("~"), F.pmod(F.xxhash64(*spread), F.lit(1024)).cast("string"))
    return [F.coalesce(key.cast("string"), dealt) == other.cast("string"), key == other]
