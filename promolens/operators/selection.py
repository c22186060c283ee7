"""Exact order statistics of many columns and a few groups at once, by counting.

Every wanted rank is a search. A round counts, for each search, the values in 256 equal parts of the
range it is down to, with the least and the largest value in each; the part that holds the rank
is the next range. A search ends when its range is one value, after some log256(rows) rounds, and
eight at most: a part has fewer keys than its range, or one. A task counts all its batches into one
array. What is shuffled are these counters, some hundred per task and search, never a row per value;
what the driver gets is one row per search and round. The rounds run while the call is made, over a
stored copy of the columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from promolens.sources import scratch_dir

PARTS = 256
QUARTILES = (0.25, 0.5, 0.75)
_LOW_BITS = np.int64(0x7FFFFFFFFFFFFFFF)

#: (group, column): sorted keys of a batch.
Sorted = dict[tuple[int, int], np.ndarray]
_NONE = np.iinfo(np.int64)


class Counters:
    """Count, least and largest key, and a second count, of numbered places; batches are added up."""

    def __init__(self, size: int):
        self.n, self.out = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.low, self.high = np.full(size, _NONE.max), np.full(size, _NONE.min)

    def add(self, at, n, low, high, out=0) -> None:
        """Places `at` are distinct."""
        self.n[at] += n
        self.out[at] += out
        self.low[at] = np.minimum(self.low[at], low)
        self.high[at] = np.maximum(self.high[at], high)


def keys_of(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles; 0.0 and -0.0 are one, NaN is the largest."""
    values = np.where(np.isnan(values), np.nan, values + 0.0)
    bits = values.view(np.int64)
    return np.where(bits < 0, bits ^ _LOW_BITS, bits)


def value_of(key: int) -> float:
    bits = np.int64(key)
    return float((bits ^ _LOW_BITS if bits < 0 else bits).view(np.float64))


class Columns:
    """The stored columns, with each row's group as a number."""

    def __init__(self, df: DataFrame, columns: Sequence[str], by: str):
        self.columns, self.by = list(columns), by
        self.kind = df.schema[by].dataType.simpleString()
        doubles = [F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(self.columns)]
        path = scratch_dir(df.sparkSession)
        df.select(F.col(by).alias("by"), *doubles).write.parquet(path)
        kept = df.sparkSession.read.parquet(path)
        #: The values of a column of few values.
        self.groups = [r[0] for r in kept.select("by").distinct().collect()]
        some = [g for g in self.groups if g is not None]
        number = F.array_position(F.array(*map(F.lit, some)), F.col("by")) if some else F.lit(None)
        # 0 is the group of NULL.
        self.rows = kept.select(
            F.coalesce(number.cast("int"), F.lit(0)).alias("group"),
            *[f"c{k}" for k in range(len(self.columns))],
        )
        self.names = {0: None} | dict(enumerate(some, 1))

    def fold(self, size: int, add: Callable[[Counters, Sorted], None]) -> DataFrame:
        """(at, n, low, high, out) of the places below `size` that have any: what `add` counts of
        the sorted keys of each batch, added up per task and then over the tasks. Without a key of
        its own a place has no low and high."""
        count = len(self.columns)
        schema = "at int, n long, low long, high long, out long"
        kind = to_arrow_schema(StructType.fromDDL(schema))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = Counters(size)
            for batch in batches:
                group = batch.column(0).to_numpy()
                found: Sorted = {}
                for k in range(count):
                    column = batch.column(k + 1)
                    there = column.is_valid().to_numpy(zero_copy_only=False)
                    keys = keys_of(column.drop_null().to_numpy())
                    at = group[there]
                    for g in np.unique(at):
                        found[int(g), k] = np.sort(keys[at == g])
                add(total, found)
            at = np.flatnonzero((total.n > 0) | (total.out > 0))
            none = total.n[at] == 0
            ends = [pa.array(x[at], mask=none) for x in (total.low, total.high)]
            columns = [pa.array(at.astype(np.int32)), pa.array(total.n[at]), *ends, pa.array(total.out[at])]
            yield pa.RecordBatch.from_arrays(columns, schema=kind)

        found = self.rows.mapInArrow(run, schema)
        return found.groupBy("at").agg(
            *[how(c).alias(c) for c, how in
              (("n", F.sum), ("low", F.min), ("high", F.max), ("out", F.sum))]
        )


def _edges(low: int, high: int) -> np.ndarray:
    """The first key of each part of low to high, in whole numbers beyond 64 bits. No part has both
    ends, so that every round narrows a range."""
    return np.array([low + (high - low + 1) * k // PARTS for k in range(PARTS)], np.int64)


def _ends(data: Columns) -> dict[tuple[int, int], tuple[int, int, int]]:
    """Count, least and largest key of each group and column that has a value."""
    count = len(data.columns)

    def add(total: Counters, found: Sorted) -> None:
        for (g, k), keys in found.items():
            total.add(g * count + k, len(keys), keys[0], keys[-1])

    rows = data.fold(len(data.names) * count, add)
    return {divmod(r.at, count): (r.n, r.low, r.high) for r in rows.collect()}


def select_ranks(
    data: Columns, wanted: dict[tuple[int, int], set[int]], ends: dict
) -> dict[tuple[int, int, int], float]:
    """The value at each wanted rank (from 0) of a (group, column)."""
    searches = [(g, k, r) for (g, k), ranks in wanted.items() for r in sorted(ranks)]
    # Of each search the keys its range lies between, and how many values lie before it.
    state = {s: (*ends[s[:2]][1:], 0) for s in searches}
    while open_ := [s for s in searches if state[s][0] < state[s][1]]:
        # Searches down to the same range share their counters.
        ranges = sorted({(*s[:2], *state[s][:2]) for s in open_})
        of_range = {x: i for i, x in enumerate(ranges)}
        cut = [(g, k, high, _edges(low, high)) for g, k, low, high in ranges]

        def add(total: Counters, found: Sorted, cut=cut) -> None:
            for i, (g, k, high, edges) in enumerate(cut):
                keys = found.get((g, k))
                if keys is None:
                    continue
                at = np.append(np.searchsorted(keys, edges), np.searchsorted(keys, high, "right"))
                part = np.flatnonzero(np.diff(at))
                first, last = at[part], at[part + 1]
                total.add(i * PARTS + part, last - first, keys[first], keys[last - 1])

        counts = data.fold(len(ranges) * PARTS, add).selectExpr(
            f"at div {PARTS} as i", f"at % {PARTS} as part", "n", "low", "high"
        )
        asked = data.rows.sparkSession.createDataFrame(
            pa.table(
                {
                    "j": range(len(open_)),
                    "i": [of_range[(*s[:2], *state[s][:2])] for s in open_],
                    "rank": [s[2] - state[s][2] for s in open_],
                }
            )
        )
        before = Window.partitionBy("i").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        placed = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        inside = (F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n"))
        # One row a search.
        for r in placed.join(F.broadcast(asked), "i").where(inside).collect():
            s = open_[r.j]
            state[s] = (r.low, r.high, state[s][2] + r.before)
    return {s: value_of(state[s][0]) for s in searches}


def _places(n: int, p: float) -> tuple[int, int, float]:
    place = p * (n - 1)
    low = int(np.floor(place))
    return low, int(np.ceil(place)), place - low


def box_by_group(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """feature, `by`, n, q1, median, q3, whisker_low, whisker_high, n_outliers of each column in
    each group: quartiles between neighbours, whiskers at 1.5 interquartile ranges.

    NULL values are left out, a group without values has no row; NULL in `by` is a group. `by`
    should have few values: their number bounds what the driver holds. Unlike other operators this
    one runs its counting rounds when it is called.
    """
    data = Columns(df, columns, by)
    ends = _ends(data)
    wanted = {
        key: {r for p in QUARTILES for r in _places(n, p)[:2]} for key, (n, _, _) in ends.items()
    }
    values = select_ranks(data, wanted, ends)
    limits = {}
    for (g, k), (n, _, _) in ends.items():
        quartiles = []
        for p in QUARTILES:
            low, high, part = _places(n, p)
            a, b = values[g, k, low], values[g, k, high]
            quartiles.append(a + (b - a) * part)
        reach = 1.5 * (quartiles[2] - quartiles[0])
        limits[g, k] = (*quartiles, quartiles[0] - reach, quartiles[2] + reach)
    near = {
        at: tuple(int(x) for x in keys_of(np.array(limit[3:]))) for at, limit in limits.items()
    }

    count = len(data.columns)

    def add(total: Counters, found: Sorted) -> None:
        for (g, k), keys in found.items():
            low, high = near[g, k]
            first, last = np.searchsorted(keys, low), np.searchsorted(keys, high, "right")
            inside = max(int(last - first), 0)
            if inside:
                total.add(g * count + k, inside, keys[first], keys[last - 1], len(keys) - inside)
            else:
                total.out[g * count + k] += len(keys)

    out = []
    for r in data.fold(len(data.names) * count, add).collect():
        (g, k), n, low, high, outside = divmod(r.at, count), r.n + r.out, r.low, r.high, r.out
        whiskers = [None if x is None else value_of(x) for x in (low, high)]
        out.append((data.columns[k], data.names[g], n, *limits[g, k][:3], *whiskers, outside))
    schema = StructType.fromDDL(
        f"feature string, `{by}` {data.kind}, n long, q1 double, median double, q3 double, "
        "whisker_low double, whisker_high double, n_outliers long"
    )
    columns = [pa.array([r[i] for r in out], f.type) for i, f in enumerate(to_arrow_schema(schema))]
    table = pa.Table.from_arrays(columns, schema=to_arrow_schema(schema))
    return df.sparkSession.createDataFrame(table, schema)
