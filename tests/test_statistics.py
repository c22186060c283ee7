"""Moments merged in any order, and order statistics found by counting, against numpy."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from promolens.operators import selection
from promolens.operators.correlation import Moments, correlation_matrix, feature_box_by_target


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def values_with_gaps(rows, seed):
    draw = np.random.default_rng(seed)
    base = draw.normal(size=rows)
    columns = [
        1.7e15 + 300 * base + draw.normal(size=rows) * 50,
        base * 1e-6 - 4,
        draw.integers(0, 3, rows).astype(float),
        np.full(rows, 42.1),
        draw.normal(size=rows),
    ]
    out = np.column_stack(columns)
    out[draw.random(out.shape) < 0.2] = np.nan
    out[:, 3] = 42.1
    return out


@pytest.mark.parametrize("cuts", [[], [1], [1, 2, 3], [50, 51, 400], list(range(7, 500, 7))])
def test_moments_of_parts_are_those_of_the_whole(cuts):
    values = values_with_gaps(500, 1)
    total = Moments(5)
    for part in np.split(values, cuts):
        if len(part):
            total.add(part)
    for a in range(5):
        for b in range(5):
            both = ~np.isnan(values[:, a]) & ~np.isnan(values[:, b])
            # Exact reference: shifted by a value first.
            x, y = values[both, a] - values[both, a][0], values[both, b] - values[both, b][0]
            x, y = x - x.mean(), y - y.mean()
            assert total.n[a, b] == both.sum()
            scale = np.sqrt((x @ x) * (y @ y)) + 1e-300
            assert abs(total.second[2, a, b] - x @ y) <= 1e-9 * scale
            assert total.second[0, a, b] == pytest.approx(x @ x, rel=1e-9, abs=1e-12)
    assert total.second[0, 3, 0] == 0 == total.second[0, 3, 3]


def test_correlation_over_many_tasks(spark):
    values = values_with_gaps(3000, 2)
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in values]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    found = correlation_matrix(df.repartition(37), df.columns, None).collect()
    assert len(found) == 15
    for r in found:
        x, y = (values[:, "abcde".index(c)] for c in (r.column_a, r.column_b))
        both = ~np.isnan(x) & ~np.isnan(y)
        assert r.n == both.sum()
        if "d" in (r.column_a, r.column_b):
            assert r.correlation is None
        else:
            x, y = x[both] - x[both][0], y[both] - y[both][0]
            assert r.correlation == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-9)


def test_correlation_scans_events_no_more_often_than_the_table(spark, sf_dir):
    scans = [
        len(re.findall(r"FileScan parquet \[[^\]]*user_id", plan(contract.queries()[name](spark, sf_dir))))
        for name in ("abt", "correlation_matrix")
    ]
    assert scans[1] <= scans[0]


def test_correlation_of_no_rows(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert correlation_matrix(df, ["a", "b"], None).collect() == []
    one = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    found = {(r.column_a, r.column_b): (r.n, r.correlation) for r in correlation_matrix(one, ["a", "b"], None).collect()}
    assert found == {("a", "a"): (2, 1.0)}


def test_keys_have_the_order_of_the_doubles():
    values = [-np.inf, -1e300, -2.5, -5e-324, -0.0, 0.0, 5e-324, 1.0, np.nextafter(1.0, 2), 1e300, np.inf, np.nan]
    keys = selection.keys_of(np.array(values))
    assert keys[4] == keys[5] and np.isnan(selection.value_of(keys[-1]))
    assert list(keys) == sorted(keys) and len(set(keys)) == len(values) - 1
    assert [selection.value_of(k) for k in keys[:-1]] == [v + 0.0 for v in values[:-1]]


def box(values):
    x = np.sort(np.array([v for v in values if v is not None], float))
    q1, median, q3 = np.quantile(x, [0.25, 0.5, 0.75])
    near = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    return len(x), q1, median, q3, near.min(), near.max(), len(x) - len(near)


def test_box_statistics_by_counting(spark):
    dice = random.Random(5)
    kinds = {
        "normal": lambda: dice.gauss(0, 1e6),
        "ties": lambda: float(dice.choice([0, 0, 0, 1, 7])),
        "one": lambda: -3.25,
        "wide": lambda: dice.choice([-1, 1]) * 10.0 ** dice.uniform(-300, 300),
        "close": lambda: 1.0 + dice.randrange(9) * 2.0**-52,
        "gaps": lambda: dice.choice([None, None, dice.random()]),
    }
    rows = [(dice.choice([0, 0, 0, 1, None]), *[draw() for draw in kinds.values()]) for _ in range(4000)]
    schema = "target int, " + ", ".join(f"{k} double" for k in kinds)
    df = spark.createDataFrame(rows, schema).repartition(9)
    found = {(r.feature, r.target): tuple(r)[2:] for r in feature_box_by_target(df, list(kinds)).collect()}
    assert len(found) == 3 * len(kinds)
    for (feature, target), got in found.items():
        k = list(kinds).index(feature) + 1
        assert got == pytest.approx(box([r[k] for r in rows if r[0] == target]), rel=1e-12)


def test_box_statistics_of_little(spark):
    df = spark.createDataFrame([(1, 2.0, None), (1, 4.0, None), (None, None, 3.0)], "g int, a double, b double")
    found = sorted(map(tuple, selection.box_by_group(df, ["a", "b"], "g").collect()))
    assert found == [
        ("a", 1, 2, 2.5, 3.0, 3.5, 2.0, 4.0, 0),
        ("b", None, 1, 3.0, 3.0, 3.0, 3.0, 3.0, 0),
    ]
    assert selection.box_by_group(df.limit(0), ["a"], "g").collect() == []


def test_box_counters_are_shuffled_not_rows(spark, sf_dir):
    df = spark.range(100).select(F.lit(1).alias("g"), F.col("id").cast("double").alias("x"))
    data = selection.Columns(df, ["x"], "g")
    rounds = []
    fold = data.fold
    data.fold = lambda *a: rounds.append(fold(*a)) or rounds[-1]
    ends = selection._ends(data)
    assert selection.select_ranks(data, {(1, 0): {0, 50, 99}}, ends) == {
        (1, 0, 0): 0.0, (1, 0, 50): 50.0, (1, 0, 99): 99.0,
    }
    assert all("Expand" not in plan(r) and "Generate" not in plan(r) for r in rounds)
    assert len(rounds) <= 4


def counting_rounds(data, at_most):
    """Stops a search that does not end."""
    rounds, fold = [], data.fold

    def counted(*a):
        assert len(rounds) < at_most
        rounds.append(a)
        return fold(*a)

    data.fold = counted
    return rounds


@pytest.mark.parametrize("start", [1.0, -1.0, 0.0, 5e300])
def test_ranks_among_neighbouring_doubles(spark, start):
    values = [start]
    for _ in range(299):
        values.append(float(np.nextafter(values[-1], np.inf)))
    rows = [(1, v) for v in values for _ in range(3)]
    df = spark.createDataFrame(rows, "g int, x double").repartition(3)
    data = selection.Columns(df, ["x"], "g")
    counting_rounds(data, 12)
    ends = selection._ends(data)
    found = selection.select_ranks(data, {(1, 0): set(range(900))}, ends)
    assert [found[1, 0, r] for r in range(900)] == [v for _, v in rows]


def test_a_task_counts_all_its_batches_at_once(spark):
    df = spark.range(50_000).select(F.lit(1).alias("g"), F.col("id").cast("double").alias("x"))
    data = selection.Columns(df.coalesce(1), ["x"], "g")
    [row] = data.fold(2, lambda total, found: total.add(1, 1, 0, 0)).collect()
    assert tuple(row) == (1, 5, 0, 0, 0)  # five batches of 10,000
