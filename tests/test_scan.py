"""The ordered scan with and without hot keys, against brute force in Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from promolens.operators.layout import CELL, Layout, Limits
from promolens.operators.scan import BEFORE, FROM, UPTO, Running, ordered_scan

TINY = Limits(chunks=8, min_rows=5)


def rows_with_hot_key(n=400, seed=3):
    """One key holds most rows, in bursts and with copies; some keys and times are NULL."""
    dice = random.Random(seed)
    rows = []
    for i in range(n):
        key = dice.choice(["hot"] * 6 + ["a", "b", "c", None])
        t = dice.choice([dice.randrange(20), 500 + dice.randrange(4), dice.randrange(1000), None])
        rows.append((i, key, t, dice.randrange(10)))
    return rows


def running():
    known = F.coalesce(F.col("v"), F.lit(0))
    return [
        Running("sum_before", "sum", known, BEFORE),
        Running("max_before", "max", F.col("v"), BEFORE),
        Running("sum_upto", "sum", known, UPTO),
        Running("min_from", "min", F.col("v"), FROM),
        Running("sum_ago", "sum", known, BEFORE, ago=7),
        Running("sum_long_ago", "sum", known, BEFORE, "bigint", ago=300),
    ]


def brute_force(rows):
    by_key = defaultdict(list)
    for _, key, t, v in rows:
        by_key[key].append((t, v))
    out = {}
    for i, key, t, _ in rows:
        if key is None or t is None:
            continue
        before = [v for x, v in by_key[key] if x is not None and x < t]
        upto = [v for x, v in by_key[key] if x is not None and x <= t]
        later = [v for x, v in by_key[key] if x is not None and x >= t]
        earlier = [[v for x, v in by_key[key] if x is not None and x < t - d] for d in (7, 300)]
        out[i] = (
            sum(before) if before else None,
            max(before, default=None),
            sum(upto),
            min(later),
            *(sum(ago) if ago else None for ago in earlier),
        )
    return out


@pytest.mark.parametrize("limits", [None, TINY, Limits(chunks=3, min_rows=1), Limits(at_most=400)])
def test_against_brute_force(spark, limits):
    rows = rows_with_hot_key()
    df = spark.createDataFrame(rows, "id int, k string, t bigint, v int")
    placed = df.where("t is not null")
    got = ordered_scan(placed, running(), Layout.of(placed, ["k"], "t", limits))
    # Cells before add nothing, one cell has nothing before: both are no earlier rows.
    ago = ("sum_ago", "sum_long_ago")
    result = {
        r["id"]: tuple(r[x.name] or None if x.name in ago else r[x.name] for x in running())
        for r in got.where("k is not null").collect()
    }
    expected = {i: (*v[:-2], v[-2] or None, v[-1] or None) for i, v in brute_force(rows).items()}
    assert result == expected


def test_hot_key_is_cut_and_cold_keys_are_not(spark):
    df = spark.createDataFrame(rows_with_hot_key(), "id int, k string, t bigint, v int")
    layout = Layout.of(df, ["k"], "t", TINY)
    cells = layout.assign(df).where("t is not null").groupBy("k", CELL).count().collect()
    of_hot = [r for r in cells if r["k"] == "hot"]
    assert len(of_hot) > 8
    assert max(r["count"] for r in of_hot) < 150
    assert all(r[CELL] < 0 for r in cells if r["k"] is None)


def test_cells_rise_with_the_order_column(spark):
    df = spark.createDataFrame(rows_with_hot_key(), "id int, k string, t bigint, v int")
    placed = Layout.of(df, ["k"], "t", TINY).assign(df).where("k = 'hot' and t is not null")
    pairs = sorted((r["t"], r[CELL]) for r in placed.collect())
    assert all(a[1] <= b[1] for a, b in zip(pairs, pairs[1:]))


@pytest.mark.parametrize("spread", ["t", "if(t = 0, 1e15, t)", "exp(t % 997 / 60.0)", "if(t % 9 = 0, double('nan'), t)"])
def test_no_cell_is_large_unless_one_value_is(spark, spread):
    df = spark.range(30_000).selectExpr("'hot' as k", "id as t", "1 as v")
    df = df.selectExpr("k", f"cast({spread} as double) as t", "v")
    layout = Layout.of(df, ["k"], "t", Limits(chunks=100, min_rows=1))
    cells = layout.assign(df).groupBy(CELL).agg(F.count("*").alias("n"), F.countDistinct("t").alias("d"))
    assert cells.where("n > 600 and d > 1").count() == 0
    running = [Running("n", "sum", F.col("v"), UPTO)]
    found = ordered_scan(df, running, layout).groupBy("t").agg(F.max("n").alias("n"))
    plain = ordered_scan(df, running, Layout(("k",), "t")).groupBy("t").agg(F.max("n").alias("n"))
    assert found.exceptAll(plain).count() == plain.exceptAll(found).count() == 0


def test_broadcasts_are_bounded(spark):
    df = spark.createDataFrame(
        [(f"k{i % 50}", i) for i in range(5000)], "k string, t bigint"
    )
    limits = Limits(chunks=20, min_rows=1)
    layout = Layout.of(df, ["k"], "t", limits)
    assert layout.hot.count() < limits.chunks
    assert layout.heavy.count() <= limits.chunks


def test_small_input_needs_no_cells(spark):
    df = spark.createDataFrame([("a", 1)], "k string, t bigint")
    assert Layout.of(df, ["k"], "t").single
    assert not Layout.of(df, ["k"], "t", Limits(min_rows=0)).single


def test_layout_of_a_large_input_counts_by_hash(spark, monkeypatch):
    import promolens.operators.layout as layout_module

    monkeypatch.setattr(layout_module, "WITNESSES", 50)
    df = spark.range(20_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id % 500)) as k", "id * 7 % 20011 as t", "1 as v"
    )
    layout = Layout.of(df, ["k"], "t", Limits(chunks=16, min_rows=1000))
    assert [r["k"] for r in layout.hot.collect()] == ["hot"]
    total = ordered_scan(df, [Running("n", "sum", F.col("v"), UPTO)], layout)
    assert total.where("k = 'hot'").agg(F.max("n")).first()[0] == 6667


def test_large_input_without_hot_keys_moves_once(spark, monkeypatch):
    import promolens.operators.layout as layout_module

    monkeypatch.setattr(Limits, "min_rows", 1000)
    monkeypatch.setattr(layout_module, "TASK_ROWS", 500)
    df = spark.range(6000).selectExpr("id % 300 as k", "id * 7 % 6007 as t", "1 as v")
    limits = Limits(chunks=16, min_rows=1000)
    layout = Layout.of(df, ["k"], "t", limits)
    # No cells, and as many tasks as the rows ask for, which adaptive execution does not join.
    assert layout.single and layout.tasks == 12
    running = [Running("n", "sum", F.col("v"), UPTO)]
    found = ordered_scan(df, running, layout)
    assert found.rdd.getNumPartitions() == 12
    plain = ordered_scan(df, running, Layout(("k",), "t"))
    assert found.exceptAll(plain).count() == plain.exceptAll(found).count() == 0
    assert Layout.of(df.limit(900), ["k"], "t", limits).tasks is None
    # Rows without a key or an order are one partition of a window, so many of them need cells.
    for gap in ("k", "t"):
        holes = df.withColumn(gap, F.expr(f"if({gap} % 2 = 0, null, {gap})"))
        assert not Layout.of(holes, ["k"], "t", limits).single
