"""Shares and folds of customers, pooled isotonic fits and attributions, against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from promolens.operators import attribution, groups, modeling, pooling
from promolens.operators.layout import Limits


@pytest.mark.parametrize("seed", range(4))
def test_items_go_to_the_lightest_load(seed):
    dice = random.Random(seed)
    for _ in range(200):
        loads = [dice.randrange(60) for _ in range(dice.randint(1, 6))]
        size, count = dice.randint(1, 9), dice.randrange(40)
        expected, now = [0] * len(loads), list(loads)
        for _ in range(count):
            i = min(range(len(now)), key=lambda i: (now[i], i))
            now[i], expected[i] = now[i] + size, expected[i] + 1
        assert groups.lightest_first(loads, size, count) == expected


def test_many_items_cost_nothing():
    counts = groups.balanced_counts([(1, 10**12), (10**9, 3)], 4)
    rows = [sum(n * size for size, n in ((s, counts[s][k]) for s in counts)) for k in range(4)]
    assert max(rows) - min(rows) <= 1 and sum(rows) == 10**12 + 3 * 10**9


@pytest.mark.parametrize("limits", [None, Limits(chunks=8, min_rows=3)])
def test_balanced_folds(spark, limits):
    dice = random.Random(9)
    sizes = {f"c{i}": dice.choice([1, 1, 1, 2, 3, 9, 40]) for i in range(150)} | {None: 5}
    rows = [(c, n) for c, k in sizes.items() for n in range(k)]
    df = spark.createDataFrame(rows, "customer_id string, n int")
    found = groups.with_balanced_fold(df, 5, "customer_id", 1, limits).collect()
    assert Counter((r.customer_id, r.n) for r in found) == Counter(rows)
    of = {}
    for r in found:
        assert of.setdefault(r.customer_id, r.fold) == r.fold
    rows_of = Counter(r.fold for r in found)
    assert [rows_of[k] for k in range(5)] == groups.one_by_one(list(sizes.values()), 5)
    assert groups.with_balanced_fold(df.limit(0), 5, "customer_id", 1).count() == 0


@pytest.mark.parametrize("limits", [None, Limits(chunks=8, min_rows=3)])
@pytest.mark.parametrize("fraction, customers, expected", [(0.2, 11, 3), (0.2, 10, 2), (0.5, 1, 1), (1.0, 7, 7)])
def test_exact_share_of_customers(spark, limits, fraction, customers, expected):
    df = spark.range(200).selectExpr(f"if(id % {customers} = 0, null, concat('c', id % {customers})) as customer_id")
    flagged = modeling.with_calibration_flag(df, fraction, limits=limits)
    held = {r.customer_id for r in flagged.where("calibration").collect()}
    rest = {r.customer_id for r in flagged.where("not calibration").collect()}
    assert len(held) == expected and not held & rest and len(held | rest) == customers
    assert flagged.where("calibration is null").count() == 0


def plain_isotonic(pairs):
    """Fitted value of each score by largest mean of least means."""
    scores = sorted({s for s, _ in pairs})
    sums = [(sum(1 for s, _ in pairs if s == x), sum(v for s, v in pairs if s == x)) for x in scores]
    out = {}
    for i, x in enumerate(scores):
        best = -np.inf
        for a in range(i + 1):
            w, t, least = 0, 0.0, np.inf
            for b in range(a, len(scores)):
                w, t = w + sums[b][0], t + sums[b][1]
                if b >= i:
                    least = min(least, t / w)
            best = max(best, least)
        out[x] = best
    return out


@pytest.mark.parametrize("ranges, merged", [(1, 2), (3, 2), (37, 3), (8, 32)])
def test_pooling_by_ranges(spark, ranges, merged):
    dice = random.Random(ranges)
    pairs = [(dice.randrange(80) / 80, float(dice.random() < 0.3 + 0.004 * i)) for i in range(120)]
    df = spark.createDataFrame([*pairs, (None, 1.0), (0.5, None)], "score double, y double")
    blocks = pooling.isotonic_blocks(df, "score", "y", ranges, merged)
    expected = plain_isotonic(pairs)
    asked = spark.createDataFrame([(x,) for x in [*expected, None, -1.0, 2.0]], "score double")
    found = {r.score: r.calibrated for r in pooling.calibrated(asked, blocks, "score").collect()}
    for x, value in expected.items():
        assert found[x] == pytest.approx(value, abs=1e-12)
    assert found[None] is None
    assert found[-1.0] == pytest.approx(expected[min(expected)]) and found[2.0] == pytest.approx(expected[max(expected)])


def test_between_blocks_as_the_library_does(spark):
    dice = random.Random(2)
    pairs = [(dice.randrange(60) / 7, float(dice.random() < 0.1 + i / 300)) for i in range(250)]
    df = spark.createDataFrame(pairs, "score double, y double")
    blocks = pooling.isotonic_blocks(df, "score", "y")
    asked = spark.range(-5, 200).selectExpr("id / 20.0d as score")
    theirs = IsotonicRegression(featuresCol="score", labelCol="y", predictionCol="theirs").fit(df)
    both = theirs.transform(pooling.calibrated(asked, blocks, "score"))
    assert both.where("abs(theirs - calibrated) > 1e-9 or calibrated is null").count() == 0


def test_no_scores_no_blocks(spark):
    df = spark.createDataFrame([], "score double, y double")
    blocks = pooling.isotonic_blocks(df, "score", "y", 8)
    assert blocks.collect() == []
    asked = spark.createDataFrame([(0.5,)], "score double")
    assert pooling.calibrated(asked, blocks, "score").first().calibrated is None


def test_only_blocks_are_passed_on(spark):
    df = spark.range(20000).selectExpr("id / 20000 as score", "cast(id % 2 as double) as y")
    assert pooling.isotonic_blocks(df, "score", "y", 16).count() < 20


def columns_of(df, operator=None):
    """Column types of the nodes of a plan, or of one operator of it."""
    nodes, out = [df._jdf.queryExecution().optimizedPlan()], []
    while nodes:
        node = nodes.pop()
        if operator in (None, node.nodeName()):
            out.append(node.schema().simpleString())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return out


def test_no_row_carries_the_blocks(spark):
    df = spark.range(200).selectExpr("id / 200 as score", "cast(id % 3 = 0 as double) as y")
    blocks = pooling.isotonic_blocks(df, "score", "y", 4)
    found = columns_of(pooling.calibrated(df, blocks, "score"))
    assert len(found) > 1 and not any("array" in types for types in found)


@pytest.fixture(scope="module")
def fitted(spark):
    rows = spark.range(900).selectExpr(
        "concat('c', id % 90) as customer_id", "cast(id as double) as time_received",
        "if(id % 11 = 0, null, (id * 37) % 101) as up", "(id * 53) % 97 as down", "7.0d as same",
        "if(id % 5 = 0, 'x', if(id % 5 < 3, 'y', 'z')) as kind",
    )
    score = "coalesce(up, 0) - down + if(kind = 'x', 40, 0)"
    rows = rows.withColumn("target", F.expr(f"int({score} > 10)"))
    trainer = modeling.PropensityTrainer(rows, ["up", "down", "same"], ["kind"])
    trainer.train(maxIter=5, maxDepth=4, minInstancesPerNode=5)
    return trainer.model, rows


def test_contributions_add_up_to_the_margin(fitted):
    model, rows = fitted
    found = attribution.attributions(model, rows)
    assert found.columns == [*rows.columns, "base", "contributions"]
    assert found.count() == rows.count()
    total = F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    kept = modeling.numeric_inputs(found.withColumn("_total", total), model.numerical)
    margin = vector_to_array("rawPrediction")[1]
    assert model.pipeline.transform(kept).where(F.abs(margin - F.col("_total")) > 1e-9).count() == 0


def test_directions(fitted):
    model, rows = fitted
    found = {r.feature: r for r in attribution.attribution_summary(model, rows).collect()}
    assert set(found) == {"up", "down", "same", "kind"}
    assert found["up"].direction == 1 and found["down"].direction == -1
    assert found["same"].direction is None and found["same"].mean_abs == 0
    assert found["kind"].direction is None and found["kind"].mean_abs > 0
    gains = list(model.gain_importance())
    assert set(gains[:2]) == {"up", "down"} == set(sorted(found, key=lambda f: -found[f].mean_abs)[:2])


def test_reasons_are_the_strongest_inputs(fitted):
    model, rows = fitted
    of = {
        r.time_received: r.contributions for r in attribution.attributions(model, rows).collect()
    }
    found = attribution.reasons(model, rows, ["customer_id", "time_received"], 2).collect()
    by_row = {}
    for r in found:
        assert r.contribution == of[r.time_received][model.inputs.index(r.feature)]
        assert r.direction == (1 if r.contribution > 0 else -1)
        by_row.setdefault(r.time_received, {})[r["rank"]] = abs(r.contribution)
    assert len(by_row) == 900
    for time, ranks in by_row.items():
        assert sorted(ranks.values(), reverse=True) == [ranks[k] for k in sorted(ranks)]
        assert max(map(abs, of[time])) == ranks[1]


def test_reasons_pass_on_their_keys_alone(fitted):
    model, rows = fitted
    found = columns_of(attribution.reasons(model, rows, ["customer_id"]), "MapInArrow")
    assert found == ["struct<customer_id:string,base:double,contributions:array<double>>"]


@pytest.mark.parametrize("n, keep", [(50, 3), (1, 3), (4, 2), (27, 3), (2, 5)])
def test_a_race_drops_weak_sets_early(n, keep):
    draws = [{"quality": (i * 7919) % 101, "maxIter": 270} for i in range(n)]
    cost, sizes = [], []

    def scores(alive, share):
        cost.append(share * len(alive))
        sizes.append((len(alive), share))
        return [float(d["quality"]) for d in alive]

    best, score = modeling.successive_halving(draws, scores, keep)
    assert best["quality"] == score == max(d["quality"] for d in draws)
    assert sizes[0][0] == n and sizes[-1][1] == 1 and sizes[-1][0] <= max(keep, 1) + 1
    assert all(b[1] == pytest.approx(a[1] * keep) for a, b in zip(sizes, sizes[1:]))
    if n == 50:
        assert sum(cost) < 10


def test_equal_sets_leave_the_first(spark):
    draws = [{"k": i} for i in range(9)]
    assert modeling.successive_halving(draws, lambda alive, share: [1.0] * len(alive))[0] == {"k": 0}
    with pytest.raises(ValueError):
        modeling.successive_halving([], lambda alive, share: [])
