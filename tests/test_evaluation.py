"""Ranking, evaluation and policies on small scored tables, against brute force."""

import math
import random
import statistics

import pytest

from promolens.operators import correlation, evaluation, policy, quantiles, ranking
from promolens.operators.layout import Limits

SMALL = [(0.9, 1), (0.8, 0), (0.7, 1), (0.7, 0), (0.2, 1)]
LIMITS = [None, Limits(chunks=6, min_rows=3)]


def table(spark, pairs):
    rows = [(i, y, float(s)) for i, (s, y) in enumerate(pairs)]
    return spark.createDataFrame(rows, "key bigint, y int, score double")


def tied_pairs(n=300, seed=5):
    """A third of the rows share one score."""
    dice = random.Random(seed)
    return [
        (0.5 if dice.random() < 0.33 else dice.randrange(1000) / 1000, int(dice.random() < 0.4))
        for _ in range(n)
    ]


def ordered(pairs):
    return sorted(((s, -i, y) for i, (s, y) in enumerate(pairs)), reverse=True)


@pytest.mark.parametrize("limits", LIMITS)
def test_known_quality(spark, limits):
    df = table(spark, SMALL)
    row = evaluation.model_quality(df, limits).first()
    assert row["pr_auc"] == pytest.approx(0.7)
    assert row["roc_auc"] == pytest.approx(0.416667, abs=1e-6)
    assert evaluation.ks(df, limits).first()["ks_value"] == pytest.approx(1 / 3)


def test_one_class_only(spark):
    df = table(spark, [(0.3, 1), (0.6, 1)])
    assert math.isnan(evaluation.model_quality(df).first()["roc_auc"])
    assert tuple(evaluation.confusion(df, 0.5).first()) == (0, 0, 1, 1)


@pytest.mark.parametrize("limits", LIMITS)
def test_cuts_inside_a_tied_score(spark, limits):
    pairs = tied_pairs()
    best = ordered(pairs)
    ks = [1, 7, 60, 100, 150, 299, 300, 1000]
    got = evaluation.ranking_table(table(spark, pairs), ks, "key", limits).collect()
    assert len(got) == len(ks)
    for row in got:
        assert row["positives_in_topk"] == sum(y for _, _, y in best[: row["k"]])


@pytest.mark.parametrize("limits", LIMITS)
def test_every_row_ranked(spark, limits):
    pairs = tied_pairs(120)
    best = ordered(pairs)
    rows = ranking.ranked_rows(table(spark, pairs), "key", limits).collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, 121))
    for r in rows:
        assert r["key"] == -best[r["rank"] - 1][1]
        assert r["cum_pos"] == sum(y for _, _, y in best[: r["rank"]])


@pytest.mark.parametrize("n, sizes", [(23, [2] * 9 + [5]), (5, [1] * 5), (100, [10] * 10)])
def test_decile_sizes(spark, n, sizes):
    rows = evaluation.decile_table(table(spark, tied_pairs(n)), "key").collect()
    assert [r["n"] for r in rows] == sizes
    assert rows[-1]["cumulative_recall"] == 1.0


def test_default_tie_break_takes_all_rows(spark):
    rows = evaluation.decile_table(table(spark, tied_pairs(200))).collect()
    assert sum(r["n"] for r in rows) == 200


def test_gains_of_fewer_rows_than_points(spark):
    rows = evaluation.gains_lift(table(spark, SMALL), 100, "key").collect()
    assert sorted(r["k"] for r in rows) == [1, 2, 3, 4, 5]


def test_empty_selection_and_lowest_threshold(spark):
    # Between two grid values: the grid itself holds 0.35000000000000003.
    df = table(spark, [(0.355, 1), (0.355, 0)])
    curve = {round(r["threshold"], 2): r["profit"] for r in policy.profit_curve(df, 10, 1).collect()}
    assert len(curve) == 99 and curve[0.36] == 0.0 and curve[0.35] == pytest.approx(5.1)
    assert policy.best_threshold(df, 10, 1).first()["best_threshold"] == pytest.approx(0.01)
    none = policy.policy_threshold(df, 0.9).first()
    assert none["targeted_n"] == 0 and math.isnan(none["lift_in_target"])


def test_grid_thresholds_are_inclusive(spark):
    df = table(spark, [(t, 1) for t in policy.default_grid()])
    got = sorted(tuple(r) for r in policy.profit_curve(df, 0, -1).collect())
    assert [round(p) for _, p in got] == list(range(99, 0, -1))


def test_budget_must_pay_for_a_contact(spark):
    with pytest.raises(ValueError):
        policy.top_k_budget(table(spark, SMALL), budget=0.5, cost=1)


def test_report_without_contacts(spark):
    row = evaluation.evaluation_report(table(spark, SMALL), k=0).first()
    assert (row["k"], row["precision_at_k"]) == (0, 0.0)


@pytest.mark.parametrize("limits", LIMITS)
@pytest.mark.parametrize("method", ["cont", "disc"])
def test_exact_quantiles_with_a_null_group(spark, limits, method):
    dice = random.Random(11)
    rows = [(dice.choice(["a", "a", "a", None]), dice.randrange(40) / 4) for _ in range(200)]
    ps = [0.0, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame(rows, "g string, x double")
    for row in quantiles.exact_quantiles(df, ["g"], "x", ps, method, limits).collect():
        values = sorted(x for g, x in rows if g == row["g"])
        for p, got in zip(ps, row["quantiles"]):
            if method == "disc":
                want = values[max(math.ceil(p * len(values)) - 1, 0)]
            else:
                at = p * (len(values) - 1)
                low, high = values[math.floor(at)], values[math.ceil(at)]
                want = low + (high - low) * (at - math.floor(at))
            assert got == pytest.approx(want)


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double")
    assert [(r["bin"], r["n"]) for r in quantiles.histogram(df, "x").collect()] == [(1, 2)]


def test_correlation_with_gaps_and_a_constant(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, None, 5.0), (4.0, 8.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {
        (r["column_a"], r["column_b"]): (r["n"], r["correlation"])
        for r in correlation.correlation_matrix(df, ["a", "b", "c"]).collect()
    }
    assert got["a", "b"][0] == 3 and got["a", "b"][1] == pytest.approx(
        statistics.correlation([1.0, 2.0, 4.0], [2.0, 4.1, 8.0])
    )
    assert got["a", "c"] == (4, None) and got["c", "c"][1] is None
    assert got["a", "a"][1] == pytest.approx(1.0)
    with pytest.raises(ValueError):
        correlation.correlation_matrix(df, ["no such"])
