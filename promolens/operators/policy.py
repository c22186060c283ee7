"""Targeting policies and their expected profit.

Expected profit of a set of contacts is the sum of score * value - cost over it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions.columns import count_at_most, ratio
from promolens.operators.layout import Limits
from promolens.operators.ranking import at_cuts, score_counts

NAN = float("nan")


def default_grid() -> list[float]:
    """99 thresholds from 0.01 to 0.99, as evenly spaced doubles."""
    return [float(t) for t in np.linspace(0.01, 0.99, 99)]


def _report(name: str, value: float, cost: float) -> list[Column]:
    """Report columns from k, positives, score_sum, n_total and pos_total."""
    k, found = F.col("k"), F.col("positives")
    some = k > 0
    precision = ratio(found, k)
    profit = F.col("score_sum") * value - k * cost
    spend = k.cast("double") * cost
    base_rate = ratio(F.col("pos_total"), F.col("n_total"))
    return [
        F.lit(name).alias("policy_name"),
        k.alias("targeted_n"),
        F.coalesce(ratio(k, F.col("n_total")), F.lit(0.0)).alias("targeted_rate"),
        found.alias("actual_conversions_in_target"),
        F.coalesce(precision, F.lit(0.0)).alias("precision_in_target"),
        (found / F.greatest(F.col("pos_total"), F.lit(1))).alias("recall_in_target"),
        F.coalesce(ratio(precision, base_rate), F.lit(NAN)).alias("lift_in_target"),
        F.when(some, profit).otherwise(0.0).alias("expected_profit"),
        F.coalesce(F.when(some, ratio(profit, spend)), F.lit(NAN)).alias("expected_roi"),
        F.when(some, spend).otherwise(0.0).alias("spend"),
    ]


def top_k_budget(
    scored: DataFrame,
    budget: float = 50_000.0,
    cost: float = 1.0,
    value: float = 10.0,
    name: str = "Top-K by budget",
    tie: str | None = None,
    limits: Limits | None = None,
) -> DataFrame:
    """Report on contacting the best rows a budget can pay for."""
    affordable = math.floor(budget / cost)
    if affordable <= 0:
        raise ValueError("the budget does not pay for one contact")
    k = F.least(F.lit(affordable).cast("bigint"), F.col("n_total"))
    return at_cuts(scored, [(0, k)], tie, limits).select(*_report(name, value, cost))


def policy_threshold(
    scored: DataFrame,
    threshold: float,
    value: float = 10.0,
    cost: float = 1.0,
    name: str = "Threshold policy",
) -> DataFrame:
    """Report on contacting every row with score >= threshold; zeros if there is none."""
    chosen = F.col("score") >= F.lit(float(threshold))
    y = F.col("y").cast("bigint")
    sums = scored.agg(
        F.count_if(chosen).alias("k"),
        F.coalesce(F.sum(F.when(chosen, y)), F.lit(0)).alias("positives"),
        F.coalesce(F.sum(F.when(chosen, F.col("score"))), F.lit(0.0)).alias("score_sum"),
        F.count(F.lit(1)).alias("n_total"),
        F.coalesce(F.sum(y), F.lit(0)).alias("pos_total"),
    )
    return sums.select(*_report(name, value, cost))


def profit_curve(
    scored: DataFrame,
    value: float = 10.0,
    cost: float = 1.0,
    grid: Sequence[float] | None = None,
) -> DataFrame:
    """(threshold, profit) of contacting everyone at or above each grid threshold."""
    grid = sorted(float(t) for t in (default_grid() if grid is None else grid))
    steps = F.array(*[F.lit(t) for t in grid])
    score = F.col("score")
    # A row counts for every grid value up to its score: fold rows by how many those are,
    # then each of the few folds for all the thresholds it reaches. Decimal sums do not depend
    # on their order, so thresholds that select the same rows tie exactly.
    weighted = score.cast("decimal(20,16)") * F.col("n").cast("decimal(14,0)")
    # The fold number comes back as an aggregate: a filter on it then stays after the folding.
    folds = (
        score_counts(scored)
        .withColumn("_fold", count_at_most("score", [f"{t!r}D" for t in grid]))
        .groupBy("_fold")
        .agg(
            F.max("_fold").alias("reached"),
            F.sum("n").alias("n"),
            F.sum(weighted).alias("score_sum"),
        )
        .where(F.col("reached") > 0)
    )
    profits = (
        folds.select("n", "score_sum", F.explode(F.sequence(F.lit(1), "reached")).alias("step"))
        .groupBy("step")
        .agg((F.sum("score_sum").cast("double") * value - F.sum("n") * cost).alias("profit"))
    )
    thresholds = scored.sparkSession.range(1).select(F.posexplode(steps).alias("_i", "threshold"))
    return (
        thresholds.withColumn("step", F.col("_i") + 1)
        .join(profits, "step", "left")
        .select("threshold", F.coalesce("profit", F.lit(0.0)).alias("profit"))
    )


def best_threshold(
    scored: DataFrame,
    value: float = 10.0,
    cost: float = 1.0,
    grid: Sequence[float] | None = None,
) -> DataFrame:
    """One row: the threshold of highest expected profit, the lowest one if several tie."""
    first = F.struct((-F.col("profit")).alias("loss"), "threshold")
    return profit_curve(scored, value, cost, grid).agg(
        F.min_by("threshold", first).alias("best_threshold"), F.max("profit").alias("best_profit")
    )


def financial_uplift(
    scored: DataFrame, threshold: float, value: float, cost: float
) -> DataFrame:
    """One row: contacting everyone against contacting score >= threshold."""
    chosen = F.col("score") >= F.lit(float(threshold))
    sums = scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(chosen).alias("k"),
        F.coalesce(F.sum("score"), F.lit(0.0)).alias("s"),
        F.coalesce(F.sum(F.when(chosen, F.col("score"))), F.lit(0.0)).alias("s_chosen"),
    )
    baseline = F.col("s") * value - F.col("n") * cost
    model = F.col("s_chosen") * value - F.col("k") * cost
    uplift = model - baseline
    left_out = F.col("n") - F.col("k")
    return sums.select(
        F.col("n").alias("total_n"),
        baseline.alias("baseline_profit"),
        model.alias("model_profit"),
        uplift.alias("uplift"),
        F.coalesce(ratio(uplift, F.abs(baseline)) * 100, F.lit(0.0)).alias("uplift_pct"),
        F.col("k").alias("targeted_n"),
        left_out.alias("excluded_n"),
        (left_out * F.lit(float(cost))).alias("cost_saved"),
    )


def policy_report_long(report: DataFrame) -> DataFrame:
    """A policy report as (policy_name, metric, value) rows."""
    metrics = [c for c in report.columns if c != "policy_name"]
    numbers = report.select("policy_name", *[F.col(c).cast("double").alias(c) for c in metrics])
    return numbers.unpivot("policy_name", metrics, "metric", "value")


def avg_conversion_value(train: DataFrame, cost: float = 1.0) -> DataFrame:
    """Mean earlier ticket of converters, and the break-even score cost / value."""
    converters = train.where(F.col("target") == 1)
    return converters.agg(F.avg("avg_ticket_before").alias("avg_conversion_value")).select(
        "avg_conversion_value",
        ratio(F.lit(float(cost)), F.col("avg_conversion_value")).alias("break_even_threshold"),
    )
