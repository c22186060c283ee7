"""Model quality, curves and ranking tables for a scored table (`y` 0/1, `score`)."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.functions.columns import ratio
from promolens.operators.layout import Limits
from promolens.operators.quantiles import exact_quantiles
from promolens.operators.ranking import at_cuts, cumulative, ranked_rows, score_counts

NAN = float("nan")


def _over(numerator: Column, denominator: Column) -> Column:
    """Ratio with a denominator of at least 1."""
    return numerator.cast("double") / F.greatest(denominator, F.lit(1)).cast("double")


def _lift(precision: Column, base_rate: Column) -> Column:
    return F.coalesce(ratio(precision, base_rate), F.lit(NAN))


def quality_columns() -> dict[str, Column]:
    """Aggregates over `ranking.cumulative`."""
    p, n, pos = F.col("score"), F.col("n"), F.col("pos")
    neg = n - pos
    total_n, total_pos = F.max("total.n"), F.max("total.pos")
    total_neg = total_n - total_pos
    eps = sys.float_info.epsilon
    clipped = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    precision = F.col("cum_pos") / F.col("cum_n")
    higher_pos = F.col("cum_pos") - pos
    pairs = F.sum(neg.cast("double") * (higher_pos + pos / 2))
    loss = F.sum(-(pos * F.ln(clipped) + neg * F.ln(1 - clipped)))
    squares = F.sum(pos * (1 - p) * (1 - p) + neg * p * p)
    both = (total_pos > 0) & (total_neg > 0)
    return {
        "pr_auc": F.coalesce(ratio(F.sum(pos * precision), total_pos), F.lit(0.0)),
        "roc_auc": F.when(
            both, ratio(pairs, total_pos.cast("double") * total_neg.cast("double"))
        ).otherwise(NAN),
        "logloss": ratio(loss, total_n),
        "brier": ratio(squares, total_n),
        "base_rate": ratio(total_pos, total_n),
    }


def model_quality(scored: DataFrame, limits: Limits | None = None) -> DataFrame:
    """One row: average precision, tie-aware ROC-AUC (NaN with one class only), log loss,
    Brier score, base rate."""
    return cumulative(scored, limits).agg(*[v.alias(k) for k, v in quality_columns().items()])


def roc_curve(scored: DataFrame, limits: Limits | None = None) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, and the origin with a NULL threshold."""
    points = cumulative(scored, limits).select(
        F.col("score").alias("threshold"),
        ratio(
            F.col("cum_n") - F.col("cum_pos"), F.col("total.n") - F.col("total.pos")
        ).alias("fpr"),
        ratio(F.col("cum_pos"), F.col("total.pos")).alias("tpr"),
    )
    origin = scored.sparkSession.range(1).selectExpr(
        "cast(null as double) as threshold", "0.0D as fpr", "0.0D as tpr"
    )
    return points.unionByName(origin)


def pr_curve(scored: DataFrame, limits: Limits | None = None) -> DataFrame:
    """(threshold, recall, precision) per distinct score, and the end point (0, 1)."""
    points = cumulative(scored, limits).select(
        F.col("score").alias("threshold"),
        ratio(F.col("cum_pos"), F.col("total.pos")).alias("recall"),
        ratio(F.col("cum_pos"), F.col("cum_n")).alias("precision"),
    )
    end = scored.sparkSession.range(1).selectExpr(
        "cast(null as double) as threshold", "0.0D as recall", "1.0D as precision"
    )
    return points.unionByName(end)


def calibration_curve(
    scored: DataFrame, n_bins: int = 10, strategy: str = "quantile", limits: Limits | None = None
) -> DataFrame:
    """(bin, n, mean_pred, frac_pos) of the bins that hold rows; a score equal to an edge
    belongs to the lower bin."""
    counts = score_counts(scored)
    inner = [i / n_bins for i in range(1, n_bins)]
    if strategy == "quantile":
        edges = exact_quantiles(scored, [], "score", inner, "cont", limits).scalar()
    elif strategy == "uniform":
        edges = F.array(*[F.lit(e) for e in inner])
    else:
        raise ValueError("strategy is 'quantile' or 'uniform'")
    n, pos, score = F.col("n"), F.col("pos"), F.col("score")
    below = F.size(F.filter("_edges", lambda e: e < score))
    return (
        counts.withColumn("_edges", edges)
        .groupBy((below + 1).alias("bin"))
        .agg(
            F.sum(n).alias("n"),
            ratio(F.sum(score * n), F.sum(n)).alias("mean_pred"),
            ratio(F.sum(pos), F.sum(n)).alias("frac_pos"),
        )
    )


def _confusion(threshold: float) -> dict[str, Column]:
    chosen, positive = F.col("score") >= F.lit(float(threshold)), F.col("y") == 1
    return {
        "tn": F.count_if(~chosen & ~positive),
        "fp": F.count_if(chosen & ~positive),
        "fn": F.count_if(~chosen & positive),
        "tp": F.count_if(chosen & positive),
    }


def confusion(scored: DataFrame, threshold: float) -> DataFrame:
    """One row: tn, fp, fn, tp at score >= threshold; all four also with one class only."""
    return scored.agg(*[v.alias(k) for k, v in _confusion(threshold).items()])


def conversion_metrics(scored: DataFrame, threshold: float) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n, chosen = tn + fp + fn + tp, tp + fp
    base_rate, precision = ratio(tp + fn, n), _over(tp, chosen)
    return confusion(scored, threshold).select(
        F.lit(float(threshold)).alias("threshold"),
        base_rate.alias("base_rate"),
        chosen.alias("targeted_n"),
        F.coalesce(ratio(chosen, n), F.lit(0.0)).alias("targeted_rate"),
        "tp",
        "fp",
        "fn",
        "tn",
        precision.alias("precision"),
        _over(tp, tp + fn).alias("recall"),
        _lift(precision, base_rate).alias("lift"),
    )


def classification_report(scored: DataFrame, threshold: float) -> DataFrame:
    """(label, precision, recall, f1_score, support) for both classes, macro and weighted
    averages; in the accuracy row all three scores are the accuracy. Rounded to 4 places."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp

    def rate(a: Column, b: Column) -> Column:
        return F.coalesce(ratio(a, b), F.lit(0.0))

    def scores(hit: Column, wrongly: Column, missed: Column) -> tuple[Column, Column, Column]:
        return rate(hit, hit + wrongly), rate(hit, hit + missed), rate(
            2 * hit, 2 * hit + wrongly + missed
        )

    negative, positive = scores(tn, fn, fp), scores(tp, fp, fn)
    n0, n1 = tn + fp, tp + fn
    macro = [(a + b) / 2 for a, b in zip(negative, positive)]
    weighted = [rate(a * n0 + b * n1, n) for a, b in zip(negative, positive)]

    def line(label: str, values: Sequence[Column], support: Column) -> Column:
        names = ("precision", "recall", "f1_score")
        rounded = [F.round(v, 4).alias(c) for v, c in zip(values, names)]
        return F.struct(F.lit(label).alias("label"), *rounded, support.alias("support"))

    lines = F.array(
        line("0", negative, n0),
        line("1", positive, n1),
        line("accuracy", [rate(tp + tn, n)] * 3, n),
        line("macro avg", macro, n),
        line("weighted avg", weighted, n),
    )
    return confusion(scored, threshold).select(F.inline(lines))


def ks_columns() -> dict[str, Column]:
    """Aggregates over `ranking.cumulative`."""
    pos = _over(F.col("cum_pos"), F.col("total.pos"))
    neg = _over(F.col("cum_n") - F.col("cum_pos"), F.col("total.n") - F.col("total.pos"))
    gap = F.abs(pos - neg)
    return {
        "ks_value": F.max(gap),
        "ks_threshold": F.max_by("score", F.struct(gap.alias("gap"), "score")),
    }


def ks(scored: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Largest gap between the classes' cumulative shares, and the (highest) score there."""
    return cumulative(scored, limits).agg(*[v.alias(k) for k, v in ks_columns().items()])


def _at_k(cuts: DataFrame) -> DataFrame:
    k, found = F.col("k"), F.col("positives")
    precision = ratio(found, k)
    base_rate = ratio(F.col("pos_total"), F.col("n_total"))
    return cuts.select(
        "cut",
        "k",
        ratio(k, F.col("n_total")).alias("k_rate"),
        precision.alias("precision_at_k"),
        _over(found, F.col("pos_total")).alias("recall_at_k"),
        _lift(precision, base_rate).alias("lift_at_k"),
        found.alias("positives_in_topk"),
    )


def ranking_table(
    scored: DataFrame, ks: Sequence[int], tie: str | None = None, limits: Limits | None = None
) -> DataFrame:
    """Precision, recall and lift in the top k, one row per requested k (kept within 1..n)."""
    n = F.col("n_total")
    cuts = [(i, F.least(F.lit(max(int(k), 1)).cast("bigint"), n)) for i, k in enumerate(ks)]
    return _at_k(at_cuts(scored, cuts, tie, limits)).drop("cut")


def ranking_at_k(
    scored: DataFrame, k: int, tie: str | None = None, limits: Limits | None = None
) -> DataFrame:
    return ranking_table(scored, [k], tie, limits)


def gains_lift(
    scored: DataFrame,
    points: int | None = 100,
    tie: str | None = None,
    limits: Limits | None = None,
) -> DataFrame:
    """(k, population, gains, lift) at `points` equal steps of the ranked list, or at every
    row with `points=None`."""
    if points is None:
        rows = ranked_rows(scored, tie, limits).select(
            F.col("rank").alias("k"),
            F.col("cum_pos").alias("positives"),
            F.col("total.n").alias("n_total"),
            F.col("total.pos").alias("pos_total"),
        )
    else:
        n = F.col("n_total")
        cuts = [(i, F.ceil(n * i / F.lit(points)).cast("bigint")) for i in range(1, points + 1)]
        # With fewer rows than points, several points fall on one row.
        rows = at_cuts(scored, cuts, tie, limits).drop("cut").distinct()
    population = ratio(F.col("k"), F.col("n_total"))
    gains = _over(F.col("positives"), F.col("pos_total"))
    return rows.select(
        "k", population.alias("population"), gains.alias("gains"), ratio(gains, population).alias("lift")
    )


def decile_table(
    scored: DataFrame, tie: str | None = None, limits: Limits | None = None
) -> DataFrame:
    """Ten score-ranked groups of n // 10 rows, the last with the remainder; 4 places."""
    n = F.col("n_total")
    size = F.greatest(F.floor(n / 10), F.lit(1))
    cuts = [(d, F.least(size * d, n).cast("bigint")) for d in range(1, 10)]
    ends = at_cuts(scored, [*cuts, (10, n)], tie, limits)
    before = Window.orderBy("cut")  # ten rows

    def step(name: str) -> Column:
        return F.col(name) - F.coalesce(F.col(f"_{name}"), F.lit(0))

    ends = ends.withColumns(
        {f"_{c}": F.lag(c).over(before) for c in ("k", "positives", "score_sum")}
    )
    rows, found = step("k"), step("positives")
    rate = ratio(found, rows)
    base_rate = ratio(F.col("pos_total"), n)
    return (
        ends.where(rows > 0)
        .select(
            F.col("cut").alias("decile"),
            rows.alias("n"),
            F.round(ratio(step("score_sum"), rows), 4).alias("avg_score"),
            found.alias("conversions"),
            F.round(rate, 4).alias("conversion_rate"),
            F.round(_lift(rate, base_rate), 4).alias("lift"),
            F.round(_over(F.col("positives"), F.col("pos_total")), 4).alias("cumulative_recall"),
        )
        .orderBy("decile")
    )


def eval_summary(
    scored: DataFrame, threshold: float = 0.5, limits: Limits | None = None
) -> DataFrame:
    """One row: model quality, conversion at a threshold, and KS."""
    chosen = F.col("score") >= F.lit(float(threshold))
    aggregates = {
        **quality_columns(),
        **ks_columns(),
        "_chosen": F.coalesce(F.sum(F.when(chosen, F.col("n"))), F.lit(0)),
        "_tp": F.coalesce(F.sum(F.when(chosen, F.col("pos"))), F.lit(0)),
        "_n": F.max("total.n"),
        "_pos": F.max("total.pos"),
    }
    n, pos, targeted, tp = (F.col(c) for c in ("_n", "_pos", "_chosen", "_tp"))
    precision = _over(tp, targeted)
    return (
        cumulative(scored, limits)
        .agg(*[v.alias(k) for k, v in aggregates.items()])
        .select(
            *quality_columns(),
            F.lit(float(threshold)).alias("threshold"),
            targeted.alias("targeted_n"),
            F.coalesce(ratio(targeted, n), F.lit(0.0)).alias("targeted_rate"),
            tp.alias("tp"),
            (targeted - tp).alias("fp"),
            (pos - tp).alias("fn"),
            (n - targeted - (pos - tp)).alias("tn"),
            precision.alias("precision"),
            _over(tp, pos).alias("recall"),
            _lift(precision, F.col("base_rate")).alias("lift"),
            *ks_columns(),
        )
    )


def evaluation_report(
    scored: DataFrame, k: int = 5000, tie: str | None = None, limits: Limits | None = None
) -> DataFrame:
    """One row: model quality next to precision, recall and lift in the top k.

    k is kept at n or less; k = 0 gives precision 0.
    """
    quality = model_quality(scored, limits)
    names = list(quality_columns())
    if k <= 0:
        none = F.lit(0.0)
        lift = F.when(F.col("base_rate") > 0, none).otherwise(NAN)
        return quality.select(
            *names[:-1],
            none.alias("precision_at_k"),
            none.alias("recall_at_k"),
            lift.alias("lift_at_k"),
            F.lit(0).cast("bigint").alias("k"),
            "base_rate",
        )
    ranked = ranking_at_k(scored, k, tie, limits).agg(
        F.first(F.struct("precision_at_k", "recall_at_k", "lift_at_k", "k"))
    )
    return quality.withColumn("_top", ranked.scalar()).select(
        *names[:-1],
        "_top.precision_at_k",
        "_top.recall_at_k",
        "_top.lift_at_k",
        "_top.k",
        "base_rate",
    )
