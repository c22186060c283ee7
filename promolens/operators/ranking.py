"""Ranking by score without a global sort in one task.

Input: a DataFrame with an outcome `y` (0/1), a `score`, and a numeric tie-breaker. Tied
scores are folded first; running counts go over distinct scores; single rows are only looked
at inside the few tied scores that a cut-off falls into.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.operators.layout import Layout, Limits
from promolens.operators.scan import FROM, UPTO, Running, ordered_scan

ALL = "_all"


def score_counts(scored: DataFrame) -> DataFrame:
    """(score, n, pos): rows and positives per distinct score."""
    return scored.groupBy(F.col("score").cast("double").alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("bigint")).alias("pos")
    )


def score_totals(counts: DataFrame, **more: Column) -> Column:
    """Struct of all rows `n` and all positives `pos`, as a scalar subquery; `more` fields are
    expressions of `n_total` and `pos_total`."""
    sums = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_total"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("pos_total"),
    )
    fields = {"n": F.col("n_total"), "pos": F.col("pos_total"), **more}
    return sums.select(F.struct(*[v.alias(k) for k, v in fields.items()])).scalar()


def cumulative(scored: DataFrame, limits: Limits | None = None, **more: Column) -> DataFrame:
    """Per distinct score: n, pos, and both summed over this and all higher scores
    (`cum_n`, `cum_pos`; `cum_score` sums the scores), with `score_totals` in `total`."""
    counts = score_counts(scored)
    keyed = counts.withColumn(ALL, F.lit(0))
    return (
        ordered_scan(
            keyed,
            [
                Running("cum_n", "sum", F.col("n"), FROM),
                Running("cum_pos", "sum", F.col("pos"), FROM),
                Running("cum_score", "sum", F.col("score") * F.col("n"), FROM),
            ],
            Layout.of(keyed, [ALL], "score", limits, weight="n"),
        )
        .drop(ALL)
        .withColumn("total", score_totals(counts, **more))
    )


def default_tie(scored: DataFrame) -> Column:
    """A numeric tie-breaker for rows without one: a hash of the columns that name the row."""
    return F.xxhash64(*[c for c in scored.columns if c not in ("y", "score")])


def at_cuts(
    scored: DataFrame,
    cuts: Sequence[tuple[Column | str | int, Column]],
    tie: str | None = None,
    limits: Limits | None = None,
) -> DataFrame:
    """What the top k rows hold, for several k at once.

    `cuts` are (label, k) pairs, k a bigint expression of the total row count `n_total` with
    0 < k <= n_total. Output per cut: cut, k, positives, score_sum, n_total, pos_total. Ties
    at a cut-off go by `tie`; equal ties put negatives first.
    """
    tie_value = F.col(tie) if tie else default_tie(scored)
    rows = scored.select("y", F.col("score").cast("double").alias("score"), tie_value.alias("_tie"))
    # The cuts, computed once per query. The row at rank k has exactly one score: a score takes
    # the cuts above the rows before it, up to and with its own last row.
    wanted_cuts = F.array(
        *[F.struct(k.alias("k"), F.lit(label).alias("cut")) for label, k in cuts]
    )
    above = F.col("cum_n") - F.col("n")
    here = F.filter("total.cuts", lambda c: (above < c["k"]) & (c["k"] <= F.col("cum_n")))
    per_cut = (
        cumulative(rows, limits, cuts=wanted_cuts)
        .select("*", F.inline(here))
        .select(
            "cut",
            "k",
            "score",
            F.col("total.n").alias("n_total"),
            F.col("total.pos").alias("pos_total"),
            (F.col("cum_pos") - F.col("pos")).alias("pos_above"),
            "pos",
            (F.col("cum_score") - F.col("score") * F.col("n")).alias("score_above"),
            (F.col("k") - above).alias("taken"),
            F.when(F.col("k") < F.col("cum_n"), F.col("k") - above).alias("split_n"),
        )
    )
    # At most one row per cut: safe to broadcast.
    wanted = F.broadcast(
        per_cut.where(F.col("split_n").isNotNull()).select("cut", "score", "split_n")
    )
    split_scores = F.broadcast(wanted.select("score").distinct())
    tied = (
        rows.join(split_scores, "score", "left_semi")
        .groupBy("score", "_tie")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("bigint")).alias("pos"))
    )
    inside = ordered_scan(
        tied,
        [
            Running("upto_n", "sum", F.col("n"), UPTO),
            Running("upto_pos", "sum", F.col("pos"), UPTO),
        ],
        Layout.of(rows, ["score"], "_tie", limits),
    )
    before = F.col("upto_n") - F.col("n")
    taken = F.col("split_n") - before
    partial = (
        inside.join(wanted, "score")
        .where((before < F.col("split_n")) & (F.col("split_n") <= F.col("upto_n")))
        .select(
            "cut",
            (
                F.col("upto_pos")
                - F.col("pos")
                + F.greatest(taken - (F.col("n") - F.col("pos")), F.lit(0))
            ).alias("split_pos"),
        )
    )
    found = F.when(F.col("split_n").isNull(), F.col("pos")).otherwise(F.col("split_pos"))
    return per_cut.join(partial, "cut", "left").select(
        "cut",
        "k",
        (F.col("pos_above") + found).alias("positives"),
        (F.col("score_above") + F.col("score") * F.col("taken")).alias("score_sum"),
        "n_total",
        "pos_total",
    )


def ranked_rows(
    scored: DataFrame, tie: str | None = None, limits: Limits | None = None
) -> DataFrame:
    """Every row with its rank from the highest score, `cum_pos` up to it, and `total`.

    `tie` must tell rows of one score apart; rows that share it share the later rank.
    """
    tie_value = F.col(tie) if tie else default_tie(scored)
    rows = scored.withColumns({"score": F.col("score").cast("double"), "_tie": tie_value})
    inside = ordered_scan(
        rows,
        [
            Running("_n", "sum", F.lit(1).cast("bigint"), UPTO),
            Running("_pos", "sum", F.col("y").cast("bigint"), UPTO),
        ],
        Layout.of(rows, ["score"], "_tie", limits),
    )
    table = cumulative(scored, limits).select(
        "score",
        (F.col("cum_n") - F.col("n")).alias("_above_n"),
        (F.col("cum_pos") - F.col("pos")).alias("_above_pos"),
        "total",
    )
    return inside.join(table, "score").select(
        *scored.columns,
        (F.col("_above_n") + F.col("_n")).alias("rank"),
        (F.col("_above_pos") + F.col("_pos")).alias("cum_pos"),
        "total",
    )
