"""Opportunities: one row per received offer, with the response inside its validity window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.functions.columns import bands, to_days, to_micros
from promolens.functions.domains import COMPLETED, RECEIVED, UNKNOWN, VIEWED
from promolens.operators.eventlog import narrow_log
from promolens.operators.layout import Layout, Limits
from promolens.operators.quantiles import quantile_row
from promolens.operators.scan import FROM, Running, ordered_scan

OFFER_COLUMNS = ["offer_type", "duration", "min_value", "discount_value", "channels"]
PROFILE_COLUMNS = ["age", "age_group", "gender", "credit_card_limit"]
RESULT_COLUMNS = [
    "user_id",
    "offer_id",
    *OFFER_COLUMNS,
    "t_received",
    "t_expires",
    "t_viewed",
    "t_completed",
    "viewed",
    "completed",
]


def next_responses(events: DataFrame, limits: Limits | None = None) -> DataFrame:
    """(user_id, offer_id, t_us) of each receipt with the first view and completion of that
    offer by that customer at or after it, however late.

    A forward as-of: rows of one instant are folded first (copies vanish map-side), then one
    scan from the latest to the earliest instant of a (customer, offer) finds both answers.
    """
    log = narrow_log(events).where(F.col("event").isin(RECEIVED, VIEWED, COMPLETED))
    keys = ["user_id", "offer_id"]
    # A NULL key or time matches nothing: such a receipt stays, without a response.
    known = F.col("user_id").isNotNull() & F.col("offer_id").isNotNull() & F.col("t_us").isNotNull()
    layout = Layout.of(log, keys, "t_us", limits)
    if layout.single:
        # Dealt once, for folding and for the scan.
        log, layout = layout.dealt(log, *keys), Layout(layout.keys, layout.order)
    instants = (
        log.groupBy(*keys, "t_us")
        .agg(
            F.max(F.col("event") == RECEIVED).alias("received"),
            F.max(F.col("event") == VIEWED).alias("viewed"),
            F.max(F.col("event") == COMPLETED).alias("completed"),
        )
        .where(F.col("received") | known)
    )
    return (
        ordered_scan(
            instants,
            [
                Running("view_us", "min", F.when(F.col("viewed") & known, F.col("t_us")), FROM),
                Running(
                    "completion_us", "min", F.when(F.col("completed") & known, F.col("t_us")), FROM
                ),
            ],
            layout,
        )
        .where("received")
        .select(
            *keys, "t_us", *[F.when(known, F.col(c)).alias(c) for c in ("view_us", "completion_us")]
        )
    )


def _within_window(receipts: DataFrame, last: Sequence[str] = ()) -> DataFrame:
    expires = F.col("t_us") + to_micros(F.col("duration").cast("double"))
    t_viewed = F.when(F.col("view_us") <= expires, to_days(F.col("view_us")))
    t_completed = F.when(F.col("completion_us") <= expires, to_days(F.col("completion_us")))
    times = ("t_us", "view_us", "completion_us")
    carried = [c for c in receipts.columns if c not in (*times, *last)]
    return receipts.select(
        *carried,
        to_days(F.col("t_us")).alias("t_received"),
        to_days(expires).alias("t_expires"),
        t_viewed.alias("t_viewed"),
        t_completed.alias("t_completed"),
        t_viewed.isNotNull().cast("int").alias("viewed"),
        t_completed.isNotNull().cast("int").alias("completed"),
        *last,
    )


def opportunities_from_parts(
    events: DataFrame, offers: DataFrame, profile: DataFrame, limits: Limits | None = None
) -> DataFrame:
    """Opportunities straight from flat events, offers and cleaned profiles.

    Only narrow event rows go through the scan; attributes are joined to the receipts left
    after it, which is far less than joining them to the whole log first.
    """
    return opportunities_of_receipts(next_responses(events, limits), offers, profile)


def opportunities_of_receipts(
    receipts: DataFrame, offers: DataFrame, profile: DataFrame, carried: Sequence[str] = ()
) -> DataFrame:
    """Opportunities from receipts (user_id, offer_id, t_us, view_us, completion_us), with the
    columns `carried` of the receipts behind them."""
    o, p = offers.alias("o"), profile.alias("p")
    received = receipts.join(o, F.col("offer_id") == F.col("o.id"), "left").select(
        "user_id",
        F.col("offer_id"),
        *[F.col(f"o.{c}").alias(c) for c in OFFER_COLUMNS],
        "t_us",
        "view_us",
        "completion_us",
        *carried,
    )
    return (
        _within_window(received, carried)
        .alias("r")
        .join(p, F.col("r.user_id") == F.col("p.id"), "left")
        .select(
            *[F.col(f"r.{c}") for c in RESULT_COLUMNS],
            *[F.col(f"p.{c}").alias(c) for c in PROFILE_COLUMNS],
            *[F.col(f"r.{c}") for c in carried],
        )
    )


def opportunities(log: DataFrame, limits: Limits | None = None) -> DataFrame:
    """Opportunities from a joined event log, attributes taken from its receipt rows.

    Receipts that differ in an attribute stay apart, as rows of their own.
    """
    attributes = [c for c in OFFER_COLUMNS + PROFILE_COLUMNS if c in log.columns]
    described = (
        log.where(F.col("event") == RECEIVED)
        .select(
            "user_id",
            "offer_id",
            to_micros(F.col("time_since_test_start").cast("double")).alias("t_us"),
            *attributes,
        )
        .distinct()
        .alias("d")
    )
    answers = next_responses(log, limits).alias("a")
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"a.{k}")) for k in ("user_id", "offer_id", "t_us")]
    return _within_window(
        described.join(answers, same, "left").select("d.*", "a.view_us", "a.completion_us")
    )


def with_limit_band(
    opps: DataFrame, rel_error: float = 0.01, limits: Limits | None = None
) -> DataFrame:
    """Credit-limit quartile band of each opportunity.

    `rel_error=0` takes exact quartiles. The edges travel as a one-row scalar subquery.
    """
    thresholds = quantile_row(opps, "credit_card_limit", [0.25, 0.5, 0.75], rel_error, limits)
    limit = F.col("credit_card_limit")
    q = [F.col("_edges")[i] for i in range(3)]
    text = [x.cast("bigint").cast("string") for x in q]
    labels = [
        F.concat(F.lit("<= "), text[0]),
        F.concat(text[0], F.lit(" - "), text[1]),
        F.concat(text[1], F.lit(" - "), text[2]),
        F.concat(F.lit("> "), text[2]),
    ]
    return (
        opps.withColumn("_edges", thresholds.scalar())
        .withColumn("limit_band", bands(limit, q, labels, UNKNOWN))
        .drop("_edges")
    )
