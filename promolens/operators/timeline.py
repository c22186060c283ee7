"""Receipts with their responses and their customer's history, from rows that lie by customer.

All time operators look at one customer's events. Once these lie together, by one shuffle or by a
clustered table, folding by instant, both response windows and all history sums are local sorts and
windows of one stage: no event moves again. Customers with very many events, and rows without a
customer or a time, are left out of it (`Clustered.apart`) and go through the scans that cut keys
into cells.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.functions.columns import to_days
from promolens.functions.domains import COMPLETED, RECEIVED, VIEWED
from promolens.operators import features
from promolens.operators.eventlog import narrow_log
from promolens.operators.layout import Layout, Limits
from promolens.operators.opportunities import next_responses
from promolens.operators.scan import FROM, Running, in_partition

USER = "user_id"
EVENT_COLUMNS = [USER, "event", "offer_id", "t_us", "amount"]


@dataclass(frozen=True)
class Clustered:
    """Narrow events: `together` has all rows of a customer in one partition; `apart` the others,
    or None where there are none."""

    together: DataFrame
    apart: DataFrame | None = None
    #: How many tasks `together` is to be dealt to; None leaves it to the session.
    tasks: int | None = None


def narrow(events: DataFrame) -> DataFrame:
    log = narrow_log(events)
    return log.withColumn("amount", features.log_amount(log)).select(*EVENT_COLUMNS)


def split_busy(events: DataFrame, limits: Limits | None = None) -> Clustered:
    """Narrow events of customers a task can hold, still to be dealt, and the others'.

    An input too small to hold a busy customer stays whole."""
    log = narrow(events)
    layout = Layout.of(log.select(USER, "t_us"), [USER], "t_us", limits)
    if layout.single:
        return Clustered(log, tasks=layout.tasks)
    busy = F.broadcast(layout.hot.select(USER))  # fewer than limits.chunks
    placed = F.col(USER).isNotNull() & F.col("t_us").isNotNull()
    apart = log.join(busy, USER, "left_semi").unionByName(log.where(~placed))
    return Clustered(log.where(placed).join(busy, USER, "left_anti"), apart, layout.tasks)


def clustered(events: DataFrame, limits: Limits | None = None) -> Clustered:
    """One shuffle, of the narrow events by customer."""
    parts = split_busy(events, limits)
    dealt = [parts.tasks, USER] if parts.tasks else [USER]
    return Clustered(parts.together.repartition(*dealt), parts.apart)


def _responses() -> list[Running]:
    known = F.col("offer_id").isNotNull() & F.col(USER).isNotNull() & F.col("t_us").isNotNull()
    at = F.col("t_us")
    return [
        Running("view_us", "min", F.when(F.col("viewed") & known, at), FROM),
        Running("completion_us", "min", F.when(F.col("completed") & known, at), FROM),
    ]


def _history(lookback: features.Lookback) -> list[Running]:
    seen = F.struct(F.col("t_us").alias("x"), F.col("offer_id").alias("seen_offer"))
    known = F.col(USER).isNotNull() & F.col("t_us").isNotNull()
    return features.history("t_us", lookback, seen, known)


def history_names(lookback: features.Lookback | None = None) -> list[str]:
    return [r.name for r in _history(lookback or features.Lookback())]


def _of_together(rows: DataFrame, lookback: features.Lookback) -> DataFrame:
    event = F.col("event")
    instants = rows.groupBy(USER, "t_us", "offer_id").agg(
        F.max(event == RECEIVED).alias("received"),
        F.max(event == VIEWED).alias("viewed"),
        F.max(event == COMPLETED).alias("completed"),
        *features.instant_sums(event, F.col("amount")),
    )
    responses, history = _responses(), _history(lookback)
    answered = instants.select("*", *in_partition(responses, [USER, "offer_id"], "t_us"))
    # A frame of a row without a time has all rows of its key.
    placed = F.col(USER).isNotNull() & F.col("t_us").isNotNull()
    known = placed & F.col("offer_id").isNotNull()
    return (
        answered.select("*", *in_partition(history, [USER], "t_us"))
        .where("received")
        .select(
            USER,
            "offer_id",
            "t_us",
            *[F.when(known, F.col(r.name)).alias(r.name) for r in responses],
            *[F.when(placed, F.col(r.name)).alias(r.name) for r in history],
        )
    )


def _of_apart(
    rows: DataFrame, lookback: features.Lookback, limits: Limits | None, names: list[str]
) -> DataFrame:
    base = next_responses(rows, limits).select(
        F.col(USER).alias("customer_id"),
        to_days(F.col("t_us")).alias("time_received"),
        "offer_id",
        "t_us",
        "view_us",
        "completion_us",
    )
    seen = F.col("last_seen")
    return (
        features.with_timeline(base, rows, None, lookback, limits)
        .withColumn("last_seen", F.when(seen.isNotNull(), F.struct(seen.x, seen.seen_offer)))
        .select(
            F.col("customer_id").alias(USER),
            "offer_id",
            "t_us",
            "view_us",
            "completion_us",
            *names,
        )
    )


def receipts(
    events: Clustered, lookback: features.Lookback | None = None, limits: Limits | None = None
) -> DataFrame:
    """One row per received offer (user_id, offer_id, t_us): view_us and completion_us, the first
    view and completion of it at or after the receipt, and the history of its customer strictly
    before it. A receipt without customer, offer or time has no response; without customer or time
    it has no history either. Equal receipts are one.

    What a reader does not use is not computed: windows of unused columns are pruned.
    """
    lookback = lookback or features.Lookback()
    found = _of_together(events.together, lookback)
    if events.apart is None:
        return found
    names = history_names(lookback)
    return found.unionByName(_of_apart(events.apart, lookback, limits, names))
