"""Clean inputs and the joined event log (one row per event)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.functions.columns import (
    age_band,
    clean_gender,
    known_age,
    same_key,
    to_micros,
    yyyymmdd,
)


def flatten_events(transactions: DataFrame) -> DataFrame:
    """Lift the nested payload; the offer id sits in either of two fields.

    A table without the payload column is taken as flat already.
    """
    if "value" not in transactions.columns:
        return transactions
    kept = [c for c in transactions.columns if c not in ("value", "offer_id", "amount", "reward")]
    return transactions.select(
        *kept,
        F.coalesce(F.col("value.offer_id"), F.col("value.`offer id`")).alias("offer_id"),
        F.col("value.amount").alias("amount"),
        F.col("value.reward").alias("reward"),
    )


def clean_profile(profile: DataFrame) -> DataFrame:
    """Age sentinel to NULL, age band, gender code, registration date.

    Cleaning a cleaned table changes nothing.
    """
    cleaned = {}
    if "age" in profile.columns:
        age = known_age(F.col("age"))
        cleaned |= {"age": age, "age_group": age_band(age)}
    if "gender" in profile.columns:
        cleaned["gender"] = clean_gender(F.col("gender"))
    if "registered_on" in profile.columns:
        cleaned["registered_on_date"] = yyyymmdd(F.col("registered_on"))
    return profile.withColumns(cleaned) if cleaned else profile


def event_log(events: DataFrame, profile: DataFrame, offers: DataFrame) -> DataFrame:
    """Flat events with the customer's and the offer's attributes; no event is dropped.

    Sizes decide the join strategy: a side goes out by broadcast only below Spark's size
    threshold, and a customer with very many events is left to the adaptive skew join. Events
    without an offer are spread over tasks.
    """
    e, p, o = events.alias("e"), profile.alias("p"), offers.alias("o")
    by_offer = same_key(
        F.col("e.offer_id"), F.col("o.id"), F.col("e.account_id"), F.col("e.time_since_test_start")
    )
    return (
        e.join(o, by_offer, "left")
        .join(p, F.col("e.account_id") == F.col("p.id"), "left")
        .select(
            F.col("e.account_id").alias("user_id"),
            "e.event",
            F.col("e.time_since_test_start").cast("double").alias("time_since_test_start"),
            "e.offer_id",
            "e.amount",
            "e.reward",
            "p.age",
            "p.gender",
            "p.credit_card_limit",
            "p.age_group",
            "o.offer_type",
            "o.min_value",
            F.col("o.duration").cast("double").alias("duration"),
            "o.discount_value",
            "o.channels",
            "p.registered_on_date",
        )
    )


def narrow_log(events: DataFrame) -> DataFrame:
    """The columns the time scans need, with time in whole microseconds.

    Takes flat events (`account_id`), the joined log (`user_id`), or narrow rows again.
    """
    user = "user_id" if "user_id" in events.columns else "account_id"
    if "t_us" in events.columns:
        time = F.col("t_us")
    else:
        time = to_micros(F.col("time_since_test_start").cast("double")).alias("t_us")
    return events.select(
        F.col(user).alias("user_id"),
        "event",
        "offer_id",
        time,
        *[c for c in ("amount", "offer_type") if c in events.columns],
    )
