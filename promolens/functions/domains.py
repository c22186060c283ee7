"""Event vocabulary and ordered category domains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The event vocabulary of the log.
RECEIVED = "offer received"
VIEWED = "offer viewed"
COMPLETED = "offer completed"
PURCHASE = "transaction"

# Names of customers by whether they complete any offer.
USER_TYPES = {0: "Does Not Use Offers", 1: "Uses Offers"}

# Category domains in presentation order.
OFFER_TYPES = ["bogo", "discount", "informational"]
AGE_BANDS = ["18-24", "25-34", "35-44", "45-54", "55-64", "65+", "Unknown"]
GENDERS = ["F", "M", "O", "Unknown"]
CHANNELS = ["web", "email", "mobile", "social"]
RECENCY_BINS = [
    "0-1 day",
    "1-3 days",
    "3-7 days",
    "7-14 days",
    "14-30 days",
    "30+ days",
    "No history",
]
REGISTRATION_QUARTILES = ["Q1 (Oldest)", "Q2", "Q3", "Q4 (Newest)"]

UNKNOWN = "Unknown"
NO_HISTORY = "No history"


def in_domain_order(df: DataFrame, **domains: Sequence[str]) -> DataFrame:
    """Sort by each column's position in its domain; values outside it come last, by value."""
    order = []
    for column, domain in domains.items():
        place = F.array_position(F.array(*[F.lit(v) for v in domain]), F.col(column))
        order += [F.when(place > 0, place).otherwise(len(domain) + 1), F.col(column)]
    return df.orderBy(*order)


def complete_domain(
    df: DataFrame, column: str, domain: Sequence[str], zero_columns: Sequence[str]
) -> DataFrame:
    """One row per domain value; values without data get zeros.

    Both sides have at most one row per domain value.
    """
    values = F.array(*[F.lit(v) for v in domain])
    full = df.sparkSession.range(1).select(F.explode(values).alias(column))
    kept = [c for c in df.columns if c != column]
    zeros = [
        F.coalesce(F.col(c), F.lit(0)).alias(c) if c in zero_columns else F.col(c) for c in kept
    ]
    return full.join(df, column, "left").select(column, *zeros)
