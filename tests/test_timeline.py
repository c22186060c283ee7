"""Receipts from events that lie by customer, against brute force, whole and with busy customers apart."""

import math
import random

import pytest
from pyspark.sql import functions as F

from promolens.functions.columns import DAY_US, to_days
from promolens.operators import features, timeline
from promolens.operators.layout import Limits
from promolens.operators.opportunities import next_responses

KINDS = ["offer received", "offer viewed", "offer completed", "transaction"]
SCHEMA = "account_id string, event string, offer_id string, amount double, time_since_test_start double"


def random_events(seed, n=900):
    """A busy customer, copies, and rows without customer, offer or time."""
    dice = random.Random(seed)
    rows = []
    for _ in range(n):
        kind = dice.choice(KINDS)
        offer = dice.choice(["a", "b", "c", None]) if kind != "transaction" else None
        amount = dice.choice([None, 1.25, 10.0, 0.1, float("inf")]) if kind == "transaction" else None
        time = dice.choice([None, *[dice.randrange(0, 160) / 4 for _ in range(8)]])
        rows.append((dice.choice(["busy"] * 8 + ["u", "v", "w", None]), kind, offer, amount, time))
    return rows + rows[::7]


def plain_receipts(rows):
    """{(user, offer, t_us): (view, completion, history...)} by looking at every event again."""
    events = [(u, k, o, a, None if t is None else round(t * DAY_US)) for u, k, o, a, t in rows]
    out = {}
    for user, kind, offer, _, t in events:
        if kind != KINDS[0]:
            continue
        later = {
            k: [x for u, e, o, _, x in events if e == k and u == user and o == offer and x is not None and x >= t]
            if None not in (user, offer, t) else []
            for k in KINDS[1:3]
        }
        mine = [] if user is None or t is None else [e for e in events if e[0] == user and e[4] is not None]
        before = [e for e in mine if e[4] < t] if t is not None else []
        count = lambda k, since=-math.inf: sum(e[1] == k and e[4] >= since for e in before)
        long = (t or 0) - 28 * DAY_US
        paid = [e for e in before if e[1] == KINDS[3] and e[3] is not None and math.isfinite(e[3])]
        last = lambda k: max((e[4] for e in before if e[1] == k), default=None)
        seen = max(((e[4], e[2] is not None, e[2] or "") for e in before if e[1] == KINDS[1]), default=None)
        out[user, offer, t] = (
            min(later[KINDS[1]], default=None), min(later[KINDS[2]], default=None),
            count(KINDS[3]), count(KINDS[3], (t or 0) - 7 * DAY_US), count(KINDS[3], long),
            round(sum(e[3] for e in paid), 6), round(sum(e[3] for e in paid if e[4] >= long), 6), len(paid),
            max((e[3] for e in paid), default=None), min((e[3] for e in paid), default=None),
            *(count(k, since) for k in KINDS[:3] for since in (-math.inf, long)),
            last(KINDS[3]), last(KINDS[2]),
            None if seen is None else (seen[0], seen[2] or None),
            min((e[4] for e in mine if e[1] == KINDS[3] and e[4] >= t), default=None),
        )
    return out


def found_receipts(df):
    out = {}
    for r in df.collect():
        n = lambda name, r=r: r[name] or 0
        row = (
            r.view_us, r.completion_us, n("tx_ever"), n("tx_ever") - n("tx_short_ago"), n("tx_ever") - n("tx_long_ago"),
            round(float(n("spent_ever")), 6), round(float(n("spent_ever") - n("spent_long_ago")), 6), n("spent_n_ever"),
            r.ticket_max, r.ticket_min,
            n("received_ever"), n("received_ever") - n("received_long_ago"),
            n("viewed_ever"), n("viewed_ever") - n("viewed_long_ago"),
            n("completed_ever"), n("completed_ever") - n("completed_long_ago"),
            r.last_tx, r.last_completed, None if r.last_seen is None else tuple(r.last_seen), r.next_tx,
        )
        key = (r.user_id, r.offer_id, r.t_us)
        assert key not in out
        out[key] = row
    return out


@pytest.mark.parametrize("limits", [Limits(at_most=1000), Limits(chunks=6, min_rows=5)])
@pytest.mark.parametrize("seed", [1, 2])
def test_receipts_against_brute_force(spark, limits, seed):
    rows = random_events(seed)
    parts = timeline.clustered(spark.createDataFrame(rows, SCHEMA), limits)
    assert (parts.apart is None) == (limits.at_most is not None)
    found = found_receipts(timeline.receipts(parts, limits=limits))
    expected = plain_receipts(rows)
    assert set(found) == set(expected)
    for key, value in expected.items():
        assert found[key] == value, key


def test_the_general_scan_gives_the_same_history(spark):
    rows = [r for r in random_events(3, 400) if r[0] and r[4] is not None]
    events = timeline.narrow(spark.createDataFrame(rows, SCHEMA))
    base = next_responses(events).select(
        F.col("user_id").alias("customer_id"), "offer_id", "t_us", "view_us", "completion_us",
        to_days(F.col("t_us")).alias("time_received"),
    )
    history = features.with_timeline(base, events).withColumnRenamed("customer_id", "user_id")
    seen = F.col("last_seen")
    history = history.withColumn("last_seen", F.when(seen.isNotNull(), F.struct(seen.x, seen.seen_offer)))
    assert found_receipts(history) == plain_receipts(rows)


def test_no_events(spark):
    parts = timeline.clustered(spark.createDataFrame([], SCHEMA))
    assert timeline.receipts(parts).collect() == []
