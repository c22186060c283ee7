"""Hand-made rows: cleaning, windows, history and target at their edges."""

import datetime

import pytest

from promolens.functions.columns import DAY_US
from promolens.functions.domains import AGE_BANDS, GENDERS
from promolens.operators import eventlog, features, opportunities, quality, segments
from promolens.operators.layout import Limits
from promolens.sources import EVENT_SCHEMA, OFFER_SCHEMA, PROFILE_SCHEMA

US = 1 / DAY_US
OFFERS = [
    ("A", "bogo", 10, 5.0, 5, ["web", "email"]),
    ("I", "informational", 0, 5.0, 0, None),
]
LIMITS = [None, Limits(chunks=4, min_rows=0)]


def log_of(spark, events, profile=(("u", 40, "F", "20170601"),), offers=OFFERS):
    """events: (user, event, days, offer, amount)."""
    raw = [(u, e, float(t), (a, o, None, None)) for u, e, t, o, a in events]
    tx = spark.createDataFrame(raw, EVENT_SCHEMA)
    people = spark.createDataFrame(
        [(age, 1000.0, g, u, reg) for u, age, g, reg in profile], PROFILE_SCHEMA
    )
    catalogue = spark.createDataFrame(offers, OFFER_SCHEMA)
    return eventlog.event_log(
        eventlog.flatten_events(tx), eventlog.clean_profile(people), catalogue
    )


def received(t, offer="A", user="u"):
    return (user, "offer received", t, offer, None)


def viewed(t, offer="A", user="u"):
    return (user, "offer viewed", t, offer, None)


def completed(t, offer="A", user="u"):
    return (user, "offer completed", t, offer, None)


def paid(t, amount=10.0, user="u"):
    return (user, "transaction", t, None, amount)


@pytest.mark.parametrize("limits", LIMITS)
@pytest.mark.parametrize(
    "events, expected",
    [
        ([received(1), viewed(1.0), completed(6.0)], [(1.0, 1.0, 6.0)]),
        ([received(1), viewed(0.999), completed(6 + US)], [(1.0, None, None)]),
        ([received(1), viewed(4), viewed(2)], [(1.0, 2.0, None)]),
        ([received(1), received(3), viewed(4)], [(1.0, 4.0, None), (3.0, 4.0, None)]),
        ([received(1), received(1), viewed(2)], [(1.0, 2.0, None)]),
        ([received(1, None), viewed(2, None), completed(2, None)], [(1.0, None, None)]),
        ([received(1), viewed(2, "I"), completed(2, user="other")], [(1.0, None, None)]),
        ([received(1, user=None), viewed(2, user=None)], [(1.0, None, None)]),
        ([received(1, "none such"), viewed(2, "none such")], [(1.0, None, None)]),
    ],
)
def test_response_window(spark, events, expected, limits):
    opps = opportunities.opportunities(log_of(spark, events), limits)
    rows = opps.select("t_received", "t_viewed", "t_completed", "viewed", "completed").collect()
    assert sorted((r[0], r[1], r[2]) for r in rows) == expected
    assert all(r[3] == (r[1] is not None) and r[4] == (r[2] is not None) for r in rows)


def test_conflicting_copies_stay_and_fail_the_grain_check(spark):
    profile = [("u", 40, "F", "20170601"), ("u", 50, "F", "20170601")]
    opps = opportunities.opportunities(log_of(spark, [received(1)], profile))
    assert opps.count() == 2
    with pytest.raises(ValueError, match="1 duplicate"):
        quality.validate_grain(opps, ["user_id", "offer_id", "t_received"])


def abt_of(spark, events, limits=None, **kwargs):
    log = log_of(spark, events, **kwargs)
    abt = features.build_abt(log, opportunities.opportunities(log, limits), limits=limits)
    return abt.orderBy("time_received", "offer_id").collect()


@pytest.mark.parametrize("limits", LIMITS)
def test_informational_target_ends_with_the_window(spark, limits):
    inside = abt_of(spark, [received(1, "I"), paid(6.0)], limits)
    outside = abt_of(spark, [received(1, "I"), paid(6 + US)], limits)
    at_once = abt_of(spark, [received(1, "I"), paid(1)], limits)
    assert [r[0]["target"] for r in (inside, outside, at_once)] == [1, 0, 1]


@pytest.mark.parametrize("limits", LIMITS)
def test_history_is_strictly_before(spark, limits):
    row = abt_of(spark, [paid(1), received(1)], limits)[0]
    assert row["transaction_count_before"] == 0 and row["tx_count_28d"] == 0


@pytest.mark.parametrize("limits", LIMITS)
def test_lookback_includes_its_first_instant(spark, limits):
    row = abt_of(spark, [paid(2, 3.0), paid(2 - US, 4.0), paid(23, 1.0), received(30)], limits)[0]
    assert row["tx_count_28d"] == 2 and row["tx_amount_sum_28d"] == 4.0
    assert row["tx_count_7d"] == 1
    assert row["transaction_count_before"] == 3 and row["total_spend_before"] == 8.0
    assert (row["max_ticket_before"], row["min_ticket_before"]) == (4.0, 1.0)


def test_no_history(spark):
    row = abt_of(spark, [received(1)])[0]
    assert all(row[c] == 0.0 for c in features.ZERO_FILLED if c not in
               ("offer_channel_count", "offer_reward_ratio"))
    for name in ("avg", "max", "min"):
        assert row[f"{name}_ticket_before"] is None
    for name in ("tx", "offer_view", "offer_completion"):
        assert row[f"days_since_last_{name}"] is None
    assert row["last_viewed_offer_type"] == "Unknown"


def test_null_amount_counts_but_does_not_average(spark):
    row = abt_of(spark, [paid(1, None), paid(2, 6.0), received(3)])[0]
    assert row["transaction_count_before"] == 2 and row["total_spend_before"] == 6.0
    assert row["avg_ticket_before"] == 6.0 and row["avg_ticket_28d"] == 3.0


def test_rates_are_not_clamped(spark):
    row = abt_of(spark, [received(1), viewed(2), viewed(3), received(4)])[1]
    assert row["offer_view_rate_28d"] == 2.0 and row["view_rate_before"] == 2.0
    assert row["last_viewed_offer_type"] == "bogo"


def test_tenure_counts_from_the_day_after_the_newest_active_customer(spark):
    profile = [("u", 40, "F", "20170601"), ("v", 40, "F", "20170611"), ("w", 40, "F", "20180101")]
    events = [received(1), received(1, user="v")]
    assert [r["customer_tenure_days"] for r in abt_of(spark, events, profile=profile)] == [11, 1]


def test_later_events_change_no_feature(spark):
    events = [paid(1), viewed(2), received(3), received(5), paid(6), completed(6)]
    whole = abt_of(spark, events)[0].asDict()
    past = abt_of(spark, [e for e in events if e[2] <= 3])[0].asDict()
    assert {k: v for k, v in whole.items() if k != "target"} == {
        k: v for k, v in past.items() if k != "target"
    }


def test_channels_and_static_features(spark):
    rows = abt_of(spark, [received(1, "A"), received(1, "I")])
    assert [r["offer_channel_count"] for r in rows] == [2.0, 0.0]
    assert [r["channel_is_web"] for r in rows] == [1, 0]
    assert [r["offer_reward_ratio"] for r in rows] == [0.5, 0.0]


def test_duration_buckets(spark):
    df = spark.createDataFrame(
        [(d, None, 5) for d in (3.0, 3.5, 7.0, 10.0, None)],
        "offer_duration_days double, offer_min_spend bigint, offer_discount_value bigint",
    )
    got = features.offer_static_features(df).collect()
    assert [r["offer_duration_bucket"] for r in got] == ["short", "medium", "medium", "long", "long"]
    assert {r["offer_reward_ratio"] for r in got} == {0.0}


def test_profile_cleaning(spark):
    ages = [17, 18, 24, 25, 64, 65, 118, None]
    genders = [" m ", "F", "x", "", None, "o", "F", "F"]
    raw = spark.createDataFrame(
        [(a, None, g, str(i), "2017x" if i else "20170601") for i, (a, g) in enumerate(zip(ages, genders))],
        PROFILE_SCHEMA,
    )
    rows = eventlog.clean_profile(raw).orderBy("id").collect()
    bands = ["Unknown", "18-24", "18-24", "25-34", "55-64", "65+", "Unknown", "Unknown"]
    assert [r["age_group"] for r in rows] == bands
    assert rows[6]["age"] is None
    assert [r["gender"] for r in rows][:6] == ["M", "F", "Unknown", "Unknown", "Unknown", "O"]
    assert rows[0]["registered_on_date"] == datetime.date(2017, 6, 1)
    assert rows[1]["registered_on_date"] is None


def test_cleaning_twice_changes_nothing(spark):
    raw = spark.createDataFrame([(118, None, " m ", "u", "20170601")], PROFILE_SCHEMA)
    once = eventlog.clean_profile(raw)
    again = eventlog.clean_profile(once)
    assert again.columns == once.columns and again.collect() == once.collect()


def test_feature_tables_are_assembled_by_key(spark):
    keys = "customer_id string, offer_id string, time_received double"
    base = spark.createDataFrame([("u", "A", 1.0), ("v", "A", 1.0)], keys)
    extra = spark.createDataFrame([("u", "A", 1.0, 7)], keys + ", x int")
    rows = features.assemble(base, extra).orderBy("customer_id").collect()
    assert [r["x"] for r in rows] == [7, None]


def test_flat_events_pass_through(spark):
    flat = spark.createDataFrame([("u", "transaction", 1.0)], "account_id string, event string, t double")
    assert eventlog.flatten_events(flat).columns == flat.columns


def test_limit_band_without_limits(spark):
    df = spark.createDataFrame([(None,), (None,)], "credit_card_limit double")
    for rel_error in (0, 0.01):
        rows = opportunities.with_limit_band(df, rel_error).collect()
        assert {r["limit_band"] for r in rows} == {"Unknown"}


@pytest.mark.parametrize("limits", LIMITS)
def test_amounts_are_kept_whole(spark, limits):
    events = [paid(1, 2e16), paid(2, 0.1), received(3)]
    row = abt_of(spark, events, limits)[0]
    assert row["total_spend_before"] == 2e16 + 0.1 and row["transaction_count_before"] == 2
    wide = spark.createDataFrame(
        [("u", "A", 1.0, 6.0, "bogo", 5.0, 0, 0, 12.5, 2.5)],
        "user_id string, offer_id string, t_received double, t_expires double, offer_type string, "
        "duration double, completed int, viewed int, min_value double, discount_value double",
    )
    base = features.offer_static_features(features.base_opportunities(wide)).first()
    assert (base["offer_min_spend"], base["offer_reward_ratio"]) == (12.5, 0.2)


def test_missing_columns(spark):
    df = spark.createDataFrame([("u",)], "user_id string")
    with pytest.raises(ValueError, match="offer_id"):
        features.base_opportunities(df)


def test_key_check(spark):
    df = spark.createDataFrame([(k,) for k in ("a", "a", "a", "b", None, None)], "k string")
    assert tuple(quality.key_check(df, "k").first()) == (6, 2, 3, 2)
    assert tuple(quality.key_check(df.limit(0), "k").first()) == (0, 0, 0, 0)


def test_empty_input(spark):
    log = log_of(spark, [received(1)]).limit(0)
    assert quality.null_summary(log, ["user_id"]).first().asDict() == {"user_id": 0, "total_rows": 0}
    funnel = segments.event_funnel(log).first()
    assert funnel["view_rate"] == 0.0 and funnel["n_received"] == 0
    assert opportunities.opportunities(log).count() == 0
    assert len(segments.recency_conversion(log, opportunities.opportunities(log)).collect()) == 7


def test_gender_age_pivot_shows_every_cell(spark):
    log = log_of(spark, [received(t / 10) for t in range(12)])
    rows = segments.gender_age_pivot(opportunities.opportunities(log)).collect()
    assert {r["gender"] for r in rows} == {"F", "M", "O", "Unknown"}
    assert [r["35-44"] for r in rows if r["gender"] == "F"] == [0.0]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_same_result_in_both_ansi_modes(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        row = abt_of(spark, [received(1), viewed(2), received(3)], profile=[("u", 40, "F", "bad")])
        assert [r["customer_conversion_rate_before"] for r in row] == [0.0, 0.0]
        assert [r["customer_tenure_days"] for r in row] == [None, None]
        assert segments.funnel_by_offer_type(
            opportunities.opportunities(log_of(spark, [received(1)]))
        ).first()["completed_viewed"] is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_reports_follow_the_domain_order(spark):
    profile = [("u", 70, "F", None), ("v", 20, "M", None), ("w", None, "M", None)]
    events = [received(1, user=u) for u in "uvw"] + [received(2, "I", user="v")]
    opps = opportunities.opportunities(log_of(spark, events, profile))
    rows = segments.group_offer_rates(opps, "age_group", AGE_BANDS).collect()
    assert [(r["age_group"], r["offer_type"]) for r in rows] == [
        ("18-24", "bogo"),
        ("18-24", "informational"),
        ("65+", "bogo"),
        ("Unknown", "bogo"),
    ]
    rows = segments.group_without_view(opps, "gender", GENDERS).collect()
    assert [r["gender"] for r in rows] == ["F", "M"]


def test_purchases_by_offer_use(spark):
    events = [paid(1, 5.0), paid(2, 7.0), paid(3, 0.0), completed(1, user="v"), paid(1, 2.0, "v")]
    log = log_of(spark, events)
    for rel_error in (0, 1e-4):
        rows = segments.tx_value_summary(log, rel_error).collect()
        assert [tuple(r) for r in rows] == [(0, 5.0, 6.0, 2), (1, 2.0, 2.0, 1)]
