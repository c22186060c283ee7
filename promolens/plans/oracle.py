"""The registered queries as SQL, in their plain join form.

These statements restate each query the long way (range joins, correlated look-ups, global
windows), so that they share no plan with the operators they check.
"""

from __future__ import annotations

from promolens.functions.domains import AGE_BANDS, CHANNELS, GENDERS, RECENCY_BINS
from promolens.operators.policy import default_grid

DAY = "86400000000"

OFFERS = """
offers AS MATERIALIZED (
  SELECT CAST(p_partkey AS VARCHAR) AS id,
    CASE p_partkey % 3 WHEN 0 THEN 'bogo' WHEN 1 THEN 'discount' ELSE 'informational' END
      AS offer_type,
    CAST(5 * (p_partkey % 4) AS BIGINT) AS min_value,
    CAST(3 + p_size % 8 AS DOUBLE) AS duration,
    CAST(CASE WHEN p_partkey % 3 = 2 THEN 0 ELSE 2 + p_partkey % 9 END AS BIGINT)
      AS discount_value,
    CASE WHEN p_partkey % 10 <> 9 THEN list_filter(['email',
      CASE WHEN p_partkey % 2 = 0 THEN 'web' END,
      CASE WHEN p_partkey % 3 <> 0 THEN 'mobile' END,
      CASE WHEN p_partkey % 5 < 3 THEN 'social' END], lambda x: x IS NOT NULL) END AS channels
  FROM part)"""

PROFILE = """
profile AS MATERIALIZED (
  SELECT CAST(CASE WHEN c_custkey % 8 = 0 THEN 118 ELSE 15 + c_custkey % 60 END AS BIGINT) AS age,
    CASE WHEN c_acctbal > 0 THEN c_acctbal END AS credit_card_limit,
    CASE c_mktsegment WHEN 'MACHINERY' THEN ' m ' WHEN 'FURNITURE' THEN 'F'
      WHEN 'BUILDING' THEN 'O' WHEN 'HOUSEHOLD' THEN 'x' END AS gender,
    CAST(c_custkey AS VARCHAR) AS id,
    strftime(first_order, '%Y%m%d') AS registered_on
  FROM customer LEFT JOIN (
    SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY 1) f
    ON o_custkey = c_custkey),
clean AS MATERIALIZED (
  SELECT id, CASE WHEN age <> 118 THEN CAST(age AS INTEGER) END AS age, credit_card_limit,
    CASE WHEN upper(trim(gender)) IN ('F', 'M', 'O') THEN upper(trim(gender)) ELSE 'Unknown' END
      AS gender,
    registered_on,
    CASE WHEN age IS NULL OR age = 118 OR age < 18 THEN 'Unknown'
      WHEN age <= 24 THEN '18-24' WHEN age <= 34 THEN '25-34' WHEN age <= 44 THEN '35-44'
      WHEN age <= 54 THEN '45-54' WHEN age <= 64 THEN '55-64' ELSE '65+' END AS age_group,
    CAST(try_strptime(registered_on, '%Y%m%d') AS DATE) AS registered_on_date
  FROM profile)"""

EVENTS = """
flat AS MATERIALIZED (
  SELECT CAST(user_id AS VARCHAR) AS account_id,
    CASE event_type WHEN 'signup' THEN 'offer received' WHEN 'view' THEN 'offer viewed'
      WHEN 'click' THEN 'offer completed' WHEN 'purchase' THEN 'transaction'
      ELSE event_type END AS event,
    date_diff('microsecond', TIMESTAMP '2024-01-01', ts) AS t_us,
    CASE WHEN event_type IN ('signup', 'view', 'click') THEN
      CAST((user_id * 10 + k % 10) % (SELECT count(*) FROM part) AS VARCHAR) END
      AS offer_id,
    CASE WHEN event_type = 'purchase' THEN value END AS amount,
    CASE WHEN event_type = 'click' THEN CAST(2 + k % 9 AS DOUBLE) END AS reward
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""

LOG = f"""
log AS MATERIALIZED (
  SELECT f.account_id AS user_id, f.event, f.t_us,
    f.t_us / 86400e6 AS time_since_test_start, f.offer_id, f.amount, f.reward,
    p.age, p.gender, p.credit_card_limit, p.age_group, o.offer_type, o.min_value, o.duration,
    o.discount_value, o.channels, p.registered_on_date
  FROM flat f LEFT JOIN clean p ON f.account_id = p.id LEFT JOIN offers o ON f.offer_id = o.id)"""

OPPS = f"""
receipts AS MATERIALIZED (
  SELECT DISTINCT user_id, offer_id, offer_type, duration, age, age_group, gender,
    credit_card_limit, min_value, discount_value, channels, t_us,
    t_us + CAST(round(duration * {DAY}) AS BIGINT) AS end_us
  FROM log WHERE event = 'offer received'),
opps AS MATERIALIZED (
  SELECT r.*, t_us / 86400e6 AS t_received, end_us / 86400e6 AS t_expires,
    v_us / 86400e6 AS t_viewed, c_us / 86400e6 AS t_completed,
    CAST(v_us IS NOT NULL AS INTEGER) AS viewed, CAST(c_us IS NOT NULL AS INTEGER) AS completed
  FROM receipts r LEFT JOIN (
    SELECT r.user_id, r.offer_id, r.t_us,
      min(CASE WHEN e.event = 'offer viewed' THEN e.t_us END) AS v_us,
      min(CASE WHEN e.event = 'offer completed' THEN e.t_us END) AS c_us
    FROM receipts r JOIN log e ON e.user_id = r.user_id AND e.offer_id = r.offer_id
      AND e.t_us BETWEEN r.t_us AND r.end_us
    GROUP BY ALL) a USING (user_id, offer_id, t_us))"""

_LONG = f"e.t_us >= o.t_us - 28 * {DAY}"
ABT = f"""
tenure AS MATERIALIZED (
  SELECT user_id, CAST(date_diff('day', min(registered_on_date),
      (SELECT max(registered_on_date) + 1 FROM log)) AS INTEGER) AS customer_tenure_days
  FROM log GROUP BY 1),
hist AS MATERIALIZED (
  SELECT o.user_id, o.offer_id, o.t_us,
    count(*) FILTER (e.event = 'transaction' AND e.t_us >= o.t_us - 7 * {DAY}) AS tx7,
    count(*) FILTER (e.event = 'transaction' AND {_LONG}) AS tx28,
    coalesce(sum(e.amount) FILTER (e.event = 'transaction' AND {_LONG}), 0) AS spent28,
    count(*) FILTER (e.event = 'transaction') AS tx,
    coalesce(sum(e.amount) FILTER (e.event = 'transaction'), 0) AS spent,
    avg(e.amount) FILTER (e.event = 'transaction') AS ticket_avg,
    max(e.amount) FILTER (e.event = 'transaction') AS ticket_max,
    min(e.amount) FILTER (e.event = 'transaction') AS ticket_min,
    count(*) FILTER (e.event = 'offer received' AND {_LONG}) AS rec28,
    count(*) FILTER (e.event = 'offer viewed' AND {_LONG}) AS view28,
    count(*) FILTER (e.event = 'offer completed' AND {_LONG}) AS comp28,
    count(*) FILTER (e.event = 'offer received') AS rec,
    count(*) FILTER (e.event = 'offer viewed') AS viewed,
    count(*) FILTER (e.event = 'offer completed') AS comp,
    max(e.t_us) FILTER (e.event = 'transaction') AS last_tx,
    max(e.t_us) FILTER (e.event = 'offer viewed') AS last_view,
    max(e.t_us) FILTER (e.event = 'offer completed') AS last_comp
  FROM opps o LEFT JOIN log e ON e.user_id = o.user_id AND e.t_us < o.t_us
  GROUP BY ALL),
last_seen AS MATERIALIZED (
  SELECT o.user_id, o.offer_id, o.t_us, e.offer_type AS seen_type
  FROM opps o JOIN log e
    ON e.user_id = o.user_id AND e.t_us < o.t_us AND e.event = 'offer viewed'
  QUALIFY row_number() OVER (PARTITION BY o.user_id, o.offer_id, o.t_us
    ORDER BY e.t_us DESC, e.offer_id DESC NULLS LAST, e.offer_type DESC NULLS LAST) = 1),
bought AS MATERIALIZED (
  SELECT DISTINCT o.user_id, o.offer_id, o.t_us
  FROM opps o JOIN log e ON e.user_id = o.user_id AND e.event = 'transaction'
    AND e.t_us BETWEEN o.t_us AND o.end_us),
abt0 AS MATERIALIZED (
  SELECT o.user_id AS customer_id, o.offer_id, o.t_received AS time_received,
    o.t_expires AS time_expires, coalesce(o.offer_type, 'Unknown') AS offer_type,
    o.duration AS offer_duration_days, o.min_value AS offer_min_spend,
    o.discount_value AS offer_discount_value, o.channels AS offer_channels,
    CAST(o.age AS DOUBLE) AS customer_age, coalesce(o.gender, 'Unknown') AS customer_gender,
    o.credit_card_limit AS customer_credit_limit,
    CAST(CASE WHEN o.offer_type = 'informational' THEN b.user_id IS NOT NULL
      ELSE o.completed = 1 END AS INTEGER) AS target,
    CASE WHEN o.min_value > 0 AND o.discount_value IS NOT NULL
      THEN CAST(o.discount_value AS DOUBLE) / o.min_value ELSE 0.0 END AS offer_reward_ratio,
    CASE WHEN o.duration <= 3 THEN 'short' WHEN o.duration <= 7 THEN 'medium' ELSE 'long' END
      AS offer_duration_bucket,
    {", ".join(f"CAST(coalesce(list_contains(o.channels, '{c}'), false) AS INTEGER) AS channel_is_{c}" for c in CHANNELS)},
    CAST(coalesce(len(o.channels), 0) AS DOUBLE) AS offer_channel_count,
    CAST(tx7 AS DOUBLE) AS tx_count_7d, CAST(tx28 AS DOUBLE) AS tx_count_28d,
    CAST(spent28 AS DOUBLE) AS tx_amount_sum_28d,
    CAST(tx AS DOUBLE) AS transaction_count_before, CAST(spent AS DOUBLE) AS total_spend_before,
    ticket_avg AS avg_ticket_before, ticket_max AS max_ticket_before,
    ticket_min AS min_ticket_before,
    CAST(view28 AS DOUBLE) AS offers_viewed_count_28d,
    CAST(comp28 AS DOUBLE) AS offers_completed_count_28d,
    CAST(rec AS DOUBLE) AS offers_received_count_before,
    CAST(h.viewed AS DOUBLE) AS offers_viewed_count_before,
    CAST(comp AS DOUBLE) AS offers_completed_count_before,
    (o.t_us - last_tx) / 86400e6 AS days_since_last_tx,
    (o.t_us - last_view) / 86400e6 AS days_since_last_offer_view,
    (o.t_us - last_comp) / 86400e6 AS days_since_last_offer_completion,
    CASE WHEN rec28 > 0 THEN CAST(comp28 AS DOUBLE) / rec28 ELSE 0.0 END
      AS offer_completion_rate_28d,
    CASE WHEN rec28 > 0 THEN CAST(view28 AS DOUBLE) / rec28 ELSE 0.0 END AS offer_view_rate_28d,
    CASE WHEN tx28 > 0 THEN CAST(spent28 AS DOUBLE) / tx28 ELSE 0.0 END AS avg_ticket_28d,
    CASE WHEN h.viewed > 0 THEN CAST(comp AS DOUBLE) / h.viewed * 100 ELSE 0.0 END
      AS customer_conversion_rate_before,
    CASE WHEN rec > 0 THEN CAST(h.viewed AS DOUBLE) / rec ELSE 0.0 END AS view_rate_before,
    CASE WHEN rec > 0 THEN CAST(comp AS DOUBLE) / rec ELSE 0.0 END AS completion_rate_before,
    coalesce(s.seen_type, 'Unknown') AS last_viewed_offer_type,
    n.customer_tenure_days
  FROM opps o LEFT JOIN hist h USING (user_id, offer_id, t_us)
    LEFT JOIN last_seen s USING (user_id, offer_id, t_us)
    LEFT JOIN bought b ON b.user_id = o.user_id AND b.offer_id = o.offer_id AND b.t_us = o.t_us
    LEFT JOIN tenure n ON n.user_id = o.user_id),
abt AS MATERIALIZED (
  SELECT *, offer_reward_ratio * avg_ticket_28d AS reward_x_avg_ticket FROM abt0)"""

SCORED = """
scored AS MATERIALIZED (
  SELECT o_orderkey AS key, CAST(o_orderstatus <> 'O' AS INTEGER) AS y,
    CAST(50 + (o_orderkey * 7919) % 600
      + 300 * CAST(o_orderstatus <> 'O' AS INTEGER) AS DOUBLE) / 1000 AS score
  FROM orders),
total AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(y) AS DOUBLE) AS pos,
    CAST(sum(1 - y) AS DOUBLE) AS neg FROM scored),
by_score AS MATERIALIZED (
  SELECT score, count(*) AS n, sum(y) AS pos,
    sum(count(*)) OVER (ORDER BY score DESC) AS cum_n,
    sum(sum(y)) OVER (ORDER BY score DESC) AS cum_pos
  FROM scored GROUP BY 1),
ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY score DESC, key) AS rn,
    sum(y) OVER (ORDER BY score DESC, key ROWS UNBOUNDED PRECEDING) AS cum_pos
  FROM scored)"""

_LAYERS = {
    "offers": [OFFERS],
    "profile": [PROFILE],
    "events": [EVENTS],
    "log": [OFFERS, PROFILE, EVENTS, LOG],
    "opps": [OFFERS, PROFILE, EVENTS, LOG, OPPS],
    "abt": [OFFERS, PROFILE, EVENTS, LOG, OPPS, ABT],
    "scored": [SCORED],
}

NUMERIC = [
    "offer_duration_days", "offer_min_spend", "offer_discount_value", "customer_age",
    "customer_credit_limit", "offer_reward_ratio", *[f"channel_is_{c}" for c in CHANNELS],
    "offer_channel_count", "tx_count_7d", "tx_count_28d", "tx_amount_sum_28d",
    "transaction_count_before", "total_spend_before", "avg_ticket_before", "max_ticket_before",
    "min_ticket_before", "offers_viewed_count_28d", "offers_completed_count_28d",
    "offers_received_count_before", "offers_viewed_count_before",
    "offers_completed_count_before", "days_since_last_tx", "days_since_last_offer_view",
    "days_since_last_offer_completion", "offer_completion_rate_28d", "offer_view_rate_28d",
    "avg_ticket_28d", "customer_conversion_rate_before", "view_rate_before",
    "completion_rate_before", "customer_tenure_days", "reward_x_avg_ticket",
]
CATEGORICAL = [
    "offer_type", "customer_gender", "offer_duration_bucket", "last_viewed_offer_type",
]
HISTORY = [c for c in NUMERIC[NUMERIC.index("tx_count_7d") :] if c not in
           ("customer_tenure_days", "reward_x_avg_ticket")]
# Columns of the table that are doubles; the rest is compared as it is.
_WHOLE = {"offer_min_spend", "offer_discount_value", "customer_tenure_days",
          *[f"channel_is_{c}" for c in CHANNELS]}


def _with(layer: str, body: str) -> str:
    return "WITH " + ",".join(_LAYERS[layer]) + "\n" + body


def _r(expression: str, name: str, digits: int = 6) -> str:
    return f"round(CAST({expression} AS DOUBLE), {digits}) AS {name}"


def _dice(key: str, seed: int, sides: int) -> str:
    digits = f"left(md5(concat({key}, ':{seed}')), 8)"
    return f"CAST(concat('0x', {digits}) AS BIGINT) % {sides}"


def _number(key: str, seed: int) -> str:
    return f"CAST(concat('0x', left(md5(concat({key}, ':{seed}')), 13)) AS BIGINT)"


def _balanced_folds() -> str:
    """Customer by customer, largest first, each to the lightest fold."""
    loads = [f"l{k}" for k in range(5)]
    least = f"least({', '.join(loads)})"
    fold = " ".join(f"WHEN {least} = l{k} THEN {k}" for k in range(5))
    fold = f"CASE {fold} END"
    moved = ", ".join(f"l{k} + CASE WHEN {fold} = {k} THEN size ELSE 0 END" for k in range(5))
    body = f"""sizes AS (SELECT customer_id, count(*) AS size FROM abt GROUP BY 1
    ), ordered AS (
      SELECT customer_id, size, row_number() OVER (ORDER BY size DESC, customer_id) AS i FROM sizes
    ), dealt(i, fold, size, {", ".join(loads)}) AS (
      SELECT CAST(0 AS BIGINT), -1, CAST(0 AS BIGINT), {", ".join("CAST(0 AS BIGINT)" for _ in loads)}
      UNION ALL
      SELECT o.i, {fold}, o.size, {moved.replace("THEN size", "THEN o.size")}
      FROM dealt d JOIN ordered o ON o.i = d.i + 1
    )
    SELECT CAST(fold AS INTEGER) AS fold, CAST(sum(size) AS BIGINT) AS n, count(*) AS n_customers
    FROM dealt WHERE i > 0 GROUP BY 1"""
    return "WITH RECURSIVE " + ",".join(_LAYERS["abt"]) + ", " + body


def _abt_columns(names: list[str]) -> str:
    text = {*CATEGORICAL, "customer_id", "offer_id", "target", "time_received", "time_expires",
            *_WHOLE}
    return ", ".join(c if c in text else _r(c, c) for c in names)


def _big(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


_N = "count(*) AS n_received"
_DONE = _big("sum(completed)", "n_completed")
_SEEN = _big("sum(viewed)", "n_viewed")
_DONE_RATE = _r("sum(completed) / count(*)", "completed_rate")
_SEEN_RATE = _r("sum(viewed) / count(*)", "viewed_rate")


def _rates(by: str, source: str = "opps") -> str:
    return _with(
        "opps",
        f"SELECT {by}, {_N}, {_SEEN}, {_DONE}, {_DONE_RATE}, {_SEEN_RATE} "
        f"FROM {source} GROUP BY {by}",
    )


def _box(source: str, value: str, by: str = "") -> str:
    """Box statistics of `value` per group of the relation `source`."""
    keys = [b.strip() for b in by.split(",") if b.strip()]
    same = " AND ".join(f"v.{k} IS NOT DISTINCT FROM q.{k}" for k in keys) or "true"
    head = "".join(f"v.{k}, " for k in keys)
    inner = "".join(f"{k}, " for k in keys)
    group = "GROUP BY ALL"
    near = "v.x BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1)"
    return f""", vals AS (SELECT {inner} CAST({value} AS DOUBLE) AS x FROM {source}
      WHERE {value} IS NOT NULL),
    qs AS (SELECT {inner} quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
      quantile_cont(x, 0.75) AS q3 FROM vals {group if keys else ""})
    SELECT {head} count(*) AS n, {_r("q.q1", "q1")}, {_r("q.median", "median")},
      {_r("q.q3", "q3")}, {_r(f"min(v.x) FILTER ({near})", "whisker_low")},
      {_r(f"max(v.x) FILTER ({near})", "whisker_high")},
      count(*) FILTER (NOT ({near})) AS n_outliers
    FROM vals v JOIN qs q ON {same} GROUP BY {head} q.q1, q.median, q.q3"""


def _histogram(source: str, value: str, by: str = "", bins: int = 30) -> str:
    comma = f"{by}, " if by else ""
    return f""", vals AS (SELECT {comma} CAST({value} AS DOUBLE) AS x FROM {source}
      WHERE {value} IS NOT NULL),
    ends AS (SELECT min(x) AS lo, max(x) AS hi FROM vals),
    binned AS (SELECT {comma} lo, hi,
      least(CAST(floor((x - lo) * {bins} / (hi - lo)) AS BIGINT), {bins - 1}) + 1 AS bin
      FROM vals, ends)
    SELECT {comma} CAST(bin AS BIGINT) AS bin,
      {_r(f"lo + (hi - lo) * ((bin - 1) / {bins}.0)", "bin_low")},
      {_r(f"lo + (hi - lo) * (bin / {bins}.0)", "bin_high")}, count(*) AS n
    FROM binned GROUP BY {comma} bin, lo, hi"""


_CUSTOMERS = """, customers AS (SELECT DISTINCT user_id, age, age_group, credit_card_limit FROM log)
"""
_TX = """, users AS (SELECT DISTINCT user_id FROM log WHERE event = 'offer completed'),
tx AS (SELECT l.user_id, l.amount, CASE WHEN u.user_id IS NULL THEN 0 ELSE 1 END AS uses_offers,
    CASE WHEN u.user_id IS NULL THEN 'Does Not Use Offers' ELSE 'Uses Offers' END AS user_type,
    log10(l.amount) AS log_amount
  FROM log l LEFT JOIN users u USING (user_id)
  WHERE l.event = 'transaction' AND l.amount > 0)
"""

_PRECISION = "CAST(cum_pos AS DOUBLE) / cum_n"
_QUALITY = f"""
    {_r(f"sum(b.pos * ({_PRECISION})) / max(t.pos)", "pr_auc")},
    {_r("sum((b.n - b.pos) * (b.cum_pos - b.pos + b.pos / 2)) / (max(t.pos) * max(t.neg))", "roc_auc")},
    {_r("sum(-(b.pos * ln(b.score) + (b.n - b.pos) * ln(1 - b.score))) / max(t.n)", "logloss")},
    {_r("sum(b.pos * (1 - b.score) * (1 - b.score) + (b.n - b.pos) * b.score * b.score) / max(t.n)", "brier")}"""
_GAP = "abs(b.cum_pos / t.pos - (b.cum_n - b.cum_pos) / t.neg)"
_KS = f"""{_r(f"max({_GAP})", "ks_value")},
    {_r(f"arg_max(b.score, struct_pack(g := {_GAP}, s := b.score))", "ks_threshold")}"""


def _cells(threshold: float) -> str:
    thr = f"CAST({threshold!r} AS DOUBLE)"
    return f"""cells AS (SELECT
      count(*) FILTER (score < {thr} AND y = 0) AS tn,
      count(*) FILTER (score >= {thr} AND y = 0) AS fp,
      count(*) FILTER (score < {thr} AND y = 1) AS fn,
      count(*) FILTER (score >= {thr} AND y = 1) AS tp FROM scored)"""


def _conversion(threshold: float) -> str:
    return f"""{_r(str(threshold), "threshold")}, CAST(tp + fp AS BIGINT) AS targeted_n,
      {_r("(tp + fp) / (tn + fp + fn + tp)", "targeted_rate")}, tp, fp, fn, tn,
      {_r("tp / greatest(tp + fp, 1)", "precision")}, {_r("tp / greatest(tp + fn, 1)", "recall")},
      {_r("(tp / greatest(tp + fp, 1)) / ((tp + fn) / (tn + fp + fn + tp))", "lift")}"""


def _policy(where: str, name: str, value: float, cost: float, source: str = "ranked") -> str:
    return f"""SELECT '{name}' AS policy_name, count(*) AS targeted_n,
      {_r("count(*) / max(t.n)", "targeted_rate")},
      {_big("sum(y)", "actual_conversions_in_target")},
      {_r("sum(y) / count(*)", "precision_in_target")}, {_r("sum(y) / max(t.pos)", "recall_in_target")},
      {_r("sum(y) / count(*) / (max(t.pos) / max(t.n))", "lift_in_target")},
      {_r(f"sum(score * {value} - {cost})", "expected_profit")},
      {_r(f"sum(score * {value} - {cost}) / (count(*) * {cost})", "expected_roi")},
      {_r(f"count(*) * {cost}", "spend")}
    FROM {source}, total t WHERE {where}"""


_GRID = ", ".join(f"CAST({t!r} AS DOUBLE)" for t in default_grid())
_CURVE = f""", grid AS (SELECT unnest([{_GRID}]) AS threshold),
curve AS (SELECT g.threshold,
    coalesce(sum(CAST(s.score AS DECIMAL(20, 16))), 0) AS s, count(s.key) AS n
  FROM grid g LEFT JOIN scored s ON s.score >= g.threshold GROUP BY 1),
profits AS (SELECT threshold, CAST(s AS DOUBLE) * 16.62 - n * 1.0 AS profit FROM curve)
"""

_AT_K = f"""CAST(k AS BIGINT) AS k, {_r("k / max(t.n)", "k_rate")},
    {_r("sum(y) / k", "precision_at_k")}, {_r("sum(y) / max(t.pos)", "recall_at_k")},
    {_r("sum(y) / k / (max(t.pos) / max(t.n))", "lift_at_k")},
    {_big("sum(y)", "positives_in_topk")}"""


def _ks_list(ks: list[int]) -> str:
    return f"(SELECT unnest([{', '.join(str(k) for k in ks)}]) AS want)"


def _bins(value: str, edges: list[float], labels: list[str], missing: str) -> str:
    whens = " ".join(f"WHEN {value} <= {e} THEN '{x}'" for e, x in zip(edges, labels))
    return f"CASE WHEN {value} IS NULL THEN '{missing}' {whens} ELSE '{labels[-1]}' END"


def _correlations() -> str:
    names = [*NUMERIC, "target"]
    long = " UNION ALL ".join(
        f"SELECT rid, {i} AS i, '{c}' AS name, CAST({c} AS DOUBLE) AS v FROM numbered"
        for i, c in enumerate(names)
    )
    return f""", numbered AS MATERIALIZED (SELECT *, row_number() OVER () AS rid FROM abt),
    long AS MATERIALIZED ({long})
    SELECT a.name AS column_a, b.name AS column_b, count(*) AS n,
      {_r("covar_pop(b.v, a.v) / nullif(stddev_pop(a.v) * stddev_pop(b.v), 0)", "correlation")}
    FROM long a JOIN long b ON a.rid = b.rid AND a.i <= b.i
    WHERE a.v IS NOT NULL AND b.v IS NOT NULL GROUP BY 1, 2"""


def _shifted_correlation() -> str:
    values = {
        "seconds": "1.7e9 + o_orderkey % 100",
        "micros": "1.7e15 + (o_orderkey * 7) % 1000",
        "plain": "o_orderkey % 100",
        "same": "42.1",
        "gaps": "CASE WHEN o_orderkey % 3 <> 0 THEN (o_orderkey * 31) % 97 END",
    }
    names = list(values)
    columns = ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in values.items())
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, count({a} + {b}) AS n, "
        + (
            "CAST(NULL AS DOUBLE) AS correlation"
            if "same" in (a, b)
            else _r(f"corr({b} - m_{b}, {a} - m_{a})", "correlation")
        )
        + " FROM v, m"
        for i, a in enumerate(names)
        for b in names[i:]
    )
    means = ", ".join(f"avg({c}) AS m_{c}" for c in names)
    return f"WITH v AS (SELECT {columns} FROM orders), m AS (SELECT {means} FROM v) {pairs}"


def oracle_sql() -> dict[str, str]:
    ordered_bins = ", ".join(f"'{b}'" for b in RECENCY_BINS)
    q: dict[str, str] = {}

    # sources and clean tables
    q["scan_json_offers"] = _with(
        "offers",
        "SELECT id, offer_type, min_value, duration, discount_value, "
        "array_to_string(channels, ',') AS channels FROM offers",
    )
    q["sink_roundtrip"] = _with(
        "opps",
        "SELECT 'offers_processed' AS table_name, count(*) AS n FROM offers "
        "UNION ALL SELECT 'transactions_processed', count(*) FROM flat "
        "UNION ALL SELECT 'profile_processed', count(*) FROM clean "
        "UNION ALL SELECT 'event_log', count(*) FROM log "
        "UNION ALL SELECT 'opportunities', count(*) FROM opps",
    )
    q["row_counts"] = _with(
        "opps",
        "SELECT 'offers' AS table_name, count(*) AS total_rows FROM offers "
        "UNION ALL SELECT 'profile', count(*) FROM profile "
        "UNION ALL SELECT 'transactions', count(*) FROM flat "
        "UNION ALL SELECT 'event_log', count(*) FROM log "
        "UNION ALL SELECT 'opportunities', count(*) FROM opps",
    )
    q["flatten_events"] = _with(
        "events",
        f"SELECT account_id, event, t_us / 86400e6 AS time_since_test_start, offer_id, "
        "amount, reward FROM flat",
    )
    q["clean_profile"] = _with("profile", "SELECT * FROM clean")
    q["dedupe_users"] = _with(
        "log", _CUSTOMERS + "SELECT user_id, age, credit_card_limit FROM customers"
    )
    q["event_log"] = _with(
        "log",
        "SELECT * EXCLUDE (t_us, channels), array_to_string(channels, ',') AS channels FROM log",
    )
    q["opportunities"] = _with(
        "opps",
        "SELECT user_id, offer_id, offer_type, duration, min_value, discount_value, "
        "array_to_string(channels, ',') AS channels, age, age_group, gender, credit_card_limit, "
        "t_received, t_expires, t_viewed, t_completed, viewed, completed FROM opps",
    )
    q["opportunities_of_log"] = q["opportunities"]
    q["limit_band"] = _with(
        "opps",
        """, e AS (SELECT quantile_disc(credit_card_limit, 0.25) AS a,
      quantile_disc(credit_card_limit, 0.5) AS b, quantile_disc(credit_card_limit, 0.75) AS c
      FROM opps)
    SELECT CASE WHEN credit_card_limit IS NULL THEN 'Unknown'
      WHEN credit_card_limit <= a THEN '<= ' || CAST(trunc(a) AS BIGINT)
      WHEN credit_card_limit <= b THEN CAST(trunc(a) AS BIGINT) || ' - ' || CAST(trunc(b) AS BIGINT)
      WHEN credit_card_limit <= c THEN CAST(trunc(b) AS BIGINT) || ' - ' || CAST(trunc(c) AS BIGINT)
      ELSE '> ' || CAST(trunc(c) AS BIGINT) END AS limit_band, count(*) AS n,
      CAST(sum(completed) AS BIGINT) AS n_completed
    FROM opps, e GROUP BY 1""",
    )

    # quality
    cols = ["id", "gender", "age", "credit_card_limit"]
    nulls = ", ".join(f"count(*) - count({c}) AS {c}" for c in cols)
    q["null_summary"] = _with("profile", f"SELECT {nulls}, count(*) AS total_rows FROM profile")
    q["null_rates"] = _with(
        "profile",
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", p AS null_pct, CASE WHEN p > 20 THEN 'high' "
            f"WHEN p > 5 THEN 'medium' ELSE 'low' END AS severity FROM (SELECT "
            f"round(100.0 * (count(*) - count({c})) / count(*), 1) AS p FROM profile)"
            for c in cols
        ),
    )
    q["key_check"] = _with(
        "log",
        """SELECT CAST(sum(n) AS BIGINT) AS total_rows,
      count(*) FILTER (n > 1) AS duplicate_key_groups,
      CAST(sum(n - 1) AS BIGINT) AS duplicate_rows,
      CAST(coalesce(sum(n) FILTER (user_id IS NULL OR offer_id IS NULL), 0) AS BIGINT)
        AS rows_with_null_keys
    FROM (SELECT user_id, offer_id, count(*) AS n FROM log GROUP BY 1, 2)""",
    )
    q["distinct_counts"] = _with(
        "log",
        f"""SELECT event, offer_id, count(*) AS count,
      {_r("count(*) / (SELECT count(*) FROM log)", "pct", 4)}
    FROM log GROUP BY 1, 2 ORDER BY count DESC, event, offer_id NULLS FIRST LIMIT 20""",
    )

    # univariate
    q["event_funnel"] = _with(
        "log",
        f"""SELECT count(*) FILTER (event = 'transaction') AS n_transaction,
      count(*) FILTER (event = 'offer received') AS n_received,
      count(*) FILTER (event = 'offer viewed') AS n_viewed,
      count(*) FILTER (event = 'offer completed') AS n_completed,
      {_r("(count(*) FILTER (event = 'offer viewed')) / (count(*) FILTER (event = 'offer received'))", "view_rate")},
      {_r("(count(*) FILTER (event = 'offer completed')) / (count(*) FILTER (event = 'offer received'))", "completion_rate")}
    FROM log""",
    )
    for column, key in (("age", "age"), ("credit_card_limit", "limit")):
        q[f"{key}_histogram"] = _with("profile", _histogram("profile", column))
        q[f"{key}_box"] = _with("profile", _box("profile", column))
    q["gender_share"] = _with(
        "profile",
        f"""SELECT coalesce(gender, 'Unknown') AS gender, count(*) AS count,
      {_r("count(*) / (SELECT count(*) FROM profile)", "pct")} FROM profile GROUP BY 1""",
    )
    q["channel_distribution"] = _with(
        "offers",
        "SELECT channel, count(*) AS count FROM (SELECT unnest(channels) AS channel FROM offers) "
        "GROUP BY 1",
    )
    q["offer_type_share"] = _with(
        "opps",
        f"""SELECT offer_type, count(*) AS count,
      {_r("count(*) / (SELECT count(*) FROM opps)", "share")} FROM opps GROUP BY 1""",
    )
    q["completed_share"] = _with(
        "opps",
        f"""SELECT completed, count(*) AS count,
      {_r("count(*) / (SELECT count(*) FROM opps)", "rate")} FROM opps GROUP BY 1""",
    )
    q["viewed_completed_xtab"] = _with(
        "opps", "SELECT viewed, completed, count(*) AS count FROM opps GROUP BY 1, 2"
    )

    # bivariate, multivariate
    q["limit_by_age_box"] = _with(
        "log",
        _CUSTOMERS
        + _box(
            "(SELECT * FROM customers WHERE age_group <> 'Unknown')",
            "credit_card_limit",
            "age_group",
        ),
    )
    q["group_offer_rates"] = _rates("age_group, offer_type")
    q["gender_offer_rates"] = _rates("gender, offer_type")
    q["duration_rates"] = _rates("duration")
    three = f"""{_r("sum(completed) / count(*)", "completed_received")},
      {_r("sum(viewed) / count(*)", "viewed_received")},
      {_r("sum(completed) / nullif(sum(viewed), 0)", "completed_viewed")}"""
    q["funnel_by_offer_type"] = _with(
        "opps", f"SELECT offer_type, {_N}, {_SEEN}, {_DONE}, {three} FROM opps GROUP BY 1"
    )
    q["funnel_by_offer_type_long"] = _with(
        "opps",
        f"""UNPIVOT (SELECT offer_type, {three} FROM opps GROUP BY 1)
    ON completed_received, viewed_received, completed_viewed INTO NAME metric VALUE rate""",
    )
    q["profile_effectiveness"] = _with(
        "opps",
        f"""SELECT offer_type, gender, age_group, {_N}, {_DONE}, {_DONE_RATE}
    FROM opps GROUP BY 1, 2, 3 HAVING count(*) >= 10""",
    )
    by_age = f"""SELECT coalesce(gender, 'Unknown') AS gender, age_group, {_N}, {_DONE},
      {_r("sum(completed) / count(*)", "conversion_rate")}
    FROM opps GROUP BY 1, 2 HAVING count(*) >= 10"""
    q["gender_age_conversion"] = _with("opps", by_age)
    wide = ", ".join(
        f"max(conversion_rate) FILTER (age_group = '{b}') AS \"{b}\""
        for b in AGE_BANDS
        if b != "Unknown"
    )
    genders = ", ".join(f"'{g}'" for g in GENDERS)
    q["gender_age_pivot"] = _with(
        "opps",
        f""", c AS ({by_age}) SELECT g.gender, {wide}
    FROM (SELECT unnest([{genders}]) AS gender) g LEFT JOIN c USING (gender) GROUP BY 1""",
    )
    exploded = ", x AS (SELECT unnest(channels) AS channel, offer_type, completed FROM opps)"
    q["channel_conversion"] = _with(
        "opps", f"{exploded} SELECT channel, {_N}, {_DONE}, {_DONE_RATE} FROM x GROUP BY 1"
    )
    q["channel_type_conversion"] = _with(
        "opps",
        f"{exploded} SELECT channel, offer_type, {_N}, {_DONE}, {_DONE_RATE} FROM x GROUP BY 1, 2",
    )

    # completion without a view
    unseen = "count(*) FILTER (completed = 1 AND viewed = 0)"
    q["completed_without_view"] = _with(
        "opps",
        f"""SELECT count(*) AS total_completed, {unseen} AS n_without_view,
      {_r(f"({unseen}) / count(*)", "rate_without_view")} FROM opps WHERE completed = 1""",
    )
    for key, group in (
        ("group_without_view", "age_group"),
        ("gender_without_view", "gender"),
        ("type_without_view", "offer_type"),
    ):
        q[key] = _with(
            "opps",
            f"""SELECT {group}, {_N}, {unseen} AS n_without_view, {_r(f"({unseen}) / count(*)", "rate")}
    FROM opps GROUP BY 1""",
        )

    # spending
    q["tx_value_summary"] = _with(
        "log",
        _TX
        + f"""SELECT uses_offers, {_r("quantile_disc(amount, 0.5)", "median")},
      {_r("avg(amount)", "mean")}, count(*) AS n FROM tx GROUP BY 1""",
    )
    q["tx_log_histogram"] = _with("log", _TX + _histogram("tx", "log_amount", "user_type"))
    q["tx_value_box"] = _with("log", _TX + _box("tx", "amount", "user_type"))

    # time
    q["conversion_over_time"] = _with(
        "opps",
        f"""SELECT t_received, count(*) AS n, {_DONE},
      {_r("sum(completed) / count(*)", "conversion_rate")} FROM opps GROUP BY t_received""",
    )
    for key, group in (("engagement_by_week", "gender"), ("engagement_by_week_age", "age_group")):
        q[key] = _with(
            "log",
            f"""SELECT CAST(floor(t_us / (7.0 * {DAY})) AS INTEGER) AS week,
      coalesce({group}, {"'Unknown'" if group == "gender" else "NULL"}) AS {group}, event,
      count(*) AS count
    FROM log WHERE event IN ('offer viewed', 'offer completed') GROUP BY ALL""",
        )
    spend = """, spend AS (SELECT user_id, sum(amount) AS total_spend FROM log
      WHERE event = 'transaction' {} GROUP BY 1)"""
    q["registration_cohort"] = _with(
        "opps",
        spend.format("")
        + f""", reg AS (SELECT user_id, max(registered_on_date) AS d FROM log GROUP BY 1),
    conv AS (SELECT user_id, sum(completed) / count(*) AS conv_rate FROM opps GROUP BY 1)
    SELECT strftime(d, '%Y-%m') AS reg_month, count(*) AS n_customers,
      {_r("avg(total_spend)", "avg_spend")}, {_r("avg(conv_rate)", "avg_conversion_rate")}
    FROM reg LEFT JOIN spend USING (user_id) LEFT JOIN conv USING (user_id)
    WHERE d IS NOT NULL GROUP BY 1""",
    )

    # signals
    conversion = _r("coalesce(sum(completed) / nullif(count(completed), 0), 0)", "conversion_rate")
    days = "(t_us - last_tx) / 86400e6"
    q["recency_conversion"] = _with(
        "opps",
        f""", last AS (SELECT o.*, (SELECT max(e.t_us) FROM log e WHERE e.user_id = o.user_id
        AND e.event = 'transaction' AND e.t_us < o.t_us) AS last_tx FROM opps o),
    b AS (SELECT {_bins(days, [1, 3, 7, 14, 30], RECENCY_BINS[:-1], "No history")} AS recency_bin,
      completed FROM last)
    SELECT d.recency_bin, count(b.completed) AS n_offers,
      CAST(coalesce(sum(completed), 0) AS BIGINT) AS n_completed, {conversion}
    FROM (SELECT unnest([{ordered_bins}]) AS recency_bin) d LEFT JOIN b USING (recency_bin)
    GROUP BY 1""",
    )
    n_done = f"""count(*) AS n, {_DONE}, {_r("sum(completed) / count(*)", "conversion_rate")}"""
    q["registration_quartile"] = _with(
        "opps",
        f""", reg AS (SELECT user_id, max(registered_on_date) AS d FROM log GROUP BY 1
      HAVING max(registered_on_date) IS NOT NULL),
    aged AS (SELECT user_id, date_diff('day', (SELECT min(d) FROM reg), d) AS x FROM reg),
    e AS (SELECT quantile_disc(x, 0.25) AS a, quantile_disc(x, 0.5) AS b,
      quantile_disc(x, 0.75) AS c FROM aged),
    g AS (SELECT user_id, CASE WHEN x <= a THEN 'Q1 (Oldest)' WHEN x <= b THEN 'Q2'
      WHEN x <= c THEN 'Q3' ELSE 'Q4 (Newest)' END AS reg_quartile FROM aged, e)
    SELECT reg_quartile, {n_done} FROM opps LEFT JOIN g USING (user_id) GROUP BY 1""",
    )
    ps = "[0.2, 0.4, 0.6, 0.8]"
    fmt = "format('{{:,}}', CAST(floor(e.q[{0}]) AS BIGINT))"
    band = (
        "CASE WHEN total_spend IS NULL THEN 'No history' "
        + " ".join(
            f"WHEN total_spend <= e.q[{i}] THEN 'Q{i} (≤ ' || {fmt.format(i)} || ')'"
            for i in range(1, 5)
        )
        + f" ELSE 'Q5 (>' || {fmt.format(4)} || ')' END"
    )
    n_done = n_done.replace("AS n,", "AS n_received,")
    q["spend_band_conversion"] = _with(
        "opps",
        spend.format("AND amount > 0")
        + f""", e AS (SELECT quantile_disc(total_spend, {ps}) AS q FROM spend)
    SELECT {band} AS spend_band, {n_done}
    FROM opps LEFT JOIN spend USING (user_id), e GROUP BY 1""",
    )
    q["spend_band_as_of"] = _with(
        "opps",
        f""", s AS (SELECT o.*, (SELECT sum(CAST(e.amount AS DECIMAL(28, 12))) FROM log e
        WHERE e.user_id = o.user_id AND e.event = 'transaction' AND e.amount > 0
        AND e.t_us < o.t_us) AS total_spend FROM opps o),
    e AS (SELECT quantile_disc(total_spend, {ps}) AS q FROM s)
    SELECT {band} AS spend_band, {n_done} FROM s, e GROUP BY 1""",
    )

    # modelling table
    keys = ["customer_id", "offer_id", "time_received"]
    q["offer_static_features"] = _with(
        "abt", f"SELECT {_abt_columns([*keys, 'offer_reward_ratio', 'offer_duration_bucket'])} FROM abt"
    )
    flags = [f"channel_is_{c}" for c in CHANNELS]
    q["channel_features"] = _with(
        "abt",
        f"SELECT {_abt_columns([*keys, *flags])}, "
        "CAST(offer_channel_count AS INTEGER) AS offer_channel_count FROM abt",
    )
    q["history_features"] = _with("abt", f"SELECT {_abt_columns([*keys, *HISTORY])} FROM abt")
    q["last_viewed_type"] = _with(
        "abt", f"SELECT {_abt_columns([*keys, 'last_viewed_offer_type'])} FROM abt"
    )
    q["tenure"] = _with(
        "abt", f"SELECT {_abt_columns([*keys, 'customer_tenure_days'])} FROM abt"
    )
    q["target"] = _with("abt", f"SELECT {_abt_columns([*keys, 'offer_type', 'target'])} FROM abt")
    whole = [*keys, "time_expires", *CATEGORICAL, *NUMERIC, "target"]
    q["abt"] = _with(
        "abt",
        f"SELECT {_abt_columns(whole)}, array_to_string(offer_channels, ',') AS offer_channels FROM abt",
    )
    q["abt_of_log"] = q["abt_clustered"] = q["abt_clustered_cells"] = q["abt"]
    q["abt_columns"] = _with(
        "abt",
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, '{role}' AS role, count({c}) AS n_set FROM abt"
            for role, names in (("numerical", NUMERIC), ("categorical", CATEGORICAL))
            for c in names
        ),
    )
    q["abt_grain"] = _with(
        "abt",
        """SELECT CAST(sum(n) AS BIGINT) AS total_rows,
      count(*) FILTER (n > 1) AS duplicate_key_groups,
      CAST(sum(n - 1) AS BIGINT) AS duplicate_rows,
      CAST(coalesce(sum(n) FILTER (customer_id IS NULL OR offer_id IS NULL
        OR time_received IS NULL), 0) AS BIGINT) AS rows_with_null_keys
    FROM (SELECT customer_id, offer_id, time_received, count(*) AS n FROM abt GROUP BY 1, 2, 3)""",
    )
    q["class_balance"] = _with(
        "abt",
        f"""SELECT target, count(*) AS count, {_r("count(*) / (SELECT count(*) FROM abt)", "pct", 4)}
    FROM abt GROUP BY 1""",
    )
    q["shifted_correlation"] = _shifted_correlation()
    q["correlation_matrix"] = _with("abt", _correlations())
    melted = "(" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, target, CAST({c} AS DOUBLE) AS value FROM abt" for c in NUMERIC
    ) + ")"
    q["feature_box_by_target"] = _with("abt", _box(melted, "value", "feature, target"))
    last = "max(time_received) OVER (PARTITION BY customer_id)"
    split = f""", s AS (SELECT *, {last} AS max_time FROM abt)"""
    q["avg_conversion_value"] = _with(
        "abt",
        f"""{split} SELECT {_r("avg(avg_ticket_before)", "avg_conversion_value")},
      {_r("1.0 / avg(avg_ticket_before)", "break_even_threshold")}
    FROM s WHERE time_received < max_time AND target = 1""",
    )
    q["split_last_event"] = _with(
        "abt",
        f"""{split} SELECT {_abt_columns(keys)},
      CASE WHEN time_received = max_time THEN 'test' ELSE 'train' END AS split FROM s""",
    )

    # evaluation
    joined = "FROM by_score b, total t"
    q["model_quality"] = _with(
        "scored", f"SELECT {_QUALITY}, {_r('max(t.pos) / max(t.n)', 'base_rate')} {joined}"
    )
    q["roc_curve"] = _with(
        "scored",
        f"""SELECT {_r("score", "threshold")}, {_r("(b.cum_n - b.cum_pos) / t.neg", "fpr")},
      {_r("b.cum_pos / t.pos", "tpr")} {joined} UNION ALL SELECT NULL, 0.0, 0.0""",
    )
    q["pr_curve"] = _with(
        "scored",
        f"""SELECT {_r("score", "threshold")}, {_r("b.cum_pos / t.pos", "recall")},
      {_r(_PRECISION, "precision")} {joined} UNION ALL SELECT NULL, 0.0, 1.0""",
    )
    q["calibration_curve"] = _with(
        "scored",
        f""", e AS (SELECT quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q
      FROM scored),
    b AS (SELECT s.*, 1 + len(list_filter(e.q, lambda x: x < s.score)) AS bin FROM scored s, e)
    SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n, {_r("avg(score)", "mean_pred")},
      {_r("avg(y)", "frac_pos")} FROM b GROUP BY bin""",
    )
    q["calibration_curve_uniform"] = _with(
        "scored",
        f""", b AS (SELECT *, 1 + len(list_filter(
        [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[], lambda x: x < score)) AS bin
      FROM scored)
    SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n, {_r("avg(score)", "mean_pred")},
      {_r("avg(y)", "frac_pos")} FROM b GROUP BY bin""",
    )
    q["confusion"] = _with("scored", f", {_cells(0.5)} SELECT * FROM cells")
    base = _r("(tp + fn) / (tn + fp + fn + tp)", "base_rate")
    q["conversion_metrics"] = _with(
        "scored", f", {_cells(0.5)} SELECT {base}, {_conversion(0.5)} FROM cells"
    )
    lines = f"""c AS (SELECT tn / (tn + fn) AS p0, tn / (tn + fp) AS r0,
        2 * tn / (2 * tn + fp + fn) AS f0, tn + fp AS s0, tp / (tp + fp) AS p1,
        tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fp + fn) AS f1, tp + fn AS s1,
        (tp + tn) / (tn + fp + fn + tp) AS acc FROM cells)"""

    def line(label: str, p: str, r: str, f: str, s: str) -> str:
        return (
            f"SELECT '{label}' AS label, {_r(p, 'precision', 4)}, {_r(r, 'recall', 4)}, "
            f"{_r(f, 'f1_score', 4)}, {_big(s, 'support')} FROM c"
        )

    def mean(x: str, weighted: bool) -> str:
        if weighted:
            return f"({x}0 * s0 + {x}1 * s1) / (s0 + s1)"
        return f"({x}0 + {x}1) / 2"

    q["classification_report"] = _with(
        "scored",
        f", {_cells(0.5)}, {lines} "
        + " UNION ALL ".join(
            [
                line("0", "p0", "r0", "f0", "s0"),
                line("1", "p1", "r1", "f1", "s1"),
                line("accuracy", "acc", "acc", "acc", "s0 + s1"),
                line("macro avg", *[mean(x, False) for x in "prf"], "s0 + s1"),
                line("weighted avg", *[mean(x, True) for x in "prf"], "s0 + s1"),
            ]
        ),
    )
    q["ks"] = _with("scored", f"SELECT {_KS} {joined}")
    q["ranking_table"] = _with(
        "scored",
        f""", k AS (SELECT want, greatest(least(want, CAST(t.n AS BIGINT)), 1) AS k
      FROM {_ks_list([100, 1000, 2000, 5000, 10000, 16994])}, total t)
    SELECT {_AT_K} FROM k JOIN ranked r ON r.rn <= k.k, total t GROUP BY want, k""",
    )
    q["evaluation_report"] = _with(
        "scored",
        f""", q AS (SELECT {_QUALITY}, {_r("max(t.pos) / max(t.n)", "base_rate")} {joined}),
    p AS (SELECT {_r("sum(y) / count(*)", "precision_at_k")}, {_r("sum(y) / max(t.pos)", "recall_at_k")},
      {_r("sum(y) / count(*) / (max(t.pos) / max(t.n))", "lift_at_k")}, count(*) AS k
      FROM ranked, total t WHERE rn <= 5000) SELECT * FROM q, p""",
    )
    q["gains_lift"] = _with(
        "scored",
        f""", c AS (SELECT DISTINCT CAST(ceil(CAST(t.n AS BIGINT) * i / 100) AS BIGINT) AS k
      FROM range(1, 101) g(i), total t)
    SELECT k, {_r("k / t.n", "population")}, {_r("r.cum_pos / t.pos", "gains")},
      {_r("r.cum_pos / t.pos / (k / t.n)", "lift")} FROM c JOIN ranked r ON r.rn = k, total t""",
    )
    q["gains_lift_rows"] = _with(
        "scored",
        f"""SELECT rn AS k, {_r("rn / t.n", "population")}, {_r("r.cum_pos / t.pos", "gains")},
      {_r("r.cum_pos / t.pos / (rn / t.n)", "lift")} FROM ranked r, total t""",
    )
    q["decile_table"] = _with(
        "scored",
        f""", d AS (SELECT *, least((rn - 1) // greatest(CAST(t.n AS BIGINT) // 10, 1), 9) + 1 AS decile
      FROM ranked, total t)
    SELECT CAST(decile AS INTEGER) AS decile, count(*) AS n, {_r("avg(score)", "avg_score", 4)},
      {_big("sum(y)", "conversions")}, {_r("sum(y) / count(*)", "conversion_rate", 4)},
      {_r("sum(y) / count(*) / (max(t.pos) / max(t.n))", "lift", 4)},
      {_r("max(cum_pos) / max(t.pos)", "cumulative_recall", 4)}
    FROM d, total t GROUP BY decile""",
    )
    q["eval_summary"] = _with(
        "scored",
        f""", {_cells(0.5)}, m AS (SELECT {_QUALITY} {joined}),
    c AS (SELECT {base}, {_conversion(0.5)} FROM cells), k AS (SELECT {_KS} {joined})
    SELECT * FROM m, c, k""",
    )

    # policies
    top = _policy("rn <= 10000", "Top-K by budget", 16.62, 1.0)
    q["top_k_budget"] = _with("scored", top)
    threshold = _policy("score >= CAST(0.06 AS DOUBLE)", "Threshold policy", 16.62, 1.0, "scored")
    q["policy_threshold"] = _with("scored", threshold)
    metrics = (
        "targeted_n, targeted_rate, actual_conversions_in_target, precision_in_target, "
        "recall_in_target, lift_in_target, expected_profit, expected_roi, spend"
    )
    casts = ", ".join(f"CAST({m.strip()} AS DOUBLE) AS {m.strip()}" for m in metrics.split(","))
    q["policy_report_long"] = _with(
        "scored",
        f", p AS ({threshold}) UNPIVOT (SELECT policy_name, {casts} FROM p) ON {metrics} "
        "INTO NAME metric VALUE value",
    )
    q["profit_curve"] = _with(
        "scored", _CURVE + f"SELECT {_r('threshold', 'threshold')}, {_r('profit', 'profit')} FROM profits"
    )
    q["best_threshold"] = _with(
        "scored",
        _CURVE
        + f"""SELECT {_r("threshold", "best_threshold")}, {_r("profit", "best_profit")}
    FROM profits ORDER BY profit DESC, threshold LIMIT 1""",
    )
    chosen = "FILTER (score >= CAST(0.3 AS DOUBLE))"
    q["financial_uplift"] = _with(
        "scored",
        f""", u AS (SELECT count(*) AS total_n, sum(score * 16.62 - 1.0) AS b,
      sum(score * 16.62 - 1.0) {chosen} AS m, count(*) {chosen} AS targeted_n FROM scored)
    SELECT total_n, {_r("b", "baseline_profit")}, {_r("m", "model_profit")}, {_r("m - b", "uplift")},
      {_r("(m - b) / abs(b) * 100", "uplift_pct")}, targeted_n, total_n - targeted_n AS excluded_n,
      {_r("(total_n - targeted_n) * 1.0", "cost_saved")} FROM u""",
    )
    # draws
    q["split_calibration"] = _with(
        "abt",
        f"""{split}, train AS (SELECT * FROM s WHERE time_received < max_time), numbers AS (
      SELECT DISTINCT customer_id, {_number("customer_id", 42)} AS number FROM train
    ), ranked AS (
      SELECT customer_id, row_number() OVER (ORDER BY number) AS place, count(*) OVER () AS total
      FROM numbers
    )
    SELECT place <= ceil(total * CAST(0.2 AS DOUBLE)) AS calibration, count(*) AS n,
      count(DISTINCT customer_id) AS n_customers FROM train JOIN ranked USING (customer_id) GROUP BY 1""",
    )
    q["cv_folds_balanced"] = _balanced_folds()
    q["baseline_scores"] = _with(
        "abt",
        f"""{split}, rate AS (
      SELECT CAST(sum(target) AS DOUBLE) / count(*) AS base FROM s WHERE time_received < max_time)
    SELECT customer_id, offer_id, time_received, target, CASE WHEN {_dice(
        "concat(customer_id, ':', offer_id, ':', "
        "CAST(CAST(round(time_received * 86400000000) AS BIGINT) AS VARCHAR))", 42, 1_000_000
    )} / CAST(1000000 AS DOUBLE) < base THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score
    FROM s, rate WHERE time_received = max_time""",
    )
    q["features_vector"] = _with(
        "abt",
        f"""SELECT customer_id, offer_id, time_received, CAST({2 * len(NUMERIC)} + {" + ".join(
        f"(SELECT count(DISTINCT {c}) FROM abt)" for c in CATEGORICAL)} AS INTEGER) AS n_features,
      {_r(" + ".join(
        [f"coalesce(CAST({c} AS DOUBLE), -1) + CAST({c} IS NULL AS INTEGER)" for c in NUMERIC]
        + [f"CAST({c} IS NOT NULL AS INTEGER)" for c in CATEGORICAL]), "feature_sum")} FROM abt""",
    )
    q["isotonic_fit"] = _with(
        "scored",
        f""", folded AS (
      SELECT score, row_number() OVER (ORDER BY score) AS i, count(*) AS w, sum(y) AS t
      FROM scored GROUP BY score
    ), sums AS (
      SELECT score, i, sum(w) OVER (ORDER BY i) AS cw, sum(t) OVER (ORDER BY i) AS ct, w, t FROM folded
    ), means AS (
      SELECT a.i AS a, b.i AS b,
        CAST(b.ct - a.ct + a.t AS DOUBLE) / CAST(b.cw - a.cw + a.w AS DOUBLE) AS mean
      FROM sums a JOIN sums b ON b.i >= a.i
    ), least AS (
      SELECT a, b, min(mean) OVER (PARTITION BY a ORDER BY b DESC) AS m FROM means
    )
    SELECT score, {_r("max(m)", "calibrated")} FROM least JOIN sums ON i = b GROUP BY score""",
    )
    q["cv_folds"] = _with(
        "abt",
        f"""SELECT CAST({_dice("customer_id", 43, 5)} AS INTEGER) AS fold, count(*) AS n,
      count(DISTINCT customer_id) AS n_customers FROM abt GROUP BY 1""",
    )
    q["age_limit_sample"] = _with(
        "log",
        _CUSTOMERS
        + f"""SELECT user_id, age, {_r("credit_card_limit", "credit_card_limit")} FROM customers
    WHERE age IS NOT NULL AND credit_card_limit IS NOT NULL
      AND {_dice("user_id", 42, 1_000_000)} < 80000""",
    )
    cents = "concat(user_id, ':', CAST(CAST(round(amount * 100) AS BIGINT) AS VARCHAR))"
    q["sample_tx"] = _with(
        "log",
        _TX + f"""SELECT user_id, {_r("amount", "amount")}, uses_offers, user_type FROM tx
    WHERE {_dice(cents, 42, 1_000_000)} < 300000""",
    )
    q["recency_of_log"] = q["recency_conversion"]
    # the same answers with hot keys cut into cells
    for name in ("opportunities", "abt", "tx_value_box", "gains_lift_rows", "decile_table"):
        q[f"{name}_cells"] = q[name]
    return q
