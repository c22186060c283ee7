"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from promolens.functions.columns import to_micros
from promolens.functions.domains import AGE_BANDS, GENDERS
from promolens.operators import (
    attribution,
    correlation,
    evaluation,
    features,
    groups,
    modeling,
    opportunities,
    policy,
    pooling,
    quality,
    segments,
)
from promolens.operators.layout import Limits
from promolens.plans.campaign import TABLES, Campaign
from promolens.sources import OFFER_SCHEMA, drop_tables, read_json, scratch_dir, testdata

Query = Callable[[SparkSession, str], DataFrame]

# Policy parameters of the published evaluation.
VALUE, COST = 16.62, 1.0
BUDGET = 10_000.0


# Quotients of whole microseconds: equal in every engine, so left as they are.
TIMES = {
    "time_since_test_start",
    "time_received",
    "time_expires",
    "t_received",
    "t_expires",
    "t_viewed",
    "t_completed",
}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison: engines differ in the last bits of a sum."""
    return df.selectExpr(
        *[
            f"round(`{f.name}`, {digits}) as `{f.name}`"
            if isinstance(f.dataType, DoubleType) and f.name not in TIMES
            else f"`{f.name}`"
            for f in df.schema
        ]
    )


def _text_channels(df: DataFrame, column: str = "channels") -> DataFrame:
    return df.withColumn(column, F.array_join(column, ","))


def _counts(tables: dict[str, DataFrame], n: str) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = quality.row_count(df).select(F.lit(name).alias("table_name"), F.col("total_rows").alias(n))
        out = one if out is None else out.unionByName(one)
    return out


def _on(layer: str, report: Callable[[DataFrame], DataFrame]) -> Query:
    """A query that is one report over one table of the campaign."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(report(getattr(Campaign.of_testdata(spark, sf_dir), layer)))

    return run


def _campaign(report: Callable[[Campaign], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(report(Campaign.of_testdata(spark, sf_dir)))

    return run


def _scored(report: Callable[[DataFrame, Limits], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        scored = testdata.scored(spark, sf_dir)
        # Answered from file footers, without reading the rows.
        return rounded(report(scored, Limits(at_most=scored.count())))

    return run


def _features(*columns: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        abt = Campaign.of_testdata(spark, sf_dir).abt
        return rounded(abt.select(*features.KEYS, *columns))

    return run


# -- sources ---------------------------------------------------------------------------------


def scan_json_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    testdata.offers(spark, sf_dir).write.json(path)
    return _text_channels(read_json(spark, path, OFFER_SCHEMA))


@contextmanager
def _stored(spark: SparkSession, sf_dir: str, limits: Limits | None = None) -> Iterator[Campaign]:
    """The campaign's tables in the catalog, which are dropped again."""
    base = scratch_dir(spark)
    suffix = f"_{base[-8:]}"
    campaign = Campaign.of_testdata(spark, sf_dir)
    campaign.limits = limits or campaign.limits
    try:
        yield campaign.store(base, suffix)
    finally:
        drop_tables(spark, [f"{t}{suffix}" for t in TABLES])


def _kept(df: DataFrame) -> DataFrame:
    """`df` in a file of its own, for use when the tables it reads are gone."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the campaign's tables to the catalog, read them back, count."""
    with _stored(spark, sf_dir) as stored:
        counts = {
            "offers_processed": stored.offers,
            "transactions_processed": stored.transactions,
            "profile_processed": stored.profile_raw,
            "event_log": stored.log,
            "opportunities": stored.opportunities,
        }
        return _kept(_counts(counts, "n"))


def abt_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modelling table from the stored events by customer, without a shuffle of events."""
    with _stored(spark, sf_dir) as stored:
        return _kept(rounded(_text_channels(stored.abt, "offer_channels")))


def abt_clustered_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the busier customers in the table of their own."""
    with _stored(spark, sf_dir, CELLS) as stored:
        return _kept(rounded(_text_channels(stored.abt, "offer_channels")))


def row_counts(c: Campaign) -> DataFrame:
    return _counts(
        {
            "offers": c.offers,
            "profile": c.profile_raw,
            "transactions": c.transactions,
            "event_log": c.log,
            "opportunities": c.opportunities,
        },
        "total_rows",
    )


def opportunities_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Campaign.of_testdata(spark, sf_dir)
    return rounded(_text_channels(c.opportunities))


def opportunities_of_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same opportunities, from the joined event log alone."""
    c = Campaign.of_testdata(spark, sf_dir)
    return rounded(_text_channels(opportunities.opportunities(c.log, c.limits)))


#: Limits under which the busier keys of the test tables are cut into cells.
CELLS = Limits(chunks=400, min_rows=20)


def _in_cells(spark: SparkSession, sf_dir: str) -> Campaign:
    c = Campaign.of_testdata(spark, sf_dir)
    c.limits = CELLS
    return c


def opportunities_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_text_channels(_in_cells(spark, sf_dir).opportunities))


def abt_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_text_channels(_in_cells(spark, sf_dir).abt, "offer_channels"))


def tx_value_box_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _in_cells(spark, sf_dir)
    return rounded(segments.tx_value_box(c.events, c.limits))


def shifted_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns whose mean dwarfs their spread, one constant and one with gaps."""
    orders = testdata.table(spark, sf_dir, "orders").selectExpr(
        "1.7e9 + o_orderkey % 100 as seconds",
        "1.7e15 + (o_orderkey * 7) % 1000 as micros",
        "cast(o_orderkey % 100 as double) as plain",
        "cast(42.1 as double) as same",
        "if(o_orderkey % 3 = 0, null, cast((o_orderkey * 31) % 97 as double)) as gaps",
    )
    return rounded(correlation.correlation_matrix(orders, orders.columns, None))


def limit_band(c: Campaign) -> DataFrame:
    return c.opportunities_with_band(rel_error=0).groupBy("limit_band").agg(
        F.count(F.lit(1)).alias("n"), F.sum("completed").alias("n_completed")
    )


def abt_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_text_channels(Campaign.of_testdata(spark, sf_dir).abt, "offer_channels"))


def abt_of_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table, from the joined event log and its opportunities."""
    c = Campaign.of_testdata(spark, sf_dir)
    opps = opportunities.opportunities(c.log, c.limits)
    abt = features.build_abt(c.log, opps, limits=c.limits)
    return rounded(_text_channels(abt, "offer_channels"))


def abt_columns(c: Campaign) -> DataFrame:
    """Feature columns, their roles, and how many rows have them set."""
    abt = c.abt
    numerical, categorical = features.column_roles(abt)
    names = numerical + categorical
    role = F.when(F.col("column_name").isin(categorical), "categorical").otherwise("numerical")
    return (
        abt.agg(*[F.count(n).alias(n) for n in names])
        .unpivot([], names, "column_name", "n_set")
        .withColumn("role", role)
    )


def channel_features_query(c: Campaign) -> DataFrame:
    base = features.channel_features(features.base_opportunities(c.opportunities))
    flags = [f"channel_is_{x}" for x in features.CHANNELS]
    return base.select(*features.KEYS, *flags, "offer_channel_count")


def offer_static_query(c: Campaign) -> DataFrame:
    base = features.offer_static_features(features.base_opportunities(c.opportunities))
    return base.select(*features.KEYS, "offer_reward_ratio", "offer_duration_bucket")


def history_query(c: Campaign) -> DataFrame:
    return c.abt.select(*features.KEYS, *features.history_columns())


def correlation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    abt = Campaign.of_testdata(spark, sf_dir).abt
    return rounded(correlation.correlation_matrix(abt, features.column_roles(abt)[0]))


def feature_box_query(c: Campaign) -> DataFrame:
    abt = c.abt
    return correlation.feature_box_by_target(abt, features.column_roles(abt)[0])


def split_query(c: Campaign) -> DataFrame:
    return modeling.with_split(c.abt).select(*features.KEYS, "split")


def avg_value_query(c: Campaign) -> DataFrame:
    train, _ = modeling.split_last_event(c.abt)
    return policy.avg_conversion_value(train, COST)


# -- models ----------------------------------------------------------------------------------


def _stored_abt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modelling table, written to the shared folder: training reads it many times."""
    path = scratch_dir(spark)
    abt = Campaign.of_testdata(spark, sf_dir).abt
    abt.write.parquet(path)
    return spark.read.schema(abt.schema).parquet(path)


def _trainer(spark: SparkSession, sf_dir: str, **options) -> modeling.PropensityTrainer:
    abt = _stored_abt(spark, sf_dir)
    numerical, categorical = features.column_roles(abt)
    limits = Limits(at_most=abt.count())
    return modeling.PropensityTrainer(abt, numerical, categorical, limits=limits, **options)


def _fitted(spark: SparkSession, sf_dir: str) -> tuple[modeling.PropensityTrainer, DataFrame]:
    trainer = _trainer(spark, sf_dir)
    _, test = trainer.train(maxIter=10, maxDepth=4, stepSize=0.1, minInstancesPerNode=10)
    return trainer, test


def split_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = modeling.split_last_event(_stored_abt(spark, sf_dir))
    flagged = modeling.with_calibration_flag(train)
    return flagged.groupBy("calibration").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("customer_id").alias("n_customers")
    )


def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = modeling.with_fold(_stored_abt(spark, sf_dir))
    return folded.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("customer_id").alias("n_customers")
    )


def cv_folds_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    abt = _stored_abt(spark, sf_dir)
    folded = groups.with_balanced_fold(abt, 5, "customer_id", 43, Limits(at_most=abt.count()))
    return folded.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("customer_id").alias("n_customers")
    )


def features_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    trainer = _trainer(spark, sf_dir)
    stages = modeling.feature_stages(trainer.numerical, trainer.categorical)
    inputs = modeling.numeric_inputs(trainer.df, trainer.numerical)
    vectors = modeling.Pipeline(stages=stages).fit(inputs).transform(inputs)
    values = modeling.vector_to_array("features")
    return vectors.select(
        *features.KEYS,
        F.size(values).alias("n_features"),
        F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), 6).alias("feature_sum"),
    )


def train_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows with their uncalibrated score."""
    trainer, test = _fitted(spark, sf_dir)
    return trainer.model.raw_scores(test).select(*features.KEYS, "target", "raw_score")


def tune_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best parameters of a short race, one row each, with their fold score: all six ranges, but
    fewer sets, folds and trees than by default."""
    space = {**modeling.SEARCH_SPACE, "maxIter": (4, 8), "maxDepth": (3, 5)}
    trainer = _trainer(spark, sf_dir, n_trials=4, n_folds=2, space=space, keep_one_in=2)
    train, _, _ = trainer.split()
    params, score = trainer.tune(train)
    rows = F.array(
        *[
            F.struct(F.lit(k).alias("param"), F.lit(str(v)).alias("value"))
            for k, v in params.items()
        ]
    )
    return spark.range(1).select(F.inline(rows)).withColumn("cv_pr_auc", F.lit(score))


def isotonic_calibrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calibration set: raw score next to the calibrated one."""
    trainer, _ = _fitted(spark, sf_dir)
    raw = trainer.model.raw_scores(trainer.calibration_set)
    return trainer.model.calibrator.transform(raw).select(
        *features.KEYS, "target", "raw_score", "calibrated"
    )


def score_abt(spark: SparkSession, sf_dir: str) -> DataFrame:
    trainer, _ = _fitted(spark, sf_dir)
    scored = trainer.model.predict(trainer.df, 0.5)
    return scored.select(*features.KEYS, "target", "score", "prediction")


def evaluate_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    trainer, test = _fitted(spark, sf_dir)
    return trainer.evaluate_ranking(test, k=5000)


def model_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most profitable threshold on the calibration set."""
    trainer, _ = _fitted(spark, sf_dir)
    return trainer.find_threshold(trainer.calibration_set, VALUE, COST)


def baseline_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = modeling.split_last_event(_stored_abt(spark, sf_dir))
    micros = to_micros(F.col("time_received")).cast("string")
    scored = modeling.baseline_scores(train, test, ["customer_id", "offer_id", micros])
    return scored.select(*features.KEYS, "target", "score")


def permutation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    trainer, test = _fitted(spark, sf_dir)
    return modeling.permutation_importance(
        trainer.model, test, features.KEYS, limits=trainer.limits
    )


def attribution_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and direction of every input in the fitted model, over all test rows."""
    trainer, test = _fitted(spark, sf_dir)
    return attribution.attribution_summary(trainer.model, test)


def attribution_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five strongest inputs of every test row."""
    trainer, test = _fitted(spark, sf_dir)
    return attribution.reasons(trainer.model, test, features.KEYS)


def isotonic_fit(scored: DataFrame, limits: Limits) -> DataFrame:
    blocks = pooling.isotonic_blocks(scored, "score", "y")
    return pooling.calibrated(scored.select("score").distinct(), blocks, "score")


KS = [100, 1_000, 2_000, 5_000, 10_000, 16_994]


def queries() -> dict[str, Query]:
    s, e, p = segments, evaluation, policy
    return {
        # sources and clean tables
        "scan_json_offers": scan_json_offers,
        "sink_roundtrip": sink_roundtrip,
        "row_counts": _campaign(row_counts),
        "flatten_events": lambda spark, d: rounded(Campaign.of_testdata(spark, d).events),
        "clean_profile": lambda spark, d: Campaign.of_testdata(spark, d).profile,
        "event_log": lambda spark, d: rounded(_text_channels(Campaign.of_testdata(spark, d).log)),
        "dedupe_users": _on(
            "log", lambda df: s.per_customer(df, "user_id", "age", "credit_card_limit")
        ),
        "opportunities": opportunities_query,
        "opportunities_of_log": opportunities_of_log,
        "opportunities_cells": opportunities_cells,
        "limit_band": _campaign(limit_band),
        # data quality
        "null_summary": _on(
            "profile_raw",
            lambda df: quality.null_summary(df, ["id", "gender", "age", "credit_card_limit"]),
        ),
        "null_rates": _on(
            "profile_raw",
            lambda df: quality.null_rates(df, ["id", "gender", "age", "credit_card_limit"]),
        ),
        "key_check": _on("log", lambda df: quality.key_check(df, ["user_id", "offer_id"])),
        "distinct_counts": _on(
            "log", lambda df: quality.distinct_counts(df, ["event", "offer_id"], top_n=20)
        ),
        # univariate
        "event_funnel": _on("events", s.event_funnel),
        "age_histogram": _on("profile_raw", lambda df: s.customer_histogram(df, "age")),
        "age_box": _campaign(lambda c: s.customer_box(c.profile_raw, "age", None)),
        "limit_histogram": _on(
            "profile_raw", lambda df: s.customer_histogram(df, "credit_card_limit")
        ),
        "limit_box": _campaign(lambda c: s.customer_box(c.profile_raw, "credit_card_limit", None)),
        "gender_share": _on("profile_raw", s.gender_share),
        "channel_distribution": _on("offers", s.channel_distribution),
        "offer_type_share": _on("opportunities", s.offer_type_share),
        "completed_share": _on("opportunities", s.completed_share),
        "viewed_completed_xtab": _on("opportunities", s.viewed_completed_xtab),
        # bivariate and multivariate
        "limit_by_age_box": _campaign(lambda c: s.limit_by_age_box(c.log, c.limits)),
        "age_limit_sample": _on("log", s.age_limit_sample),
        "group_offer_rates": _on("opportunities", lambda o: s.group_offer_rates(o, "age_group", AGE_BANDS)),
        "gender_offer_rates": _on("opportunities", lambda o: s.group_offer_rates(o, "gender", GENDERS)),
        "duration_rates": _on("opportunities", s.duration_rates),
        "funnel_by_offer_type": _on("opportunities", s.funnel_by_offer_type),
        "funnel_by_offer_type_long": _on("opportunities", s.funnel_by_offer_type_long),
        "profile_effectiveness": _on("opportunities", s.profile_effectiveness),
        "gender_age_conversion": _on("opportunities", s.gender_age_conversion),
        "gender_age_pivot": _on("opportunities", s.gender_age_pivot),
        "channel_conversion": _on("opportunities", lambda o: s.channel_conversion(o, False)),
        "channel_type_conversion": _on("opportunities", s.channel_conversion),
        # completion without a view
        "completed_without_view": _on("opportunities", s.completed_without_view),
        "group_without_view": _on("opportunities", lambda o: s.group_without_view(o, "age_group", AGE_BANDS)),
        "gender_without_view": _on("opportunities", lambda o: s.group_without_view(o, "gender", GENDERS)),
        "type_without_view": _on("opportunities", s.type_without_view),
        # spending
        "tx_value_summary": _campaign(lambda c: s.tx_value_summary(c.events, 0, c.limits)),
        "tx_value_sketch": _campaign(lambda c: s.tx_value_summary(c.events, limits=c.limits)),
        "tx_log_histogram": _campaign(lambda c: s.tx_log_histogram(c.events, limits=c.limits)),
        "tx_value_box": _campaign(lambda c: s.tx_value_box(c.events, c.limits)),
        "tx_value_box_cells": tx_value_box_cells,
        "sample_tx": _campaign(lambda c: s.tx_sample(c.events, limits=c.limits)),
        # time
        "conversion_over_time": _on("opportunities", s.conversion_over_time),
        "engagement_by_week": _on("log", lambda df: s.engagement_by_week(df, "gender")),
        "engagement_by_week_age": _on("log", lambda df: s.engagement_by_week(df, "age_group")),
        "registration_cohort": _campaign(
            lambda c: s.registration_cohort(c.events, c.opportunities, c.registrations)
        ),
        # signals
        "recency_conversion": _on("opportunities_with_history", s.recency_of_history),
        "recency_of_log": _campaign(
            lambda c: s.recency_conversion(c.events, c.opportunities, c.limits)
        ),
        "registration_quartile": _campaign(
            lambda c: s.registration_quartile(
                c.events, c.opportunities, 0, c.registrations, c.limits
            )
        ),
        "spend_band_conversion": _campaign(
            lambda c: s.spend_band_conversion(
                c.events, c.opportunities, rel_error=0, limits=c.limits
            )
        ),
        "spend_band_as_of": _campaign(
            lambda c: s.spend_band_conversion(
                c.events, c.opportunities, rel_error=0, as_of=True, limits=c.limits
            )
        ),
        # modelling table
        "offer_static_features": _campaign(offer_static_query),
        "channel_features": _campaign(channel_features_query),
        "history_features": _campaign(history_query),
        "last_viewed_type": _features("last_viewed_offer_type"),
        "tenure": _features("customer_tenure_days"),
        "target": _features("offer_type", "target"),
        "abt": abt_query,
        "abt_of_log": abt_of_log,
        "abt_cells": abt_cells,
        "abt_clustered": abt_clustered,
        "abt_clustered_cells": abt_clustered_cells,
        "abt_columns": _campaign(abt_columns),
        "abt_grain": _on("abt", lambda df: quality.key_check(df, features.KEYS)),
        "class_balance": _on("abt", lambda df: quality.distinct_counts(df, "target")),
        "correlation_matrix": correlation_query,
        "shifted_correlation": shifted_correlation,
        "feature_box_by_target": _campaign(feature_box_query),
        "avg_conversion_value": _campaign(avg_value_query),
        "split_last_event": _campaign(split_query),
        # models
        "split_calibration": split_calibration,
        "cv_folds": cv_folds,
        "cv_folds_balanced": cv_folds_balanced,
        "features_vector": features_vector,
        "train_gbt": train_gbt,
        "tune_gbt": tune_gbt,
        "isotonic_calibrate": isotonic_calibrate,
        "score_abt": score_abt,
        "evaluate_model": evaluate_model,
        "model_threshold": model_threshold,
        "baseline_scores": baseline_query,
        "permutation_importance": permutation_query,
        "attribution_summary": attribution_summary,
        "attribution_reasons": attribution_reasons,
        "isotonic_fit": _scored(isotonic_fit),
        # evaluation
        "model_quality": _scored(lambda df, n: e.model_quality(df, n)),
        "roc_curve": _scored(lambda df, n: e.roc_curve(df, n)),
        "pr_curve": _scored(lambda df, n: e.pr_curve(df, n)),
        "calibration_curve": _scored(lambda df, n: e.calibration_curve(df, limits=n)),
        "calibration_curve_uniform": _scored(
            lambda df, n: e.calibration_curve(df, strategy="uniform")
        ),
        "confusion": _scored(lambda df, n: e.confusion(df, 0.5)),
        "conversion_metrics": _scored(lambda df, n: e.conversion_metrics(df, 0.5)),
        "classification_report": _scored(lambda df, n: e.classification_report(df, 0.5)),
        "ks": _scored(lambda df, n: e.ks(df, n)),
        "ranking_table": _scored(lambda df, n: e.ranking_table(df, KS, "key", n)),
        "evaluation_report": _scored(lambda df, n: e.evaluation_report(df, 5000, "key", n)),
        "gains_lift": _scored(lambda df, n: e.gains_lift(df, 100, "key", n)),
        "gains_lift_rows": _scored(lambda df, n: e.gains_lift(df, None, "key", n)),
        "decile_table": _scored(lambda df, n: e.decile_table(df, "key", n)),
        "gains_lift_rows_cells": _scored(lambda df, n: e.gains_lift(df, None, "key", CELLS)),
        "decile_table_cells": _scored(lambda df, n: e.decile_table(df, "key", CELLS)),
        "eval_summary": _scored(lambda df, n: e.eval_summary(df, 0.5, n)),
        # policies
        "top_k_budget": _scored(
            lambda df, n: p.top_k_budget(df, BUDGET, COST, VALUE, tie="key", limits=n)
        ),
        "policy_threshold": _scored(lambda df, n: p.policy_threshold(df, 0.06, VALUE, COST)),
        "policy_report_long": _scored(
            lambda df, n: p.policy_report_long(p.policy_threshold(df, 0.06, VALUE, COST))
        ),
        "profit_curve": _scored(lambda df, n: p.profit_curve(df, VALUE, COST)),
        "best_threshold": _scored(lambda df, n: p.best_threshold(df, VALUE, COST)),
        "financial_uplift": _scored(lambda df, n: p.financial_uplift(df, 0.3, VALUE, COST)),
    }
