"""From raw JSON to stored tables, a model and its reports."""

import pytest

import compare
from promolens.operators import evaluation, features, modeling
from promolens.plans.campaign import TABLES, Campaign
from promolens.sources import (
    EVENT_SCHEMA,
    OFFER_SCHEMA,
    PROFILE_SCHEMA,
    drop_tables,
    read_json,
    scratch_dir,
    table_versions,
    testdata,
)


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    path = scratch_dir(spark)
    testdata.offers(spark, sf_dir).write.json(f"{path}/offers")
    testdata.profile(spark, sf_dir).write.json(f"{path}/profile")
    testdata.transactions(spark, sf_dir).write.json(f"{path}/transactions")
    return Campaign(
        read_json(spark, f"{path}/offers", OFFER_SCHEMA),
        read_json(spark, f"{path}/profile", PROFILE_SCHEMA),
        read_json(spark, f"{path}/transactions", EVENT_SCHEMA),
    )


def test_json_array_line_gives_a_row_per_element(spark, tmp_path):
    (tmp_path / "offers.json").write_text('[{"id": "a", "duration": 7.0}, {"id": "b"}]')
    rows = read_json(spark, str(tmp_path / "offers.json"), OFFER_SCHEMA).collect()
    assert [(r["id"], r["duration"]) for r in rows] == [("a", 7.0), ("b", None)]


def test_json_inputs_give_the_same_table(raw, spark, sf_dir):
    direct = Campaign.of_testdata(spark, sf_dir)
    assert compare.spark_result(raw.abt) == compare.spark_result(direct.abt)


def test_stored_tables_give_the_same_table(raw, spark):
    stored = raw.store(scratch_dir(spark), "_test")
    assert "limit_band" in stored.opportunities.columns
    assert compare.spark_result(stored.abt) == compare.spark_result(raw.abt)


def test_scratch_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    first, second = scratch_dir(spark), scratch_dir(spark)
    assert first.startswith(f"{shared}/promolens-") and first != second


def test_splits(spark):
    rows = [("u", "a", 1.0), ("u", "b", 2.0), ("u", "c", 2.0), ("v", "a", 5.0), ("w", "a", None)]
    df = spark.createDataFrame(rows, "customer_id string, offer_id string, time_received double")
    train, test = modeling.split_last_event(df)
    assert [tuple(r) for r in train.collect()] == [("u", "a", 1.0)]
    assert sorted(tuple(r) for r in test.collect()) == [rows[1], rows[2], rows[3]]


def test_customers_are_never_divided(spark):
    df = spark.range(2000).selectExpr("cast(id % 300 as string) as customer_id")
    flagged = modeling.with_fold(modeling.with_calibration_flag(df))
    kinds = flagged.distinct()
    assert kinds.count() == 300
    share = kinds.where("calibration").count() / 300
    assert 0.1 < share < 0.3 and kinds.select("fold").distinct().count() == 5


def test_untrained_model_raises(spark):
    trainer = modeling.PropensityTrainer(spark.range(1), [], [])
    for name in ("model", "best_params", "best_score", "calibration_set"):
        with pytest.raises(RuntimeError):
            getattr(trainer, name)


def test_model_learns_and_is_calibrated(spark):
    """A learnable rule with gaps and an unseen category beats the base rate by far."""
    df = spark.range(1500).selectExpr(
        "cast(id % 150 as string) as customer_id",
        "cast(id as string) as offer_id",
        "cast(id div 150 as double) as time_received",
        "if(id % 7 = 0, null, cast(id * 37 % 100 as double)) as x",
        "if(id div 150 = 9 and id % 150 = 3, 'new', if(id % 2 = 0, 'a', 'b')) as g",
        "cast(coalesce(id * 37 % 100 > 50, false) and id % 7 <> 0 as int) as target",
    ).cache()
    trainer = modeling.PropensityTrainer(df, ["x"], ["g"])
    _, test = trainer.train(maxIter=5, maxDepth=3)
    scored = trainer.scored(test)
    assert scored.count() == 150
    quality = evaluation.model_quality(scored).first()
    assert quality["pr_auc"] > 0.95 and quality["brier"] < 0.05
    bounds = scored.selectExpr("min(score)", "max(score)").first()
    assert 0.0 <= bounds[0] <= bounds[1] <= 1.0
    report = modeling.permutation_importance(trainer.model, test, features.KEYS).collect()
    assert max(report, key=lambda r: r["importance"])["feature"] == "x"
    labels = trainer.model.predict(test, 0.5).groupBy("prediction").count().collect()
    assert {r["prediction"] for r in labels} == {0, 1}


def test_search_draws_stay_in_range():
    draws = modeling.draw_params(20, seed=1)
    assert draws == modeling.draw_params(20, seed=1)
    for drawn in draws:
        for name, (low, high) in modeling.SEARCH_SPACE.items():
            assert low <= float(drawn[name]) <= high


def test_buckets_follow_the_events(spark, monkeypatch):
    import promolens.plans.campaign as campaign_module

    monkeypatch.setattr(campaign_module, "TASK_ROWS", 10)
    n, suffix = 240, "_by_size"
    campaign = Campaign(
        spark.createDataFrame(
            [("a", "bogo", 5, 7.0, 5, ["web"])],
            "id string, offer_type string, min_value long, "
            "duration double, discount_value long, channels array<string>",
        ),
        spark.createDataFrame(
            [("u1", 30, 100.0, "M", "20170101")],
            "id string, age long, credit_card_limit double, gender string, registered_on string",
        ),
        spark.range(n).selectExpr(
            "concat('u', id % 40) as account_id",
            "if(id % 2 = 0, 'offer received', 'transaction') as event",
            "cast(id as double) as time_since_test_start",
            "if(id % 2 = 0, 'a', null) as offer_id",
            "if(id % 2 = 1, 1.5D, null) as amount",
            "cast(null as double) as reward",
        ),
    )
    try:
        stored = campaign.store(scratch_dir(spark), suffix)
        [version] = table_versions(spark, f"events_by_customer{suffix}")
        described = {r[0]: r[1] for r in spark.sql(f"describe extended {version}").collect()}
        assert described["Num Buckets"] == "24"
        assert compare.spark_result(stored.abt) == compare.spark_result(campaign.abt)
    finally:
        drop_tables(spark, [f"{t}{suffix}" for t in TABLES])


def test_trees_grow_on_stored_features(spark, monkeypatch):
    rows = [
        (f"u{i % 60}", "a", float(i), i % 7 % 2, float(i * 31 % 17), "xyz"[i % 3]) for i in range(300)
    ]
    df = spark.createDataFrame(
        rows,
        "customer_id string, offer_id string, time_received double, target int, x double, c string",
    )
    stored, write = [], modeling.PropensityTrainer._stored_features
    monkeypatch.setattr(
        modeling.PropensityTrainer,
        "_stored_features",
        lambda self, rows: stored.append(write(self, rows)) or stored[-1],
    )
    trainer, params = modeling.PropensityTrainer(df, ["x"], ["c"]), {"maxIter": 3, "maxDepth": 3}
    train, test = trainer.train(**params)
    assert len(stored) == 1 and stored[0].count() == train.count()
    whole = trainer.pipeline(**params).fit(modeling.numeric_inputs(train, ["x"]))
    direct = modeling.PropensityModel(["x"], ["c"], whole).raw_scores(test).orderBy("customer_id")
    again = trainer.model.raw_scores(test).orderBy("customer_id")
    found = [[r["raw_score"] for r in scores.collect()] for scores in (direct, again)]
    assert found[0] == pytest.approx(found[1], rel=1e-9)


def test_permuted_rows_are_scored_in_many_tasks(spark):
    rows = [(f"u{i % 40}", "a", float(i), i % 7 % 2, float(i * 31 % 17)) for i in range(200)]
    df = spark.createDataFrame(
        rows, "customer_id string, offer_id string, time_received double, target int, x double"
    )
    trainer = modeling.PropensityTrainer(df, ["x"], [])
    _, test = trainer.train(maxIter=2, maxDepth=2)
    report = modeling.permutation_importance(trainer.model, test, features.KEYS)
    assert "hashpartitioning(_rank" in report._jdf.queryExecution().executedPlan().toString()
    [row] = report.collect()
    assert row["feature"] == "x" and 0 <= row["permuted_pr_auc"] <= 1


@pytest.fixture(scope="module")
def ranker(spark):
    """A trained model, its test rows, and these with their scores."""
    rows = [(f"u{i % 60}", "a", float(i), i % 7 % 2, float(i * 31 % 17)) for i in range(300)]
    df = spark.createDataFrame(
        rows, "customer_id string, offer_id string, time_received double, target int, x double"
    )
    trainer = modeling.PropensityTrainer(df, ["x"], [])
    _, test = trainer.train(maxIter=2, maxDepth=2)
    scored = trainer.scored(test)
    return trainer, test, spark.createDataFrame(scored.collect(), scored.schema)


@pytest.mark.parametrize("tie", [None, "x"])
def test_a_ranking_is_planned_over_rows_scored_before(ranker, tie):
    trainer, test, scored = ranker
    assert scored.count() == 60 > scored.select("score").distinct().count()
    found = trainer.evaluate_ranking(test, 7, tie)
    direct = evaluation.evaluation_report(scored, 7, tie)
    assert found.columns == direct.columns
    assert list(found.first()) == pytest.approx(list(direct.first()), rel=1e-12)
    plans = [
        d._jdf.queryExecution().optimizedPlan().toString() for d in (trainer.scored(test), found)
    ]
    # Trees score in functions, and the text of a plan holds its subqueries.
    assert ["UDF(" in p for p in plans] == [True, False]


@pytest.mark.parametrize("k", [5, 0])
def test_a_ranking_of_no_rows(ranker, k):
    trainer, test, scored = ranker
    found = trainer.evaluate_ranking(test.where("target > 1"), k).collect()
    direct = evaluation.evaluation_report(scored.where("target > 1"), k).collect()
    assert str(found) == str(direct)
