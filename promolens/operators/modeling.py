"""Splits, training, calibration, scoring and attribution on Spark MLlib."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions.columns import dice, ratio
from promolens.operators.evaluation import evaluation_report, model_quality
from promolens.operators.groups import in_share, with_balanced_fold
from promolens.operators.layout import Layout, Limits
from promolens.operators.policy import best_threshold
from promolens.operators.pooling import calibrated, isotonic_blocks
from promolens.operators.ranking import ALL, default_tie
from promolens.operators.scan import FROM, UPTO, Running, ordered_scan
from promolens.sources import scratch_dir

# A tree splits the sentinel off by itself; the flag keeps "missing" visible next to it.
MISSING = -1.0
FOLDS = 5
UNCHECKED_TREES = 50  # beyond so many trees a checkpoint folder is needed

# Search ranges (low, high); whole numbers are drawn as integers.
SEARCH_SPACE: dict[str, tuple[float, float]] = {
    "maxIter": (200, 1200),
    "stepSize": (0.01, 0.2),
    "maxDepth": (3, 12),
    "minInstancesPerNode": (10, 200),
    "subsamplingRate": (0.6, 1.0),
    "featureSubsetStrategy": (0.6, 1.0),
}


# -- splits ----------------------------------------------------------------------------------


def with_split(
    df: DataFrame, id_col: str = "customer_id", time_col: str = "time_received"
) -> DataFrame:
    """Add `split`: test = rows at the customer's latest time, train = rows before it, NULL
    for rows without a time. The latest time is an aggregate joined back, so a customer with
    very many rows is never one window partition."""
    last = df.groupBy(id_col).agg(F.max(time_col).alias("_last"))
    t = F.col(time_col)
    label = F.when(t == F.col("_last"), "test").when(t < F.col("_last"), "train")
    return df.join(last, id_col, "left").withColumn("split", label).drop("_last")


def _customer_hash(id_col: str, seed: int, n: int) -> Column:
    return dice(id_col, seed=seed, sides=n).cast("int")


def split_last_event(
    df: DataFrame, id_col: str = "customer_id", time_col: str = "time_received"
) -> tuple[DataFrame, DataFrame]:
    """(train, test)."""
    tagged = with_split(df, id_col, time_col)
    parts = [tagged.where(F.col("split") == s).drop("split") for s in ("train", "test")]
    return parts[0], parts[1]


def with_calibration_flag(
    train: DataFrame,
    fraction: float = 0.2,
    id_col: str = "customer_id",
    seed: int = 42,
    limits: Limits | None = None,
) -> DataFrame:
    """Add `calibration`: whole customers, ceil(fraction * customers) of them by a seeded hash."""
    return train.withColumn("calibration", in_share(train, fraction, id_col, seed, limits))


def with_fold(
    df: DataFrame, n_folds: int = FOLDS, id_col: str = "customer_id", seed: int = 42
) -> DataFrame:
    """Add `fold`: all rows of a customer share one."""
    return df.withColumn("fold", _customer_hash(id_col, seed + 1, n_folds))


# -- features --------------------------------------------------------------------------------


def numeric_inputs(df: DataFrame, numerical: Sequence[str]) -> DataFrame:
    """Numbers as doubles without NULLs, and a `missing_*` flag per number."""
    values = {c: F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in numerical}
    flags = {f"missing_{c}": F.col(c).isNull().cast("double") for c in numerical}
    return df.withColumns({**flags, **values})


def feature_stages(numerical: Sequence[str], categorical: Sequence[str]) -> list:
    """One-hot categories (unseen or NULL ones are all zeros) next to the numbers."""
    stages: list = []
    vectors: list[str] = []
    if categorical:
        indexed = [f"{c}_index" for c in categorical]
        vectors = [f"{c}_onehot" for c in categorical]
        stages = [
            StringIndexer(
                inputCols=list(categorical),
                outputCols=indexed,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(inputCols=indexed, outputCols=vectors, dropLast=True),
        ]
    inputs = [*numerical, *[f"missing_{c}" for c in numerical], *vectors]
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


# -- training --------------------------------------------------------------------------------


class AveragePrecision(Evaluator):
    """Average precision of the positive class, the metric of the search."""

    def __init__(self, target: str = "target", limits: Limits | None = None):
        super().__init__()
        self.target, self.limits = target, limits

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(F.col(self.target).alias("y"), _raw_score().alias("score"))
        return model_quality(scored, self.limits).first()["pr_auc"]

    def isLargerBetter(self) -> bool:
        return True


def _raw_score() -> Column:
    return vector_to_array("probability")[1]


def draw_params(
    n: int, space: Mapping[str, tuple[float, float]] | None = None, seed: int = 42
) -> list[dict[str, object]]:
    """`n` random parameter sets from the search ranges."""
    dice = random.Random(seed)
    draws: list[dict[str, object]] = []
    for _ in range(n):
        drawn: dict[str, object] = {}
        for name, (low, high) in (space or SEARCH_SPACE).items():
            whole = isinstance(low, int) and isinstance(high, int)
            value = dice.randint(low, high) if whole else dice.uniform(low, high)
            drawn[name] = str(round(value, 4)) if name == "featureSubsetStrategy" else value
        draws.append(drawn)
    return draws


def successive_halving(
    draws: Sequence[dict[str, object]],
    scores: Callable[[list[dict[str, object]], float], list[float]],
    keep_one_in: int = 3,
) -> tuple[dict[str, object], float]:
    """The best of `draws` and its score at full cost, by a race.

    `scores(alive, share)` rates parameter sets at a share of their cost. All sets run at a small
    share, the best one in `keep_one_in` of them at so many times that share, and so on until few
    run at full cost: of 50 sets some seven times the cost of one instead of 50 times. Of equal
    scores the earlier set goes on.
    """
    if not draws or keep_one_in < 2:
        raise ValueError("a race needs parameter sets, and keeps one in two of them or fewer")
    rounds, left = 0, len(draws)
    while left >= keep_one_in:
        rounds, left = rounds + 1, left // keep_one_in
    alive = list(draws)
    for k in range(rounds, -1, -1):
        found = scores(alive, keep_one_in**-k)
        order = sorted(range(len(alive)), key=lambda i: (-found[i], i))
        if not k:
            return alive[order[0]], found[order[0]]
        alive = [alive[i] for i in sorted(order[: -(-len(alive) // keep_one_in)])]
    raise AssertionError


@dataclass(frozen=True)
class IsotonicModel:
    """A non-decreasing step function of `raw_score`, linear between its steps."""

    blocks: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        return calibrated(df, self.blocks, "raw_score")


def isotonic(calibration: DataFrame, target: str = "target") -> IsotonicModel:
    """Fit on (`raw_score`, target); clamps outside the range it saw."""
    return IsotonicModel(isotonic_blocks(calibration, "raw_score", target))


@dataclass(frozen=True)
class PropensityModel:
    numerical: list[str]
    categorical: list[str]
    pipeline: PipelineModel
    calibrator: IsotonicModel | None = None

    def raw_scores(self, df: DataFrame) -> DataFrame:
        """`df` with the uncalibrated `raw_score`; every row and column stays."""
        carried = numeric_inputs(df.withColumn("_row", F.struct(*df.columns)), self.numerical)
        kept = [F.col(f"_row.{c}").alias(c) for c in df.columns]
        return self.pipeline.transform(carried).select(*kept, _raw_score().alias("raw_score"))

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """`df` with the calibrated `score` in 0..1."""
        if self.calibrator is None:
            raise RuntimeError("the model is not calibrated yet")
        raw = self.calibrator.transform(self.raw_scores(df))
        score = F.least(F.greatest(F.col("calibrated"), F.lit(0.0)), F.lit(1.0))
        return raw.withColumn("score", score).drop("calibrated", "raw_score")

    def predict(self, df: DataFrame, threshold: float) -> DataFrame:
        chosen = F.col("score") >= F.lit(float(threshold))
        return self.predict_proba(df).withColumn("prediction", chosen.cast("int"))

    @property
    def inputs(self) -> list[str]:
        return [*self.numerical, *self.categorical]

    def feature_owners(self) -> list[str]:
        """The input column each place of the feature vector comes from."""
        owners = [*self.numerical, *self.numerical]
        if self.categorical:
            for name, labels in zip(self.categorical, self.pipeline.stages[0].labelsArray):
                owners += [name] * len(labels)
        return owners

    def gain_importance(self) -> dict[str, float]:
        """Split gains of the trees, summed per input column, largest first."""
        gains = dict.fromkeys(self.inputs, 0.0)
        values = self.pipeline.stages[-1].featureImportances.toArray()
        for owner, value in zip(self.feature_owners(), values):
            gains[owner] += float(value)
        return dict(sorted(gains.items(), key=lambda kv: (-kv[1], kv[0])))


@dataclass
class PropensityTrainer:
    """Time-aware split, search by customer folds, isotonic calibration.

    `df` should be a stored table: training passes over it many times.
    """

    df: DataFrame
    numerical: Sequence[str]
    categorical: Sequence[str]
    target: str = "target"
    id_col: str = "customer_id"
    time_col: str = "time_received"
    seed: int = 42
    n_trials: int = 50
    n_folds: int = FOLDS
    space: Mapping[str, tuple[float, float]] = field(default_factory=lambda: dict(SEARCH_SPACE))
    keep_one_in: int = 3
    parallelism: int = 4
    limits: Limits | None = None

    _model: PropensityModel | None = None
    _best: tuple[dict[str, object], float] | None = None
    _calibration: DataFrame | None = None

    def _trained(self, value):
        if value is None:
            raise RuntimeError("not trained yet: call train() first")
        return value

    @property
    def model(self) -> PropensityModel:
        return self._trained(self._model)

    @property
    def best_params(self) -> dict[str, object]:
        return self._trained(self._best)[0]

    @property
    def best_score(self) -> float:
        return self._trained(self._best)[1]

    @property
    def calibration_set(self) -> DataFrame:
        return self._trained(self._calibration)

    def split(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(train, calibration, test); train and calibration share no customer."""
        train, test = split_last_event(self.df, self.id_col, self.time_col)
        flagged = with_calibration_flag(
            train, id_col=self.id_col, seed=self.seed, limits=self.limits
        )
        held = F.col("calibration")
        return flagged.where(~held).drop("calibration"), flagged.where(held).drop(
            "calibration"
        ), test

    def learner(self, **params) -> GBTClassifier:
        """Trees build on each other; without checkpoints the plan of many grows with each."""
        context = self.df.sparkSession.sparkContext
        if params.get("maxIter", 0) > UNCHECKED_TREES and not context.getCheckpointDir():
            raise RuntimeError(f"more than {UNCHECKED_TREES} trees need spark.checkpoint.dir")
        return GBTClassifier(
            featuresCol="features",
            labelCol=self.target,
            seed=self.seed,
            checkpointInterval=10,
            **params,
        )

    def pipeline(self, **params) -> Pipeline:
        stages = feature_stages(self.numerical, self.categorical)
        return Pipeline(stages=[*stages, self.learner(**params)])

    def tune(self, train: DataFrame) -> tuple[dict[str, object], float]:
        """Best of `n_trials` random parameter sets by mean average precision over the folds of
        customers, found by `successive_halving` of the trees; the winner is not fitted again here.

        Encoders are fitted and features stored once per fold.
        """
        metric = AveragePrecision(self.target, self.limits)
        folded = numeric_inputs(
            with_balanced_fold(train, self.n_folds, self.id_col, self.seed + 1, self.limits),
            self.numerical,
        )
        folds = []
        for fold in range(self.n_folds):
            rest, held = (folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold))
            encoders = Pipeline(stages=feature_stages(self.numerical, self.categorical)).fit(rest)
            folds.append([self._stored_features(encoders.transform(part)) for part in (rest, held)])

        def score(params: dict[str, object]) -> float:
            found = [
                metric.evaluate(self.learner(**params).fit(rest).transform(held))
                for rest, held in folds
            ]
            return sum(found) / len(found)

        def scores(alive: list[dict[str, object]], share: float) -> list[float]:
            fewer = [{**p, "maxIter": max(1, round(share * p["maxIter"]))} for p in alive]
            with ThreadPool(self.parallelism) as pool:
                return pool.map(inheritable_thread_target(train.sparkSession)(score), fewer)

        draws = draw_params(self.n_trials, self.space, self.seed)
        return successive_halving(draws, scores, self.keep_one_in)

    def _stored_features(self, encoded: DataFrame) -> DataFrame:
        path = scratch_dir(encoded.sparkSession)
        encoded.select("features", self.target).write.parquet(path)
        return encoded.sparkSession.read.parquet(path)

    def train(self, **params) -> tuple[DataFrame, DataFrame]:
        """Fit and calibrate; returns (train, test). Given `params` take the search's place."""
        train, calibration, test = self.split()
        if params:
            self._best = (dict(params), float("nan"))
        else:
            self._best = self.tune(train)
        inputs = numeric_inputs(train, self.numerical)
        encoders = Pipeline(stages=feature_stages(self.numerical, self.categorical)).fit(inputs)
        # Growing trees reads its rows several times; they are split off and encoded once.
        rows = self._stored_features(encoders.transform(inputs))
        fitted = PipelineModel([*encoders.stages, self.learner(**self._best[0]).fit(rows)])
        model = PropensityModel(list(self.numerical), list(self.categorical), fitted)
        calibrator = isotonic(model.raw_scores(calibration), self.target)
        self._model = PropensityModel(model.numerical, model.categorical, fitted, calibrator)
        self._calibration = calibration
        return train, test

    def scored(self, df: DataFrame) -> DataFrame:
        """`df` with `y` and the calibrated `score`, as the evaluation operators take it."""
        return self.model.predict_proba(df).withColumn("y", F.col(self.target).cast("int"))

    def evaluate_ranking(self, df: DataFrame, k: int = 5000, tie: str | None = None) -> DataFrame:
        """The `evaluation_report` of `df`, whose rows are scored once, when this is called.

        The report names its rows in each of its subqueries. Stored, they are a scan there; else each
        holds the whole scoring, itself full of subqueries, and the driver plans hundreds of them.
        """
        scored = self.scored(df)
        tie_value = F.col(tie) if tie else default_tie(scored)
        path = scratch_dir(df.sparkSession)
        narrow = scored.select("y", "score", tie_value.alias("_tie"))
        narrow.write.parquet(path)
        stored = df.sparkSession.read.schema(narrow.schema).parquet(path)
        return evaluation_report(stored, k, "_tie", self.limits)

    def find_threshold(self, df: DataFrame, value: float, cost: float) -> DataFrame:
        return best_threshold(self.scored(df), value, cost)


def baseline_scores(
    train: DataFrame, test: DataFrame, keys: Sequence[str | Column], seed: int = 42
) -> DataFrame:
    """Test rows with scores drawn 0/1 at the training base rate: the floor for any model.

    The draw is a hash of the row's key, so that a recomputed task draws the same.
    """
    base_rate = train.agg(ratio(F.sum("target"), F.count(F.lit(1)))).scalar()
    draw = dice(*keys, seed=seed) / F.lit(1e6)
    return test.withColumn("score", F.when(draw < base_rate, 1.0).otherwise(0.0))


# -- attribution -----------------------------------------------------------------------------


def permutation_importance(
    model: PropensityModel,
    df: DataFrame,
    keys: Sequence[str],
    target: str = "target",
    top_n: int | None = None,
    seed: int = 42,
    limits: Limits | None = None,
) -> DataFrame:
    """(feature, gain, base_pr_auc, permuted_pr_auc, importance) of all features, or the
    `top_n` of largest gain.

    A column is permuted by giving each row the value of another one: rows are ranked by two
    hashes of their key, and equal ranks exchange values. `df` should be a stored table.
    """
    gains = list(model.gain_importance().items())[:top_n]
    names = [name for name, _ in gains]

    def ranked(shift: int) -> DataFrame:
        hashed = df.withColumns({ALL: F.lit(0), "_h": F.xxhash64(*keys, F.lit(seed + shift))})
        return ordered_scan(
            hashed,
            [Running("_rank", "sum", F.lit(1).cast("bigint"), UPTO)],
            Layout.of(hashed, [ALL], "_h", limits),
        ).drop(ALL, "_h")

    donors = ranked(1).select("_rank", F.struct(*names).alias("_donor"))
    features = [*model.numerical, *model.categorical]
    own = ranked(0).select("_rank", target, *features)
    changed = F.explode(F.array(*[F.lit(c) for c in ("", *names)])).alias("feature")
    # A scan of ranks may end in one task, which would score all rows; each is scored many times.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = own.repartition(tasks, "_rank")
    mixed = own.join(donors, "_rank", "left").select("*", changed)
    swap = {
        c: F.when((F.col("feature") == c) & F.col("_donor").isNotNull(), F.col(f"_donor.{c}"))
        .otherwise(F.col(c))
        for c in names
    }
    scored = model.raw_scores(mixed.withColumns(swap).select(target, *features, "feature"))
    counts = scored.groupBy("feature", F.col("raw_score").alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(target).cast("bigint")).alias("pos")
    )
    running = [Running(f"cum_{c}", "sum", F.col(c), FROM) for c in ("n", "pos")]
    if limits is not None and limits.at_most is not None:
        limits = Limits(limits.chunks, limits.min_rows, limits.at_most * (len(names) + 1))
    layout = Layout.of(counts, ["feature"], "score", limits, weight="n")
    precision = F.col("cum_pos") / F.col("cum_n")
    quality = (
        ordered_scan(counts, running, layout)
        .groupBy("feature")
        .agg(ratio(F.sum(F.col("pos") * precision), F.sum("pos")).alias("permuted_pr_auc"))
    )
    base = quality.where(F.col("feature") == "").select("permuted_pr_auc").scalar()
    gain = F.create_map(*[x for name, g in gains for x in (F.lit(name), F.lit(g))])
    return quality.where(F.col("feature") != "").select(
        "feature",
        gain[F.col("feature")].alias("gain"),
        base.alias("base_pr_auc"),
        "permuted_pr_auc",
        (base - F.col("permuted_pr_auc")).alias("importance"),
    )
