"""What each input adds to a row's score, with its direction, from the trees of a boosted model.

On its way down a tree a row's expected value changes at every split, from the node's mean to its
child's. The change belongs to the input that is split on. Summed over all trees, weighted like
them, the changes and the roots' means give the row's raw margin exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from promolens.operators.modeling import PropensityModel, numeric_inputs
from promolens.sources import scratch_dir


@dataclass(frozen=True)
class Tree:
    """Columns of a node table; a leaf has no left child (-1)."""

    weight: float
    feature: np.ndarray
    threshold: np.ndarray
    #: Of a split on categories those that go left.
    categories: dict[int, np.ndarray]
    left: np.ndarray
    right: np.ndarray
    mean: np.ndarray


def trees_of(model: PropensityModel, df: DataFrame) -> list[Tree]:
    """The node tables of the fitted trees, read from the saved model; as large as the model."""
    spark, trees = df.sparkSession, model.pipeline.stages[-1]
    path = scratch_dir(spark)
    trees.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toPandas()
    out = []
    for number, table in nodes.sort_values(["treeID", "id"]).groupby("treeID"):
        splits = [s["leftCategoriesOrThreshold"] for s in table["split"]]
        ordered = [s["numCategories"] == -1 for s in table["split"]]
        inner = table["leftChild"].to_numpy() >= 0
        out.append(
            Tree(
                weight=float(trees.treeWeights[number]),
                feature=np.array([s["featureIndex"] for s in table["split"]]),
                threshold=np.array([s[0] if o and len(s) else 0.0 for s, o in zip(splits, ordered)]),
                categories={
                    i: np.array(splits[i], float) for i in np.flatnonzero(inner) if not ordered[i]
                },
                left=table["leftChild"].to_numpy(),
                right=table["rightChild"].to_numpy(),
                mean=table["prediction"].to_numpy(),
            )
        )
    return out


def contributions(trees: Sequence[Tree], owner: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray]:
    """The base and [row, input]: what each input adds to each row of the feature matrix `x`."""
    out = np.zeros((len(x), int(owner.max()) + 1))
    for tree in trees:
        open_ = [(0, np.arange(len(x)))]
        while open_:
            node, rows = open_.pop()
            if tree.left[node] < 0 or not len(rows):
                continue
            values = x[rows, tree.feature[node]]
            if node in tree.categories:
                goes_left = np.isin(values, tree.categories[node])
            else:
                goes_left = values <= tree.threshold[node]
            column = owner[tree.feature[node]]
            for child, part in ((tree.left[node], rows[goes_left]), (tree.right[node], rows[~goes_left])):
                out[part, column] += tree.weight * (tree.mean[child] - tree.mean[node])
                open_.append((child, part))
    return sum(t.weight * t.mean[0] for t in trees), out


def attributions(
    model: PropensityModel, df: DataFrame, carried: Sequence[str] | None = None
) -> DataFrame:
    """`df` with `base`, the margin before any input is known, and `contributions`, one number per
    input in the order of `model.inputs`; base and contributions add up to the raw margin.

    Every row stays, with all columns or those `carried`; a row is never multiplied. Missing numbers
    count as the model sees them.
    """
    carried = df.columns if carried is None else list(carried)
    trees = trees_of(model, df)
    names = model.inputs
    owner = np.array([names.index(c) for c in model.feature_owners()])
    given = [*carried, "base", "contributions"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(n, len(owner))
            base, found = contributions(trees, owner, x)
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * len(names))
            lists = pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.full(n, base)), lists],
                names=given,
            )

    kept = numeric_inputs(df.withColumn("_row", F.struct(*carried)), model.numerical)
    vectors = model.pipeline.transform(kept)
    rows = vectors.select(
        *[F.col(f"_row.{c}").alias(c) for c in carried], vector_to_array("features").alias("_x")
    )
    schema = StructType([df.schema[c] for c in carried])
    schema = schema.add("base", DoubleType()).add("contributions", ArrayType(DoubleType()))
    return rows.mapInArrow(run, schema)


def attribution_summary(model: PropensityModel, df: DataFrame) -> DataFrame:
    """One row per input: mean_abs (its weight in the model), mean, share_up (of rows it pushes
    up), and direction: 1 if larger values push up, -1 if they push down, NULL for categories, and
    for an input that is constant or never used."""
    rows = attributions(model, df, model.numerical)
    parts = []
    for k, name in enumerate(model.inputs):
        c = F.get("contributions", F.lit(k))
        if name in model.numerical:
            slope = F.covar_pop(F.col(name).cast("double"), c)
            direction = F.when(slope != 0, F.signum(slope)).cast("int")
        else:
            direction = F.lit(None).cast("int")
        parts.append(
            F.struct(
                F.lit(name).alias("feature"),
                F.avg(F.abs(c)).alias("mean_abs"),
                F.avg(c).alias("mean"),
                F.avg((c > 0).cast("double")).alias("share_up"),
                F.when(F.max(F.abs(c)) > 0, direction).alias("direction"),
            )
        )
    return rows.agg(F.array(*parts).alias("_all")).select(F.inline("_all"))


def reasons(
    model: PropensityModel, df: DataFrame, keys: Sequence[str], top_n: int = 5
) -> DataFrame:
    """Per row its `top_n` strongest inputs: `keys`, rank, feature, contribution, direction (1
    towards conversion, -1 away from it). Inputs that add nothing are left out."""
    named = F.zip_with(
        F.array(*map(F.lit, model.inputs)),
        F.col("contributions"),
        lambda n, c: F.struct((-F.abs(c)).alias("order"), n.alias("feature"), c.alias("contribution")),
    )
    strongest = F.slice(F.sort_array(F.filter(named, lambda r: r["contribution"] != 0)), 1, top_n)
    return (
        attributions(model, df, keys)
        .select(*keys, F.posexplode(strongest).alias("_at", "_reason"))
        .select(
            *keys,
            (F.col("_at") + 1).alias("rank"),
            "_reason.feature",
            "_reason.contribution",
            F.signum("_reason.contribution").cast("int").alias("direction"),
        )
    )
