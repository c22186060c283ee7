"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A feature is the presence of a hashed n-gram in a text, scaled by the log of the ratio of its
smoothed shares among toxic and clean training documents. The n-grams that separate the classes
best are kept, and a regularised logistic regression weighs them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import Columns, drawn, map_columns, stored
from promolens.llm.ngrams import hashes

ORDERS = (4, 5, 6)
BITS = 20  # n-grams are hashed to 2 ** BITS buckets
TOXIC_ROWS, CLEAN_ROWS = 3000, 6000  # the classifier is fitted on so many rows of a class at most
FEATURES = 8192  # buckets kept
LEAST_GAIN = 15.0  # log-likelihood ratio (G) a bucket needs to be kept
THRESHOLD = 0.7
TASKS = 8  # the bounded sample is spread over so many tasks


def buckets(text: str) -> np.ndarray:
    """Distinct buckets of the text's n-grams, sorted."""
    found = [c >> np.uint64(64 - BITS) for c in hashes(text, ORDERS)]
    return np.unique(np.concatenate([*found, np.zeros(0, np.uint64)])).astype(np.int64)


@dataclass
class ToxicityModel:
    intercept: float
    kept: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # sorted buckets
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))  # coefficient times ratio

    def table(self) -> np.ndarray:
        """The feature number of each bucket, or -1."""
        at = np.full(1 << BITS, -1, np.int16)
        at[self.kept] = np.arange(len(self.kept))
        return at

    def score(self, text: str | None, table: np.ndarray) -> float:
        total = self.intercept
        present = np.zeros(len(self.kept), bool)
        for codes in hashes(text or "", ORDERS):
            found = table[codes >> np.uint64(64 - BITS)]
            present[found[found >= 0]] = True
        total += float(self.weights[present].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    toxic_rows: int = TOXIC_ROWS,
    clean_rows: int = CLEAN_ROWS,
) -> ToxicityModel:
    """Fit on the texts of `docs` (doc_id, text) that `labels` (doc_id, toxic 0 or 1) marks.

    At most `toxic_rows` and `clean_rows` documents are used, those whose hashed doc_id is least.
    A doc_id with several labels is toxic if one says so, and rows of one doc_id are one document,
    with the least of their texts; NULL labels and texts are left out.
    Where a class is missing, every text gets the share of toxic rows as its score.
    """
    marked = stored(
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    bounds = {1: toxic_rows, 0: clean_rows}
    parts = [drawn(marked.where(F.col("toxic") == t), ["doc_id"], n) for t, n in bounds.items()]
    marked = stored(parts[0].union(parts[1]))
    # At most toxic_rows + clean_rows rows: small by the parameters.
    texts = docs.where("text is not null").select("doc_id", "text")
    found = texts.join(F.broadcast(marked), "doc_id").groupBy("doc_id", "toxic")
    sample = stored(found.agg(F.min("text").alias("text")).select("text", "toxic"))
    sample = sample.repartition(TASKS)
    size = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    ones, zeros = size.get(1, 0), size.get(0, 0)
    if not ones or not zeros:
        share = np.clip(ones / max(ones + zeros, 1), 1e-6, 1 - 1e-6)
        return ToxicityModel(float(np.log(share / (1 - share))))

    def count(batches: Iterable[Columns]) -> Iterator[Columns]:
        found = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                found[toxic, buckets(text)] += 1
        some = np.flatnonzero(found.any(axis=0))
        yield {"bucket": some, "toxic": found[1, some], "clean": found[0, some]}

    toxic, clean = F.sum("toxic"), F.sum("clean")
    counts = (
        map_columns(sample, count, "bucket long, toxic long, clean long")
        .groupBy("bucket")
        .agg(toxic.alias("toxic"), clean.alias("clean"))
    )

    def part(n, of, total):
        """The class's term of G: observed against expected documents with the n-gram."""
        expected = (F.col("toxic") + F.col("clean")) * F.lit(of / total)
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    total = ones + zeros
    gain = 2 * (part(F.col("toxic"), ones, total) + part(F.col("clean"), zeros, total))
    best = (
        counts.withColumn("gain", gain)
        .where(F.col("gain") >= LEAST_GAIN)
        .orderBy(F.desc("gain"), "bucket")
        .limit(FEATURES)
        .toPandas()
        .sort_values("bucket")
    )
    kept = best["bucket"].to_numpy()
    if not len(kept):
        return ToxicityModel(float(np.log(ones / zeros)))
    p, q = best["toxic"].to_numpy() + 1.0, best["clean"].to_numpy() + 1.0
    ratios = np.log(p / (ones + 2) / (q / (zeros + 2)))

    def features(batches: Iterable[Columns]) -> Iterator[Columns]:
        for batch in batches:
            at = [np.searchsorted(kept, np.intersect1d(buckets(t), kept)) for t in batch["text"]]
            yield {"toxic": batch["toxic"], "at": [a.tolist() for a in at]}

    as_vector = F.udf(lambda at: SparseVector(len(kept), at, ratios[at].tolist()), VectorUDT())
    # Stored, so that a task never holds two Python workers at once.
    rows = stored(map_columns(sample, features, "toxic int, at array<int>")).select(
        F.col("toxic").cast("double").alias("label"), as_vector("at").alias("features")
    )
    fitted = LogisticRegression(regParam=1e-3, standardization=False, maxIter=60).fit(rows)
    return ToxicityModel(fitted.intercept, kept, fitted.coefficients.toArray() * ratios)


def score(docs: DataFrame, model: ToxicityModel, *keep: str) -> DataFrame:
    """score (0 to 1) of each whole text, next to doc_id and the columns `keep`.

    NULL and empty texts get the score of a text without features. Repeated rows are scored each.
    Columns of `docs` are carried only where `keep` names them; it cannot name the result.
    """
    if "score" in keep:
        raise ValueError("score is the name of the result")
    keep = ("doc_id", *(k for k in keep if k != "doc_id"))
    kinds = dict(docs.dtypes)

    def rows(batches: Iterable[Columns]) -> Iterator[Columns]:
        at = model.table()
        for batch in batches:
            yield {k: batch[k] for k in keep} | {"score": [model.score(t, at) for t in batch["text"]]}

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", score double"
    return map_columns(docs.select(*dict.fromkeys(("text", *keep))), rows, schema)
