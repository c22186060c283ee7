"""The registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm import (
    bpe,
    conversations,
    fingerprints,
    langid,
    neardup,
    oracle,
    packing,
    resampling,
    secrets,
    sharding,
    token_files,
    toxicity,
    urls,
    vectors,
)
from promolens.llm.common import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), BYTE_BPE)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), WORD_BPE)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def held_out() -> Column:
    """Documents no model of these queries learns from."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~held_out()))
    found = langid.predict(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_k(table(spark, sf_dir, "embeddings"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(table(spark, sf_dir, "documents"))


#: The rules of the query.
RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), RULES)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = token_files.round_trip(table(spark, sf_dir, "documents"), WORD_BPE)
    return read.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    model = toxicity.fit(docs, labels.where(~held_out()))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return toxicity.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted")
    )


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.trie(table(spark, sf_dir, "conversations"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    found = resampling.resample(docs, benchmark)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.find(docs, secrets.fit(docs))

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def listed(spans: Column) -> Column:
        parts = lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])
        return F.array_join(F.transform(spans, parts), ",")

    base = secrets.KINDS[:-1]
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base]
    digest = F.sha2(listed(of(*base)), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, listed(F.col("spans")).alias("spans"))


REGISTERED = (
    op1_bpe,
    op2_packing,
    op3_sharding,
    op4_language_id,
    op5_top_k,
    op6_fingerprints,
    op7_urls,
    op8_token_files,
    op9_near_duplicates,
    op10_toxicity,
    op11_conversations,
    op12_resampling,
    op13_secrets,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in REGISTERED}


OP5 = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), vectors AS (
  SELECT vec_id, min(v) AS v FROM good GROUP BY vec_id
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM pairs
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_top_k": OP5,
        "op11_conversations": oracle.OP11,
        "op12_resampling": oracle.OP12,
    }
