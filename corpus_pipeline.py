"""The document pipeline: its stages call the numbered operators one after the other.

Each stage gets what its predecessor kept, written as Parquet and read again. All but the last
return the columns of `documents`; the last one returns packed sequences.

Repeated rows and a NULL doc_id pass through every stage as they come; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from promolens.llm import langid, neardup, packing, toxicity
from promolens.llm.common import stored, table
from promolens.llm.queries import WORD_BPE, held_out

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: A text is rejected as being in no known language if the best language contains less than this
#: share of its n-grams; mixed and noisy texts lie far above.
LEAST_LANGUAGE = 0.2


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters (NULL and empty texts too) and those in none of the languages
    learned. Where no row has a language, none is learned and nothing stays."""
    found = langid.predict(docs, langid.fit(docs.where(~held_out())), *COLUMNS[1:])
    return found.where(f"lang_pred <> 'und' and score >= {LEAST_LANGUAGE}").select(COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents predicted toxic. A text without features has the score of the class sizes;
    without labels of both classes every text has."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    scored = toxicity.score(docs, model, *COLUMNS[1:])
    return scored.where(f"score < {toxicity.THRESHOLD}").select(COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, the one of least doc_id. Rows of one
    doc_id are one document; texts without words are nobody's duplicate and stay."""
    return neardup.kept_documents(docs).select(COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, none across documents, none padded. A NULL or empty text is its end
    id alone."""
    return packing.pack(docs, WORD_BPE)


STAGES = [
    ("language_id", language_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

#: Classifiers and tokenizers have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
