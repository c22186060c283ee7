"""Small fixtures with every odd case, and the public tables at the smallest size."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_texts import TEXTS  # noqa: E402

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names the operators use themselves.
    "score double, ids string, part string, n string, size string, id string, component string, "
    "toxic string, shard string, bucket string, key string, label string"
)
def rows(texts=TEXTS):
    """The texts with the other columns of documents and with names that clash."""
    return [
        (i, t, "en" if k % 2 else None, "src", len(t or ""), 0.5, *["x"] * 11)
        for k, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}
