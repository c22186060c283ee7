"""Importance resampling against a plain version and SQL."""

from __future__ import annotations

import hashlib
import math
import re
import string
import zlib
from collections import Counter

import pytest
from compare import connect, differences, spark_result, sql_result
from pyspark.sql import functions as F

from promolens.llm import oracle, queries, resampling
from promolens.llm.common import stored

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain(docs, target, percent=25, least=20, buckets=10000, seed=7):
    """doc_id, n_words, n_features, weight, score, rank of (doc_id, text) rows."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, x in docs for f in plain_features(x)[1])
    t = Counter(bucket(f) for x in target for f in plain_features(x)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in docs:
        words, found = plain_features(text)
        gains = [
            math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
            for b in map(bucket, found)
        ]
        weight = sum(gains) // len(gains) if gains else 0
        name = f"{seed}:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        out.append([doc_id, words, len(found), weight, score, None])
    able = [r for r in out if r[1] >= least]
    able.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: len(able) * percent // 100], 1):
        row[5] = rank
    return out


def key(row):
    return [(v is None, v or 0) for v in row]


def rows(df):
    return sorted(([*r] for r in df.collect()), key=key)


@pytest.mark.parametrize("percent, least", [(25, 20), (100, 0), (50, 1), (0, 0)])
def test_odd_rows(spark, odd, percent, least):
    target = spark.createDataFrame([("word1 some more",), (None,), ("",)], "text string")
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    found = resampling.resample(odd, target, percent, least)
    expected = plain(texts, ["word1 some more", None, ""], percent, least)
    assert rows(found) == sorted(expected, key=key)


def test_empty_tables(spark, nothing, odd):
    assert resampling.resample(nothing, odd).collect() == []
    none = nothing.select("text")
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    assert rows(resampling.resample(odd, none)) == sorted(plain(texts, []), key=key)


def test_words_at_the_edges_of_spans(monkeypatch):
    monkeypatch.setattr(resampling, "SPAN", 16)
    texts = ["a", "", " x  y ", "word " * 30, "z" * 100 + " " + "y" * 70 + " É日本 q", "Ab-cd_ef9 " * 9]
    for text in texts:
        n, found = resampling.features(text)
        words, expected = plain_features(text)
        assert n == words
        assert Counter(int(b) for f in found for b in f) == Counter(
            zlib.crc32(f.encode()) % 10000 for f in expected
        )


def test_tied_scores_are_cut_by_doc_id(spark):
    """All scores equal but few: the cutoff lies among thousands of ties, and in NULL ids."""
    table = stored(
        spark.range(5000).select(
            F.when(F.col("id") % 7 > 0, (F.col("id") * 7919) % 5003 - 900).alias("doc_id"),
            F.lit(30).cast("long").alias("n_words"),
            F.when(F.col("id") < 50, 9).otherwise(4).cast("long").alias("score"),
        )
    )
    ids = sorted(
        ((-r.score, r.doc_id is None, r.doc_id or 0) for r in table.collect())
    )
    for percent in (1, 30, 85, 95, 100):
        drawn = [r for r in resampling.drawn(table, percent, 20).collect() if r["rank"] is not None]
        drawn.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in drawn] == list(range(1, 5000 * percent // 100 + 1))
        assert [(-r.score, r.doc_id is None, r.doc_id or 0) for r in drawn] == ids[: len(drawn)]


def test_op12(spark, sf_dir):
    found = spark_result(queries.op12_resampling(spark, sf_dir))
    assert not differences(found, sql_result(connect(sf_dir), oracle.OP12))
