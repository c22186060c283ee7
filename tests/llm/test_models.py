"""Language filters and toxicity: held-out accuracy and odd cases."""

from __future__ import annotations

import numpy as np
import pytest
from llm_texts import TEXTS
from pyspark.sql import functions as F

from promolens.llm import langid, ngrams, queries, toxicity

SF = "/root/testdata/sf0.01"


def test_ngrams_lie_within_words():
    def count(text, n):
        return sum(map(len, ngrams.hashes(text, (n,))))

    # _ab_ and _c_
    assert count("AB, c", 3) == 3 and count("ab", 4) == 1 and count("", 3) == 0 and count("42", 3) == 0
    first, second = (np.concatenate(list(ngrams.hashes(t, (3, 4)))) for t in ("Été!", " été\n"))
    assert (first == second).all()


def test_long_texts_are_hashed_in_spans(monkeypatch):
    text = TEXTS[3][1][:5000]
    whole = sorted(np.concatenate(list(ngrams.hashes(text, (3, 4)))).tolist())
    monkeypatch.setattr(ngrams, "SPAN", 37)
    assert sorted(np.concatenate(list(ngrams.hashes(text, (3, 4)))).tolist()) == whole


def test_op4_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = queries.op4_language_id(spark, SF).join(docs, "doc_id")
    shares = dict(
        found.groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).collect()
    )
    assert found.count() == docs.count() and shares[True] > 0.98
    assert found.where("score < 0 or score > 1").count() == 0


def test_languages_of_odd_rows(spark, odd, nothing):
    labelled = spark.createDataFrame(
        [(k, t, g) for k in range(5) for t, g in (("the cat and the dog", "en"), ("der hund und die katze", "de"))]
        + [(8, "the dog", "en"), (9, None, "en"), (10, "text", None)],
        "doc_id long, text string, lang string",
    )
    model = langid.fit(labelled, per_language=3)
    assert model.languages == ["en", "de"]
    assert model.predict("und die hunde")[0] == "de" and model.predict("the dogs")[0] == "en"
    assert model.predict("日本") == ("en", 0.0)
    rows = {(r.doc_id, r.lang_pred) for r in langid.predict(odd, model, "n").collect() if r.doc_id in (1, 2, 6, 14)}
    assert rows == {(i, "und") for i in (1, 2, 6, 14)}
    assert langid.predict(odd, model).count() == len(TEXTS)
    assert langid.predict(nothing, model).count() == 0
    unlearned = langid.fit(nothing)
    assert {r.lang_pred for r in langid.predict(odd, unlearned).collect()} == {"und"}


def test_more_languages_than_bits_of_a_mask(spark):
    words = ["".join(chr(97 + (k * p + j) % 26) for j in range(6)) for k in range(70) for p in (7,)]
    rows = [(k * 2 + i, f"{w} {w}", f"l{k:02}") for k, w in enumerate(words) for i in (0, 1)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 70 and model.masks.shape[0] == 2
    named = dict(zip((f"l{k:02}" for k in range(70)), words))
    assert named[model.predict(words[69])[0]] == words[69]


def test_op10_on_held_out_rows(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = queries.op10_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out")
    n = {(r.toxic, r.predicted): r["count"] for r in found.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.7
    assert n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.01


def test_toxicity_of_odd_rows(spark, odd, nothing):
    docs = spark.createDataFrame(
        [(k, "you vile brute" if k % 4 == 0 else "you kind friend") for k in range(80)] + [(99, None)],
        "doc_id long, text string",
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    labels = labels.union(labels).union(spark.createDataFrame([(None, 1), (3, None)], labels.schema))
    model = toxicity.fit(docs, labels)
    table = model.table()
    assert model.score("a vile thing", table) > 0.7 > 0.3 > model.score("a kind friend", table)
    assert model.score(None, table) == model.score("", table)
    scored = toxicity.score(odd, model, "label")
    assert scored.count() == len(TEXTS) and scored.where("score between 0 and 1").count() == len(TEXTS)
    assert toxicity.score(nothing, model).count() == 0
    for few in (labels.where("toxic = 0"), labels.where("toxic = 1"), labels.where("false")):
        prior = toxicity.fit(docs, few)
        score = prior.score("a vile thing", prior.table())
        assert 0 <= score <= 1 and (score < 0.01 or score > 0.99)
    assert toxicity.fit(nothing, labels).kept.size == 0


@pytest.mark.parametrize("text", ["a", "é", "x y"])
def test_short_texts_get_a_learned_language(spark, text):
    model = langid.LanguageFilter(["en"], np.zeros((1, 1 << langid.BITS), np.uint8), np.zeros(1))
    assert model.predict(text) == ("en", 0.0)


def test_samples_keep_to_their_bounds(spark, monkeypatch):
    """One doc_id in 5,000 rows of different texts, and 3,000 others."""
    docs = spark.range(8000).selectExpr(
        "if(id < 5000, 7, id) as doc_id", "concat('word ', id, ' more') as text", "'aa' as lang"
    )
    labels = spark.range(8000).selectExpr("id as doc_id", "int(id % 2) as toxic")
    seen = []
    for module in (langid, toxicity):
        of = module.map_columns
        monkeypatch.setattr(
            module, "map_columns", lambda df, *a, of=of: seen.append(df.count()) or of(df, *a)
        )
    langid.fit(docs, per_language=10)
    assert seen[0] <= 10
    seen.clear()
    toxicity.fit(docs, labels, toxic_rows=5, clean_rows=5)
    assert 0 < max(seen) <= 10
    few = langid.fit(docs.withColumn("lang", F.concat("lang", F.col("doc_id") % 5)), 4, languages=3)
    assert len(few.languages) == 3


def test_names_of_results_cannot_be_kept(spark, odd):
    model = langid.LanguageFilter([], np.zeros((0, 1), np.uint8), np.zeros(0))
    with pytest.raises(ValueError, match="score"):
        langid.predict(odd, model, "score")
    with pytest.raises(ValueError, match="score"):
        toxicity.score(odd, toxicity.ToxicityModel(0.0), "score")
    kept = langid.predict(odd, model, "doc_id", "lang")
    assert kept.columns == ["doc_id", "lang", "lang_pred", "score"] and kept.count() == odd.count()
