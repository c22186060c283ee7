"""Language identification by bit-sliced Bloom filters of n-grams.

The filter is one array of language bitmasks. An n-gram sets a language's bit at its few hashed
places, so the AND of the masks at these places is the set of all languages that contain the
n-gram, found with one look. A text's n-grams are counted per language bit. A filter answers some
n-grams it never saw; its rate is known from how full a language's bit is, and the count is
corrected by it. The language with the largest corrected share is the prediction, and that share
is the score.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import Columns, hash_edge, map_columns, stored
from promolens.llm.ngrams import hashes

ORDERS = (3, 4)
PLACES = 3  # places of an n-gram
BITS = 20  # the filter has 2 ** BITS places; PLACES * BITS hash bits are used
WORD = 64  # languages per mask
PER_LANGUAGE = 1000  # documents of a language that the filter is fitted on, at most
LANGUAGES = 256  # languages learned, the most frequent ones, at most
SHARE = 0.25  # of the n-gram's highest rate in any language, to count as contained
LEAST = 2  # times an n-gram must occur in a language


@dataclass
class LanguageFilter:
    languages: list[str]
    masks: np.ndarray  # [ceil(languages / WORD), 2 ** BITS]
    false_rate: np.ndarray  # of each language

    def shares(self, text: str) -> np.ndarray:
        """Corrected share of the text's n-grams that each language contains."""
        hits, total = np.zeros(len(self.languages)), 0
        for codes in hashes(text, ORDERS):
            total += len(codes)
            for plane, masks in enumerate(self.masks):
                found = masks[codes & np.uint64((1 << BITS) - 1)]
                for k in range(1, PLACES):
                    places = (codes >> np.uint64(BITS * k)) & np.uint64((1 << BITS) - 1)
                    found = found & masks[places]
                first = plane * WORD
                for bit in range(min(WORD, len(self.languages) - first)):
                    hits[first + bit] += np.count_nonzero(found & masks.dtype.type(1 << bit))
        seen = hits / total if total else hits
        return np.clip((seen - self.false_rate) / (1 - self.false_rate), 0, 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not any(map(str.isalpha, text)):
            return "und", 0.0
        shares = self.shares(text)
        best = int(np.argmax(shares))  # languages are ordered by frequency: ties to the first
        return self.languages[best], float(shares[best])


def fit(
    labelled: DataFrame, per_language: int = PER_LANGUAGE, languages: int = LANGUAGES
) -> LanguageFilter:
    """Fit on `labelled` (doc_id, text, lang): at most `per_language` documents of each of the
    `languages` most frequent languages, those whose hashed doc_id is least. Rows of one doc_id and
    language are one document, with the least of their texts; NULL texts and languages are left out.

    The n-grams are counted by Spark. The driver gets the languages and the filter's places, both
    of fixed size.
    """
    known = labelled.where("text is not null and lang is not null")
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    names = [r.lang for r in counts]
    number = {name: i for i, name in enumerate(names)}
    # Only the rows that can be among the least are ranked, so a frequent language is no hot key.
    edges = [(r.lang, hash_edge(per_language, r["count"])) for r in counts]
    place = F.xxhash64("doc_id")
    pairs = [F.lit(x) for edge in edges for x in edge]
    near = place <= F.create_map(*pairs)[F.col("lang")] if edges else F.lit(False)
    draw = Window.partitionBy("lang").orderBy(place, "doc_id")
    drawn = (
        known.where(near)
        .select("doc_id", "lang")
        .distinct()
        .withColumn("n", F.row_number().over(draw))
        .where(F.col("n") <= per_language)
        .select("doc_id", "lang")
    )
    # At most per_language rows of each language: small by the parameters.
    same = [F.col(f"k.{c}").eqNullSafe(F.col(f"d.{c}")) for c in ("doc_id", "lang")]
    sample = (
        known.alias("k")
        .join(F.broadcast(drawn.alias("d")), same)
        .groupBy("k.doc_id", "k.lang")
        .agg(F.min("k.text").alias("text"))
        .select("text", "lang")
    )

    def count(batches: Iterable[Columns]) -> Iterator[Columns]:
        for batch in batches:
            for lang in set(batch["lang"]):
                texts = [t for t, g in zip(batch["text"], batch["lang"]) if g == lang]
                codes = [c for t in texts for c in hashes(t, ORDERS)]
                codes.append(np.zeros(0, np.uint64))
                found, n = np.unique(np.concatenate(codes), return_counts=True)
                yield {
                    "language": [number[lang]] * len(found),
                    "code": found.view(np.int64),
                    "n": n,
                }

    grams = (
        map_columns(sample, count, "language int, code long, n long")
        .groupBy("code", "language")
        .agg(F.sum("n").alias("n"))
    )
    grams = stored(grams)
    totals = grams.groupBy("language").agg(F.sum("n").alias("total"))
    rate = F.col("n") / F.col("total")
    contained = (
        grams.join(F.broadcast(totals), "language")  # one row per language
        .withColumn("most", F.max(rate).over(Window.partitionBy("code")))
        .where((F.col("n") >= LEAST) & (rate >= SHARE * F.col("most")))
    )
    place = F.explode(
        F.array(
            *(
                F.shiftrightunsigned("code", BITS * k).bitwiseAND(F.lit((1 << BITS) - 1))
                for k in range(PLACES)
            )
        )
    )
    planes = -(-len(names) // WORD)
    masks = np.zeros((planes, 1 << BITS), np.uint64)
    bits = (
        contained.select(
            F.expr(f"language div {WORD}").alias("plane"), "language", place.alias("place")
        )
        .groupBy("plane", "place")
        .agg(F.expr(f"bit_or(shiftleft(1L, language % {WORD}))").alias("mask"))
        .toArrow()
    )
    plane, at = bits["plane"].to_numpy(), bits["place"].to_numpy()
    masks[plane, at] = bits["mask"].to_numpy().view(np.uint64)
    full = [
        np.count_nonzero(masks[i // WORD] & np.uint64(1 << i % WORD)) / (1 << BITS)
        for i in range(len(names))
    ]
    if len(names) <= 8:
        masks = masks.astype(np.uint8)
    return LanguageFilter(names, masks, np.array(full) ** PLACES)


def predict(docs: DataFrame, model: LanguageFilter, *keep: str) -> DataFrame:
    """lang_pred and score of each whole text, next to doc_id and the columns `keep`.

    `und` with score 0 where the text is NULL or has no letter, or nothing was learned. A text
    whose n-grams are all unknown gets the most frequent language with score 0. Repeated rows are
    predicted each. Columns of `docs` are carried only where `keep` names them; it cannot name the
    results.
    """
    if clash := {"lang_pred", "score"} & set(keep):
        raise ValueError(f"names of results: {sorted(clash)}")
    keep = ("doc_id", *(k for k in keep if k != "doc_id"))
    kinds = dict(docs.dtypes)

    def rows(batches: Iterable[Columns]) -> Iterator[Columns]:
        for batch in batches:
            found = [model.predict(t) for t in batch["text"]]
            yield {k: batch[k] for k in keep} | {
                "lang_pred": [f[0] for f in found],
                "score": [f[1] for f in found],
            }

    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", lang_pred string, score double"
    return map_columns(docs.select(*dict.fromkeys(("text", *keep))), rows, schema)
