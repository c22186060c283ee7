"""Near duplicates, fingerprints and shards against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import string
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_texts import TEXTS
from pyspark.sql import functions as F

import corpus_pipeline
from promolens.llm import components, fingerprints, neardup, queries, sharding, shingles

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def groups(sets):
    """Least id reachable over links of at least three quarters, all pairs looked at."""
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, x), (b, y) in itertools.combinations(sets.items(), 2):
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: find(i) for i in sets}


def check_components(rows, texts):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    want = groups(sets)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {
        i: (len(sets[i]), want[i]) for i in texts
    }
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_op9(spark, sf_dir, texts):
    check_components(queries.op9_near_duplicates(spark, sf_dir).collect(), texts)


def varied(n, seed, words=60):
    """Chains of texts that differ by a few words, so that many pairs lie near the limit."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcdefgh", k=4)) for _ in range(500)]
    made = [draw.choices(vocabulary, k=words) for _ in range(4)]
    for _ in range(n - len(made)):
        new = list(draw.choice(made))
        for _ in range(draw.choice((0, 1, 1, 2, 3))):
            new[draw.randrange(len(new))] = draw.choice(vocabulary)
        made.append(new)
    return {i: " ".join(w) for i, w in enumerate(made)}


def test_links_near_the_limit(spark, monkeypatch):
    monkeypatch.setattr(neardup, "TILE", 200)
    for seed, words in ((5, 60), (6, 8)):
        texts = varied(250, seed, words)
        docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        check_components(neardup.near_duplicates(docs).collect(), texts)


def test_tiles_hold_few_small_sets(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SETS", 50, raising=False)

    def counted(tile):
        return tile.assign(a=len(tile), b=0)[["a", "b"]][:1]

    monkeypatch.setattr(neardup, "_crossing", counted)
    ids = spark.range(1000)
    mixed = ids.select(F.lit(1).alias("bucket"), "id", F.lit(1).alias("n"), F.col("id").alias("component"))
    sets = ids.select("id", F.lit(b"12345678").alias("shingles"))
    held = [r.a for r in neardup._missing_links(mixed, sets).collect()]
    assert len(held) > 100 and max(held) < 2 * 50 * 1.6


def test_near_duplicates_of_odd_rows(odd, nothing):
    found = neardup.near_duplicates(odd).collect()
    assert len(found) == len(TEXTS)
    of = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert of[4][1] == 3 and of[8][1] == 7 and of[13][1] == 12 and of[12][0] == 1
    assert of[1] == (0, 1) and of[2] == (0, 2) and of[14] == (0, 14)
    assert all(r.component_id is None and r.kept for r in found if r.doc_id is None)
    assert neardup.near_duplicates(nothing).count() == 0
    kept = neardup.kept_documents(odd)
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(
        (r.doc_id or -1) for r in found if r.kept
    )
    assert kept.columns == odd.columns


def test_rows_of_one_document_have_one_component(spark):
    a, b, c, d = ("a b c d e f g", "h i j k l m n", "o p q r s t u", "v w x y z")
    rows = [(5, a), (7, a), (3, b), (5, b)]  # 5 has the texts of 7 and of 3
    rows += [(25, c), (27, c), (27, d), (23, d)]
    rows += [(39, None), (39, "short text"), (38, "short text"), (41, ""), (41, None), (43, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = neardup.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.component_id) for r in found} == {
        (3, 3), (5, 3), (7, 3), (23, 23), (25, 23), (27, 23), (38, 38), (39, 38), (41, 41), (43, 43),
    }
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    kept = sorted(r.doc_id for r in neardup.kept_documents(docs).collect())
    assert kept == [3, 23, 38, 41, 41, 43]


def test_shingles_in_spans(monkeypatch):
    whole = shingles.shingle_set(TEXTS[3][1])
    assert len(whole) == len(shingle_set(TEXTS[3][1]))
    monkeypatch.setattr(shingles, "SPAN", 11)
    assert (shingles.shingle_set(TEXTS[3][1]) == whole).all()


def test_estimate_is_near_the_likeness():
    draw = np.random.default_rng(7)
    for shared, own in ((600, 100), (30, 5), (4000, 2000)):
        pool = np.unique(draw.integers(0, 2**63, shared + 2 * own, dtype=np.uint64) * np.uint64(2))
        a, b = np.sort(pool[: shared + own]), np.sort(np.concatenate([pool[:shared], pool[shared + own :]]))
        pool = draw.permutation(pool)
        a, b = np.sort(pool[: shared + own]), np.sort(np.concatenate([pool[:shared], pool[shared + own :]]))
        found, error = shingles.estimate(shingles.registers(a), shingles.registers(b))
        assert abs(found - shared / len(pool)) < 5 * error


def test_components_of_a_path_and_a_star(spark):
    draw = random.Random(8)
    ids = draw.sample(range(10_000), 300)
    path = list(zip(ids[:150], ids[1:150]))
    star = [(ids[150], i) for i in ids[151:]]
    links = spark.createDataFrame(path + star + [(5_000_000, 5_000_000)], "a long, b long")
    found = {r.id: r.component for r in components.components(links).collect()}
    assert found == {i: min(ids[:150]) for i in ids[:150]} | {i: min(ids[150:]) for i in ids[150:]}
    assert components.components(links.where("false")).count() == 0


def paragraphs(text):
    return {p.strip(" ") for p in re.findall(r"[^\n]{200,}?[.!?](?=\s|$)|[^\n]+", text)} - {""}


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check_versions(rows, texts):
    order = sorted(texts)
    rows = {r.doc_id: r for r in rows}
    prints = {}
    for k, i in enumerate(order):
        text, after = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited, r = text[: len(text) - half] + after[:half], rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - likeness(paragraphs(text), paragraphs(edited))) < 1e-12
        assert abs(r.near_next - likeness(paragraphs(text), paragraphs(after))) < 1e-12
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint


def test_op6(spark, sf_dir, texts):
    check_versions(queries.op6_fingerprints(spark, sf_dir).collect(), texts)


def test_fingerprints_of_odd_rows(odd, nothing):
    found = fingerprints.compared(odd).collect()
    assert len(found) == len(TEXTS) and fingerprints.compared(nothing).count() == 0
    unique = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    texts = {i: t or "" for i, t in TEXTS if i is not None}
    check_versions(fingerprints.compared(unique).collect(), texts)
    one = odd.where("doc_id = 15")
    assert [r.near_next for r in fingerprints.compared(one).collect()] == [1.0]


@pytest.mark.parametrize("n", [1, 400, 20_000])
def test_differences_of_any_size_are_peeled(spark, n):
    """Two versions of n paragraphs share the middle; one sketch alone holds but a few."""
    moved = max(1, n * 3 // 8)
    df = spark.createDataFrame([(0, n, moved, moved + n)], "a long, b long, c long, d long")
    digest = [
        F.transform(F.sequence(F.col(x), F.col(y) - 1), lambda v: F.xxhash64(v.cast("string")))
        for x, y in (("a", "b"), ("c", "d"))
    ]
    signed = F.concat(*[fingerprints._signed(d, sign) for d, sign in zip(digest, (1, -1))])
    small = F.get(fingerprints._attempt(signed, F.lit(1), F.lit(1)), F.lit(0))["ok"]
    row = df.select(fingerprints.likeness(*digest).alias("found"), small.alias("small")).first()
    assert row.small == (n == 1) and abs(row.found - (n - moved) / (n + moved)) < 1e-12


def check_shards(rows, texts, shards=16):
    """texts: list of (doc_id, text) rows."""
    size = lambda t: len((t or "").encode()) + 1
    crc = lambda t: zlib.crc32((t or "").encode())
    key = lambda r: (r[0] or -1, *r[1:])
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=key) == sorted(
        ((i, size(t), crc(t)) for i, t in texts), key=key
    )
    of_shard, of_text = defaultdict(list), defaultdict(set)
    for r in rows:
        of_shard[r.shard].append(r.slot)
        of_text[r.size, r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in of_shard.values())
    assert set(of_shard) <= set(range(shards))
    return of_text


def test_op3(spark, sf_dir, texts):
    rows = queries.op3_sharding(spark, sf_dir).collect()
    of_text = check_shards(rows, list(texts.items()))
    assert all(len(s) == 1 for s in of_text.values())
    total = defaultdict(int)
    for r in rows:
        total[r.shard] += r.size
    mean = sum(total.values()) / 16
    assert max(total.values()) <= max(mean * 1.001, max(r.size for r in rows)) + 2


def test_differencing_is_tight():
    draw = random.Random(9)
    starts = [[draw.randint(1, 10_000), 0, 0, 0] for _ in range(500)]
    sums, places = sharding.difference(starts)
    got = [0] * 4
    for start, place in zip(starts, places):
        assert sorted(place) == [0, 1, 2, 3]
        for k, to in enumerate(place):
            got[to] += start[k]
    assert got == sums and max(sums) - min(sums) <= 2


def test_shards_of_odd_rows(odd, nothing, monkeypatch):
    for cell, fan in ((20_000, 1000), (2, 2)):
        monkeypatch.setattr(sharding, "CELL", cell)
        monkeypatch.setattr(sharding, "FAN", fan)
        monkeypatch.setattr(sharding, "SLOTS", 3)
        check_shards(sharding.shard(odd, 4).collect(), TEXTS, 4)
    assert sharding.shard(nothing).count() == 0


def test_pipeline(spark, sf_dir, docs):
    stages, kept = dict(corpus_pipeline.STAGES), docs.select(corpus_pipeline.COLUMNS)
    n = [kept.count()]
    for name in ("language_id", "toxicity", "near_duplicates"):
        kept = corpus_pipeline.stored(stages[name](spark, kept, sf_dir))
        assert kept.columns == corpus_pipeline.COLUMNS
        n.append(kept.count())
    assert n == sorted(n, reverse=True) and n[1] == n[0] and n[3] > 0.6 * n[0]
    left = {r.doc_id: r.text or "" for r in kept.collect()}
    assert set(groups({i: shingle_set(t) for i, t in left.items()}).values()) == set(left)
    packed = stages["packing"](spark, kept, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(left)


def test_pipeline_of_odd_rows(spark, sf_dir, odd, nothing):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (odd.select(names), nothing.select(names)):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, sf_dir))
        docs.count()
