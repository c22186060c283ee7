"""Secrets against plain pattern matching, plain Viterbi and held-out documents."""

from __future__ import annotations

import hashlib
import os
import random
import re

import numpy as np
import pytest

from promolens.llm import queries, secrets
from promolens.llm.secrets import BEGIN, INSIDE, OUT

KEY = "0123456789abcdef" * 2 + "01234567"


def plain_spans(text):
    """The patterns as the query states them; short matches are dropped afterwards."""
    found = []
    for kind, pattern, group, least in secrets.PATTERNS:
        flags = re.IGNORECASE | re.ASCII if kind == "assign" else 0
        for m in re.finditer(pattern, text, flags):
            if len(m[group]) >= least:
                found.append((m.start(), secrets.KINDS.index(kind), kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


PIECES = [
    "password", "Passwd", "SECRET", "token", "api_key", "apikey", '"', "'", " ", ":", "=", "AKIA", "A1B2C3D4E5F6G7H8",
    "hunter2", "x.y=z/", "deadbeef", "0123456789", "é", "ſecret", "toKen", "\n", "abcdefabcdef", "-", "_",
]


def test_patterns_on_random_texts():
    draw = random.Random(3)
    for _ in range(4000):
        text = "".join(draw.choices(PIECES, k=draw.randint(0, 25)))
        assert [s[:3] for s in secrets.base_spans(text)] == plain_spans(text)


@pytest.fixture(scope="module")
def many_docs(spark, sf_dir):
    """The smallest tables hold too few secrets to learn from."""
    return spark.read.parquet(f"{os.path.dirname(sf_dir)}/sf0.1/documents.parquet")


@pytest.fixture(scope="module")
def model(many_docs):
    return secrets.fit(many_docs.where(~queries.held_out()))


def plain_tags(model, text):
    """Viterbi over all tokens, with weights summed feature by feature."""
    tokens = secrets.TOKEN.findall(text)
    if not tokens:
        return []
    shares = secrets.file_features(len(tokens), *secrets._counted(tokens))
    of_file = model.of_file[shares[0]] + model.of_file[secrets.FILE[0] + shares[1]]
    scores = []
    for i in range(len(tokens)):
        total = np.array(of_file)
        for k, place in enumerate(secrets.PLACES):
            if 0 <= i + place < len(tokens):
                token = tokens[i + place]
                word = model.words.get(token.lower(), 0) if len(token) < 32 else 0
                shape = secrets.shape(token)
                at = [secrets.WORDS + 1 + int(secrets.OFFSETS[j]) + v for j, v in enumerate(shape)]
                total = total + model.own[k, [word, *at]].sum(axis=0)
        scores.append(total)
    best, back = scores[0], []
    for row in scores[1:]:
        paths = best[:, None] + model.steps
        back.append(paths.argmax(axis=0))
        best = paths.max(axis=0) + row
    tags = [int(best.argmax())]
    for came in reversed(back):
        tags.append(int(came[tags[-1]]))
    return tags[::-1]


def test_decoding_is_plain_viterbi(model, texts, monkeypatch):
    monkeypatch.setattr(secrets, "SPAN", 300)
    monkeypatch.setattr(secrets, "REMEMBERED", 500)
    decoder, draw = secrets.Decoder(model), random.Random(4)
    words = ["token", "=", '"', KEY, "key", ":", "the", "a1b2c3d4e5f6a7b8", "2669109448945250", ".", "\n", "AKIA" + "Z9" * 9]
    random_texts = [" ".join(draw.choices(words, k=draw.randint(0, 60))) for _ in range(150)]
    for text in [*random_texts, *[t for t in texts.values() if len(t) < 8000][:60]]:
        expected = plain_tags(model, text)
        found = dict(decoder.tags(text))
        assert [found.get(i, OUT) for i in range(len(expected))] == expected


def test_held_out_secrets_are_found(model, many_docs):
    decoder = secrets.Decoder(model)
    hits = total = wrong = clean = 0
    for row in many_docs.where(queries.held_out()).collect():
        text = row.text or ""
        known = {b[3:] for b in secrets.base_spans(text)}
        own = decoder.spans(text)
        total += len(known)
        hits += sum(any(o[0] < k[1] and k[0] < o[1] for o in own) for k in known)
        clean += not known
        wrong += not known and bool(own)
    assert hits >= 0.9 * total
    assert wrong <= 0.02 * clean


def test_learned_weights_find_unknown_names(model):
    """A value without a known name: no pattern but the hex run fits, and none fits upper case."""
    upper = f'then passphrase = "{KEY.upper()}" follows'
    assert plain_spans(upper) == []
    assert [upper[a:b] for a, b in secrets.Decoder(model).spans(upper)] == [KEY.upper()]


def test_gradient_learns_tags_of_several_tokens():
    """A field fitted on values of two tokens tags the second one as inside."""
    line = ["so", "we", "set", "token", "=", "9f3a9f3a9f3a", ".", "77be77be77be", "and", "go"]
    pad = [None] * 3
    window = pad + line + ["on"] * 7 + [None]
    tags = [OUT] * 5 + [BEGIN, INSIDE, INSIDE] + [OUT] * 9
    plain = pad + ["so", "we", "go", "on", "and", "on", ".", "the", "way"] + ["on"] * 8 + [None]
    model = secrets.learned(
        {
            "found": [True, False],
            "tokens": [window, plain],
            "tags": [tags, [OUT] * 17],
            "of_file": [[0, 0], [0, 0]],
        }
    )
    text = "so we set token = 9f3a9f3a9f3a.77be77be77be and go on"
    assert [text[a:b] for a, b in secrets.Decoder(model).spans(text)] == ["9f3a9f3a9f3a.77be77be77be"]


def test_windows_keep_to_their_bounds(spark):
    """No doc_id in a third of the rows, and three texts in all: the fit stays bounded."""
    many = spark.range(6000).selectExpr(
        "if(id % 3 = 0, null, id) as doc_id", f"concat('token = \"{KEY}\" and 1234567 id ', id % 3) as text"
    )
    seen = {}

    def count(windows):
        seen.update(windows)

    original, secrets.learned = secrets.learned, count
    try:
        secrets.fit(many, documents=400, secrets=20, others=30)
    finally:
        secrets.learned = original
    assert sum(seen["found"]) == 20 and len(seen["found"]) <= 50


def test_odd_rows(spark, odd, nothing):
    model = secrets.fit(odd)
    found = secrets.find(odd, model).collect()
    assert len(found) == odd.count()
    expected = sorted((r.doc_id or -1, plain_spans(r.text or "")) for r in odd.collect())
    base = [(r.doc_id or -1, [tuple(s) for s in r.spans if s.kind != secrets.LEARNED]) for r in found]
    assert sorted(base) == expected
    assert secrets.fit(nothing) is None
    assert secrets.find(nothing, None).collect() == []


def test_op13(spark, sf_dir, texts):
    found = queries.op13_secrets(spark, sf_dir).collect()
    assert {r.doc_id for r in found} == set(texts)
    for r in found:
        base = plain_spans(texts[r.doc_id])
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(
            sum(b[0] == k for b in base) for k in ("assign", "access", "hex")
        )
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith(secrets.LEARNED)] == listed
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts)
