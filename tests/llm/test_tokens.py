"""Encoding, packing and token files against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import string
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_texts import TEXTS
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from promolens.llm import bpe, packing, queries, token_files
from promolens.llm.common import map_columns
from promolens.llm.wordpieces import WordIds

BYTE, WORD = Tokenizer.from_file(queries.BYTE_BPE), Tokenizer.from_file(queries.WORD_BPE)
PARTS = [
    "a", "b", " ", "  ", "\n", "é", "ß", "日本", "😀", "'s", "'ll", "1", "23", "the", "ing", "!", "...", "\t",
    "\x1c", "\x85", "\xa0", "<|endoftext|>", "́", "Ñ", "aaa", "　", "tion", " The", "Σ", "İ", "\r",
]


def random_texts(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choices(PARTS, k=draw.randint(0, 14))) for _ in range(n)]


def byte_ids(text):
    return BYTE.encode(text or "", add_special_tokens=False).ids


def word_ids(text):
    return [*WORD.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_prefix_encoding_is_the_librarys():
    own = bpe.ByteBpe(queries.BYTE_BPE, remembered=64)
    for text in random_texts(3000, 1):
        ids = list(own.encode(text))
        assert ids == byte_ids(text)
        assert own.decode(ids) == BYTE.decode(ids, skip_special_tokens=False)


def test_decoding_of_any_ids_is_the_librarys():
    own, draw = bpe.byte_bpe(queries.BYTE_BPE), random.Random(2)
    for _ in range(500):
        ids = [draw.randrange(BYTE.get_vocab_size()) for _ in range(8)]
        assert own.decode(ids) == BYTE.decode(ids, skip_special_tokens=False)


def test_word_lookup_is_the_librarys():
    texts = random_texts(3000, 3)
    own = WordIds(queries.WORD_BPE, remembered=64)
    assert own._direct
    for start in range(0, len(texts), 500):
        part = texts[start : start + 500]
        for text, ids in zip(part, own.encode(part)):
            assert np.frombuffer(ids, "<u4").tolist() == word_ids(text)[:-1]


def test_words_are_looked_up_once_and_without_stops(monkeypatch):
    asked = []
    of_word = WordIds._by_tokenizer
    own = WordIds(queries.WORD_BPE)
    monkeypatch.setattr(WordIds, "_by_tokenizer", lambda self, w: asked.append(w) or of_word(self, w))
    own._ends, own._whole = (type(own._ends)(own._by_tokenizer, 64) for _ in range(2))

    class Counted(type(own._known)):
        def __getitem__(self, key):
            looked_up.append(key)
            return super().__getitem__(key)

    looked_up = []
    own._known = Counted(own._bare, 1 << 10)
    texts = ["Zebra$$$ zebra e-7. zebra, e-7$$$ " * 50, None, "zebra--- слово. <|endoftext|>. it's! 'tis' ·."]
    found = own.encode(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [word_ids(t)[:-1] for t in texts]
    assert looked_up.count("zebra") == 1 and len(looked_up) < 20
    assert sorted(asked) == sorted(
        ["", "$$$", ".", ",", "---", "!", "'", "e-7", "it's", "'tis", "слово.", "<|endoftext|>.", "·."]
    )


def test_stops_of_any_kind_and_length():
    draw = random.Random(6)
    tails = [*string.punctuation, "...", "$$$", "'.", "<|", "|>", "-" * 100, ""]
    heads = [*PARTS, "Ab", "x9", "don't", "a.b", "слово", "²", "é"]
    texts = [" ".join(draw.choice(heads) + draw.choice(tails) for _ in range(9)) for _ in range(1500)]
    own = WordIds(queries.WORD_BPE, remembered=64)
    for start in range(0, len(texts), 300):
        part = texts[start : start + 300]
        for text, ids in zip(part, own.encode(part)):
            assert np.frombuffer(ids, "<u4").tolist() == word_ids(text)[:-1]
    assert own.encode([]) == [] and own.encode([None, ""]) == [b"", b""]


def test_encode_and_decode_odd_rows(odd):
    tokens = bpe.encoded(odd, queries.BYTE_BPE)
    found = sorted((r.doc_id or -1, np.frombuffer(r.ids, "<u4").tolist()) for r in tokens.collect())
    assert found == sorted((i or -1, byte_ids(t)) for i, t in TEXTS)
    back = bpe.decoded(tokens, queries.BYTE_BPE)
    key = lambda r: (r[0] or -1, r[1])
    assert sorted(map(tuple, back.collect()), key=key) == sorted(((i, t or "") for i, t in TEXTS), key=key)


def test_op1(spark, sf_dir, texts):
    found = queries.op1_bpe(spark, sf_dir).collect()
    assert {r.doc_id for r in found} == set(texts)
    for r in found:
        ids = byte_ids(texts[r.doc_id])
        listed = ",".join(map(str, ids)).encode()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(listed).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def check_pieces(found, want, size=2048):
    """found: rows of a packing; want: list of ids of each document row."""
    left = defaultdict(list)
    for ids in want:
        left[len(ids)].append(ids)
    for r in found:
        assert r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= size
    assert sorted(r.sequence_id for r in found) == list(range(len(found)))
    by_length = sorted(found, key=lambda r: r.sequence_id)
    assert [r.length for r in by_length] == sorted((r.length for r in found), reverse=True)
    assert sum(r.length for r in found) == sum(map(len, want))


def test_op2(spark, sf_dir, texts):
    found = queries.op2_packing(spark, sf_dir).collect()
    want = {i: word_ids(t) for i, t in texts.items()}
    check_pieces(found, list(want.values()))
    pieces = defaultdict(list)
    for r in found:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == crc(ids[r.start : r.start + r.length])
        pieces[r.doc_id].append((r.start, r.start + r.length))
    for i, ids in want.items():
        ends = sorted(pieces[i])
        assert [a for a, _ in ends] == [0, *(b for _, b in ends[:-1])] and ends[-1][1] == len(ids)


def test_binary_lengths():
    assert packing.binary_lengths(11, 4) == [4, 4, 2, 1]
    assert packing.binary_lengths(1, 2048) == [1]
    assert packing.binary_lengths(4096, 2048) == [2048, 2048]
    for n in range(1, 300):
        assert sum(packing.binary_lengths(n, 16)) == n


def test_pack_odd_rows(odd, nothing):
    check_pieces(packing.pack(odd, queries.WORD_BPE, 64).collect(), [word_ids(t) for _, t in TEXTS], 64)
    assert packing.pack(nothing, queries.WORD_BPE).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd, queries.WORD_BPE, 100)


def test_codes_give_any_token():
    draw = np.random.default_rng(4)
    for top in (200, 70_000, 2**32):
        for n in (1, 511, 512, 513, 5000):
            ids = draw.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
            codes = token_files.Codes(*token_files.encode_codes(ids))
            for _ in range(20):
                a, b = sorted(draw.integers(0, n + 1, 2))
                assert (codes.tokens(a, b) == ids[a:b]).all()
            at = int(draw.integers(0, n))
            assert codes.token(at) == ids[at]


def check_stream(found, want):
    """found: rows in the order of the files; want: (doc_id, ids) in the same order."""
    before = 0
    for r, (doc_id, ids) in zip(found, want, strict=True):
        assert (r.doc_id, r.start, r.n_tokens) == (doc_id, before, len(ids))
        before += len(ids)


def test_op8(spark, sf_dir, texts):
    found = sorted(queries.op8_token_files(spark, sf_dir).collect(), key=lambda r: r.start)
    want = [(i, word_ids(texts[i])) for i in sorted(texts)]
    check_stream(found, want)
    assert [r.ids_crc32 for r in found] == [crc(ids) for _, ids in want]


def test_files_of_odd_rows(odd, nothing, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT", 100)
    found = sorted(token_files.round_trip(odd, queries.WORD_BPE).collect(), key=lambda r: r.start)
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want = [(i, word_ids(t)) for i, t in order]
    check_stream(found, want)
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in found] == [ids for _, ids in want]
    assert token_files.round_trip(nothing, queries.WORD_BPE).count() == 0


def test_a_segment_is_read_in_one_range(odd, tmp_path, monkeypatch):
    path = str(tmp_path / "files")
    token_files.write_files(odd.coalesce(1), path, queries.WORD_BPE)
    segments = token_files.read_segments(odd.sparkSession, path)
    maps = []
    monkeypatch.setattr(
        token_files, "map_columns", lambda df, rows, *a: maps.append(rows) or map_columns(df, rows, *a)
    )
    documents = token_files.read_documents(segments)
    ranges, of_range = [], token_files.Codes.tokens
    monkeypatch.setattr(
        token_files.Codes, "tokens", lambda self, a, b: ranges.append((a, b)) or of_range(self, a, b)
    )
    batch = {c: list(v) for c, v in zip(segments.columns, zip(*segments.collect()))}
    read = [row for out in maps[0]([batch]) for row in zip(out["doc_id"], out["ids"])]
    assert sorted(ranges) == sorted((0, n) for n in batch["tokens"])
    assert sorted(map(repr, read)) == sorted(repr((r.doc_id, bytes(r.ids))) for r in documents.collect())


def test_op1_of_nothing(odd, nothing):
    assert bpe.round_trip_digests(nothing, queries.BYTE_BPE).count() == 0
    empty = odd.where(F.col("doc_id").isin(1, 2)).select("doc_id", "text", "n")
    of_nothing = hashlib.sha256(b"").hexdigest()
    for r in bpe.round_trip_digests(empty, queries.BYTE_BPE).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (0, of_nothing, of_nothing)
