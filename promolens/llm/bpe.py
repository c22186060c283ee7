"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word exactly one token can be the last one of the prefix's encoding. An
automaton with suffix links yields the tokens that end at a place; the one wanted is that whose
predecessor, the stored last token of the shorter prefix, is compatible with it: the two, joined,
would be encoded as just these two. Following the stored tokens back from the end gives the ids.
No merge is ever carried out on the text.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import regex
from pyspark.sql import DataFrame

from promolens.llm.common import Columns, bounded, byte_alphabet, map_columns

# Fixed value: how byte-level vocabularies of this kind cut a text before encoding.
WORDS = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteBpe:
    """A byte-level vocabulary with merges and special tokens, read from a tokenizers file."""

    def __init__(self, path: str, remembered: int = 1 << 19):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids: dict[str, int] = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*ids.values(), *special.values()])
        self._rank, self._left, self._right = [-1] * size, [0] * size, [0] * size
        self._joined: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            whole, left, right = ids[a + b], ids[a], ids[b]
            self._joined[left, right] = rank
            self._rank[whole], self._left[whole], self._right[whole] = rank, left, right
        self._alphabet = byte_alphabet()
        self._pairs: dict[tuple[int, int], bool] = {}
        self._suffixes = ahocorasick.Automaton()
        for token, i in ids.items():
            if self._rank[i] < 0 and len(token) == 1 or self._reachable(i):
                self._suffixes.add_word(token, (len(token), i))
        self._suffixes.make_automaton()
        value = {c: b for b, c in enumerate(self._alphabet)}
        self._bytes = [b""] * size
        for token, i in ids.items():
            self._bytes[i] = bytes(map(value.__getitem__, token))
        for token, i in special.items():
            self._bytes[i] = token.encode()
        self._special = special
        strings = sorted(map(regex.escape, special), key=len, reverse=True)
        self._cut = regex.compile("(" + "|".join(strings) + ")") if strings else None
        self._find = regex.compile(WORDS).findall
        self._words: dict[str, bytes] = {}
        self._spaced: dict[str, bytes] = {}
        self._remembered = remembered

    def _reachable(self, token: int) -> bool:
        """Whether the token's own bytes are encoded as this token."""
        rank = self._rank[token]
        if rank < 0:
            return False
        left, right = self._left[token], self._right[token]
        return self._compatible(left, right, 2 * rank)

    def _compatible(self, a: int, b: int, limit: int | None = None) -> bool:
        """Whether the bytes of a and b, joined, are encoded as a, b.

        The later of the two last merges is undone again and again. A pair that meets at the
        border would have been joined if its merge came before the one undone last. Of equal
        merges the left one comes first.
        """
        rank, joined = self._rank, self._joined
        while True:
            merge = joined.get((a, b))
            if merge is not None and (limit is None or 2 * merge < limit):
                return False
            if rank[a] > rank[b]:
                limit, a = 2 * rank[a], self._right[a]
            elif rank[b] >= 0:
                limit, b = 2 * rank[b] + 1, self._left[b]
            else:
                return True

    def _encode_word(self, word: str) -> bytes:
        """Ids of one word: the last token of every prefix, then back from the end."""
        symbols = "".join(map(self._alphabet.__getitem__, word.encode()))
        last: list[int] = [-1] * (len(symbols) + 1)
        length = [0] * (len(symbols) + 1)
        pairs = self._pairs
        for end, (n, token) in self._suffixes.iter(symbols):
            end += 1
            if last[end] >= 0:
                continue
            if n < end:
                pair = (last[end - n], token)
                fits = pairs.get(pair)
                if fits is None:
                    fits = pairs[pair] = self._compatible(*pair)
                if not fits:
                    continue
            last[end], length[end] = token, n
        found, at = [], len(symbols)
        while at:
            found.append(last[at])
            at -= length[at]
        return array("I", found[::-1]).tobytes()

    def _encode_chunk(self, chunk: str) -> bytes:
        words, out = self._words, []
        for word in self._find(chunk):
            ids = words.get(word)
            if ids is None:
                ids = self._encode_word(word)
                if len(word) <= 64:
                    words[word] = ids
            out.append(ids)
        return b"".join(out)

    def _encode_plain(self, text: str) -> bytes:
        """A single space between two other characters always starts a word, so a text cut there
        is encoded chunk by chunk, and chunks seen before are looked up."""
        first, *rest = text.split(" ")
        if not rest:
            return self._encode_chunk(text)
        end, spaced = rest.pop(), self._spaced
        if first[-1:].isspace() or not end or end[0].isspace():
            return self._encode_chunk(text)
        for chunk in set(rest).difference(spaced):
            if not chunk or chunk[0].isspace() or chunk[-1].isspace():
                return self._encode_chunk(text)
            spaced[chunk] = self._encode_chunk(" " + chunk)
        body = b"".join(map(spaced.__getitem__, rest))
        return self._encode_chunk(first) + body + self._encode_chunk(" " + end)

    def encode(self, text: str) -> array:
        self._words = bounded(self._words, self._remembered // 4)
        self._spaced = bounded(self._spaced, self._remembered)
        self._pairs = bounded(self._pairs, self._remembered)
        ids = array("I")
        parts = self._cut.split(text) if self._cut else [text]
        for part in parts:
            if part in self._special:
                ids.append(self._special[part])
            elif part:
                ids.frombytes(self._encode_plain(part))
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self._bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBpe:
    """One per Python worker and vocabulary."""
    return ByteBpe(path)


def encoded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) and n_tokens of each text.

    A NULL text counts as empty and has no ids. Strings of special tokens in a text become those
    tokens. Repeated rows are encoded each. Other columns are ignored.
    """

    def rows(batches: Iterable[Columns]) -> Iterator[Columns]:
        bpe = byte_bpe(vocabulary)
        for batch in batches:
            ids = [bpe.encode(t or "") for t in batch["text"]]
            yield {
                "doc_id": batch["doc_id"],
                "n_tokens": [len(i) for i in ids],
                "ids": [i.tobytes() for i in ids],
            }

    return map_columns(
        docs.select("doc_id", "text"), rows, "doc_id long, n_tokens long, ids binary"
    )


def decoded(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """The text of each row of `encoded`: doc_id, text."""

    def rows(batches: Iterable[Columns]) -> Iterator[Columns]:
        bpe = byte_bpe(vocabulary)
        for batch in batches:
            texts = [bpe.decode(array("I", i or b"")) for i in batch["ids"]]
            yield {"doc_id": batch["doc_id"], "text": texts}

    return map_columns(tokens.select("doc_id", "ids"), rows, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, and the hashes of the ids and of the text decoded from them.

    Ids and texts stay in the task that made them; only the digests leave it. A NULL text counts as
    empty, repeated rows are encoded each, other columns are ignored, no rows give no rows.
    """

    def rows(batches: Iterable[Columns]) -> Iterator[Columns]:
        bpe = byte_bpe(vocabulary)
        decimal = list(map(str, range(len(bpe._bytes))))
        for batch in batches:
            out: Columns = {"doc_id": batch["doc_id"], "n_tokens": []}
            hashes: tuple[list, list] = ([], [])
            for text in batch["text"]:
                ids = bpe.encode(text or "").tolist()
                out["n_tokens"].append(len(ids))
                listed = ",".join(map(decimal.__getitem__, ids))
                hashes[0].append(hashlib.sha256(listed.encode()).hexdigest())
                hashes[1].append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield out | {"ids_sha256": hashes[0], "decoded_sha256": hashes[1]}

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_columns(docs.select("doc_id", "text"), rows, schema)
