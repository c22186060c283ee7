"""Token ids of whole texts by a public tokenizer that drops white space."""

from __future__ import annotations

import os
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from promolens.llm.common import byte_alphabet, kept

STOPS = string.punctuation
LAST_LATIN = "ɏ"  # up to here letters are composed ones
LONGEST = 64  # longer words are not remembered
AT_ONCE = 4096  # texts of a call: the more, the fewer of their words are distinct
SAMPLES = ("The", "nations", "Straße", "Été", "naïve", "don", "I")


class Remembered(dict):
    """A memory of two generations: what is met while an entry of the old one is young again.

    `find` gives the value of a key in neither. Once the young generation is full it becomes the
    old one, so an entry goes that was not met during the last `most` new ones.
    """

    def __init__(self, find, most: int, old: dict | None = None):
        super().__init__()
        self.find, self.most, self.old = find, most, old or {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.find(key)
        if len(key) <= LONGEST:
            self[key] = value
        return value

    def aged(self) -> Remembered:
        """The memory to go on with."""
        if len(self) < self.most:
            return self
        self.old = {}
        return Remembered(self.find, self.most, self)


class WordIds:
    """Ids as little-endian unsigned 32-bit bytes.

    The tokenizer must take no token across a space, as those do that drop white space. A text is
    then the sequence of its space-separated words. Arrow splits the texts of a call and puts their
    ids together; each distinct word of a call is looked up once, without the stops at its end. The
    memory of words is bounded; dropping it costs time, never a token. Where `SAMPLES` show that
    this gives the tokenizer's own ids, stops after a Latin letter or digit are taken by themselves
    and plain Latin words go to the tokenizer's model directly.
    """

    def __init__(self, path: str, remembered: int = 1 << 19):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._model = self._tokenizer.model
        self._alphabet = byte_alphabet()
        self._ends = Remembered(self._by_tokenizer, 1 << 10)
        self._known = Remembered(self._bare, remembered // 2)
        self._whole = Remembered(self._by_tokenizer, remembered // 4)
        of = self._by_tokenizer
        self._direct = all(self._by_model(w.lower()) == of(w) for w in SAMPLES) and all(
            of(w + stops) == of(w) + of(stops)
            for w in (*SAMPLES, "e-7")
            for stops in (*STOPS, STOPS)
        )

    def _by_tokenizer(self, word: str) -> bytes:
        return array("I", self._tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _by_model(self, word: str) -> bytes:
        symbols = word
        if not word.isascii():
            symbols = "".join(map(self._alphabet.__getitem__, word.encode()))
        return array("I", [t.id for t in self._model.tokenize(symbols)]).tobytes()

    def _bare(self, word: str) -> bytes | None:
        """Ids of a word without stops at its end, met for the first time; a capital makes no new
        word. None if the ids may be others before stops."""
        if not self._direct:
            return None
        low = word.lower()
        if low.isalpha() and len(low) <= LONGEST and (low.isascii() or max(word) <= LAST_LATIN):
            return self._by_model(low) if low == word else self._known[low]
        last = word[-1:]
        if last.isascii() and (last.isalnum() or not last) and "<|" not in word:
            return self._by_tokenizer(word)
        return None

    def _lowered(self, text: str) -> str:
        """The text, lower-cased where that changes no id: Latin-1 letters are composed and have
        one lower case each, and a special token's string can only come from another case."""
        if self._direct and "<|" not in text:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text
            return text.lower()
        return text

    def _ids(self, words: pa.Array) -> np.ndarray:
        """Ids of distinct words."""
        without = pc.ascii_rtrim(words, STOPS)
        bare = without.dictionary_encode()
        known = list(map(self._known.__getitem__, bare.dictionary.to_numpy(zero_copy_only=False)))
        ids = np.array(known, object)[bare.indices.to_numpy()]
        whole = np.flatnonzero(np.equal(ids, None))
        ids[whole] = [self._whole[word] for word in words.take(pa.array(whole)).to_pylist()]
        stops = np.array(pc.subtract(pc.binary_length(words), pc.binary_length(without)))
        stops[whole] = 0
        for n in np.unique(stops[stops > 0]).tolist():
            at = np.flatnonzero(stops == n)
            ends = pc.utf8_slice_codeunits(words.take(pa.array(at)), -n).dictionary_encode()
            of_ends = [self._ends[end] for end in ends.dictionary.to_pylist()]
            ids[at] += np.array(of_ends, object)[ends.indices.to_numpy()]
        return ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        self._known, self._whole = self._known.aged(), self._whole.aged()
        self._ends = self._ends.aged()
        lowered = [self._lowered(text or "").replace("\n", " ") for text in texts]
        split = pc.split_pattern(pa.array(lowered, pa.large_string()), " ")
        words = split.values.dictionary_encode()
        ids = pa.array(self._ids(words.dictionary), pa.large_binary()).take(words.indices)
        by_text = pa.ListArray.from_arrays(split.offsets, ids)
        return pc.binary_join(by_text, pa.scalar(b"", pa.large_binary())).to_pylist()


def word_ids(path: str) -> WordIds:
    """One per Python worker and tokenizer."""
    return kept((WordIds, path), lambda: WordIds(path))
