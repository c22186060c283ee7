"""Secrets in texts: fixed patterns, and a linear-chain conditional random field beside them.

The field tags each token as beginning, continuing or lying outside a secret. A token's scores are
sums of weights of its own shape and word, the words and shapes of its neighbours, and features of
the whole text; a transition weight joins the tags of neighbours. Texts are decoded by Viterbi.

No table says where secrets are, so the field learns from the patterns' own matches: windows of
tokens around them, and windows without any. Weights of single words and shapes are left out at
random while it learns, so that it also finds what the patterns miss: unknown names before a value,
values of other alphabets.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from promolens.llm.common import Columns, drawn, hashed_share, map_columns, stored

#: The patterns, the group that holds the secret, and its least length.
PATTERNS = [
    (
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
LEARNED = "learned"  # kind of the field's spans, after the others
KINDS = [*(name for name, *_ in PATTERNS), LEARNED]

_ASSIGN = re.compile(PATTERNS[0][1], re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(PATTERNS[1][1])
_HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs that are long enough
_NAMES = ("password", "passwd", "secret", "token", "api")

DOCUMENTS = 20000  # the field learns from windows of so many documents at most
SECRETS, OTHERS = 1000, 2000  # and of so many windows with and without a match
WINDOW = 17  # tokens of a window, the middle one in the middle
WORDS = 512  # words with weights of their own
LEFT_OUT = 0.3  # share of a window's word and shape weights left out while learning
STEPS = 60
DECAY = 1e-3

OUT, BEGIN, INSIDE = range(3)
TOKEN = re.compile(r"[\w+/-]+|[^\w\s]")
SPAN = 1 << 19  # characters whose tokens are listed at a time
REMEMBERED = 1 << 18  # tokens a decoder keeps the scores of

#: A token's features are its word and a value of each of these: length, kinds of characters, share
#: of digits, different characters, whether hex digits alone.
PARTS = (12, 32, 6, 6, 3)
OFFSETS = np.cumsum([0, *PARTS])
#: Where the features of a neighbour at this distance add to a token.
PLACES = (0, -1, -2, -3, 1)
FILE = (6, 6)  # shares of tokens with digits and of single signs in the text, in steps


def _order(span: tuple) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


def base_spans(text: str) -> list[tuple[str, int, int, int, int]]:
    """kind, start, end of each match of the patterns, and start and end of its secret."""
    found = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= PATTERNS[0][3]:
                found.append(("assign", *m.span(), *m.span(2)))
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if len(m[0]) >= PATTERNS[1][3]:
                found.append(("access", *m.span(), *m.span()))
    found.extend(("hex", *m.span(), *m.span()) for m in _HEX.finditer(text))
    return sorted(found, key=_order)


def _step(share: float) -> int:
    """0, then in steps of doubled shares."""
    return 0 if share <= 0 else 1 + sum(share > s for s in (0.05, 0.1, 0.2, 0.4))


def shape(token: str) -> tuple[int, ...]:
    """The value of each of `PARTS`."""
    n = len(token)
    size = n if n < 8 else min(8 + (n - 8) // 8, PARTS[0] - 1)
    if token.isalpha() and token.islower():
        return size, 1, 0, min(len(set(token[:64])) // 4, PARTS[3] - 1), int(n > 15)
    digits = sum(map(str.isdigit, token))
    kinds = (
        (token.lower() != token) * 2
        + (token.upper() != token) * 1
        + (digits > 0) * 4
        + any(c in "+/_-" for c in token) * 8
        + (not token.isascii()) * 16
    )
    whole = all(c in "0123456789abcdefABCDEF" for c in token)
    return (
        size,
        kinds,
        _step(digits / n),
        min(len(set(token[:64])) // 4, PARTS[3] - 1),
        2 * whole if n > 7 else int(n > 15),
    )


def file_features(n: int, digits: int, signs: int) -> tuple[int, int]:
    return (_step(digits / n), _step(signs / n)) if n else (0, 0)


def _counted(tokens: list[str]) -> tuple[int, int]:
    """Tokens with digits, and single signs."""
    digits = sum(not t.isalpha() and any(map(str.isdigit, t)) for t in tokens)
    return digits, sum(len(t) == 1 and not t.isalnum() for t in tokens)


def _token_lists(text: str) -> Iterator[list[str]]:
    """The text's tokens, some at a time; texts are cut at white space."""
    start, space = 0, re.compile(r"\s")
    while start < len(text):
        gap = space.search(text, start + SPAN)
        end = gap.start() if gap else len(text)
        yield TOKEN.findall(text, start, end)
        start = end


@dataclass
class SecretTagger:
    """Weights of the field; `words` gives a word's number, from 1."""

    words: dict[str, int]
    own: np.ndarray  # [place, word or shape value, tag]
    of_file: np.ndarray  # [feature value, tag]
    steps: np.ndarray  # [tag, next tag]

    def of_shape(self, found: tuple[int, ...]) -> np.ndarray:
        """What a token of this shape adds at each place: [place, tag]."""
        at = [WORDS + 1 + int(OFFSETS[i]) + v for i, v in enumerate(found)]
        return self.own[:, at].sum(axis=1)

    def of_word(self, number: int) -> np.ndarray:
        return self.own[:, number]


class Decoder:
    """A tagger with a bounded memory of what tokens add."""

    def __init__(self, tagger: SecretTagger):
        self._tagger = tagger
        steps = tagger.steps
        #: A token whose outside score leads by more than its transitions can make up lies outside
        #: on the best path, whatever its neighbours are.
        self._sure = 2 * float(steps.max() - steps.min())
        self._steps = steps.tolist()
        # As few as there are shapes and words with weights; a token's row is one sum of both.
        self._rows: dict[tuple, np.ndarray] = {}
        self._reset()

    def _reset(self) -> None:
        decoder = self

        class Known(dict):
            def __missing__(self, token):
                at = self[token] = decoder._add(token)
                return at

        self._known = Known()
        self._table = np.zeros((1 << 12, len(PLACES), 3), np.float32)
        self._flags = np.zeros((1 << 12, 2), bool)

    def _add(self, token: str) -> int:
        at = len(self._known)
        if at == len(self._table):
            self._table = np.concatenate([self._table, np.zeros_like(self._table)])
            self._flags = np.concatenate([self._flags, np.zeros_like(self._flags)])
        word = self._tagger.words.get(token.lower(), 0) if len(token) < 32 else 0
        key = (word, *shape(token))
        row = self._rows.get(key)
        if row is None:
            row = self._tagger.of_shape(key[1:]) + self._tagger.of_word(word)
            row = self._rows[key] = row.astype(np.float32)
        self._table[at] = row
        if not token.isalpha():
            self._flags[at] = _counted([token])
        return at

    @staticmethod
    def _added(rows: np.ndarray) -> np.ndarray:
        """Each token's own score and what its neighbours add; `rows` is [token, place, tag]."""
        out = rows[:, 0].copy()
        for k, place in enumerate(PLACES[1:], 1):
            if place < 0:
                out[-place:] += rows[:place, k]
            else:
                out[:-place] += rows[place:, k]
        return out

    def _scores(self, text: str) -> np.ndarray:
        """[token, tag] of the whole text."""
        parts, flags, before, now = [], np.zeros(2, np.int64), [], []
        for after in chain(_token_lists(text), [[]]):
            if now:
                if len(self._known) > REMEMBERED:
                    self._reset()
                tokens = before + now + after[:1]
                at = np.fromiter(map(self._known.__getitem__, tokens), np.int64, len(tokens))
                inner = slice(len(before), len(before) + len(now))
                parts.append(self._added(self._table[at])[inner])
                flags += self._flags[at[inner]].sum(axis=0)
                before = (before + now)[min(PLACES) :]
            now = after
        if not parts:
            return np.zeros((0, 3), np.float32)
        scores = np.concatenate(parts)
        of_file = file_features(len(scores), *flags.tolist())
        return scores + self._tagger.of_file[of_file[0]] + self._tagger.of_file[FILE[0] + of_file[1]]

    def _best(self, scores: list[list[float]], first: bool, last: bool) -> list[int]:
        """Viterbi over a run of tokens; outside tokens lie before and after, but at the text's ends."""
        steps, back = self._steps, []
        best = list(scores[0]) if first else [s + t for s, t in zip(scores[0], steps[OUT])]
        for row in scores[1:]:
            came = [max(range(3), key=lambda a, b=b: best[a] + steps[a][b]) for b in range(3)]
            best = [best[a] + steps[a][b] + row[b] for b, a in enumerate(came)]
            back.append(came)
        if not last:
            best = [s + steps[b][OUT] for b, s in enumerate(best)]
        tags = [max(range(3), key=best.__getitem__)]
        for came in reversed(back):
            tags.append(came[tags[-1]])
        return tags[::-1]

    def tags(self, text: str) -> list[tuple[int, int]]:
        """Number and tag of the tokens that do not lie outside."""
        scores = self._scores(text)
        lead = scores[:, OUT] - scores[:, 1:].max(axis=1)
        unsure = np.flatnonzero(lead <= self._sure)
        found = []
        for run in np.split(unsure, np.flatnonzero(np.diff(unsure) > 1) + 1):
            if len(run):
                ends = run[0] == 0, run[-1] == len(scores) - 1
                best = self._best(scores[run].tolist(), *ends)
                found.extend((int(i), t) for i, t in zip(run, best) if t != OUT)
        return found

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Start and end of each secret."""
        tags = dict(self.tags(text))
        out: list[tuple[int, int]] = []
        if tags:
            left, last = len(tags), None
            for i, m in enumerate(TOKEN.finditer(text)):
                if i in tags:
                    if tags[i] == INSIDE and last == i - 1:
                        out[-1] = (out[-1][0], m.end())
                    else:
                        out.append(m.span())
                    left, last = left - 1, i
                    if not left:
                        break
        return out


def _windows(doc_id: int | None, text: str) -> Iterator[tuple]:
    """With and without a match: found, tokens (None beyond the text), their tags, file features,
    and the window's name."""
    found = list(TOKEN.finditer(text))
    if not found:
        return
    tokens = [m[0] for m in found]
    tags, begins, at = [OUT] * len(found), [], 0
    for start, end in sorted({f[3:] for f in base_spans(text)}, key=lambda s: (s[0], -s[1])):
        first = True
        while at < len(found) and found[at].start() < end:
            if found[at].end() > start:
                if first:
                    begins.append(at)
                tags[at] = BEGIN if first else INSIDE
                first = False
            at += 1
    of_file = file_features(len(tokens), *_counted(tokens))
    left, right = -min(PLACES), max(PLACES)

    def window(middle: int):
        start = max(0, min(middle - WINDOW // 2, len(tokens) - WINDOW))
        places = range(start - left, start + WINDOW + right)
        near = [tokens[i] if 0 <= i < len(tokens) else None for i in places]
        return near, (tags[start : start + WINDOW] + [OUT] * WINDOW)[:WINDOW], of_file

    for i in begins:
        yield True, *window(i), f"{doc_id}:{i}"
    draw = int.from_bytes(hashlib.sha256(f"{doc_id}:{len(text)}".encode()).digest()[:8], "little")
    others = [i for i, t in enumerate(tokens) if tags[i] == OUT and not t.isalpha() and len(t) > 5]
    middles = [draw % len(tokens)] + ([others[draw % len(others)]] if others else [])
    for i in middles:
        near = window(i)
        if not any(near[1]):
            yield False, *near, f"{doc_id}:{i}"


def fit(docs: DataFrame, documents: int = DOCUMENTS, secrets: int = SECRETS, others: int = OTHERS):
    """A `SecretTagger` learned from the matches of the patterns in `docs` (doc_id, text), or None
    if they match nothing.

    Windows are cut from the whole texts of about `documents` documents, drawn by hashed doc_id.
    At most `secrets` windows with a match and `others` without are used; only these reach the
    driver, where the weights are fitted.
    """
    schema = "found boolean, tokens array<string>, tags array<int>, of_file array<int>, name string"

    def rows(batches: Iterable[Columns]) -> Iterator[Columns]:
        for batch in batches:
            out: Columns = {k: [] for k in ("found", "tokens", "tags", "of_file", "name")}
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                for window in _windows(doc_id, text):
                    for column, value in zip(out.values(), window):
                        column.append(value)
            yield out

    texts = docs.where("text is not null").select("doc_id", "text")
    cut = stored(map_columns(hashed_share(texts, ["doc_id"], documents), rows, schema))
    by = ["name", "tokens"]
    with_match = drawn(cut.where("found"), by, secrets).toArrow().to_pydict()
    without = drawn(cut.where("not found"), by, others).toArrow().to_pydict()
    return learned({k: with_match[k] + without[k] for k in with_match}) if with_match["tags"] else None


def learned(windows: Columns) -> SecretTagger:
    """Weights that make the windows' tags likely, by full gradient steps (Adam) with decay."""
    draw = np.random.default_rng(7)
    first = [t.lower() for w, found in zip(windows["tokens"], windows["found"]) if found for t in w if t]
    rest = [t.lower() for w in windows["tokens"] for t in w if t]
    ranked = Counter({t: 100 * n for t, n in Counter(first).items() if n > 1}) + Counter(rest)
    common = [t for t, n in ranked.most_common(WORDS) if n > 1 and len(t) < 32]
    words = {t: i for i, t in enumerate(common, 1)}
    nothing = WORDS + 1 + int(OFFSETS[-1])  # the row of what is left out; its weights stay 0

    def features(token: str | None) -> list[int]:
        if token is None:
            return [nothing] * (1 + len(PARTS))
        at = [words.get(token.lower(), 0) if len(token) < 32 else 0]
        return at + [WORDS + 1 + int(OFFSETS[i]) + v for i, v in enumerate(shape(token))]

    values = np.array([[features(t) for t in w] for w in windows["tokens"]])  # [window, token, feature]
    of_file = np.array(windows["of_file"]) + [0, FILE[0]]
    tags = np.array(windows["tags"])
    n, size = tags.shape
    at = np.arange(n)
    left = -min(PLACES)
    goal = np.eye(3)[tags]
    weights = {
        "own": np.zeros((len(PLACES), nothing + 1, 3)),
        "of_file": np.zeros((sum(FILE), 3)),
        "steps": np.zeros((3, 3)),
    }
    means = {k: np.zeros_like(w) for k, w in weights.items()}
    squares = {k: np.zeros_like(w) for k, w in weights.items()}

    def total(x: np.ndarray, axis: int) -> np.ndarray:
        most = x.max(axis=axis, keepdims=True)
        return np.log(np.exp(x - most).sum(axis=axis)) + most.squeeze(axis)

    for step in range(1, STEPS + 1):
        kept = np.where(draw.random(values.shape) < LEFT_OUT, nothing, values)
        near = [kept[:, left + p : left + p + size].reshape(n * size, -1) for p in PLACES]
        scores = sum(w[x].sum(axis=1) for w, x in zip(weights["own"], near)).reshape(n, size, 3)
        scores = scores + weights["of_file"][of_file].sum(axis=1)[:, None]
        steps = weights["steps"]
        ahead, behind = [scores[:, 0]], [np.zeros((n, 3))]
        for t in range(1, size):
            ahead.append(total(ahead[-1][:, :, None] + steps, 1) + scores[:, t])
            back = behind[0] + scores[:, size - t]
            behind.insert(0, total(steps + back[:, None, :], 2))
        ahead, behind = np.stack(ahead, 1), np.stack(behind, 1)
        whole = total(ahead[:, -1], 1)[:, None, None]
        wrong = np.exp(ahead + behind - whole) - goal  # [window, token, tag]
        pairs = ahead[:, :-1, :, None] + steps + (scores + behind)[:, 1:, None, :] - whole[..., None]
        slopes = {
            "own": np.zeros_like(weights["own"]),
            "of_file": np.zeros_like(weights["of_file"]),
            "steps": np.exp(pairs).sum(axis=(0, 1)),
        }
        np.subtract.at(slopes["steps"], (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
        np.add.at(slopes["of_file"], of_file, wrong.sum(axis=1)[:, None])
        flat = wrong.reshape(n * size, 3)
        for k, x in enumerate(near):
            for tag in range(3):
                weight = np.repeat(flat[:, tag], x.shape[1])
                slopes["own"][k, :, tag] = np.bincount(x.ravel(), weight, nothing + 1)
        slopes["own"][:, nothing] = 0
        for k, w in weights.items():
            slope = slopes[k] / n + DECAY * w
            means[k] += 0.1 * (slope - means[k])
            squares[k] += 0.01 * (slope**2 - squares[k])
            rate = 0.1 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            w -= rate * means[k] / (np.sqrt(squares[k]) + 1e-8)
    # All features are there when a text is read.
    own = weights["own"][:, :-1] * (1 - LEFT_OUT)
    return SecretTagger(words, own, weights["of_file"], weights["steps"])


SPANS = "array<struct<kind:string,start:long,stop:long>>"


def find(docs: DataFrame, tagger: SecretTagger | None) -> DataFrame:
    """doc_id and spans (kind, start, stop in code points, stop exclusive) of the secrets in each
    whole text, ordered by start, then kind.

    All matches of the patterns are there; the field adds spans of kind `learned` that overlap
    none of them. A NULL or empty text has none; without a tagger only the patterns speak.
    Repeated rows are searched each. Other columns are ignored.
    """

    def rows(batches: Iterable[Columns]) -> Iterator[Columns]:
        decoder = Decoder(tagger) if tagger else None
        for batch in batches:
            spans = []
            for text in batch["text"]:
                base = [f[:3] for f in base_spans(text or "")]
                own = decoder.spans(text) if decoder and text else []
                free = [s for s in own if not any(s[0] < b[2] and b[1] < s[1] for b in base)]
                every = sorted(base + [(LEARNED, *s) for s in free], key=_order)
                spans.append([{"kind": k, "start": a, "stop": b} for k, a, b in every])
            yield {"doc_id": batch["doc_id"], "spans": spans}

    return map_columns(docs.select("doc_id", "text"), rows, f"doc_id long, spans {SPANS}")
