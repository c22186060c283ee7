"""The conversation trie against a plain one and SQL."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from compare import connect, differences, spark_result, sql_result

from promolens.llm import conversations, oracle, queries

SCHEMA = "conv_id long, turn long, role string, text string, depth long, key1 string, owner string, n_convs string, block string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(rows):
    """The trie of (conv_id, turn, role, text) rows, node by node."""
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv_id].append((turn is not None, turn or 0, digest, (role, text)))
    turns = {c: [t[-1] for t in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        # SQL's remainder has the sign of c.
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        whole[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, of in members.items():
        size = len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(of) - 1) * size
    out = []
    for path, of in members.items():
        ended = ",".join(str(c) for c in of if whole[c] == path)
        out.append(
            (
                of[0],
                len(path),
                members[path[:-1]][0] if path else None,
                len(of),
                children[path],
                leaves[path],
                saved[path],
                hashlib.sha256(ended.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def found(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", "y", "z", "b") for r in rows], SCHEMA)
    return sorted((tuple(r[c] for c in COLUMNS) for r in conversations.trie(df).collect()), key=str)


def random_rows(seed, convs, turns, words=3):
    draw = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(draw.randint(1, turns)):
            text = draw.choice([None, "", "é"] + ["a long turn", "b"][:words])
            rows.append((c * 2 - 11, t if draw.random() < 0.9 else None, draw.choice(["user", None]), text))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, convs, turns", [(1, 60, 6), (2, 25, 40), (3, 200, 3)])
def test_random_conversations(spark, seed, convs, turns):
    rows = random_rows(seed, convs, turns)
    assert found(spark, rows) == plain(rows)


def test_blocks_and_cells_of_any_size(spark, monkeypatch):
    rows = random_rows(4, 25, 30, words=2)
    expected = plain(rows)
    monkeypatch.setattr(conversations, "CELL", 2)
    for size in (1, 3):
        monkeypatch.setattr(conversations, "BLOCK", size)
        assert found(spark, rows) == expected


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "no conversation"),
        (10, 1, "user", "same"), (10, 1, "user", "same"), (10, None, None, None), (10, 2, "", "tail"),
        *[(11, t, "user", "only the head stays") for t in range(2)],
        (12, 5, "system", "x" * 200_000), (12, -5, "system", "first"),
        (-3, 0, "a:b", "c"), (-3, 0, "a", ":bc"),
        (21, 0, "user", "no base"),
    ]
    assert found(spark, rows) == plain(rows)


def test_no_conversations(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 0, "user", "x")]) == []


def test_one_long_conversation_and_many_copies(spark):
    """A conversation with a third of the rows, and thousands of equal ones that end at one node."""
    rows = [(3, t, "user", f"turn {t % 50}") for t in range(6000)]
    rows += [(5 * c, t, "user", f"copy {t}") for c in range(2, 6002) for t in range(2)]
    nodes = found(spark, rows)
    assert len(nodes) == 1 + 6000 - zlib.crc32(b"3") % 9 + 2
    convs = [5 * c for c in range(2, 6002)]
    ended = hashlib.sha256(",".join(map(str, convs)).encode()).hexdigest()
    assert (10, 2, 10, 6000, 0, 1, 5999 * 6, ended) in nodes
    assert sum(n[1] == 0 and n[3] == 6001 and n[5] == 2 and n[6] == 5999 * 12 for n in nodes) == 1


def test_op11(spark, sf_dir):
    result = spark_result(queries.op11_conversations(spark, sf_dir))
    assert not differences(result, sql_result(connect(sf_dir), oracle.OP11))
