"""The prefix trie of conversations, grouped by digests of fixed-length blocks of turns.

A conversation is cut into blocks of `BLOCK` turns. Conversations are grouped by their successive
block digests first, so that a path of many turns costs one row a block. Turn boundaries are only
looked for inside blocks where the group before has several different blocks: their distinct
blocks, not the conversations, are taken apart into turns and grouped again. All other blocks are
chains whose nodes have the block's members.

The key of a path is the XOR of two 64-bit hashes of (depth, turn digest) over its turns. So the
key of a block is that of its turns, a running XOR over blocks is the key of the whole path, and a
node's parent has the node's key without its last turn. Paths are told apart by these 128 bits; they
withstand chance, not someone who seeks collisions.

Sums over subtrees need no walk along the tree. The smallest member of a node owns it. A leaf is
counted for its owner, and the bytes a conversation shares are those of its path above the nodes it
owns; both are numbers of a conversation, summed over the members of each node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from promolens.llm.common import stored

BLOCK = 8  # turns
CELL = 1024  # blocks whose keys are added up in one window
FAMILY = 5  # conversations that begin like the first of them
MOST_HEAD = 8  # turns they can have of it
CHUNK = 4096  # ids joined in one piece of a hashed list

NODE = ["depth", "key1", "key2"]
ABOVE = ["depth", "above1", "above2"]


def digests(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest and size (UTF-8 bytes of the text) of each row that has a conv_id."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        digest.alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )


def _map_batches(df: DataFrame, run, schema: str) -> DataFrame:
    kind = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(lambda batches: run(batches, kind), schema)


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 1, by turn, NULL first, then digest), digest, size.

    Turns are sorted in ranges, so that a conversation of any length is cut over tasks; a task
    numbers its rows, and the conversation it begins in goes on from the rows of the tasks before.
    """

    def run(batches: Iterator[pa.RecordBatch], kind) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
            if not len(ids):
                continue
            starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            lengths = np.diff(np.append(starts, len(ids)))
            place = np.arange(len(ids)) - np.repeat(starts, lengths)
            if last == ids[0]:
                place[: lengths[0]] += count
            last, count = ids[-1], int(place[-1]) + 1
            columns = {
                "conv_id": batch.column("conv_id"),
                "digest": batch.column("digest"),
                "size": batch.column("size"),
                "part": np.full(len(ids), part),
                "place": place,
            }
            yield pa.RecordBatch.from_pydict(columns, kind)

    # `row` splits ranges of repeated rows.
    order = ["conv_id", "turn", "digest", "row"]
    rows = stored(turns).withColumn("row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "conv_id long, digest binary, size long, part int, place long"
    placed = stored(_map_batches(ordered.drop("row"), run, schema))
    counts = placed.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A task's first conversation alone can have begun before: one row a task at most.
    begun = counts.select("conv_id", "part", F.sum("n").over(before).alias("before"))
    begun = F.broadcast(begun.where("before is not null"))
    pos = F.col("place") + F.coalesce("before", F.lit(0)) + 1
    return placed.join(begun, ["conv_id", "part"], "left").select(
        "conv_id", pos.alias("pos"), "digest", "size"
    )


def _head() -> Column:
    """How many turns a conversation takes over."""
    return (F.crc32(F.col("conv_id").cast("string")) % (MOST_HEAD + 1)).cast("int")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of numbered `turns` the rebuilt conversations: conv_id, total (turns), and their turns:
    conv_id, depth, digest, size.

    Conversation c begins with the first h turns of conversation c - c % 5, and goes on with its
    own turns after its first h, h = crc32(decimal c) % 9.
    """
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    turn = F.struct("pos", "digest", "size")
    heads = (
        turns.where((base == F.col("conv_id")) & (F.col("pos") <= MOST_HEAD))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(turn)).alias("head"))  # MOST_HEAD turns at most
    )
    nothing = F.array().cast("array<struct<pos:long,digest:binary,size:long>>")
    convs = stored(
        turns.groupBy("conv_id")
        .agg(F.count(F.lit(1)).alias("turns"))
        .withColumn("base", base)
        .join(heads, "base", "left")
        .withColumn("head", F.slice(F.coalesce("head", nothing), F.lit(1), _head()))
        .select(
            "conv_id",
            "head",
            F.size("head").alias("taken"),
            (F.size("head") + F.greatest(F.col("turns") - _head(), F.lit(0))).alias("total"),
        )
    )
    own = (
        turns.where(F.col("pos") > _head())
        .join(convs.select("conv_id", "taken"), "conv_id")
        .select("conv_id", (F.col("taken") + F.col("pos") - _head()).alias("depth"), "digest", "size")
    )
    first = convs.select("conv_id", F.explode("head").alias("t")).select(
        "conv_id", F.col("t.pos").alias("depth"), "t.digest", "t.size"
    )
    return convs.select("conv_id", "total"), own.unionByName(first)


def _xor(*columns: Column) -> Column:
    out, *rest = columns
    for c in rest:
        out = out.bitwiseXOR(c)
    return out


def blocks(turns: DataFrame) -> DataFrame:
    """One row per block of a conversation: conv_id, block, key1 and key2 of the path to its end,
    above1 and above2 of the path before it, bytes, pre (bytes before it), and its turns, each
    with the keys and bytes of the block up to it."""
    hashed = turns.withColumns(
        {
            "block": F.expr(f"(depth - 1) div {BLOCK}"),
            "hash1": F.xxhash64("depth", "digest"),
            "hash2": F.xxhash64("digest", "depth", F.lit("second")),
        }
    )
    until = Window.partitionBy("conv_id", "block").orderBy("depth")
    until = until.rowsBetween(Window.unboundedPreceding, 0)
    run = [F.bit_xor(f"hash{i}").over(until).alias(f"run{i}") for i in (1, 2)]
    before = (F.sum("size").over(until) - F.col("size")).alias("before")
    turn = F.struct("depth", "run1", "run2", "hash1", "hash2", "before", "size")
    cut = stored(
        hashed.select("*", *run, before)
        .groupBy("conv_id", "block")
        .agg(
            F.sort_array(F.collect_list(turn)).alias("turns"),  # BLOCK turns at most
            F.bit_xor("hash1").alias("hash1"),
            F.bit_xor("hash2").alias("hash2"),
            F.sum("size").alias("bytes"),
        )
        .withColumn("cell", F.expr(f"block div {CELL}"))
    )
    # Long conversations are added up cell by cell, then over the cells before.
    within = Window.partitionBy("conv_id", "cell").orderBy("block")
    within = within.rowsBetween(Window.unboundedPreceding, 0)
    cells = cut.groupBy("conv_id", "cell").agg(
        F.bit_xor("hash1").alias("c1"), F.bit_xor("hash2").alias("c2"), F.sum("bytes").alias("c3")
    )
    earlier = Window.partitionBy("conv_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "conv_id",
        "cell",
        F.bit_xor("c1").over(earlier).alias("c1"),
        F.bit_xor("c2").over(earlier).alias("c2"),
        F.sum("c3").over(earlier).alias("c3"),
    ).where("cell > 0")
    running = cut.select(
        "*",
        F.bit_xor("hash1").over(within).alias("k1"),
        F.bit_xor("hash2").over(within).alias("k2"),
        F.sum("bytes").over(within).alias("k3"),
    ).join(cells, ["conv_id", "cell"], "left")
    zero = F.lit(0).cast("long")
    key1, key2, end = (
        _xor(F.col("k1"), F.coalesce("c1", zero)),
        _xor(F.col("k2"), F.coalesce("c2", zero)),
        F.col("k3") + F.coalesce("c3", zero),
    )
    return running.select(
        "conv_id",
        "block",
        key1.alias("key1"),
        key2.alias("key2"),
        _xor(key1, F.col("hash1")).alias("above1"),
        _xor(key2, F.col("hash2")).alias("above2"),
        "bytes",
        (end - F.col("bytes")).alias("pre"),
        "turns",
    )


def classes(cut: DataFrame) -> DataFrame:
    """The distinct blocks of stored `cut`, each after the same path: block, its keys, turns and
    pre, n_convs and owner, and whether other blocks come after the same path (split)."""
    found = stored(
        cut.groupBy("block", "key1", "key2").agg(
            *(F.first(c).alias(c) for c in ("above1", "above2", "pre", "turns")),
            F.count(F.lit(1)).alias("n_convs"),
            F.min("conv_id").alias("owner"),
        )
    )
    above = ["block", "above1", "above2"]
    split = stored(
        found.groupBy(*above).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    # Stored, so that the adaptive join can split the many blocks after one path.
    return stored(
        found.join(split.withColumn("split", F.lit(True)), above, "left").withColumn(
            "split", F.coalesce("split", F.lit(False))
        )
    )


def _by_turn(found: DataFrame, same: list[str], sums: dict[str, Column]) -> DataFrame:
    """The nodes in the blocks of `found`: a block that alone follows its path gives one node a
    turn; those that have siblings are grouped turn by turn. `same` are columns alike in all of a
    node's rows, `sums` aggregates of the blocks' columns of these names."""
    each = found.select("*", F.explode("turns").alias("t")).select(
        F.col("t.depth").alias("depth"),
        *(_xor(F.col(f"above{i}"), F.col(f"t.run{i}")).alias(f"key{i}") for i in (1, 2)),
        *(
            _xor(F.col(f"above{i}"), F.col(f"t.run{i}"), F.col(f"t.hash{i}")).alias(f"up{i}")
            for i in (1, 2)
        ),
        F.col("t.size").alias("size"),
        (F.col("pre") + F.col("t.before")).alias("pre"),
        "split",
        "owner",
        *(c for c in sums if c != "owner"),
    )
    kept = [*NODE, *same, *sums]
    merged = (
        each.where("split")
        .groupBy(*NODE)
        .agg(*(F.first(c).alias(c) for c in same), *(agg.alias(c) for c, agg in sums.items()))
    )
    return each.where("not split").select(kept).unionByName(merged.select(kept))


def ends(ended: DataFrame) -> DataFrame:
    """SHA-256 of the ascending decimal conv_ids of each node in stored `ended` (node, conv_id).

    A hash can only be taken in order. The ids are sorted in ranges that may cut a node, and joined
    to long pieces there; one task then feeds the few pieces of a node to its hash, one by one.
    """

    def joined(batches: Iterator[pa.RecordBatch], kind) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def piece() -> pa.RecordBatch:
            row = (*node, ids[0], ",".join(map(str, ids)))
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], schema=kind)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in (*NODE, "conv_id"))
            for *key, conv_id in zip(*columns):
                if key != node or len(ids) == CHUNK:
                    if ids:
                        yield piece()
                    node, ids = key, []
                ids.append(conv_id)
        if ids:
            yield piece()

    def hashed(batches: Iterator[pa.RecordBatch], kind) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out: list[tuple] = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if key == node:
                    digest.update(b",")
                else:
                    if node:
                        out.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256()
                digest.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], schema=kind)
        if node:
            row = (*node, digest.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], schema=kind)

    keys = "depth long, key1 long, key2 long"
    order = [*NODE, "conv_id"]
    ranged = ended.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = stored(_map_batches(ranged, joined, f"{keys}, first long, ids string"))
    dealt = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return _map_batches(dealt, hashed, f"{keys}, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of the rebuilt `conversations` (conv_id, turn, role, text), one row a node:
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    NULL roles and texts count as empty. Turns of one number are ordered by their digest; repeated
    rows are turns of their own. Rows without a conv_id belong to no conversation and take no
    part. No conversations give no rows, not even a root. Other columns are ignored.
    """
    convs, turns = rebuilt(numbered(digests(conversations)))
    cut = stored(blocks(turns))
    found = classes(cut)
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("owner"))
    nodes = stored(
        _by_turn(
            found,
            ["up1", "up2", "size", "pre"],
            {"n_convs": F.sum("n_convs"), "owner": F.min("owner")},
        ).unionByName(
            root.where("n_convs > 0").select(
                zero.alias("depth"),
                *(zero.alias(c) for c in ("key1", "key2", "size", "pre")),
                "n_convs",
                "owner",
            ),
            allowMissingColumns=True,
        )
    )
    parent = [(F.col("depth") - 1).alias("depth"), F.col("up1").alias("key1"), F.col("up2").alias("key2")]
    children = nodes.where("depth > 0").groupBy(*parent).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(
        nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", zero))
    )

    owned = nodes.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min("pre").alias("shared"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")
    )
    size = cut.groupBy("conv_id").agg(F.sum("bytes").alias("bytes"))
    members = stored(
        convs.join(size, "conv_id", "left")
        .join(owned, "conv_id", "left")
        .select(
            "conv_id",
            "total",
            F.coalesce("shared", "bytes", zero).alias("shared"),
            F.coalesce("leaf", zero).alias("leaf"),
        )
    )
    of_members = cut.select("conv_id", "block", "key1", "key2").join(members, "conv_id")
    sums = of_members.groupBy("block", "key1", "key2").agg(
        F.sum("shared").alias("shared"),
        F.sum("leaf").alias("n_leaves"),
        F.min_by("shared", "conv_id").alias("of_owner"),
    )
    of_all = members.agg(
        F.sum("shared").alias("shared"),
        F.sum("leaf").alias("n_leaves"),
        F.min_by("shared", "conv_id").alias("of_owner"),
    )
    by_turn = _by_turn(
        found.join(sums, ["block", "key1", "key2"]),
        [],
        {
            "shared": F.sum("shared"),
            "n_leaves": F.sum("n_leaves"),
            "of_owner": F.min_by("of_owner", "owner"),
        },
    )
    subtree = by_turn.unionByName(of_all.select(*(zero.alias(c) for c in NODE), "*"))

    last = F.col("block") == F.expr(f"(total - 1) div {BLOCK}")
    ended = of_members.where(last).select(F.col("total").alias("depth"), "key1", "key2", "conv_id")
    empty = members.where("total = 0").select(*(zero.alias(c) for c in NODE), "conv_id")
    hashes = ends(stored(ended.withColumn("depth", F.col("depth").cast("long")).unionByName(empty)))

    up = nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("key1").alias("up1"),
        F.col("key2").alias("up2"),
        F.col("owner").alias("parent_conv_id"),
    )
    saved = F.col("shared") - F.col("of_owner") - (F.col("n_convs") - 1) * F.col("pre")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        nodes.join(subtree, NODE)
        .join(hashes, NODE, "left")
        .join(up, ["depth", "up1", "up2"], "left")
        .select(
            F.col("owner").alias("conv_id"),
            F.col("depth").cast("long").alias("depth"),
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            saved.alias("saved_tokens"),
            F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
        )
    )
