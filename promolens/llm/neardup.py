"""Near duplicates by HyperMinHash bands, confirmed on full shingle sets.

Texts with one shingle set are one node. A node's registers are cut into bands; nodes that agree
in a band meet in a bucket. No bucket is expanded into all pairs:

1. In a few rounds each bucket picks a leader, in another order each round, and its members of
   another component are held against it. Components grow by the links confirmed.
2. What then still lies in one bucket but in two components is compared in tiles, all sets of
   a tile at once, so no link between different texts is lost; only links leave a tile.

In the rounds a pair is first judged by its registers; unless that estimate is far below the
limit, the sets themselves decide. Sets travel to tiles of bounded size, once for all pairs of a
tile.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import Columns, map_columns, stored
from promolens.llm.components import components
from promolens.llm.shingles import bands, estimate, mix, registers, shingle_set

SHARED, OF = 75, 100  # linked: OF * shared shingles >= SHARED * shingles of either
ROUNDS = 3
ERRORS = 5  # standard errors an estimate must lie below the limit to be believed
TILE = 1 << 17  # shingles of each side of a tile on average
SETS = 1 << 10  # sets of each side of a tile on average, at most
COLUMNS = 2048  # shingles of a tile compared at a time


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n (shingles), the set's 128-bit name, and the band keys."""

    def rows(batches: Iterable[Columns]) -> Iterator[Columns]:
        for batch in batches:
            sets = [shingle_set(t) for t in batch["text"]]
            yield {
                "doc_id": batch["doc_id"],
                "n": [len(s) for s in sets],
                "name": [mix(s).sum(dtype=np.uint64).view(np.int64) for s in sets],
                "name2": [np.bitwise_xor.reduce(mix(s + np.uint64(1)), initial=0).view(np.int64) for s in sets],
                "bands": [bands(registers(s)).view(np.int64).tolist() if len(s) else [] for s in sets],
            }

    schema = "doc_id long, n long, name long, name2 long, bands array<long>"
    return map_columns(docs.select("doc_id", "text"), rows, schema)


def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """id and shingle set (bytes) of the documents named by `ids` (id)."""

    def rows(batches: Iterable[Columns]) -> Iterator[Columns]:
        for batch in batches:
            yield {
                "id": batch["doc_id"],
                "shingles": [shingle_set(t).tobytes() for t in batch["text"]],
            }

    wanted = docs.join(ids.withColumnRenamed("id", "doc_id"), "doc_id").select("doc_id", "text")
    return map_columns(wanted, rows, "id long, shingles binary")


def _judge(pairs: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
    """Whether each pair of a tile is linked."""
    found: dict[int, list[np.ndarray]] = {}
    for i, data in zip(sets["id"], sets["shingles"]):
        found.setdefault(i, []).append(np.frombuffer(data, np.uint64))
    known = {i: [registers(s) for s in own] for i, own in found.items()}
    linked = np.zeros(len(pairs), bool)
    for row, (x, y) in enumerate(zip(pairs["x"], pairs["y"])):
        for a, regs_a in zip(found[x], known[x]):
            for b, regs_b in zip(found[y], known[y]):
                likeness, error = estimate(regs_a, regs_b)
                if OF * (likeness + ERRORS * error) < SHARED:
                    continue
                both = np.concatenate([a, b])
                both.sort(kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                linked[row] |= OF * shared >= SHARED * (len(both) - shared)
    return pd.DataFrame({"x": pairs["x"], "y": pairs["y"], "linked": linked})


def _parts(n: str) -> Column:
    """How many parts the sets of a target are cut into, by their shingles and by their count."""
    return F.greatest(F.ceil(F.sum(n) / TILE), F.ceil(F.count(n) / SETS)).cast("int")


def judged(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """x, y, linked of `pairs` (target, x, y, nx, ny), unique in x and y.

    The pairs of a target are dealt to a grid of tiles by x and y, as fine as their sets are
    large or many.
    """

    def parts(side: str) -> DataFrame:
        of_target = pairs.select("target", side, f"n{side}").distinct().groupBy("target")
        return of_target.agg(_parts(f"n{side}").alias(f"parts_{side}"))

    def at(side: str) -> Column:
        return F.pmod(F.xxhash64(side), F.greatest(F.col(f"parts_{side}"), F.lit(1)))

    tile = F.xxhash64("target", at("x"), at("y")).alias("tile")
    tiles = pairs.join(parts("x"), "target").join(parts("y"), "target").select(tile, "x", "y")
    tiles = stored(tiles)
    needed = tiles.select("tile", F.col("x").alias("id")).union(tiles.select("tile", "y")).distinct()
    sent = needed.join(sets, "id").select(F.col("tile").alias("to"), "id", "shingles")
    both = tiles.groupBy("tile").cogroup(sent.groupBy("to"))
    return stored(both.applyInPandas(_judge, "x long, y long, linked boolean"))


def _in_components(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members of those buckets that hold several components, with their component."""
    found = members
    known = components(links)
    found = members.join(known.withColumnRenamed("component", "c"), "id", "left").select(
        "bucket", "id", "n", F.coalesce("c", "id").alias("component")
    )
    mixed = (
        found.groupBy("bucket")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"))
        .where("least <> most")
        .select("bucket")
    )
    return stored(found.join(mixed, "bucket"))


def _led(members: DataFrame, order: int) -> DataFrame:
    """Members with their bucket's leader, its size and its component."""
    first = F.struct(F.xxhash64("id", F.lit(order)), "id", "n", "component")
    leaders = members.groupBy("bucket").agg(F.min(first).alias("first"))
    return members.join(leaders, "bucket").select(
        "bucket",
        "id",
        "n",
        "component",
        F.col("first.id").alias("leader"),
        F.col("first.n").alias("leader_n"),
        F.col("first.component").alias("leader_component"),
    )


def _links(judgements: DataFrame) -> DataFrame:
    return judgements.where("linked").select(F.col("x").alias("a"), F.col("y").alias("b"))


def of_one_document(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) from each node (name, name2, id) of a document with several sets to the least
    node of that document.

    Documents with several sets are found by aggregates, so only their rows meet the nodes.
    """
    ends = {f"{f.__name__}_{c}": f(c) for c in ("name", "name2") for f in (F.min, F.max)}
    several = rows.groupBy("doc_id").agg(*(e.alias(name) for name, e in ends.items()))
    several = several.where("min_name <> max_name or min_name2 <> max_name2").select("doc_id")
    own = rows.select("doc_id", "name", "name2").join(several, "doc_id").distinct()
    own = stored(own.join(nodes, ["name", "name2"]).select("doc_id", "id").distinct())
    least = own.groupBy("doc_id").agg(F.min("id").alias("b"))
    return own.join(least, "doc_id").select(F.col("id").alias("a"), "b").where("a <> b").distinct()


def linked_nodes(members: DataFrame, sets: DataFrame, known: DataFrame) -> DataFrame:
    """id and component of the nodes that `members` (bucket, id, n) and the links `known` (a, b)
    bring together."""
    spark = members.sparkSession
    tested = spark.createDataFrame([], "x long, y long, linked boolean")
    rest = members.withColumn("component", F.col("id"))
    for order in range(ROUNDS):
        led = stored(_led(rest, order))
        pairs = (
            led.where("component <> leader_component")
            .select(
                F.col("leader").alias("target"),
                F.col("leader").alias("x"),
                F.col("id").alias("y"),
                F.col("leader_n").alias("nx"),
                F.col("n").alias("ny"),
            )
            .distinct()
            .join(tested.select("x", "y"), ["x", "y"], "left_anti")
        )
        tested = tested.union(judged(stored(pairs), sets))
        rest = _in_components(led.select("bucket", "id", "n"), _links(tested))
    return components(_links(tested).union(_missing_links(rest, sets)).union(known))


def _crossing(tile: pd.DataFrame) -> pd.DataFrame:
    """A link for each two components of a tile that are linked, by the sizes of all
    intersections: products of 0/1 matrices, some shingles at a time."""
    sets = [np.frombuffer(s, np.uint64) for s in tile["shingles"]]
    size = np.array([len(s) for s in sets])
    _, names, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), size)
    common = counts[names] > 1
    # Numbers of the shingles that several sets have.
    number = np.cumsum(counts > 1) - 1
    name, owner = number[names[common]], owner[common]
    order = np.argsort(name, kind="stable")
    name, owner = name[order], owner[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(name[-1]) + 1 if len(name) else 0, COLUMNS):
        lo, hi = np.searchsorted(name, (start, start + COLUMNS))
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owner[lo:hi], name[lo:hi] - start] = 1
        shared += held @ held.T
    linked = OF * shared >= SHARED * (size[:, None] + size[None, :] - shared)
    component, ids = (tile[c].to_numpy(np.int64) for c in ("component", "id"))
    x, y = np.nonzero(linked & (component[:, None] < component[None, :]))
    pairs = pd.DataFrame({"a": ids[x], "b": ids[y], "of_a": component[x], "of_b": component[y]})
    return pairs.drop_duplicates(["of_a", "of_b"])[["a", "b"]]


def _missing_links(mixed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components that share a bucket of `mixed`.

    The nodes of all buckets with one least component are compared with each other, in tiles of
    two parts of bounded size; a tile gives one link for two components at most.
    """
    least = mixed.groupBy("bucket").agg(F.min("component").alias("target"))
    met = stored(
        mixed.join(least, "bucket").select("target", "id", "n", "component").distinct()
    )
    parts = met.groupBy("target").agg(_parts("n").alias("parts"))
    own = F.pmod(F.xxhash64("id"), F.col("parts"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    tiles = met.join(parts, "target").select("target", "id", "component", own.alias("own"), other)
    low, high = F.least("own", F.col("other").cast("long")), F.greatest("own", F.col("other").cast("long"))
    tiles = tiles.select(F.xxhash64("target", low, high).alias("tile"), "id", "component")
    return stored(
        tiles.join(sets, "id").groupBy("tile").applyInPandas(_crossing, "a long, b long")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row of `docs` (doc_id, text).

    Words are runs of other than white space, A-Z lower-cased; a set has the distinct shingles of
    five words, or of all words if there are fewer. Documents whose sets share at least 75 of 100
    shingles are linked; a component's id is its least doc_id, and that document is kept.
    A NULL or empty text has an empty set and is linked with nothing. Rows of one doc_id are one
    document: whatever their texts, they have one component. A NULL doc_id takes no part: its
    component_id is NULL and it is kept. Other columns are ignored.
    """
    # The empty set is a node of its own in each document.
    name = F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("doc_id"))
    rows = stored(sketches(docs).withColumn("name", name))
    some = rows.where("doc_id is not null")
    nodes = stored(some.groupBy("name", "name2").agg(F.min("doc_id").alias("id")))
    own = nodes.withColumnRenamed("id", "doc_id")
    banded = (
        some.join(own, ["doc_id", "name", "name2"])
        .select(F.explode("bands").alias("bucket"), F.col("doc_id").alias("id"), "n")
    )
    shared = banded.groupBy("bucket").count().where("count > 1").select("bucket")
    members = banded.join(shared, "bucket").groupBy("bucket", "id").agg(F.max("n").alias("n"))
    members = stored(members)
    sets = stored(sets_of(docs, members.select("id").distinct()))
    found = linked_nodes(members, sets, of_one_document(some, nodes))
    labels = nodes.join(found, "id", "left").select(
        "name", "name2", F.coalesce("component", "id").alias("of_set")
    )
    return (
        rows.select("doc_id", "n", "name", "name2")
        .join(labels, ["name", "name2"], "left")
        .select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.col("of_set")).alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that near_duplicates keeps: one document of each group.

    Only the ids of dropped documents meet the texts. Rows without doc_id all stay, and so do all
    rows of a kept doc_id.
    """
    dropped = near_duplicates(docs.select("doc_id", "text")).where("not kept").select("doc_id")
    return docs.join(dropped.distinct(), "doc_id", "left_anti")
