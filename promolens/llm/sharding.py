"""Balanced shards of indivisible groups by Karmarkar-Karp differencing.

A partial partition is a list of sums, one for each shard, with the groups behind them. The two
with the largest spread (largest minus smallest sum) are combined again and again, the largest
sums of one with the smallest of the other, until one is left. A single group is a partial
partition with one sum above zero.

Groups are dealt to cells by hash. Each cell is reduced to one partial partition in a task of its
own; those partitions are again dealt to cells and reduced, level after level, until one is left.
Only shard sums and permutations pass between levels, and no task gets more than a cell.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promolens.llm.common import stored

CELL = 20_000  # groups, or partial partitions, in a cell on average
FAN = 1_000  # partial partitions combined at a time on higher levels
SLOTS = 10_000  # rows in a numbering cell on average


def difference(starts: list[list[int]]) -> tuple[list[int], list[list[int]]]:
    """Combine partial partitions until one is left.

    `starts` are lists of sums. The result has the final sums, and for each start the final place
    of each of its places. Equal spreads are taken in the order of `starts`.
    """
    width = len(starts[0])
    nodes: list[tuple[int, int, list[int]]] = []
    heap, states = [], []
    for i, sums in enumerate(starts):
        order = sorted(range(width), key=lambda k: (-sums[k], k))
        states.append([sums[k] for k in order])
        nodes.append((-1, -1, order))
        heap.append((states[i][-1] - states[i][0], i, i))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        joined = [x + y for x, y in zip(states[a], reversed(states[b]))]
        order = sorted(range(width), key=lambda k: (-joined[k], k))
        back = [0] * width
        for place, k in enumerate(order):
            back[k] = place
        new = len(states)
        states.append([joined[k] for k in order])
        states[a] = states[b] = []
        nodes.append((a, b, back))
        heapq.heappush(heap, (states[new][-1] - states[new][0], new, new))
    top = heap[0][2]
    final: list[list[int]] = [[] for _ in starts]
    todo = [(top, list(range(width)))]
    while todo:
        node, places = todo.pop()
        a, b, order = nodes[node]
        if a < 0:
            # order lists a start's own places by sum; places are where those positions end up.
            own = [0] * width
            for position, k in enumerate(order):
                own[k] = places[position]
            final[node] = own
            continue
        moved = [places[order[k]] for k in range(width)]
        todo.append((a, moved))
        todo.append((b, moved[::-1]))
    return states[top], final


def balanced_groups(groups: DataFrame, shards: int) -> DataFrame:
    """key and shard of each of `groups` (key, total), by differencing level after level.

    `key` is unique. No rows give no rows.
    """
    n = groups.count()
    cells = max(1, -(-n // CELL))

    def first(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["total", "key"], ascending=[False, True])
        starts = [[int(t)] + [0] * (shards - 1) for t in part["total"]]
        sums, places = difference(starts)
        return pd.DataFrame(
            {
                "cell": [int(part["cell"].iloc[0])] * (len(part) + 1),
                "key": pd.array([*part["key"], None], "Int64"),
                "place": pd.array([*(p[0] for p in places), None], "Int32"),
                "sums": [*[None] * len(part), sums],
            }
        )

    schema = "cell long, key long, place int, sums array<long>"
    dealt = groups.withColumn("cell", F.pmod(F.xxhash64("key"), F.lit(cells)))
    both = stored(dealt.groupBy("cell").applyInPandas(first, schema))
    placed = both.where("key is not null").select("key", "cell", "place")
    level = both.where("key is null").select("cell", "sums")

    def higher(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("cell")
        sums, places = difference([list(map(int, s)) for s in part["sums"]])
        above = int(part["above"].iloc[0])
        return pd.DataFrame(
            {
                "cell": pd.array([*part["cell"], None], "Int64"),
                "above": [above] * (len(part) + 1),
                "places": [*places, None],
                "sums": [*[None] * len(part), sums],
            }
        )

    while cells > 1:
        cells = -(-cells // FAN)
        up = level.withColumn("above", F.expr(f"cell div {FAN}"))
        schema = "cell long, above long, places array<int>, sums array<long>"
        both = stored(up.groupBy("above").applyInPandas(higher, schema))
        moves = both.where("cell is not null").select("cell", "above", "places")
        placed = placed.join(moves, "cell").select(
            "key", F.col("above").alias("cell"), F.get("places", "place").alias("place")
        )
        level = both.where("cell is null").select(F.col("above").alias("cell"), "sums")
    return placed.select("key", F.col("place").alias("shard"))


def numbered(rows: DataFrame, by: str, order: list[str], n: int) -> DataFrame:
    """`slot`, gapless from 0 among the rows of each value of `by`.

    Rows are numbered within hashed cells, and a cell starts after the rows of the cells before
    it; cells are as few as rows / SLOTS for each value.
    """
    cells = max(1, -(-n // SLOTS))
    rows = rows.withColumn("cell", F.pmod(F.xxhash64(*order), F.lit(cells)))
    counts = rows.groupBy(by, "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy(by).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(by, "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy(by, "cell").orderBy(*order)) - 1
    return (
        rows.withColumn("inside", inside)
        .join(counts, [by, "cell"])
        .withColumn("slot", F.col("first") + F.col("inside"))
        .drop("cell", "inside", "first")
    )


def shard(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Shards of near-equal bytes, equal texts staying together: doc_id, size, text_crc32, law,
    shard, slot, grown_shard.

    A row's size is its text's UTF-8 bytes plus 1; a NULL text has size 1, and NULL texts form a
    group. Texts with one 64-bit hash and one length count as equal. The whole text is read once;
    what is stored and shuffled is narrow. Repeated rows keep a row and a slot each.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    rows = stored(
        docs.select(
            "doc_id",
            size.alias("size"),
            F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).alias("text_crc32"),
            F.xxhash64("text", F.octet_length("text")).alias("key"),
        )
    )
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("total")))
    placed = rows.join(balanced_groups(groups, shards), "key").drop("key")
    out = numbered(placed, "shard", ["doc_id", "size", "text_crc32"], rows.count())
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
