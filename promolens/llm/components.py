"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """id and component (its least id) of every id in `links` (a, b).

    Each round points every id to its least neighbour or itself and replaces the ends of each
    link by what they point to. Of the ids that have a neighbour at most half stay, so the rounds
    are few. The minimum is aggregated before it is shuffled, and each round is stored.
    """
    rounds = []
    links = stored(links.where("a <> b").select("a", "b").distinct())
    while not links.isEmpty():
        ends = links.union(links.select("b", "a"))
        points = stored(
            ends.groupBy("a").agg(F.min("b").alias("to")).select("a", F.least("a", "to").alias("to"))
        )
        rounds.append(points)
        left = points.select("a", F.col("to").alias("x"))
        right = points.select(F.col("a").alias("b"), F.col("to").alias("y"))
        moved = links.join(left, "a").join(right, "b").where("x <> y")
        least, most = F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
        links = stored(moved.select(least, most).distinct())
    if not rounds:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    found = rounds[0].select(F.col("a").alias("id"), F.col("to").alias("component"))
    for points in rounds[1:]:
        further = points.select(F.col("a").alias("component"), "to")
        found = found.join(further, "component", "left").select(
            "id", F.coalesce("to", "component").alias("component")
        )
    return stored(found)
