"""Exact top-k inner products by descending length, with rotated partial sums.

Rows are dealt to a grid of query blocks and candidate groups, both of bounded size. In a cell the
candidates are rotated by the singular vectors of their matrix, so that the first coordinates
carry most of every product, and are met by descending length. The product of the first
coordinates plus the product of what is left of both lengths is an upper bound (Cauchy-Schwarz);
where it stays below the query's k-th best score so far, the pair is skipped. All others are
scored by their integers. Once the longest query times the next length cannot reach any k-th
score, the cell is done.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERIES = 2048  # queries of a cell on average
CANDIDATES = 16384  # candidates of a cell on average
STEP = 1024  # candidates scored at a time
HEAD = 4  # one in HEAD coordinates belongs to the partial sum


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id and components floor(64 * x) of the rows that take part, one row per vec_id.

    Left out are NULL vec_ids, NULL vectors, and vectors with a NULL or non-finite component. Of
    several rows with one vec_id the least vector stays.
    """
    whole = (
        F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
        & F.col("vec_id").isNotNull()
    )
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 64).cast("long"))
    return (
        vectors.where(F.coalesce(whole, F.lit(False)))
        .select("vec_id", scaled.alias("v"))
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
    )


def _scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer products; in doubles where these hold them exactly."""
    most = [float(np.abs(m.astype(np.float64)).max(initial=0)) for m in (queries, candidates)]
    if most[0] * most[1] * queries.shape[1] < 2**53:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    return queries @ candidates.T


def best_of_cell(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, candidates: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query positions, candidate ids and scores of each query's k best in the cell; ties go to
    the smaller id, and a candidate with the query's id is left out."""
    real_q, real_c = queries.astype(np.float64), candidates.astype(np.float64)
    lengths = np.linalg.norm(real_c, axis=1)
    order = np.lexsort((ids, -lengths))
    ids, candidates, real_c, lengths = ids[order], candidates[order], real_c[order], lengths[order]
    width = queries.shape[1]
    _, axes = np.linalg.eigh(real_c.T @ real_c)
    axes = axes[:, ::-1]
    head = max(1, width // HEAD)
    turned_q, turned_c = real_q @ axes, real_c @ axes
    rest_q = np.linalg.norm(turned_q[:, head:], axis=1)
    rest_c = np.linalg.norm(turned_c[:, head:], axis=1)
    longest = np.linalg.norm(real_q, axis=1)
    low = np.iinfo(np.int64).min
    n = len(query_ids)
    best = np.full((n, 0), low)
    best_ids = np.full((n, 0), 0, np.int64)
    floor = np.full(n, -np.inf)
    for start in range(0, len(ids), STEP):
        part = slice(start, start + STEP)
        slack = 1e-6 * (1 + longest * lengths[start])
        live = np.flatnonzero(longest * lengths[start] + slack >= floor)
        if not len(live):
            break
        bound = turned_q[live, :head] @ turned_c[part, :head].T
        bound += np.outer(rest_q[live], rest_c[part]) + slack[live, None]
        hopeful = bound >= floor[live, None]
        some_q, some_c = hopeful.any(axis=1), hopeful.any(axis=0)
        live, hopeful = live[some_q], hopeful[some_q][:, some_c]
        if not len(live):
            continue
        part_ids = ids[part][some_c]
        scores = _scores(queries[live], candidates[part][some_c])
        scores[~hopeful | (query_ids[live, None] == part_ids[None, :])] = low
        scores = np.hstack([best[live], scores])
        all_ids = np.hstack([best_ids[live], np.broadcast_to(part_ids, (len(live), len(part_ids)))])
        kept = min(k, scores.shape[1])
        if best.shape[1] < kept:
            more = kept - best.shape[1]
            best = np.hstack([best, np.full((n, more), low)])
            best_ids = np.hstack([best_ids, np.zeros((n, more), np.int64)])
        for row, q in enumerate(live):
            line = scores[row]
            if len(line) > kept:
                least = np.partition(line, len(line) - kept)[len(line) - kept]
                at = np.flatnonzero(line >= least)
            else:
                at = np.arange(len(line))
            at = at[np.lexsort((all_ids[row, at], -line[at]))][:kept]
            best[q], best_ids[q] = low, 0
            best[q, : len(at)], best_ids[q, : len(at)] = line[at], all_ids[row, at]
            if kept == k and best[q, k - 1] > low:
                floor[q] = best[q, k - 1]
    at_q, at_k = np.nonzero(best > low)
    return at_q, best_ids[at_q, at_k], best[at_q, at_k]


def top_k(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all rows for each row whose vec_id is
    divisible by `every`; all of them where there are fewer.

    Vectors of different dimension do not meet. See `integers` for the rows that take part.
    """
    rows = integers(vectors)
    is_query = F.col("vec_id") % every == 0
    size = rows.agg(F.count("*").alias("all"), F.count_if(is_query).alias("asked")).first()
    blocks = max(1, -(-size["asked"] // QUERIES))
    groups = max(1, -(-size["all"] // CANDIDATES))

    def dealt(own: str, n: int, other: str, copies: int) -> DataFrame:
        return (
            rows.withColumn("dim", F.size("v"))
            .withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        )

    def cell(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        empty = {"query_id": [], "vec_id": [], "score": []}
        if not len(queries) or not len(candidates):
            return pd.DataFrame(empty, dtype="int64")
        q, c = (np.array(side["v"].tolist(), np.int64) for side in (queries, candidates))
        query_ids, ids = (side["vec_id"].to_numpy(np.int64) for side in (queries, candidates))
        if not q.shape[1]:
            q, c = (np.zeros((len(m), 1), np.int64) for m in (q, c))
        at, found, scores = best_of_cell(query_ids, q, ids, c, k)
        return pd.DataFrame({"query_id": query_ids[at], "vec_id": found, "score": scores})

    grid = ["dim", "block", "group"]
    asked = dealt("block", blocks, "group", groups).where(is_query).groupBy(grid)
    offered = dealt("group", groups, "block", blocks).groupBy(grid)
    found = asked.cogroup(offered).applyInPandas(cell, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
