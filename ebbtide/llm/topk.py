"""Exact k best inner products by a Voronoi join.

Inner products become distances: with M the largest norm, data x gets the extra coordinate sqrt(M^2 - |x|^2) and
queries 0, so |q - x|^2 = |q|^2 + M^2 - 2 q.x. Queries and data go to their nearest pivot; from the radius and the
smallest distances of each data cell follows how far the k-th neighbour of any query of a cell can be, and from
that which data a query cell needs. Only those rows are sent to it; each task solves a block exactly, in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import staged
from .vectors import matrix, packed

PIVOT_SAMPLE = 2000     # rows, at most, from which pivots are taken
QUERIES_PER_CELL = 256  # wanted; sets the number of pivots
MAX_PIVOTS = 64
QUERY_BLOCK, DATA_BLOCK = 512, 8192
EXACT = float(1 << 53)


def integers(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(vectors * scale)


def pivots_of(sample: np.ndarray, count: int) -> np.ndarray:
    """Far-apart rows of the sample, one after the other the farthest from those taken."""
    taken = [0]
    far = ((sample - sample[0]) ** 2).sum(1)
    while len(taken) < min(count, len(sample)) and far.max() > 0:
        taken.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[taken[-1]]) ** 2).sum(1))
    return sample[taken]


def distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray, pivot_extra: np.ndarray) -> np.ndarray:
    sq = (x * x).sum(1)[:, None] + (extra * extra)[:, None] + ((pivots * pivots).sum(1) + pivot_extra ** 2)[None]
    return np.sqrt(np.maximum(sq - 2 * (x @ pivots.T + np.outer(extra, pivot_extra)), 0))


def exact_top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every query (vec_id divisible by `every`).

    Components become floor(scale * x). Unusable vectors and null ids take no part; vectors meet only those of
    their own length; ties go to the smaller vec_id. Rows that repeat an id are candidates each, but not for
    the query of that id; of the rows of a query's id the shortest asks, then the first in the byte order of its
    little-endian components. Fewer than k candidates: all of them. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = staged(packed(vectors.where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")), "vectors")
    asking = staged(rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("dim", "vector")).alias("q"))
                    .select("vec_id", "q.dim", "q.vector"), "asking")
    parts = [_one_length(*(f.where(F.col("dim") == d[0]).drop("dim") for f in (rows, asking)), d[0], k, scale)
             for d in rows.select("dim").distinct().orderBy("dim").toLocalIterator()]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")  # k rows a block
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _one_length(rows: DataFrame, queries: DataFrame, dim: int, k: int, scale: int) -> DataFrame:
    top = rows.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"top": [float((integers(matrix(b.column("vector"), dim), scale) ** 2).sum(1).max())]})
                                      for b in bs if b.num_rows), "top double").agg(F.max("top")).first()[0]
    if top > EXACT / 4:
        raise ValueError("components too large for exact integer scores")
    norm = float(np.sqrt(top)) + 1e-9
    n, total = queries.count(), rows.count()
    fraction = -(-PIVOT_SAMPLE * 1_000_000 // max(1, total))
    sample = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < fraction).limit(2 * PIVOT_SAMPLE).toArrow().sort_by("vec_id")
    if not sample.num_rows:
        sample = rows.limit(1).toArrow()
    wanted = max(1, min(MAX_PIVOTS, -(-n // QUERIES_PER_CELL)))
    centres = pivots_of(integers(matrix(sample["vector"], dim), scale), wanted)
    beyond = np.sqrt(np.maximum(norm ** 2 - (centres ** 2).sum(1), 0))

    def cells(x: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(norm ** 2 - (x * x).sum(1), 0))
        d = distances(x, extra, centres, beyond)
        own = d.argmin(1)
        return own.astype(np.int32), d[np.arange(len(x)), own]

    def placed_as(query: bool):
        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = integers(matrix(b.column("vector"), dim), scale)
                own, far = cells(x, query)
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array([v.tobytes() for v in x.astype("<f8")], pa.binary()), pa.array(own), pa.array(far)],
                                                 names=["vec_id", "ints", "cell", "far"])
        return place

    schema = "vec_id long, ints binary, cell int, far double"
    placed = staged(rows.mapInArrow(placed_as(False), schema), "cells")
    asked = staged(queries.mapInArrow(placed_as(True), schema), "queries")
    # Summaries: at most MAX_PIVOTS rows, each with the k + 1 nearest ids of a cell (one may be the query's own).
    nearest = placed.groupBy("cell", "vec_id").agg(F.min("far").alias("far"))
    near = (nearest.withColumn("r", F.row_number().over(Window.partitionBy("cell", F.pmod(F.xxhash64("vec_id"), F.lit(64))).orderBy("far", "vec_id")))
            .where(F.col("r") <= k + 1).groupBy("cell").agg(F.slice(F.array_sort(F.collect_list(F.struct("far", "vec_id"))), 1, k + 1).alias("near")).collect())
    size = {r[0]: r[1] for r in placed.groupBy("cell").count().collect()}
    reach = {r[0]: (r[1], r[2]) for r in asked.groupBy("cell").agg(F.max("far"), F.count("*")).collect()}
    between = distances(centres, beyond, centres, beyond)
    slack = 1e-6 * (1 + norm)
    plan = []  # (data cell, query cell, least and largest distance to the pivot, query blocks, data blocks)
    for q, (radius, number) in reach.items():
        least: dict[int, float] = {}  # by id: one that repeats can lie in several cells
        for r in near:
            for far, own in r["near"]:
                least[own] = min(least.get(own, float("inf")), between[q, r["cell"]] + radius + far)
        bounds = sorted(least.values())
        limit = bounds[min(k, len(bounds) - 1)] if len(bounds) > k else float("inf")
        for c in size:
            lo, hi = between[q, c] - radius - limit - slack, between[q, c] + radius + limit + slack
            plan.append((c, q, float(lo), float(hi), -(-number // QUERY_BLOCK), -(-size[c] // DATA_BLOCK)))
    if not plan:
        return rows.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    routes = F.broadcast(rows.sparkSession.createDataFrame(plan, "c int, q int, lo double, hi double, q_blocks int, blocks int"))
    h = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 30))
    data = (placed.join(routes, F.col("cell") == F.col("c")).where(F.col("far").between(F.col("lo"), F.col("hi")))
            .select("q", "c", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("qb"), (h % F.col("blocks")).cast("int").alias("db"),
                    F.lit(False).alias("is_q"), "vec_id", "ints"))
    asked = (asked.join(routes, F.col("cell") == F.col("q"))
             .select("q", "c", (h % F.col("q_blocks")).cast("int").alias("qb"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("db"),
                     F.lit(True).alias("is_q"), "vec_id", "ints"))

    def solve(group: pa.Table) -> pa.Table:
        is_q = group["is_q"].to_numpy()
        x, ids = matrix(group["ints"], dim), group["vec_id"].to_numpy()
        q, qid, d, did = x[is_q], ids[is_q], x[~is_q], ids[~is_q]
        out = [best_of(q[a:a + 64], qid[a:a + 64], d, did, k) for a in range(0, len(q), 64)] if len(d) else []
        cols = [np.concatenate([np.zeros(0, np.int64), *(o[i] for o in out)]) for i in range(3)]
        return pa.table(cols, names=["query_id", "vec_id", "score"])

    return data.unionByName(asked).groupBy("q", "c", "qb", "db").applyInArrow(solve, "query_id long, vec_id long, score long")


def best_of(q: np.ndarray, qid: np.ndarray, d: np.ndarray, did: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of the data for each query, itself left out, ties to the smaller id."""
    s = q @ d.T
    s[qid[:, None] == did[None]] = -np.inf
    if s.shape[1] > k:
        kth = np.partition(s, s.shape[1] - k, axis=1)[:, -k]
        row, col = np.nonzero((s >= kth[:, None]) & np.isfinite(s))
    else:
        row, col = np.nonzero(np.isfinite(s))
    order = np.lexsort((did[col], -s[row, col], row))
    row, col = row[order], col[order]
    first = np.searchsorted(row, row)
    keep = np.arange(len(row)) - first < k
    row, col = row[keep], col[keep]
    return qid[row], did[col], s[row, col].astype(np.int64)

