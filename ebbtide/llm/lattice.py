"""Near-duplicate vectors by lattice hashing: projections decoded to E8 points in several tables, nearby cells probed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import components, staged
from .jaccard import centred
from .text import mix
from .vectors import matrix, packed

# Measured: 0.96 of the pairs at cosine 0.9 share a cell, all at 0.95; chance cells hold 1 % of 6,000 random rows' keys.
TABLES, PROBES, BLOCKS_OF_8, SCALE = 16, 4, 3, 1.3
BLOCK = 768


def decode(y: np.ndarray, points: int = 2) -> list[np.ndarray]:
    """The `points` nearest E8 points (twice their coordinates, as integers) of each row, nearest first.

    E8 is D8 and D8 shifted by a half; D8 holds the integer points of even sum. Of each coset the rounded point,
    made even by its worst coordinates, and two alternatives are ranked by distance.
    """
    found, far = [], []
    n = np.arange(len(y))
    for shift in (0.0, 0.5):
        r = np.round(y - shift)
        off = (y - shift) - r
        worst = np.argsort(-np.abs(off), axis=1)
        step = np.where(off >= 0, 1.0, -1.0)
        odd = r.sum(1) % 2 != 0
        for which in ((0,), (1,), (2,)):
            z = r.copy()
            # Odd sum: move one coordinate; even sum: the point itself, or two coordinates moved.
            i = worst[n, which[0]]
            z[n[odd], i[odd]] += step[n[odd], i[odd]]
            if which[0]:
                even = ~odd
                z[n[even], worst[even, 0]] += step[n[even], worst[even, 0]]
                z[n[even], i[even]] += step[n[even], i[even]]
            found.append(z + shift)
            far.append(((y - z - shift) ** 2).sum(1))
    order = np.argsort(np.stack(far, 1), axis=1, kind="stable")
    every = np.stack(found, 1)
    return [np.round(2 * every[n, order[:, p]]).astype(np.int64) for p in range(points)]


class Hasher:
    def __init__(self, dim: int, tables: int = TABLES, probes: int = PROBES, blocks: int = BLOCKS_OF_8, scale: float = SCALE, seed: int = 12):
        rng = np.random.default_rng(seed)
        self.g = rng.normal(0, 1 / np.sqrt(8), (tables, blocks, dim, 8)) * scale
        self.probes, self.factors = probes, rng.integers(1, 2**62, (blocks, 8), dtype=np.int64) * 2 + 1

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """(rows, tables, 1 + probes) cell keys: the own cell, then one block moved to its next point, ..., both moved."""
        out = []
        for t, blocks in enumerate(self.g):
            with np.errstate(over="ignore"):
                own, next_ = zip(*([(z * f).sum(1) for z in decode(unit @ g)] for g, f in zip(blocks, self.factors)))
                changes = [(), *[(b,) for b in range(len(blocks))], tuple(range(len(blocks)))][:1 + self.probes]
                keys = [sum((next_[b] if b in c else own[b]) for b in range(len(blocks))) for c in changes]
            out.append(np.stack([mix(k.view(np.uint64) + mix(np.full(len(k), t + 1, np.uint64))) for k in keys], 1))
        return np.stack(out, 1).view(np.int64)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # squares of very large or small components stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cell_rows(vectors: DataFrame, hasher_for) -> DataFrame:
    """(key, id, centre) of every cell that a vector lies in or probes; centre is null, as no row is combined here."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers: dict[int, Hasher] = {}
        for b in batches:
            dims, ids = b.column("dim").to_numpy(), b.column("id").to_numpy()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = matrix(b.column("vector").take(pa.array(at)), int(d))
                if d not in hashers:
                    hashers[d] = hasher_for(int(d))
                keys = hashers[d].cells(unit(x))
                keys = (keys.view(np.uint64) + mix(np.full(1, d, np.uint64))).view(np.int64).reshape(len(x), -1)
                own = np.repeat(ids[at], keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(own), pa.nulls(len(own), pa.int64())],
                                                 names=["key", "id", "centre"])

    return vectors.mapInArrow(emit, "key long, id long, centre long")


def linked_in(x: np.ndarray, ids: np.ndarray, threshold: float, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of unit rows with cosine >= threshold."""
    found = []
    for a in range(0, len(x), block):
        c = x[a:a + block] @ x[a:].T
        i, j = np.nonzero(c >= threshold - 1e-9)
        keep = j > i
        i, j = i[keep] + a, j[keep] + a
        exact = (x[i] * x[j]).sum(1) >= threshold
        found.append((i[exact], j[exact]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest index of each row's connected part, by repeated minima and pointer jumps."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def near_duplicates(embeddings: DataFrame, threshold: float = .9, hasher_for=Hasher) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept (vec_id = component_id).

    Equal vectors are one node with a count, so copies are never paired. Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing. Rows that repeat a vec_id count as one vector, that with the
    smallest hash, and each of them gets its result. Vectors link only with those of their own length. An empty table gives no rows.
    """
    sound = embeddings.where("vec_id IS NOT NULL").where(F.exists("embedding", lambda x: x != 0))
    rows = staged(packed(sound.select(F.col("vec_id").cast("long").alias("id"), "embedding")), "vectors")
    # Two 64-bit hashes name a vector.
    named = (rows.groupBy("id").agg(F.min(F.struct(F.xxhash64("vector").alias("h1"), F.xxhash64("vector", F.lit(1)).alias("h2"))).alias("h"))
             .select("id", "h.h1", "h.h2"))
    named = staged(named, "names")
    classes = staged(named.groupBy("h1", "h2").agg(F.min("id").alias("node"), F.count("*").alias("copies")), "classes")
    nodes = rows.join(classes.select(F.col("node").alias("id"), "copies", "h1", "h2"), "id")
    nodes = nodes.where((F.xxhash64("vector") == F.col("h1")) & (F.xxhash64("vector", F.lit(1)) == F.col("h2"))).drop("h1", "h2")
    nodes = staged(nodes.dropDuplicates(["id"]), "nodes")
    # Cells with two nodes or more; a node's list of them is bounded by the tables and probes.
    members = centred(cell_rows(nodes.select("id", "dim", "vector"), hasher_for).repartition("key")).select("key", "id").distinct()
    members = staged(members, "members")
    lists = members.groupBy("id").agg(F.sort_array(F.collect_list("key")).alias("cells"))
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    loaded = nodes.join(lists, "id").select("id", "copies", "dim", "vector", "cells", F.explode("cells").alias("key")).join(sizes, "key")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = (loaded.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", "id", "copies", "dim", "vector", "cells", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")))

    def solve(group: pa.Table) -> pa.Table:
        key, x, y = (group[c][0].as_py() for c in ("key", "x", "y"))
        group = group.sort_by("id")
        ids, copies, own = (group[c].to_numpy() for c in ("id", "copies", "own"))
        v = unit(matrix(group["vector"], group["dim"][0].as_py()))
        i, j = linked_in(v, ids, threshold)
        if x != y:
            cross = own[i] != own[j]
            i, j = i[cross], j[cross]
        links = np.zeros(len(ids), np.int64)
        if len(i):
            # A pair counts only in the smallest cell that both share.
            lists = group["cells"].combine_chunks()
            cells, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
            low = cells < key
            _, column = np.unique(cells[low], return_inverse=True)
            lower = np.zeros((len(ids), int(column.max(initial=-1)) + 1), np.float32)
            lower[owner[low], column] = 1
            first = (lower @ lower.T)[i, j] == 0
            np.add.at(links, i[first], copies[j[first]])
            np.add.at(links, j[first], copies[i[first]])
        root = ids[forest(i, j, len(ids))]
        out = (links > 0) | (root != ids)
        return pa.table([ids[out], links[out], root[out]], names=["id", "links", "root"])

    solved = staged(dealt.groupBy("key", "x", "y").applyInArrow(solve, "id long, links long, root long"), "solved")
    counts = solved.groupBy("id").agg(F.sum("links").alias("links"))
    found = components(solved.select(F.col("id").alias("a"), F.col("root").alias("b")))
    node = (classes.join(counts, classes["node"] == counts["id"], "left").drop("id").join(found, F.col("node") == F.col("id"), "left")
            .select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")))
    results = named.join(node, ["h1", "h2"]).select("id", "n_links", "component_id")
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id")).join(results, F.col("vec_id") == F.col("id"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
