"""Packing into windows: repeat counts of length combinations by non-negative least squares, the rest packed greedily."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import ranked, staged
from .tokens import default_vocabulary, encoded

WINDOW, STEP, DEPTH, END_ID = 2048, 8, 3, 1


def combinations(bins: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All multisets of up to `depth` bin sizes that fill exactly `bins` units."""
    out = [(bins,)]
    for size in range(2, depth + 1):
        for head in combinations_with_replacement(range(1, bins), size - 1):
            last = bins - sum(head)
            if last >= head[-1]:
                out.append((*head, last))
    return out


def solve(histogram: np.ndarray, patterns: list[tuple[int, ...]], rounds: int = 300) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - histogram|, A counting each bin in each pattern.

    Multiplicative updates keep x non-negative without a step size; A is sparse and used by index only.
    """
    bins = len(histogram) - 1
    column = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    row = np.concatenate([np.asarray(p) for p in patterns])
    target = histogram.astype(np.float64)
    x = np.minimum.reduceat(target[row], np.concatenate(([0], np.cumsum([len(p) for p in patterns])[:-1])))
    x /= max(1.0, len(patterns) / (4 * bins))
    up = np.bincount(column, target[row], len(patterns))
    for _ in range(rounds):
        fitted = np.bincount(row, x[column], bins + 1)
        x *= up / np.maximum(np.bincount(column, fitted[row], len(patterns)), 1e-12)
    return x


def plan(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that use up the histogram of bins 1..n exactly; patterns fill at most n units.

    Solved counts are rounded down and clipped to what is left; the rest is packed greedily, on counts: the
    largest bin left takes the largest that fit beside it, as often as the counts allow.
    """
    bins, left = len(histogram) - 1, histogram.astype(np.int64).copy()
    out = [((bins,), int(left[bins]))] if left[bins] else []
    left[bins] = 0
    patterns = combinations(bins)
    x = solve(left, patterns)
    for i in np.argsort(-x, kind="stable"):
        need = dict(zip(*np.unique(patterns[i], return_counts=True)))
        times = min([int(x[i]), *(int(left[b]) // int(q) for b, q in need.items())])
        if times > 0:
            out.append((patterns[i], times))
            for b, q in need.items():
                left[b] -= times * q
    while (present := np.flatnonzero(left)).size:
        room, pattern, held = bins, [], left.copy()
        while (fit := np.flatnonzero(held[:room + 1])).size:
            b = int(fit[-1])
            take = min(int(held[b]), room // b)
            pattern += [b] * take
            held[b] -= take
            room -= take * b
        need = dict(zip(*np.unique(pattern, return_counts=True)))
        times = min(int(left[b]) // int(q) for b, q in need.items())
        out.append((tuple(pattern), times))
        for b, q in need.items():
            left[b] -= times * q
    return out


def cut_documents(documents: DataFrame, vocabulary: str | None = None, window: int = WINDOW) -> DataFrame:
    """Pieces of every document's ids (the end id included): whole windows, then what remains."""
    path = vocabulary or default_vocabulary()
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, start, length, crc, total = [], [], [], [], []
            for row, ids in enumerate(encoded(b.column("text"), path)):
                own = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for s in range(0, len(own), window):
                    part = own[s:s + window]
                    doc.append(row)
                    start.append(s)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    total.append(len(own))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(doc, pa.int64())), *(pa.array(v, pa.int64()) for v in (start, length, crc, total))],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def pack(documents: DataFrame, vocabulary: str | None = None, window: int = WINDOW, step: int = STEP) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, filled (of the sequence).

    Null and empty texts hold the end id only. Lengths count as multiples of `step`, so the histogram, the
    patterns and their intervals are bounded by the window, whatever the input. Repeated rows are packed
    one by one. An empty table gives no rows.
    """
    if window % step:
        raise ValueError("the window must be a multiple of the step")
    bins = window // step
    pieces = staged(cut_documents(documents, vocabulary, window).withColumn("bin", F.ceil(F.col("length") / step).cast("int")), "pieces")
    histogram = np.zeros(bins + 1, np.int64)
    for row in pieces.groupBy("bin").count().collect():  # at most `bins` rows
        histogram[row[0]] = row[1]
    # For each bin: ranks [low, ...) go to sequences base, base + 1, ..., `each` at a time, after `slot` others.
    intervals: dict[int, list[tuple[int, int, int, int]]] = {}
    used, sequences = np.zeros(bins + 1, np.int64), 0
    for pattern, times in plan(histogram) if histogram.any() else []:
        slot = 0
        for b, each in zip(*(v.tolist() for v in np.unique(pattern, return_counts=True))):
            intervals.setdefault(b, []).append((int(used[b]), sequences, each, slot))
            used[b] += each * times
            slot += each
        sequences += times
    tables = {b: np.asarray(v, np.int64) for b, v in intervals.items()}
    order = ranked(pieces, "bin", ["doc_id", "start", "ids_crc32", "length"], "rank")
    schema = order.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("slot", F.lit(0).cast("long")).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, rank = batch.column("bin").to_numpy(), batch.column("rank").to_numpy()
            sequence, slot = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for b in np.unique(kind):
                own, t = kind == b, tables[int(b)]
                i = np.searchsorted(t[:, 0], rank[own], "right") - 1
                inside = rank[own] - t[i, 0]
                sequence[own] = t[i, 1] + inside // t[i, 2]
                slot[own] = t[i, 3] + inside % t[i, 2]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(slot)], names=schema.names)

    own = Window.partitionBy("sequence_id")  # at most `window` pieces
    ahead = F.sum("length").over(own.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1))
    return (order.mapInArrow(place, schema)
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                    F.coalesce(ahead, F.lit(0)).cast("long").alias("offset"), F.sum("length").over(own).alias("filled")))
