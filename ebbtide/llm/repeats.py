"""Removal of word windows that repeat from a document with a smaller id, by rolling (Rabin-Karp) hashes.

Prefix sums of word hashes times powers of an odd base give the hash of any window of words in one subtraction and one
product. Every window of `window` words hangs on its anchor, the least hash among the windows of `piece` words in it;
equal windows have equal anchors. Neighbouring windows with one anchor are a run, of 14 windows on average, and a run is
counted by the hash of the words that it spans. So counting goes from coarse to fine, and nothing is left out:

1. Anchors that only one id has settle their runs: no window of them repeats.
2. Of runs with equal spans, all but those of the smallest id repeat as a whole.
3. What is left are runs of the smallest id of their span whose anchor occurs in other spans. Each window of one such run
   for each span is counted by its own 128-bit hash.

Repeated windows merge into maximal intervals in the document. A hot passage, or a group of copies, is combined before
every shuffle into its smallest id; rows meet that result in joins, which adaptive execution can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import staged
from .text import mix, pieces, raw, word_runs

WINDOW, PIECE = 50, 24
NO_ID = (1 << 63) - 1
# Fixed odd bases of the two rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
SECOND = np.uint64(0x5851F42D4C957F2D)


def powers_of(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Rolling:
    """Hashes of word ranges of one sequence: sums of word hashes times powers of the base, shifted to power 0."""

    powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, words: np.ndarray, base: int):
        n = len(words) + 1
        up, down = self.powers.get(base, ((), ()))
        if len(up) < n:
            up, down = self.powers[base] = tuple(powers_of(b, max(n, 1 << 16)) for b in (base, pow(base, -1, 1 << 64)))
        self.down = down
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up[:n - 1])))

    def of(self, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[first]) * self.down[first] + (stop - first).astype(np.uint64))


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, by doubling."""
    size = 1
    while size < width:
        step = min(size, width - size)
        values = np.minimum(values[:-step], values[step:]) if len(values) > step else values[:0]
        size += step
    return values


def both(words: np.ndarray) -> tuple[Rolling, Rolling]:
    return Rolling(words, BASES[0]), Rolling(mix(words ^ SECOND), BASES[1])


def runs_of(words: np.ndarray, bounds: np.ndarray, window: int, piece: int) -> tuple[np.ndarray, ...]:
    """(text, anchor, span hash 1, span hash 2, first window, last window) of each run, windows counted in the sequence."""
    none = tuple(np.zeros(0, np.uint64 if 0 < i < 4 else np.int64) for i in range(6))
    if len(words) < window:
        return none
    a, b = both(words)
    starts = np.arange(len(words) - piece + 1)
    anchor = least_of(a.of(starts, starts + piece), window - piece + 1)
    start = np.arange(len(anchor))
    text = np.searchsorted(bounds, start, "right") - 1
    inside = np.flatnonzero(start + window <= bounds[text + 1])  # the others reach into the next text
    if not len(inside):
        return none
    new = np.flatnonzero((np.diff(inside, prepend=-2) != 1) | np.diff(text[inside], prepend=-1).astype(bool)
                         | np.concatenate(([True], anchor[inside][1:] != anchor[inside][:-1])))
    first = inside[new]
    last = inside[np.concatenate((new[1:] - 1, [len(inside) - 1]))]
    return text[first], anchor[first], a.of(first, last + window), b.of(first, last + window), first, last


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def scan(documents: DataFrame, window: int, piece: int) -> DataFrame:
    """Rows of runs, and for each document one row with n_words and the digest of its words.

    (doc_id, key, n_words, whole_sha256, anchor, s1, s2, first, last); the last five are lists. A text longer than
    256 kB gives a row for each piece; all but its last have no n_words.
    """
    schema = ("doc_id long, key long, n_words long, whole_sha256 string, anchor array<long>, s1 array<long>, s2 array<long>,"
              " first array<long>, last array<long>")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw(batch.column(2))
            for at, words, bounds, before, last in word_runs(texts, keep=window - 1):
                rows = len(bounds) - 1
                text, *values = runs_of(words, bounds, window, piece)
                base = bounds[text] - before
                values[3:] = values[3] - base, values[4] - base
                offsets = pa.array(np.searchsorted(text, np.arange(rows + 1)).astype(np.int32))
                n = bounds[1:] - bounds[:-1] + before
                whole = [digest_kept(texts[i], None) if last else None for i in range(at, at + rows)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, rows), batch.column(1).slice(at, rows), pa.array(n if last else [None] * rows, pa.int64()),
                     pa.array(whole, pa.string())]
                    + [pa.ListArray.from_arrays(offsets, pa.array(v.view(np.int64))) for v in values],
                    names=["doc_id", "key", "n_words", "whole_sha256", "anchor", "s1", "s2", "first", "last"])

    return documents.mapInArrow(read, schema)


def digest_kept(data: bytes, removed: np.ndarray | None) -> str:
    """sha256 of the kept words, joined by one space; `removed` says for each word whether it goes (None: none goes)."""
    out, gap, at = hashlib.sha256(), b"", 0
    for part in pieces(data):
        words = part.split()
        if removed is not None:
            gone = removed[at:at + len(words)]
            at += len(words)
            words = [w for w, g in zip(words, gone) if not g]
        if words:
            out.update(gap + b" ".join(words))
            gap = b" "
    return out.hexdigest()


def windows_of(documents: DataFrame, window: int) -> DataFrame:
    """(s1, s2, at, w1, w2, own): every window of the listed runs; `documents` hold own, text and spans."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, own, spans = raw(batch.column(1)), batch.column(0).to_numpy(), batch.column(2)
            for at, words, bounds, before, _ in word_runs(texts, keep=window - 1):
                listed = spans.slice(at, len(bounds) - 1)
                fields = listed.flatten()
                text = np.repeat(np.arange(len(listed)), np.diff(listed.offsets.to_numpy()))
                s1, s2, first, last = (fields.field(i).to_numpy() for i in range(4))
                base = bounds[text] - before
                first, last = first + base, last + base
                here = np.flatnonzero((first >= 0) & (last + window <= len(words)))
                if not len(here):
                    continue
                size = (last - first)[here] + 1
                run = np.repeat(here, size)
                place = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
                start = first[run] + place
                a, b = both(words)
                for cut in range(0, len(run), 100_000):
                    r, s = run[cut:cut + 100_000], start[cut:cut + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v) for v in (s1[r], s2[r], place[cut:cut + 100_000], _signed(a.of(s, s + window)),
                                               _signed(b.of(s, s + window)), own[at + text[r]])],
                        names=["s1", "s2", "at", "w1", "w2", "own"])

    return documents.mapInArrow(read, "s1 long, s2 long, at long, w1 long, w2 long, own long")


def cut(documents: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans) of (doc_id, text, spans: first word and end of repeats, any order)."""
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<first:long,stop:long>>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                value = batch.column(1)[row]
                data = value.as_buffer().to_pybytes() if value.is_valid else b""
                n = sum(len(p.split()) for p in pieces(data))
                listed = batch.column(2).slice(row, 1).flatten()
                change = np.zeros(n + 1, np.int64)
                np.add.at(change, listed.field(0).to_numpy(), 1)
                np.add.at(change, listed.field(1).to_numpy(), -1)
                gone = np.cumsum(change[:n]) > 0
                edges = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                yield pa.RecordBatch.from_pylist(
                    [{"doc_id": batch.column(0)[row].as_py(), "n_words": n, "n_removed": int(gone.sum()), "kept_sha256": digest_kept(data, gone),
                      "spans": [{"first": a, "stop": b} for a, b in edges.reshape(-1, 2).tolist()]}], schema=out)

    span = pa.struct([("first", pa.int64()), ("stop", pa.int64())])
    out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(span))])
    return documents.mapInArrow(read, schema)


def own_id(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(NO_ID))


def remove_repeats(documents: DataFrame, window: int = WINDOW, piece: int = PIECE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and spans, the maximal removed intervals in words.

    A word goes if a window of `window` words covers it whose words also start in a document with a smaller id. Rows
    with one id do not remove from each other, and each gets its own row. Rows without an id count as after all others.
    Null and empty texts have no words. An empty table gives no rows. Other columns are not read.
    """
    if not 0 < piece <= window:
        raise ValueError("a piece must fit the window")
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    scanned = staged(scan(docs, window, piece), "windows")
    runs = scanned.where(F.size("anchor") > 0).select(
        own_id("doc_id").alias("own"), "key", F.inline(F.arrays_zip("anchor", "s1", "s2", "first", "last")))
    met = runs.groupBy("anchor").agg(F.min("own").alias("lo"), F.max("own").alias("hi")).where("lo < hi").select("anchor")
    shared = staged(runs.join(met, "anchor"), "shared-runs")
    spans = staged(shared.groupBy("anchor", "s1", "s2").agg(F.min(F.struct("own", "key", "first", "last")).alias("head"), F.max("own").alias("most")), "spans")
    several = (spans.groupBy("anchor").agg(F.min("head.own").alias("lo"), F.max("head.own").alias("hi"))
               .where("lo < hi").select("anchor"))
    listed = (spans.join(several, "anchor")
              .groupBy(F.col("head.own").alias("_own"), F.col("head.key").alias("_key"))
              .agg(F.collect_list(F.struct("s1", "s2", F.col("head.first").alias("first"), F.col("head.last").alias("last"))).alias("spans")))
    texts = docs.join(listed, (own_id("doc_id") == F.col("_own")) & (docs["key"] == F.col("_key")))
    windows = staged(windows_of(texts.select(own_id("doc_id").alias("own"), "text", "spans"), window), "single-windows")
    # Sets, not lists, from here on: rows equal in id and text say the same.
    seen = windows.groupBy("w1", "w2").agg(F.min("own").alias("lo"), F.max("own").alias("hi")).where("lo < hi").select("w1", "w2", "lo")
    single = (windows.join(seen, ["w1", "w2"]).where("own > lo").groupBy("s1", "s2").agg(F.collect_set("at").alias("at")))
    decided = (spans.select("s1", "s2", F.col("head.own").alias("least"), (F.col("head.own") < F.col("most")).alias("again"))
               .join(single, ["s1", "s2"], "left").where(F.col("again") | F.col("at").isNotNull()))
    whole = F.array(F.struct(F.col("first").alias("first"), (F.col("last") + window).alias("stop")))
    some = F.transform(F.coalesce("at", F.array().cast("array<long>")),
                       lambda x: F.struct((F.col("first") + x).alias("first"), (F.col("first") + x + window).alias("stop")))
    hits = (shared.join(decided, ["s1", "s2"]).withColumn("spans", F.when(F.col("own") > F.col("least"), whole).otherwise(some))
            .where(F.size("spans") > 0).groupBy(F.col("own").alias("_own"), F.col("key").alias("_key"))
            .agg(F.flatten(F.collect_set("spans")).alias("spans")))
    hits = staged(hits, "repeated-windows")
    touched = cut(docs.join(hits, (own_id("doc_id") == F.col("_own")) & (docs["key"] == F.col("_key"))).select("doc_id", "text", "spans"))
    ends = scanned.where(F.col("n_words").isNotNull())
    clean = (ends.join(hits, (own_id("doc_id") == F.col("_own")) & (ends["key"] == F.col("_key")), "left_anti")
             .select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("whole_sha256").alias("kept_sha256"),
                     F.array().cast(touched.schema["spans"].dataType).alias("spans")))
    return touched.unionByName(clean)
