"""Importance resampling towards a target: bucket histograms of word runs, log-ratio gains, Gumbel top-k.

Words come from an untrained pre-tokeniser of the `tokenizers` library, a regular expression that splits ASCII-lowered
text, as byte offsets; pairs of offsets over the words joined by one space cut out each run of words. A run's bucket is
its CRC-32. Texts are split once: a document's bucket counts are staged, so that the corpus histogram, the gains (a table as
long as there are buckets) and the sums need no second pass over the text.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import arrow_rows, each_copy, staged
from .text import lower_table

BUCKETS, RUN = 10_000, (1, 1)
LEAST_WORDS, PERCENT, SEED = 20, 10, "2024"
# Fixed value: what stands between words, once A-Z are lowered.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
PIECE_BYTES = 2048  # the splitter is fastest on short strings
KNOWN_FEATURES = 50_000
TEXT_ROWS, SLICE_ROWS = 1000, 100  # texts that reach Python at once, and whose counts are held at once


def splitter():
    """Byte offsets of the words of a text of which A-Z are lowered."""
    from tokenizers import PreTokenizedString, Regex, pre_tokenizers
    split = pre_tokenizers.Split(Regex(GAP + "+"), behavior="removed")

    def offsets(text: str) -> list[tuple[int, int]]:
        held = PreTokenizedString(text)
        split.pre_tokenize(held)
        return [place for _, place, _ in held.get_splits("original", "byte")]

    return offsets


def pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The text in runs of about `size` bytes, cut between words."""
    gap, at = re.compile(GAP.encode()), 0
    while len(data) - at > size:
        found = gap.search(data, at + size)
        if not found:
            break
        yield data[at:found.start()]
        at = found.end()
    yield data[at:] if at else data


class Features:
    """Bucket counts of all runs of `least` to `most` consecutive words."""

    def __init__(self, buckets: int, run: tuple[int, int]):
        if not 0 < run[0] <= run[1] or buckets < 1:
            raise ValueError("runs of one word or more, one bucket or more")
        self.buckets, self.run, self.offsets = buckets, run, splitter()
        self.known: dict[bytes, int] = {}

    def bucket(self, feature: bytes) -> int:
        found = self.known.get(feature)
        if found is None:
            if len(self.known) >= KNOWN_FEATURES:
                self.known.clear()
            found = self.known[feature] = zlib.crc32(feature) % self.buckets
        return found

    def of(self, data: bytes) -> tuple[int, dict[int, int]]:
        """(words, count by bucket) of a text."""
        words, counts, carried = 0, {}, []
        least, most = self.run
        for piece in pieces(data.translate(lower_table().tobytes())):
            places = self.offsets(piece.decode())
            found = [piece[a:b] for a, b in places]
            words += len(found)
            if most == 1:
                here = Counter(found)
            else:
                own = carried + found
                joined = b" ".join(own)
                stops = np.cumsum([len(w) + 1 for w in own]).tolist() if own else []
                starts = [0, *stops[:-1]]
                # A run counts in the piece that holds its last word.
                here = Counter(joined[starts[i - n + 1]:stops[i] - 1] for n in range(least, most + 1)
                               for i in range(max(len(carried), n - 1), len(own)))
                carried = own[-(most - 1):]
            for feature, n in here.items():
                b = self.bucket(feature)
                counts[b] = counts.get(b, 0) + n
        return words, counts


def features_of(documents: DataFrame, id_col: str, text_col: str, buckets: int, run: tuple[int, int]) -> DataFrame:
    """(doc_id, n_words, n_features, buckets, counts) of every row."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(buckets, run)
        for batch in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
            held = [features.of(v.as_buffer().to_pybytes() if v.is_valid else b"") for v in batch.column(1)]
            offsets = pa.array(np.cumsum([0, *(len(c) for _, c in held)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([w for w, _ in held], pa.int64()), pa.array([sum(c.values()) for _, c in held], pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array([b for _, c in held for b in c], pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array([n for _, c in held for n in c.values()], pa.int64()))],
                names=["doc_id", "n_words", "n_features", "buckets", "counts"])

    return (documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(read, "doc_id long, n_words long, n_features long, buckets array<int>, counts array<long>"))


def histogram(features: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket; a task adds up its rows before the shuffle, the driver gets one row a bucket at most."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(total, batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy())
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(total[own])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in features.select("buckets", "counts").mapInArrow(add, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of each bucket's smoothed share in the target over that in the source."""
    s, t, n = float(source.sum()), float(target.sum()), float(len(source))
    return np.array([math.floor(1000 * math.log(((y + 1.0) * (s + n)) / ((x + 1.0) * (t + n))))
                     for x, y in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: str) -> int:
    """Gumbel noise in thousandths, decided by the id; rows without an id share one value."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(features: DataFrame, gains: np.ndarray, seed: str) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            value = gains[lists.flatten().to_numpy()] * batch.column(4).flatten().to_numpy()
            total = np.concatenate((np.zeros(1, np.int64), np.cumsum(value)))
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            weight = total[ends[1:]] - total[ends[:-1]]
            drawn = np.array([noise(i, seed) for i in batch.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight), pa.array(weight + drawn)],
                                             names=["doc_id", "n_words", "n_features", "weight", "score"])

    return features.mapInArrow(read, "doc_id long, n_words long, n_features long, weight long, score long")


def numbered(df: DataFrame, order: list, copies: str) -> DataFrame:
    """Adds `before`: the copies of all rows ahead in `order`, a total order of the rows of `df`.

    Spark's range partitions sort; each task counts its own rows, and one count a task meets in one place.
    """
    schema = df.withColumns({"task": F.lit(0), "ahead": F.lit(0).cast("long")}).schema
    place = df.columns.index(copies)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ahead = TaskContext.get().partitionId(), 0
        for b in batches:
            upto = np.cumsum(b.column(place).to_numpy()) + ahead
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, task, np.int32)),
                                              pa.array(np.concatenate(([ahead], upto[:-1])).astype(np.int64))], names=schema.names)
            ahead = int(upto[-1]) if len(upto) else ahead

    rows = staged(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(count, schema), "numbered")
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    tasks = rows.groupBy("task").agg(F.sum(copies).alias("n")).select("task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(tasks), "task").withColumn("before", F.col("base") + F.col("ahead")).drop("task", "ahead", "base")


def resample(documents: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
             run: tuple[int, int] = RUN, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (from 1 among the drawn, null for the others).

    floor(percent * N / 100) of the N documents with `least_words` words or more are drawn, by score, ties by id; rows
    without an id come last among ties, and equal rows take ranks one after the other. Null and empty texts have no
    features, weight 0, and are never drawn where `least_words` is positive. Without target texts the target is
    uniform. An empty table gives no rows. Texts are read whole, in pieces.
    """
    with arrow_rows(documents.sparkSession, TEXT_ROWS):
        features = staged(features_of(documents, "doc_id", "text", buckets, run), "features")
    wanted = features_of(target.select(F.lit(0).alias("doc_id"), "text"), "doc_id", "text", buckets, run)
    gains = gains_of(histogram(features, buckets), histogram(wanted, buckets))
    rows = staged(scored(features, gains, seed), "scores")
    eligible = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    draw = percent * rows.where(eligible).count() // 100
    same = rows.where(eligible).groupBy("doc_id", "n_features", "weight", "score").agg(F.count("*").alias("copies"))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    ranked = each_copy(numbered(same, order, "copies"), "copies", "copy").withColumn("_rank", F.col("before") + F.col("copy") + 1)
    rank = F.when(F.col("_rank") <= draw, F.col("_rank")).alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, rank).unionByName(rows.where(~eligible).select(*columns, F.lit(None).cast("long").alias("rank")))
