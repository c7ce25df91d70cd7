"""Shards by jump consistent hashing (Lamping and Veach): no ring table, and new shards take rows only into themselves."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ranked, staged, text_or_empty

# Fixed values of the published algorithm.
MULTIPLIER, HALF = np.uint64(2862933555777941757), float(1 << 31)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key; keys still jumping form an ever smaller active set."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state, out = keys.astype(np.uint64, copy=True), np.zeros(len(keys), np.int64)
    active = np.arange(len(keys))
    while len(active):
        state[active] = state[active] * MULTIPLIER + np.uint64(1)
        jump = ((out[active] + 1) * (HALF / ((state[active] >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        active, jump = active[jump < shards], jump[jump < shards]
        out[active] = jump
    return out.astype(np.int32)


def assign(df: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """Adds `shard` and `grown_shard` (with one shard more), decided by `key` and the number of shards only.

    A null key counts as one key of its own; equal keys share a shard. Only the columns of `df` travel, so
    project before the call.
    """
    schema = df.withColumn("shard", F.lit(0).cast("int")).withColumn("grown_shard", F.lit(0).cast("int")).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(b.num_columns - 1).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(jump_hash(keys, shards)), pa.array(jump_hash(keys, shards + 1))], names=schema.names)

    return df.withColumn("_key", F.xxhash64(key)).mapInArrow(place, schema)


def shard_documents(documents: DataFrame, shards: int = 40) -> DataFrame:
    """One row per document: size, checksum, shard and a gapless slot within the shard.

    Repeated rows each get their own slot; a null text has no bytes; an empty table gives no rows.
    """
    text = text_or_empty()
    slim = documents.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                            F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = staged(assign(slim, shards), "shards")
    return (ranked(placed, "shard", ["doc_id", "text_crc32", "size"], "slot")
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"))


def write_shards(documents: DataFrame, path: str, shards: int = 40) -> None:
    """Writes the documents in one folder per shard; tasks write what they read, without a shuffle."""
    assign(documents, shards).drop("grown_shard").write.partitionBy("shard").parquet(path)
