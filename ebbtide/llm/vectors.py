"""Vectors as fixed-width binary columns, so tasks read whole batches as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(column: str = "embedding") -> Column:
    """Neither null nor holding null or non-finite components, and not empty."""
    sound = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(column).isNotNull() & (F.size(column) > 0) & sound, F.lit(False))


def packed(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Usable rows with `column` as little-endian doubles (`vector`), and `dim`; other columns are kept."""
    rows = df.where(usable(column)).withColumn(column, F.col(column).cast("array<double>"))
    kept = [c for c in rows.columns if c != column]
    schema = rows.select(*kept).withColumns({"dim": F.lit(0).cast("int"), "vector": F.lit(b"")}).schema

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(b.num_columns - 1)
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype("<f8")
            out = pa.array([values[x:y].tobytes() for x, y in zip(offsets[:-1], offsets[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(np.diff(offsets).astype(np.int32)), out], names=schema.names)

    return rows.select(*kept, column).mapInArrow(pack, schema)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    joined = b"".join(v.as_buffer().to_pybytes() for v in column)
    return np.frombuffer(joined, "<f8").reshape(len(column), dim)
