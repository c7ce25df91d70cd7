"""Small tables: check the size before they are broadcast or read by the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MAX_SMALL_ROWS = 100_000


class Settled:
    """An aggregate result that was materialised once if it proved small.

    `rows` holds its rows as dicts when there are at most `limit`, and None otherwise;
    `frame` is then the untouched distributed table.
    """

    def __init__(self, frame: DataFrame, limit: int = MAX_SMALL_ROWS):
        table = frame.limit(limit + 1).toArrow()
        self.small = table.num_rows <= limit
        self.rows = table.to_pylist() if self.small else None
        # From Arrow this becomes a local relation, whose size the planner knows.
        self.frame = (frame.sparkSession.createDataFrame(table, frame.schema)
                      if self.small else frame)

    def listed(self) -> list[dict]:
        """All rows; an error, not a part of them, where there are too many for the driver."""
        if not self.small:
            raise ValueError("too many rows for the driver")
        return self.rows

    def side(self) -> DataFrame:
        """Join side: a broadcast if proven small, else a plain shuffled side."""
        return F.broadcast(self.frame) if self.small else self.frame
