"""Global order statistics without a single-partition window.

A distribution is first collapsed to its distinct values. Those are cut into
buckets that are a pure function of the value, prefix sums run inside each
bucket, and a table of bucket totals (groups x buckets rows) supplies the
offsets. Cut points only balance the work; results do not depend on them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.bounded import MAX_SMALL_ROWS
from ..functions.columns import double_of, doubles, lookup, with_cut_index

TEXT_SAMPLE = 1000
MAX_BUCKETS = 4096


def default_buckets(df: DataFrame) -> int:
    """Power of two, at least four buckets per shuffle partition, bounded."""
    wanted = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = 16
    while buckets < wanted and buckets < MAX_BUCKETS:
        buckets *= 2
    return buckets


def _number_cuts(hist: DataFrame, by: Sequence[str], value: str, buckets: int) -> DataFrame:
    shares = doubles(i / buckets for i in range(1, buckets))
    cuts = F.percentile_approx(value, shares, F.lit(20 * buckets)).alias("_cuts")
    return hist.groupBy(*by).agg(cuts)


def _text_cuts(hist: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Cuts from the distinct values with the smallest hashes: a bounded uniform sample."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.xxhash64(value), value))
    return (hist.withColumn("_rank", rank).where(F.col("_rank") <= TEXT_SAMPLE)
            .groupBy(*by).agg(F.array_sort(F.collect_list(value)).alias("_cuts")))


def running_sums(hist: DataFrame, by: Sequence[str], value: str, weights: Sequence[str],
                 groups: int | None = 1, next_value: bool = False,
                 buckets: int | None = None) -> DataFrame:
    """Adds `<w>_before` (sum over smaller values) and `<w>_total` for each weight.

    `hist` has one row per (`by`, `value`), none of them NULL. `groups` is the
    caller's bound on the number of groups; None means unknown, and then the
    bucket tables are joined by shuffle instead of broadcast. With `next_value`
    the next larger value of the group is added as `next_value`.
    """
    buckets = buckets or default_buckets(hist)
    keys = list(by)
    work = hist
    # True for counts. It keeps every count column in all three uses of `work`
    # below, so that they share one shuffle of the histogram instead of three scans.
    counts = [F.col(f.name) for f in hist.schema
              if isinstance(f.dataType, T.NumericType) and f.name not in (*by, value)]
    work = work.where(F.greatest(*counts, F.lit(0)) >= 0)
    text = isinstance(hist.schema[value].dataType, T.StringType)
    size = TEXT_SAMPLE if text else buckets
    bounded = groups is not None and groups * size <= MAX_SMALL_ROWS

    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if bounded else df

    cuts = _text_cuts(work, keys, value) if text else _number_cuts(work, keys, value, buckets)
    ready = work.join(side(cuts), keys) if keys else work.withColumn("_cuts", cuts.scalar())
    bucketed = with_cut_index(ready, "_cuts", value, size, "_bucket").drop("_cuts")
    totals = bucketed.groupBy(*keys, "_bucket").agg(
        F.min(value).alias("_first"), *[F.sum(w).alias(f"_sum_{w}") for w in weights])
    over_buckets = Window.partitionBy(*keys).orderBy("_bucket")
    whole = Window.partitionBy(*keys)
    offsets = totals.select(
        *keys, "_bucket", F.lead("_first").over(over_buckets).alias("_next_first"),
        *[(F.sum(f"_sum_{w}").over(over_buckets) - F.col(f"_sum_{w}")).alias(f"_off_{w}")
          for w in weights],
        *[F.sum(f"_sum_{w}").over(whole).alias(f"{w}_total") for w in weights])
    inside = Window.partitionBy(*keys, "_bucket").orderBy(value)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = bucketed.select("*", F.lead(value).over(inside).alias("_lead"),
                             *[F.sum(w).over(so_far).alias(f"_run_{w}") for w in weights])
    out: list[Column] = [F.col(c) for c in hist.columns]
    for w in weights:
        out.append((F.col(f"_off_{w}") + F.col(f"_run_{w}") - F.col(w)).alias(f"{w}_before"))
        out.append(F.col(f"{w}_total"))
    if next_value:
        out.append(F.coalesce("_lead", "_next_first").alias("next_value"))
    return ranked.join(side(offsets), [*keys, "_bucket"]).select(out)


RADIX_BITS = 16        # of a 64-bit image, counted in one round: at most 65,536 counters a column
FEW_VALUES_LEFT = 200_000  # rows inside all chosen buckets: the last round then counts their whole images


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict:
    """Exact medians (mean of the two middle values) of many columns at once; None where a column holds no value.

    Radix selection: each double has a 64-bit image that sorts as it does. A round reads the table once and counts, for all
    columns at once, the next RADIX_BITS of the images inside the buckets chosen so far, which are those that hold a
    column's two middle values. Counters are combined in each task, so nothing but them is shuffled. After two to four
    rounds the images are whole. NULL and NaN are left out. `df` is read in every round: stage what is costly to make.
    """
    if not columns:
        return {}
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    # Of each column, by its place: the chosen buckets, each with the ranks (from 0) inside it that are wanted. None: not read so far.
    wanted: list[dict[int, list[int]]] | None = None
    low, medians = 64, {c: None for c in columns}
    while low:
        # The rows of the last chosen buckets decide how far the next round goes.
        few = wanted is not None and rows <= FEW_VALUES_LEFT
        high, low = low, 0 if few else low - RADIX_BITS
        counts = _bucket_counts(values, wanted, high, low)
        chosen, rows = [{} for _ in columns], 0
        for r in counts.collect():  # two rows a column at most
            for rank in ((r.total - 1) // 2, r.total // 2) if wanted is None else wanted[r.column][r.parent]:
                if r.upto - r.n <= rank < r.upto:
                    chosen[r.column].setdefault(r.bucket, []).append(rank - r.upto + r.n)
                    rows += r.n
        wanted = chosen
    for c, buckets in zip(columns, wanted):
        found = [double_of(bucket) for bucket, ranks in buckets.items() for _ in ranks]
        medians[c] = sum(found) / 2 if found else None
    return medians


def _images(column: pa.Array) -> np.ndarray:
    """The images of a column's values: their IEEE 754 bits, negated for negative numbers; -0.0 is 0.0."""
    x = column.drop_null().to_numpy(zero_copy_only=False)
    x = x[~np.isnan(x)]
    bits = np.abs(x).view(np.int64)
    return np.where(x < 0, -bits, bits)


def _bucket_counts(values: DataFrame, wanted: list[dict] | None, high: int, low: int) -> DataFrame:
    """(column, parent, bucket, n, upto, total) of the buckets that hold a wanted rank; a bucket is an image without its `low` lowest bits.

    A task holds a counter for each bucket of up to RADIX_BITS bits, and for longer ones, of which few rows are left, the buckets found.
    """
    width = high - low
    parents = None if wanted is None else [sorted(w) for w in wanted]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[tuple[int, int], np.ndarray] = {}
        found: Counter = Counter()
        for b in batches:
            for i, column in enumerate(b.columns):
                x = _images(column)
                for parent in [0] if parents is None else parents[i]:
                    mine = x if parents is None else x[(x >> high) == parent]
                    if not len(mine):
                        continue
                    if width > RADIX_BITS:
                        buckets, n = np.unique(mine >> low, return_counts=True)
                        found.update({(i, parent, k): v for k, v in zip(buckets.tolist(), n.tolist())})
                        continue
                    least = -(1 << (width - 1)) if parents is None else parent << width
                    n = np.bincount((mine >> low) - least, minlength=1 << width)
                    counters[i, parent] = counters[i, parent] + n if (i, parent) in counters else n
        for (i, parent), n in counters.items():
            least = -(1 << (width - 1)) if parents is None else parent << width
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, np.int32)), pa.array(np.full(len(at), parent, np.int64)),
                                              pa.array(at + least), pa.array(n[at])], names=["column", "parent", "bucket", "n"])
        if found:
            rows = [(*k, n) for k, n in found.items()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                             names=["column", "parent", "bucket", "n"])

    counted = (values.mapInArrow(count, "column int, parent long, bucket long, n long")
               .groupBy("column", "parent", "bucket").agg(F.sum("n").alias("n")))
    by = Window.partitionBy("column", "parent")
    ranked = counted.select("*", F.sum("n").over(by.orderBy("bucket")).alias("upto"), F.sum("n").over(by).alias("total"))
    if wanted is None:
        ranks = [F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)]
    else:
        listed = {f"{i}|{p}": r for i, w in enumerate(wanted) for p, r in w.items()}
        key = F.concat_ws("|", F.col("column").cast("string"), F.col("parent").cast("string"))
        ranks = [lookup(key, {k: edge(r) for k, r in listed.items()}, -1) for edge in (min, max)] if listed else [F.lit(-1)]
    hit = [(rank >= F.col("upto") - F.col("n")) & (rank < F.col("upto")) for rank in ranks]
    return ranked.where(hit[0] if len(hit) == 1 else hit[0] | hit[1])
