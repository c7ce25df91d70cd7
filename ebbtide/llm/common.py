"""Shared helpers: staged tables, distributed ranks, connected components, filters by id that move no rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from ..session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes `df` once to the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most `rows` rows between Spark and Python for what is run (staged) inside; a batch is bounded by rows only."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def unclash(*frames: DataFrame, name: str) -> str:
    """A column name, close to `name`, that no frame has."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ranked(df: DataFrame, group: str, order: list[str], name: str, part_rows: int = 1000) -> DataFrame:
    """Adds a rank from 0, without gaps, within `group`; `df` must be staged, as it is read twice.

    Large groups are dealt to parts by a hash of `order`; a part's rank starts after the rows of the parts
    before it, so no task holds a whole group. The order among ranks is that of (part, order).
    """
    spread = F.xxhash64(*order)
    sizes = df.groupBy(group).agg(F.count("*").alias("_n"))
    parts = sizes.select(F.col(group).alias("_g"), F.ceil(F.col("_n") / part_rows).cast("long").alias("_parts"))
    dealt = df.join(parts, df[group].eqNullSafe(parts["_g"])).withColumn("_part", F.pmod(spread, "_parts")).drop("_g", "_parts")
    counts = dealt.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    # One row per part here, a `part_rows`-th of the input.
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order))
    return (dealt.withColumn("_row", within)
            .join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
            .withColumn(name, (F.col("_before") + F.col("_row") - 1).cast("long"))
            .drop("_part", "_row", "_g", "_p", "_before"))


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(id, component) for every node of the edges (a, b): the smallest id reachable. `edges` are read once.

    Alternates the large-star and small-star steps until the edges are stars whose centre is the smallest id;
    each step groups by node with partial minima, and hot nodes meet only in joins that AQE can split.
    """
    e = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        signature = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if signature == before or signature[0] == 0:
            break
        before = signature
        e = staged(_star(_star(e, large=True), large=False), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        e.select(F.col("b"), F.col("b")).distinct())


def _star(e: DataFrame, large: bool) -> DataFrame:
    """Connects each node's larger (large) or smaller (small) neighbours, and itself, to its smallest neighbour."""
    if large:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        return both.where("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    low = e.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    linked = e.select(F.col("a").alias("u"), F.col("b").alias("v")).join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return linked.union(low.select("u", "m")).where("a <> b").distinct()


FILTER_BITS = 1 << 26  # of a filter, at most: 8 MB that each task holds
BITS_PER_ID, LEAST_BITS_PER_ID, PLACES = 24, 8, 6
FEW_IDS = 10_000  # up to these, ids are held themselves
MAP_BITS = 1 << 15  # of one of Spark's bitmaps
IdTest = Callable[[np.ndarray, np.ndarray], np.ndarray]  # of ids and their hashes


def passes(test: IdTest, column: Column) -> Column:
    """Whether a row's id, a long, passes the test; never null, and false for a null. Only the id goes to Python."""
    @F.arrow_udf("boolean")
    def tested(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        return pa.array(test(ids.fill_null(0).to_numpy(zero_copy_only=False), hashes.to_numpy(zero_copy_only=False)), pa.bool_())

    return column.isNotNull() & tested(column, F.xxhash64(column))


def may_be_among(ids: DataFrame) -> IdTest | None:
    """A test that every id of `ids` (one column, `id`, distinct) passes, and few others; None for more ids than a filter tells apart.

    So rows are picked by id where they lie, however wide they are, while a join would shuffle all of them.
    """
    n = ids.count()
    if n <= FEW_IDS:
        held = np.array([r["id"] for r in ids.collect()], np.int64)
        return lambda found, _: np.isin(found, held)
    if n * LEAST_BITS_PER_ID > FILTER_BITS:
        return None
    bits = max(MAP_BITS, min(FILTER_BITS, 1 << (BITS_PER_ID * n - 1).bit_length()))
    h = F.xxhash64("id")
    low, step = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    place = F.explode(F.array(*[(low + step * i).bitwiseAND(F.lit(bits - 1)) for i in range(PLACES)])).alias("place")
    maps = (ids.select(place).groupBy(F.shiftright("place", 15).alias("map"))
            .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(MAP_BITS - 1))).alias("bits")))
    filled = np.zeros((bits // MAP_BITS, MAP_BITS // 8), np.uint8)
    for r in maps.collect():  # FILTER_BITS / MAP_BITS rows at most
        filled[r["map"]] = np.frombuffer(r["bits"], np.uint8)
    filled = filled.ravel()

    def test(_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        h = hashes.view(np.uint64)
        low, step = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)
        out = np.ones(len(h), bool)
        for i in range(PLACES):
            at = low + step * np.uint64(i) & np.uint64(bits - 1)
            out &= (filled[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out

    return test


def among(ids: DataFrame, universe: DataFrame) -> IdTest | None:
    """As `may_be_among`, but exact for all ids of `universe`; both frames have one column, `id`, and are staged.

    The ids of the universe that pass wrongly are looked for, by their ids alone, and told apart by a test of their own.
    """
    may = may_be_among(ids)
    if may is None:
        return None
    wrong = staged(universe.where(passes(may, F.col("id"))).join(ids, "id", "left_anti").distinct(), "wrong")
    if wrong.isEmpty():
        return may
    is_wrong = among(wrong, ids)
    return None if is_wrong is None else lambda found, hashes: may(found, hashes) & ~is_wrong(found, hashes)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


COPIES_PER_TASK = 10_000


def each_copy(df: DataFrame, count: str, index: str) -> DataFrame:
    """A row for each of `count` copies of every row, numbered from 0 in `index`; many copies of one row are made in many tasks."""
    chunk, first = unclash(df, name="_chunk"), F.lit(COPIES_PER_TASK).cast("long")
    one = df.where(F.col(count) == 1).withColumn(index, F.lit(0).cast("long"))
    chunks = df.where(F.col(count) > 1).withColumn(chunk, F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(`{count}` - 1) div {COPIES_PER_TASK}"))))
    many = chunks.repartition(chunk).withColumn(index, F.explode(F.sequence(
        F.col(chunk) * first, F.least(F.col(count), (F.col(chunk) + 1) * first) - 1))).drop(chunk)
    return one.unionByName(many).drop(count)
