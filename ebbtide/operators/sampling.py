"""Exact-size, seeded, stratified sampling without sorting any stratum.

Rows are ordered by md5(key | seed). Each stratum's quota becomes a cut point
in that order, found by descending through hash prefixes with counting jobs, so
the sample itself is a predicate on the row: no shuffle of the wide table, no
anti join, and the same rows for any partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import ID, SEED
from ..functions.bounded import Settled
from ..functions.columns import keyed_hash, lookup, stratum
from .ordered import running_sums

# Prefix lengths of the order key: four for the md5 of the key columns, four more
# (the md5 of the whole row) that only matter when keys repeat. A step counts at most
# 65,536 prefixes of a stratum, but for the last of each half, which has few rows left.
LEVELS = (4, 8, 12, 32, 36, 40, 44, 64)
# Microseconds, which the default format drops.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
LITERAL_STRATA = 64
COPIES_PER_TASK = 10_000


def row_text(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), JSON_OPTIONS)


def row_digest(columns: Sequence[str]) -> Column:
    return F.md5(row_text(columns))


def _order_key(columns: Sequence[str], key: Sequence[str], seed: int, length: int) -> Column:
    head = keyed_hash(key, seed)
    if length <= 32:
        return F.substring(head, 1, length)
    return F.concat(head, F.substring(row_digest(columns), 1, length - 32))


def allocate(strata: DataFrame, size: int | None = None, share: float | None = None,
             rounding: str = "ceil", small: bool = True) -> DataFrame:
    """Largest-remainder shares of a total: (stratum, n) -> (stratum, n, take).

    The total is `size`, or `share` of all rows rounded by `rounding`. Equal
    remainders go to the first stratum by name. `small` says that the strata
    were counted and fit one task.
    """
    rows = strata.agg(F.sum("n").alias("n")).scalar()
    total = F.lit(size) if size is not None else getattr(F, rounding)(rows * F.lit(share))
    wide = "decimal(38,0)"
    product = F.col("n").cast("decimal(19,0)") * total.cast("decimal(19,0)")
    parts = (strata.withColumn("_product", product.cast(wide)).withColumn("_rows", rows.cast(wide))
             .withColumn("_rest", F.pmod("_product", "_rows"))
             .withColumn("_base", ((F.col("_product") - F.col("_rest")) / F.col("_rows")).cast("long")))
    spare = total.cast("long") - parts.agg(F.sum("_base").alias("b")).scalar()
    if small:
        rank = F.row_number().over(Window.orderBy(F.desc("_rest"), "stratum")) - 1
        ranked = parts.withColumn("_one_before", rank)
    else:
        key = F.concat(F.lpad((F.col("_rows") - F.col("_rest")).cast("string"), 38, "0"), "stratum")
        ranked = running_sums(parts.withColumn("_key", key).withColumn("_one", F.lit(1)),
                              [], "_key", ["_one"])
    take = F.col("_base") + (F.col("_one_before") < spare).cast("long")
    return ranked.select("stratum", "n", take.alias("take"))


class SampleCuts:
    """Cut point of each stratum: (stratum, cut, need, n) at prefix length `length`."""

    def __init__(self, table: Settled, length: int, exact: bool):
        self.table, self.length, self.exact = table, length, exact


def find_cuts(df: DataFrame, strata: Sequence[str] = (), size: int | None = None,
              share: float | None = None, rounding: str = "ceil", key: Sequence[str] = (ID,),
              seed: int = SEED) -> SampleCuts:
    columns = df.columns
    named = df.withColumn("stratum", stratum(strata) if strata else F.lit(""))
    counts = Settled(named.groupBy("stratum").agg(F.count("*").alias("n")))
    if size is not None:
        rows = (sum(r["n"] for r in counts.rows) if counts.small
                else counts.frame.agg(F.sum("n")).first()[0])
        if size > rows:
            raise ValueError(f"cannot draw {size} rows from {rows}")
    quota = allocate(counts.frame, size, share, rounding, counts.small)
    cuts = None
    for length in LEVELS:
        prefix = _order_key(columns, key, seed, length).alias("prefix")
        if cuts is None:
            inside = named.select("stratum", prefix)
            wanted = quota.select("stratum", F.col("take").alias("want"))
        else:
            held = named.select("stratum", prefix).join(
                cuts.side().select("stratum", "cut", F.col("need").alias("want")), "stratum")
            inside = held.where(F.col("prefix").startswith(F.col("cut"))).select("stratum", "prefix")
            wanted = cuts.frame.select("stratum", F.col("need").alias("want"))
        hist = inside.groupBy("stratum", "prefix").agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("stratum").orderBy("prefix"))
        crossing = (hist.withColumn("upto", upto)
                    .join(F.broadcast(wanted) if counts.small else wanted, "stratum")
                    .where((F.col("upto") - F.col("n") < F.col("want")) & (F.col("upto") >= F.col("want")))
                    .select("stratum", F.col("prefix").alias("cut"),
                            (F.col("want") - F.col("upto") + F.col("n")).alias("need"), "n"))
        cuts = Settled(crossing)
        exact = (all(r["need"] == r["n"] for r in cuts.rows) if cuts.small
                 else cuts.frame.where("need <> n").isEmpty())
        if exact:
            break
    return SampleCuts(cuts, length, exact)


def mark_sample(df: DataFrame, column: str = "sampled", where: Column | None = None,
                strata: Sequence[str] = (), size: int | None = None, share: float | None = None,
                rounding: str = "ceil", key: Sequence[str] = (ID,), seed: int = SEED) -> DataFrame:
    """Adds a boolean column that is true for exactly the wanted number of rows.

    `where` limits the sampled population; other rows are marked false.
    """
    columns = df.columns
    eligible = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    cuts = find_cuts(df.where(eligible), strata, size, share, rounding, key, seed)
    name = stratum(strata) if strata else F.lit("")
    if cuts.table.small and len(cuts.table.rows) <= LITERAL_STRATA:
        none = F.lit("")
        at = {r["stratum"]: r["cut"] for r in cuts.table.rows}
        need = {r["stratum"]: r["need"] for r in cuts.table.rows if r["need"] < r["n"]}
        cut = lookup(name, at, "") if at else none
        ready = df.withColumn("_cut", cut).withColumn(
            "_need", lookup(name, need, -1) if need else F.lit(-1))
    else:
        side = cuts.table.side().select(
            F.col("stratum").alias("_s"), F.col("cut").alias("_cut"),
            F.when(F.col("need") < F.col("n"), F.col("need")).otherwise(-1).alias("_need"))
        ready = df.join(side, name == F.col("_s"), "left").drop("_s")
    order = _order_key(columns, key, seed, cuts.length)
    chosen = F.coalesce(eligible & (F.col("_cut") != "") & (order <= F.col("_cut")), F.lit(False))
    if cuts.exact:
        return ready.withColumn(column, chosen).drop("_cut", "_need")
    tied = F.coalesce(eligible & (order == F.col("_cut")) & (F.col("_need") >= 0), F.lit(False))
    plain = ready.where(~tied).withColumn(column, chosen).drop("_cut", "_need")
    return plain.unionByName(split_copies(ready.where(tied), "_cut", "_need", column))


def split_copies(copies: DataFrame, tie: str, take: str, column: str) -> DataFrame:
    """Marks exactly `take` of each set of rows with the same `tie`, a digest of the whole row.

    Copies are counted (combined map-side) and regenerated from their count in
    chunks, so a row repeated any number of times never gathers in one task. Should
    different rows share a digest, the set's share is dealt out across them.
    """
    data = [c for c in copies.columns if c not in (tie, take)]
    before = F.sum("_n").over(Window.partitionBy(tie).orderBy(row_text(data))
                              .rowsBetween(Window.unboundedPreceding, -1))
    counted = (copies.groupBy(*copies.columns).agg(F.count("*").alias("_n"))
               .withColumn("_before", F.coalesce(before, F.lit(0))))
    chunks = counted.withColumn("_chunk", F.explode(F.expr(
        f"sequence(0L, (_n - 1) div {COPIES_PER_TASK})"))).repartition("_chunk", *data)
    first = F.col("_chunk") * COPIES_PER_TASK
    last = F.least(F.col("_n"), first + COPIES_PER_TASK) - 1
    return chunks.withColumn("_i", F.explode(F.sequence(first, last))).select(
        *data, (F.col("_before") + F.col("_i") < F.col(take)).alias(column))


def assign_folds(df: DataFrame, folds: int = 3, strata: Sequence[str] = ("churn",),
                 key: Sequence[str] = (ID,), seed: int = SEED, column: str = "fold") -> DataFrame:
    """Stratified k folds: consecutive exact samples of the rows not yet assigned."""
    out = df.withColumn(column, F.lit(folds - 1))
    for i in range(folds - 1):
        free = F.col(column) == folds - 1
        out = mark_sample(out, "_hit", free, strata, share=1.0 / (folds - i), key=key, seed=seed)
        out = out.withColumn(column, F.when(F.col("_hit"), i).otherwise(F.col(column))).drop("_hit")
    return out
