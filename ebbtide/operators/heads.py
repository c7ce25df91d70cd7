"""The first rows of groups in an order of several columns and directions, by cut points instead of sorts and windows.

An order becomes fixed-width hexadecimal text that sorts as the rows do: a flag and a 64-bit image for each column, then
the md5 of the key columns and the seed, then, where keys repeat, the md5 of the row. A group's quota is a cut point in
that text, found by counting prefixes: each step reads the table once, counts at most 2 ** 20 prefixes of a group inside
the prefix that holds the cut so far, and all groups go down together. So being among the first rows is a predicate on
the row: no shuffle, no sort, no task that holds a group, and the same rows for any partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..config import SEED
from ..functions.columns import double_bits, keyed_hash, lookup
from ..session import compiled
from .sampling import row_digest, split_copies

STEP = 5             # hexadecimal digits a step
FEW_ROWS = 200_000   # inside the prefixes of all cuts: the rest is then counted by the whole key
FIELD, HASH = 17, 32
ABOVE = "~"          # sorts after every digit


@dataclass(frozen=True)
class Order:
    """Columns with True for descending, nulls last either way; rows equal in them follow the keyed hash of `key`."""

    columns: tuple[tuple[str, bool], ...]
    key: tuple[str, ...]
    seed: int = SEED

    def sorts(self) -> list[Column]:
        """The same order for orderBy; rows with one key stay unordered."""
        by = [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_last() for c, down in self.columns]
        return [*by, keyed_hash(self.key, self.seed), *map(F.col, self.key)]

    @property
    def width(self) -> int:
        return FIELD * len(self.columns) + HASH

    def text(self, df: DataFrame, length: int) -> Column:
        """The first `length` digits of the order key; only the parts that they need are computed."""
        parts = [field(df, c, down) for c, down in self.columns] + [keyed_hash(self.key, self.seed), row_digest(df.columns)]
        ends = [FIELD * (i + 1) for i in range(len(self.columns))] + [self.width, self.width + HASH]
        needed = next(i for i, end in enumerate(ends) if end >= length) + 1
        return F.substring(F.concat(*parts[:needed]), 1, length)


def field(df: DataFrame, name: str, descending: bool) -> Column:
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        image = double_bits(column.cast("double"))
    elif isinstance(kind, T.IntegralType):
        image = column.cast("long")
    else:
        raise ValueError(f"no order image for {name} of type {kind.simpleString()}")
    image = F.bitwise_not(image) if descending else image
    digits = F.lpad(F.hex(image.bitwiseXOR(F.lit(-(1 << 63)))), FIELD - 1, "0")
    return F.coalesce(F.concat(F.lit("0"), digits), F.lit("1" + "0" * (FIELD - 1)))


@dataclass
class Cut:
    """A group's cut: rows with a key below `prefix`, and `need` of the `n` rows whose key starts with it."""

    prefix: str
    need: int
    n: int


def find_cuts(df: DataFrame, group: Column, quotas: Mapping, order: Order, counts: Mapping | None = None) -> dict:
    """The cut of every group that holds rows and has a quota; `counts` are the groups' rows, if they are known.

    Quotas of a group's size or more take all of it. The driver sees one row a group and step.
    """
    quotas = {g: q for g, q in quotas.items() if q > 0}
    if not quotas:
        return {}
    counts = group_counts(df, group, quotas) if counts is None else counts
    cuts = {g: Cut("", min(q, counts[g]), counts[g]) for g, q in quotas.items() if counts.get(g)}
    length, most = 0, order.width + HASH
    while length < most:
        open_ = {g: c for g, c in cuts.items() if c.need < c.n}
        if not open_:
            break
        if length >= order.width:
            length = most
        else:
            few = sum(c.n for c in open_.values()) <= FEW_ROWS
            length = order.width if few else min(length + STEP, order.width)
        rows = df.select(group.alias("group"), order.text(df, length).alias("prefix")).where(F.col("group").isin(*open_))
        inside = rows.where(F.col("prefix").startswith(lookup(F.col("group"), {g: c.prefix for g, c in open_.items()}, ABOVE)))
        need = lookup(F.col("group"), {g: c.need for g, c in open_.items()}, 0)
        upto = F.sum("n").over(Window.partitionBy("group").orderBy("prefix"))
        crossed = (inside.groupBy("group", "prefix").agg(F.count("*").alias("n")).withColumn("upto", upto)
                   .where((F.col("upto") >= need) & (F.col("upto") - F.col("n") < need)))
        for r in crossed.collect():
            cuts[r.group] = Cut(r.prefix, open_[r.group].need - r.upto + r.n, r.n)
    return cuts


def group_counts(df: DataFrame, group: Column, groups: Sequence) -> dict:
    return {r.group: r.n for r in df.select(group.alias("group")).where(F.col("group").isin(*groups)).groupBy("group").agg(F.count("*").alias("n")).collect()}


def mark_heads(df: DataFrame, group: Column, quotas: Mapping, order: Order, column: str, counts: Mapping | None = None) -> DataFrame:
    """Adds a boolean column: whether the row is among the first `quotas[group]` rows of its group.

    Rows that are equal in all columns count one by one. Groups without a quota, and null groups, are never marked.
    """
    cuts = find_cuts(compiled(df), group, quotas, order, counts)
    if not cuts:
        return df.withColumn(column, F.lit(False))
    columns = df.columns
    length = max(len(c.prefix) for c in cuts.values())
    text = order.text(df, length) if length else F.lit("")
    limit = lookup(group, {g: c.prefix + ABOVE for g, c in cuts.items()}, "")
    chosen = F.coalesce(text < limit, F.lit(False))
    tied = {g: c for g, c in cuts.items() if c.need < c.n}
    if not tied:
        return df.withColumn(column, chosen)
    at = lookup(group, {g: c.prefix for g, c in tied.items()}, ABOVE)
    ready = df.withColumn("_at", F.when(F.coalesce(text == at, F.lit(False)), at)).withColumn("_take", lookup(group, {g: c.need for g, c in tied.items()}, 0))
    plain = ready.where("_at IS NULL").withColumn(column, chosen).select(*columns, column)
    return plain.unionByName(split_copies(ready.where("_at IS NOT NULL").select(*columns, "_at", "_take"), "_at", "_take", column))


def head_per_group(df: DataFrame, group: str, quotas: Mapping, order: Order) -> DataFrame:
    """The first `quotas[g]` rows of each group, in no particular order."""
    return mark_heads(df, F.col(group), quotas, order, "_head").where("_head").drop("_head")
