"""Reading, canonicalising and writing customer tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import number
from .schema import CANONICAL, CUSTOMER_SCHEMA, RAW_HEADINGS

# Texts that a CSV scan reads as missing.
MISSING_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                 "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                 "n/a", "nan", "null")
BATCHES = ("train", "current", "stress")
MONITOR_BATCHES = ("current", "stress")
# A quote inside a quoted field is doubled.
CSV = {"header": True, "quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV as text columns, matched by name; every file's header is checked."""
    names = spark.read.options(**CSV).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    raw = spark.read.schema(schema).options(**CSV, enforceSchema=False).csv(path)
    return raw.select([F.when(~F.col(f"`{c}`").isin(*MISSING_TEXTS), F.col(f"`{c}`")).alias(c)
                       for c in names])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def project_present(df: DataFrame, columns: Iterable[str], fill=None) -> DataFrame:
    """Ordered projection; absent columns are left out, or added as `fill` if given."""
    have = set(df.columns)
    if fill is None:
        return df.select([F.col(f"`{c}`") for c in columns if c in have])
    return df.select([F.col(f"`{c}`") if c in have else F.lit(fill).alias(c) for c in columns])


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Rows without any gap.

    One plain condition per column: the optimizer derives constraints from it in
    linear time, which it does not for the single n-ary condition of `dropna`.
    """
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    keep = F.lit(True)
    for c in df.columns:
        keep = keep & F.col(f"`{c}`").isNotNull()
        if c in floats:
            keep = keep & ~F.isnan(F.col(f"`{c}`"))
    return df.where(keep)


def coerce_numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: number(F.col(c)) for c in columns if c in df.columns})


def strict_int(name: str):
    """Integer column; a missing or unparsable value fails the job."""
    value = number(F.col(name))
    return F.when(value.isNotNull(), value.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit(f"not an integer in {name}: "),
                               F.coalesce(F.col(name).cast("string"), F.lit("NULL")))))


def canonicalise(df: DataFrame) -> DataFrame:
    """Raw or canonical headings in, the 21 canonical columns out, in order and typed."""
    df = rename(df, RAW_HEADINGS)
    missing = [c for c in CANONICAL if c not in df.columns]
    if missing:
        raise ValueError(f"the table lacks {missing}")

    def typed(field: T.StructField):
        if field.name == "churn":
            return strict_int("churn").alias("churn")
        if isinstance(field.dataType, T.StringType):
            return F.col(field.name).cast("string").alias(field.name)
        return number(F.col(field.name)).cast(field.dataType).alias(field.name)

    return df.select([typed(f) for f in CUSTOMER_SCHEMA])


def read_customers(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Customer table from CSV, Parquet, ORC or JSON, canonicalised."""
    df = read_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
    return canonicalise(df)


def from_records(spark: SparkSession, rows: Iterable[Mapping], schema: T.StructType) -> DataFrame:
    """Frame from a small list of dicts; absent keys become NULL."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists",
                partition_by: Iterable[str] = ()) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.options(**CSV)
    writer.format(fmt).save(path)


def check_batch_name(name: str) -> str:
    if name not in MONITOR_BATCHES:
        raise ValueError(f"{name!r} is no monitored batch; those are {', '.join(MONITOR_BATCHES)}")
    return name


def named_batch(df: DataFrame, name: str) -> DataFrame:
    """One batch of the split table; prunes partitions when stored by `batch`."""
    return df.where(F.col("batch") == check_batch_name(name)).drop("batch")


def train_batch(df: DataFrame) -> DataFrame:
    return df.where(F.col("batch") == "train").drop("batch")


def ensure_splits(spark: SparkSession, root: str, source: DataFrame, force: bool = False,
                  **split_options) -> DataFrame:
    """The three batches stored under `root`, written only when one is missing or on `force`."""
    from ..operators.splits import three_way_split

    if force or not _has_batches(spark, root):
        write_table(three_way_split(source, **split_options), root, mode="overwrite",
                    partition_by=["batch"])
    return spark.read.parquet(root)


def _has_batches(spark: SparkSession, root: str) -> bool:
    try:
        for name in BATCHES:
            spark.read.parquet(f"{root}/batch={name}")
    except AnalysisException:
        return False
    return True
