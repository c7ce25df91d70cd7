"""Batch summaries, alignment by key and small lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..config import COST_FN, ID, LABEL


def batch_summary(df: DataFrame, by: Sequence[str] = ("batch",), label: str = LABEL) -> DataFrame:
    """Rows and churn rate of each group."""
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"),
                               (F.sum(label) / F.count("*")).alias("churn_rate"))


def describe_batches(df: DataFrame, base: str = "train", label: str = LABEL) -> DataFrame:
    """Batch summary with each batch's churn-rate difference to the base batch."""
    stats = batch_summary(df, ["batch"], label)
    base_rate = stats.where(F.col("batch") == base).agg(F.max("churn_rate")).scalar()
    return stats.withColumn("churn_delta", F.col("churn_rate") - base_rate)


def without(df: DataFrame, picked: DataFrame, key: str = ID) -> DataFrame:
    """Rows whose key was not picked."""
    return df.join(picked.select(key).distinct(), key, "left_anti")


def align_by_key(left: DataFrame, right: DataFrame, key: str = ID) -> DataFrame:
    """Rows of both sides side by side, where they do not already travel together."""
    return left.join(right, key)


def pool(history: DataFrame, fresh: DataFrame) -> DataFrame:
    """Old and new rows under the same columns; a differing column set is an error."""
    return history.unionByName(fresh, allowMissingColumns=False)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_null, has_null) from one scan."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(f"n{i}") for i, c in enumerate(columns)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n_null"), (F.col(f"n{i}") > 0).alias("has_null"))
        for i, c in enumerate(columns)])))


def sorted_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in order, with their counts."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(column)


def missed_positives(df: DataFrame, label: str = "label", pred: str = "pred",
                     cost: int = COST_FN) -> DataFrame:
    """Positives predicted negative, and what they cost."""
    missed = F.coalesce(F.sum(((F.col(label) == 1) & (F.col(pred) == 0)).cast("long")), F.lit(0))
    return df.agg(missed.alias("missed"), (missed * cost).alias("cost"))
