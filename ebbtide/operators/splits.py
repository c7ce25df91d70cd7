"""Stress, current and train batches of one customer table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import CURRENT_SIZE, ID, SEED, STRESS_QUOTAS, STRESS_SIZE, TENURE_CUTOFF
from ..functions.columns import flag
from ..session import staged
from .heads import Order, group_counts, mark_heads
from .sampling import mark_sample

STRATA = ("churn", "contract", "internet_service")


def stress_score(tenure_cutoff: int = TENURE_CUTOFF) -> Column:
    """0..4: month-to-month, fiber, electronic check and short tenure."""
    return (flag(F.col("contract") == "Month-to-month")
            + flag(F.col("internet_service") == "Fiber optic")
            + flag(F.col("payment_method") == "Electronic check")
            + flag(F.col("tenure_months") <= tenure_cutoff))


def stress_order(seed: int = SEED, key: str = ID, score: bool = True) -> Order:
    """Worst first: score and charges down, tenure up; the keyed hash only breaks ties."""
    columns = (("monthly_charges", True), ("tenure_months", False))
    return Order((("stress_score", True), *columns) if score else columns, (key,), seed)


def rank_stress(df: DataFrame, seed: int = SEED, key: str = ID) -> DataFrame:
    """The table with its stress score, sorted by the stress order."""
    return df.withColumn("stress_score", stress_score()).orderBy(*stress_order(seed, key).sorts())


def number_stress(df: DataFrame, seed: int = SEED, key: str = ID) -> DataFrame:
    """Every row of the table with its stress score and its place, from 1, in the stress order (`stress_rank`).

    Rows are sorted over all tasks and numbered within each as they are written; one count a task meets in one place.
    """
    order = stress_order(seed, key).sorts()
    sort = df.withColumn("stress_score", stress_score()).repartitionByRange(*order).sortWithinPartitions(*order)
    # The number holds the task in its upper bits and the row in its lower 33.
    rows = staged(sort.withColumn("_place", F.monotonically_increasing_id()), "stress-ranks")
    task, place = F.shiftright("_place", 33).alias("_task"), F.col("_place").bitwiseAND((1 << 33) - 1)
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    offsets = (rows.groupBy(task).agg(F.count("*").alias("_n"))
               .select("_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    return (rows.withColumn("_task", task).join(F.broadcast(offsets), "_task")
            .withColumn("stress_rank", F.col("_before") + place + 1).drop("_task", "_place", "_before"))


def stress_quotas(counts: Mapping[int, int], quotas: Mapping[int, int] = STRESS_QUOTAS, size: int = STRESS_SIZE) -> dict[int, int]:
    """Rows that the stress batch takes of each score, of which the table has `counts`.

    Each quota takes the first rows of its score. What is then short of `size` is filled with the best other rows; as
    the score comes first in the order, these are the next rows of the highest scores that have any left.
    """
    take = {s: min(quotas.get(s, 0), n) for s, n in counts.items()}
    short = size - sum(take.values())
    for s in sorted(counts, reverse=True):
        more = max(0, min(short, counts[s] - take[s]))
        take[s], short = take[s] + more, short - more
    return take


def mark_stress(df: DataFrame, column: str, quotas: Mapping[int, int] = STRESS_QUOTAS, size: int = STRESS_SIZE,
                seed: int = SEED, key: str = ID) -> DataFrame:
    """Adds a boolean column: whether the row belongs to the stress batch. A predicate on the row."""
    score = stress_score()
    counts = group_counts(df, score, range(5))
    return mark_heads(df, score, stress_quotas(counts, quotas, size), stress_order(seed, key, score=False), column, counts)


def stress_batch(df: DataFrame, quotas: Mapping[int, int] = STRESS_QUOTAS, size: int = STRESS_SIZE,
                 seed: int = SEED, key: str = ID) -> DataFrame:
    """Quota rows per score, filled up to `size` with the best-ranked other rows, in the stress order."""
    picked = mark_stress(df, "_stress", quotas, size, seed, key).where("_stress").drop("_stress")
    return rank_stress(picked, seed, key)


def three_way_split(df: DataFrame, quotas: Mapping[int, int] = STRESS_QUOTAS,
                    stress_size: int = STRESS_SIZE, current_size: int = CURRENT_SIZE,
                    strata: Sequence[str] = STRATA, seed: int = SEED, key: str = ID) -> DataFrame:
    """The table with a `batch` column: stress, current (exact, stratified) or train."""
    # Stored, so that the steps of the next cuts read a flag instead of making the order key of every row again.
    marked = staged(mark_stress(df, "_stress", quotas, stress_size, seed, key), "stress")
    sampled = mark_sample(marked, "_current", ~F.col("_stress"), strata, size=current_size,
                          key=[key], seed=seed)
    batch = (F.when(F.col("_stress"), "stress").when(F.col("_current"), "current")
             .otherwise("train"))
    return sampled.select(*df.columns, batch.alias("batch"))


def holdout_split(df: DataFrame, share: float, strata: Sequence[str] = ("churn",),
                  seed: int = SEED, key: str = ID, column: str = "holdout") -> DataFrame:
    """Marks ceil(share * n) rows as hold-out, proportional per stratum."""
    return mark_sample(df, column, strata=strata, share=share, key=[key], seed=seed)


def sample_share(df: DataFrame, share: float = 0.5, seed: int = SEED, key: str = ID) -> DataFrame:
    """Exactly floor(share * n) rows, without replacement."""
    return (mark_sample(df, "_in", share=share, rounding="floor", key=[key], seed=seed)
            .where("_in").drop("_in"))
