"""Whether and how to retrain, from a drift table and two F1 scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DRIFT_SHARE, F1_DROP_LIMIT, KEY_DRIFT_COLUMNS


def retrain_decision(drift: DataFrame, baseline_f1: float | Column | None = None,
                     current_f1: float | Column | None = None,
                     key_columns: Sequence[str] = KEY_DRIFT_COLUMNS,
                     drop_limit: float = F1_DROP_LIMIT) -> DataFrame:
    """One row: should_retrain, strategy, reasons, observations.

    Rule 1: an important column drifted. Rule 2: two or more columns drifted.
    Rule 3: F1 fell by more than the limit while some column drifted; without
    drift the fall is only an observation.
    """
    drifted = F.col("drifted")
    summary = drift.agg(
        F.sum(drifted.cast("int")).alias("n_drifted"),
        (F.avg(drifted.cast("double")) >= DRIFT_SHARE).alias("dataset_drift"),
        *[F.max(drifted & (F.col("feature") == c)).alias(f"_key{i}") for i, c in enumerate(key_columns)])
    known = baseline_f1 is not None and current_f1 is not None
    drop = ((F.lit(baseline_f1) - F.lit(current_f1)) if known else F.lit(None)).cast("double")
    fell = F.coalesce(F.col("f1_drop") > drop_limit, F.lit(False))
    some = F.col("dataset_drift") | (F.col("n_drifted") > 0)
    # The texts of reasons and observations.
    rule1 = [F.when(F.col(f"_key{i}"), F.lit(f"Rule 1: {c} drifted (high importance)"))
             for i, c in enumerate(key_columns)]
    rule2 = F.when(F.col("n_drifted") >= 2,
                   F.concat(F.lit("Rule 2: "), F.col("n_drifted").cast("string"), F.lit(" features drifted")))
    rule3 = F.when(fell & some, F.format_string(f"Rule 3: F1 dropped %.3f (>{drop_limit:g})", F.col("f1_drop")))
    watch = F.when(fell & ~some, F.format_string(
        f"F1 dropped %.3f (>{drop_limit:g}) but no input drift was detected; monitor only.", F.col("f1_drop")))
    ruled = summary.withColumn("f1_drop", drop).select(
        "n_drifted", "dataset_drift", "f1_drop",
        F.array_compact(F.array(*rule1, rule2, rule3)).alias("reasons"),
        F.array_compact(F.array(watch)).alias("observations"), (fell & some).alias("_rule3"))
    should = F.size("reasons") > 0
    strategy = F.when(F.col("_rule3"), "reexperiment").when(should, "mixed")
    return ruled.select(should.alias("should_retrain"), strategy.alias("strategy"), "reasons",
                        "observations", "n_drifted", "dataset_drift", "f1_drop")
