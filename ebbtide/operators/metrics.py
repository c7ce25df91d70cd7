"""Binary-classification metrics from one histogram of scores.

Input rows carry a 0/1 label and a score, and optionally a given 0/1 prediction.
Everything row-proportional is one aggregation by distinct score; rank metrics
use prefix sums over that histogram.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import (COST_FN, COST_FP, DEFAULT_THRESHOLD, GATE_NAMES, GATES)
from ..functions.columns import doubles, flag, level_of, ratio
from .ordered import running_sums

# The sweep's thresholds are these exact doubles, not their two-decimal names.
SWEEP = tuple(float(t) for t in np.arange(0.05, 0.70, 0.01))
MIN_SLICE_ROWS = 10


def predict_at(score: Column, threshold: float = DEFAULT_THRESHOLD) -> Column:
    return flag(score >= F.lit(float(threshold)))


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(flag(condition)), F.lit(0)).cast("long")


def confusion(df: DataFrame, label: str = "label", pred: str = "pred",
              by: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label), F.col(pred)
    return df.groupBy(*by).agg(
        _count((y == 0) & (p == 0)).alias("tn"), _count((y == 0) & (p == 1)).alias("fp"),
        _count((y == 1) & (p == 0)).alias("fn"), _count((y == 1) & (p == 1)).alias("tp"))


def rates() -> dict[str, Column]:
    """accuracy, precision, recall and F1 over the columns tn, fp, fn, tp; 0 when undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return {"accuracy": ratio(tp + tn, tn + fp + fn + tp), "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn), "f1": ratio(2 * tp, 2 * tp + fp + fn)}


def costs(cost_fn: int = COST_FN, cost_fp: int = COST_FP) -> dict[str, Column]:
    fn, fp = F.col("fn") * cost_fn, F.col("fp") * cost_fp
    return {"business_cost_fn": fn, "business_cost_fp": fp, "total_business_cost": fn + fp}


def _histogram(df: DataFrame, label: str, score: str, pred: str | None, threshold: float,
               by: Sequence[str]) -> DataFrame:
    """Counts per distinct score; a missing score ranks below every other."""
    y = F.col(label)
    hit = F.col(pred) if pred else predict_at(F.col(score), threshold)
    ranked = F.coalesce(F.col(score).cast("double"), F.lit(float("-inf")))
    return df.groupBy(*by, ranked.alias("score")).agg(
        _count(y == 1).alias("pos"), _count(y == 0).alias("neg"),
        _count((y == 1) & (hit == 1)).alias("tp"), _count((y == 0) & (hit == 1)).alias("fp"))


def _rank_sums(hist: DataFrame, by: Sequence[str], groups: int | None) -> DataFrame:
    """Totals of the histogram, ROC AUC (ties count half) and average precision (step sum).

    With one class only AUC is NULL; without positives average precision is 0.
    """
    run = running_sums(hist, by, "score", ["pos", "neg"], groups)
    pos, neg = F.col("pos"), F.col("neg")
    # Twice the count of correctly ordered pairs, in exact integers.
    pairs = pos.cast("decimal(18,0)") * (2 * F.col("neg_before") + neg).cast("decimal(19,0)")
    true_at = (F.col("pos_total") - F.col("pos_before")).cast("double")
    called_at = true_at + (F.col("neg_total") - F.col("neg_before")).cast("double")
    step = F.try_divide(pos.cast("double"), F.col("pos_total").cast("double")) * true_at / called_at
    p, n = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    return run.groupBy(*by).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pos", "neg", "tp", "fp")],
        F.try_divide(F.sum(pairs).cast("double"), 2.0 * p * n).alias("auc_roc"),
        F.coalesce(F.sum(step), F.lit(0.0)).alias("auc_pr"))


def rank_metrics(df: DataFrame, label: str = "label", score: str = "score",
                 by: Sequence[str] = (), groups: int | None = 1) -> DataFrame:
    """ROC AUC and average precision, one row per group of `by`."""
    hist = _histogram(df, label, score, None, DEFAULT_THRESHOLD, by)
    return _rank_sums(hist, by, groups).select(*by, "auc_roc", "auc_pr")


def evaluate(df: DataFrame, label: str = "label", score: str = "score", pred: str | None = None,
             threshold: float = DEFAULT_THRESHOLD, by: Sequence[str] = (),
             groups: int | None = 1) -> DataFrame:
    """The 15 metric fields, one row (per group of `by`), from one pass over the rows."""
    hist = _histogram(df, label, score, pred, threshold, by)
    sums = (_rank_sums(hist, by, groups).withColumn("fn", F.col("pos") - F.col("tp"))
            .withColumn("tn", F.col("neg") - F.col("fp")))
    r, c = rates(), costs()
    return sums.select(
        *by, F.lit(float(threshold)).alias("threshold"), r["accuracy"].alias("accuracy"),
        r["f1"].alias("f1"), r["recall"].alias("recall"), r["precision"].alias("precision"),
        "auc_roc", "auc_pr", "tp", "fp", "fn", "tn", F.col("fn").alias("missed_churners"),
        *[v.alias(k) for k, v in c.items()])


def threshold_sweep(df: DataFrame, label: str = "label", score: str = "score",
                    thresholds: Sequence[float] = SWEEP, cost_fn: int = COST_FN,
                    cost_fp: int = COST_FP) -> DataFrame:
    """Cost, F1, counts and precision at every threshold that predicts a positive.

    Rows are counted once by the number of thresholds at or below their score;
    the rest is suffix sums over at most len(thresholds) + 1 rows.
    """
    cuts = sorted(float(t) for t in thresholds)
    level = level_of(cuts, F.col(score).cast("double"))
    y = F.col(label)
    counts = df.groupBy(level.alias("level")).agg(
        _count(y == 1).alias("pos"), _count(y == 0).alias("neg"))
    steps = df.sparkSession.range(len(cuts) + 1).select(F.col("id").cast("int").alias("level"))
    full = steps.join(counts, "level", "left").fillna(0, ["pos", "neg"])
    at_least = Window.orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    run = full.select("level", F.sum("pos").over(at_least).alias("tp"),
                      F.sum("neg").over(at_least).alias("fp"),
                      F.sum("pos").over(Window.partitionBy(F.lit(1))).alias("all_pos"))
    rows = run.where((F.col("level") > 0) & (F.col("tp") + F.col("fp") > 0)).withColumn(
        "fn", F.col("all_pos") - F.col("tp"))
    exact = F.element_at(doubles(cuts), F.col("level"))
    return rows.select(
        F.round(exact, 2).alias("threshold"), exact.alias("exact_threshold"),
        (F.col("fn") * cost_fn + F.col("fp") * cost_fp).alias("cost"),
        ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
        "fn", "fp", ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"))


def best_thresholds(sweep: DataFrame, min_precision: float | None = None) -> DataFrame:
    """Cost- and F1-optimal thresholds of a sweep, and its cost at 0.50.

    The lowest threshold wins ties. A minimum precision narrows the cost choice
    when some threshold reaches it, and is ignored otherwise.
    """
    t, cost, f1 = F.col("exact_threshold"), F.col("cost"), F.col("f1")
    free = F.min(F.struct(cost.alias("cost"), t.alias("t")))
    fits = F.lit(min_precision is not None) & (F.col("precision") >= F.lit(min_precision or 0.0))
    bound = F.min(F.when(fits, F.struct(cost.alias("cost"), t.alias("t"))))
    best = F.coalesce(F.col("bound"), F.col("free"))
    return sweep.agg(
        free.alias("free"), bound.alias("bound"),
        F.max(F.when(f1 > 0, F.struct(f1.alias("f1"), (-t).alias("t")))).alias("top"),
        F.max(F.when(F.col("threshold") == 0.5, cost)).alias("default_cost")).select(
        F.coalesce(best["t"], F.lit(DEFAULT_THRESHOLD)).alias("cost_optimal"),
        best["cost"].alias("best_cost"),
        F.coalesce(-F.col("top")["t"], F.lit(DEFAULT_THRESHOLD)).alias("f1_optimal"),
        F.coalesce(F.col("top")["f1"], F.lit(0.0)).alias("best_f1"),
        F.lit(min_precision).cast("double").alias("min_precision"), "default_cost")


def slice_metrics(df: DataFrame, columns: Sequence[str], label: str = "label", pred: str = "pred",
                  min_rows: int = MIN_SLICE_ROWS) -> DataFrame:
    """n, churn rate, F1 and recall for each value of each slice column, in one scan; NULL is no slice."""
    entries = F.array(*[F.struct(F.lit(c).alias("slice_column"),
                                 F.col(f"`{c}`").cast("string").alias("slice_value")) for c in columns])
    long = df.select(label, pred, F.inline(entries))
    counts = confusion(long.where("slice_value IS NOT NULL"), label, pred, ["slice_column", "slice_value"])
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    r = rates()
    return (counts.withColumn("n", n).where(F.col("n") >= min_rows)
            .select(F.concat("slice_column", F.lit("="), F.col("slice_value")).alias("slice"), "n",
                    ratio(F.col("tp") + F.col("fn"), F.col("n")).alias("churn_rate"),
                    r["f1"].alias("f1"), r["recall"].alias("recall")).orderBy("slice"))


def check_gates(metrics: DataFrame, gates: Mapping[str, float] = GATES) -> DataFrame:
    """Adds `failures` (a message per missed minimum, or per metric that is NULL) and `passed`."""
    messages = [F.when(F.col(m).isNull(), F.lit(f"{GATE_NAMES.get(m, m)} is undefined"))
                .when(F.col(m) < F.lit(float(least)),
                      F.format_string(f"{GATE_NAMES.get(m, m)} %.3f < {least}", F.col(m)))
                for m, least in gates.items()]
    return (metrics.withColumn("failures", F.array_compact(F.array(*messages)))
            .withColumn("passed", F.size("failures") == 0))


def compare_models(scored: DataFrame, models: int, label: str = "label", score: str = "score",
                   threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Metrics of several candidates scored side by side in a long table with `model`."""
    m = evaluate(scored, label, score, threshold=threshold, by=["model"], groups=models)
    return m.select("model", "f1", "recall", "precision", "auc_roc",
                    F.col("fn").alias("missed"), F.col("business_cost_fn").alias("cost"))


def leaderboard(comparison: DataFrame, keep: int = 3) -> DataFrame:
    """Candidates by F1: rank, the winner, the `keep` that go on to tuning."""
    rank = F.row_number().over(Window.orderBy(F.desc("f1"), "model"))
    return (comparison.withColumn("rank", rank)
            .withColumn("is_winner", F.col("rank") == 1)
            .withColumn("tuned", F.col("rank") <= keep).orderBy("rank"))


def tuning_gain(default: DataFrame, tuned: DataFrame) -> DataFrame:
    """Default against tuned F1 by model name."""
    pair = tuned.select("model", F.col("f1").alias("tuned_f1")).join(
        default.select("model", F.col("f1").alias("default_f1")), "model")
    best = F.max("tuned_f1").over(Window.partitionBy(F.lit(1)))
    return pair.select("model", "default_f1", "tuned_f1",
                       (F.col("tuned_f1") - F.col("default_f1")).alias("improvement"),
                       (F.col("tuned_f1") == best).alias("is_production"))
