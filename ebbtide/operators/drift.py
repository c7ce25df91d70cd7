"""Distribution drift between two batches, column by column and as a whole.

Both sides are unpivoted and counted per (feature, value), one scan per side for
all columns, and the counts are written once. That table gives the profile, which
decides each column's test, and the chosen statistics as aggregates; the inputs are
not read again. Only p-values of the per-feature summary use Python.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..config import (BINARY, DISTANCE_LIMIT, DRIFT_SHARE, FEW_VALUES, MEAN_SHIFT_LIMIT, NUMERIC,
                      P_VALUE_LIMIT, SMALL_REFERENCE_ROWS)
from ..functions.bounded import Settled
from ..session import staged
from .ordered import running_sums

# Names of the tests.
KS = "K-S p_value"
CHI_SQUARE = "chi-square p_value"
Z_TEST = "Z-test p_value"
WASSERSTEIN = "Wasserstein distance (normed)"
JENSEN_SHANNON = "Jensen-Shannon distance"
MIN_SPREAD = 0.001


def shared_columns(reference: DataFrame, current: DataFrame,
                   columns: Sequence[str] | None = None) -> list[str]:
    wanted = columns if columns is not None else NUMERIC + BINARY
    return [c for c in wanted if c in reference.columns and c in current.columns]


def value_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str],
                 numeric: Sequence[str] = NUMERIC) -> DataFrame:
    """(feature, num, cat, ref, cur): counts of each value on both sides, gaps left out."""
    def entry(c: str) -> Column:
        is_number = c in numeric
        num = F.col(f"`{c}`").cast("double") if is_number else F.lit(None).cast("double")
        cat = F.lit(None).cast("string") if is_number else F.col(f"`{c}`").cast("string")
        # -0.0 and 0.0 are one value; infinities count as gaps.
        num = F.when(F.abs(num) < F.lit(float("inf")), num + F.lit(0.0))
        return F.struct(F.lit(c).alias("feature"), num.alias("num"), cat.alias("cat"))

    def side(df: DataFrame, ref: int) -> DataFrame:
        return (df.select(F.inline(F.array(*[entry(c) for c in columns])))
                .where("num IS NOT NULL OR cat IS NOT NULL")
                .withColumn("ref", F.lit(ref)).withColumn("cur", F.lit(1 - ref)))

    return (side(reference, 1).unionByName(side(current, 0)).groupBy("feature", "num", "cat")
            .agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur")))


def column_profile(counts: DataFrame) -> DataFrame:
    """Rows, distinct values, kind and reference mean of each feature."""
    return counts.groupBy("feature").agg(
        F.sum("ref").alias("n_ref"), F.sum("cur").alias("n_cur"), F.count("*").alias("n_values"),
        F.min("num").alias("first_num"), F.min("cat").alias("first_cat"),
        F.try_divide(F.sum(F.col("num") * F.col("ref")), F.sum("ref").cast("double")).alias("mean_ref"))


def choose_test(few_values: int = FEW_VALUES, small: int = SMALL_REFERENCE_ROWS) -> Column:
    """Test by reference size and cardinality, over the columns of the profile."""
    discrete = F.col("first_cat").isNotNull() | (F.col("n_values") <= few_values)
    return (F.when(F.col("n_ref") > small, F.when(discrete, JENSEN_SHANNON).otherwise(WASSERSTEIN))
            .when(~discrete, KS).when(F.col("n_values") > 2, CHI_SQUARE).otherwise(Z_TEST))


def ordered_statistics(counts: DataFrame, profile: DataFrame, features: int) -> DataFrame:
    """Two-sample KS distance and normalised Wasserstein-1 of each numeric feature.

    `profile` has at most `features` rows, here and below.
    """
    run = running_sums(counts.select("feature", "num", "ref", "cur"),
                       ["feature"], "num", ["ref", "cur"], features, next_value=True)
    f = F.try_divide((F.col("ref_before") + F.col("ref")).cast("double"), F.col("ref_total").cast("double"))
    g = F.try_divide((F.col("cur_before") + F.col("cur")).cast("double"), F.col("cur_total").cast("double"))
    gap = F.abs(f - g)
    joined = run.join(F.broadcast(profile.select("feature", "mean_ref")), "feature")
    square = F.col("ref") * (F.col("num") - F.col("mean_ref")) * (F.col("num") - F.col("mean_ref"))
    sums = joined.groupBy("feature").agg(
        F.max(gap).alias("ks"), F.max("ref_total").alias("_n"), F.sum(square).alias("_ss"),
        F.coalesce(F.sum(gap * (F.col("next_value") - F.col("num"))), F.max(gap) * 0).alias("_area"))
    spread = F.greatest(F.sqrt(F.try_divide(F.col("_ss"), F.col("_n").cast("double"))), F.lit(MIN_SPREAD))
    return sums.select("feature", "ks", (F.col("_area") / spread).alias("wasserstein"))


def discrete_statistics(counts: DataFrame, profile: DataFrame) -> DataFrame:
    """Chi-square, two-proportion z and Jensen-Shannon distance of each discrete feature."""
    joined = counts.join(F.broadcast(profile), "feature")
    ref, cur = F.col("ref").cast("double"), F.col("cur").cast("double")
    n_ref, n_cur = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    scaled = ref * n_cur / F.nullif(n_ref, F.lit(0.0))
    # The current counts are the expected side of this statistic.
    chi = F.when(cur > 0, (scaled - cur) * (scaled - cur) / cur).otherwise(F.lit(float("inf")))
    p, q = F.try_divide(ref, n_ref), F.try_divide(cur, n_cur)
    middle = (p + q) / 2
    bits = (F.when(p > 0, p * F.log(p / middle)).otherwise(0.0)
            + F.when(q > 0, q * F.log(q / middle)).otherwise(0.0)) / 2
    first = F.coalesce(F.col("num") == F.col("first_num"), F.col("cat") == F.col("first_cat"))
    sums = joined.groupBy("feature", "n_ref", "n_cur").agg(
        F.sum(chi).alias("chi_square"), F.sum(bits).alias("_js"),
        F.sum(F.when(first, F.col("ref")).otherwise(0)).alias("_fr"),
        F.sum(F.when(first, F.col("cur")).otherwise(0)).alias("_fc"))
    p1 = 1 - F.try_divide(F.col("_fr").cast("double"), n_ref)
    p2 = 1 - F.try_divide(F.col("_fc").cast("double"), n_cur)
    pooled = 1 - F.try_divide((F.col("_fr") + F.col("_fc")).cast("double"), n_ref + n_cur)
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n_ref) + F.try_divide(F.lit(1.0), n_cur)))
    z = F.when(error > 0, (p1 - p2) / error).when(error.isNotNull(), 0.0)
    return sums.select("feature", "chi_square", z.alias("z"),
                       F.sqrt(F.greatest(F.col("_js"), F.lit(0.0))).alias("jensen_shannon"))


def _kolmogorov_tail(x: float) -> float:
    if x < 0.2:
        return 1.0
    return min(1.0, max(0.0, 2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * x * x)
                                     for j in range(1, 101))))


def _chi_square_tail(x: float, dof: int) -> float:
    """Survival function for a whole number of degrees of freedom, by its finite sum."""
    if math.isinf(x):
        return 0.0
    if dof <= 0 or x <= 0:
        return 1.0
    half = x / 2
    if dof % 2:
        total, term, start = math.erfc(math.sqrt(half)), math.exp(-half) * math.sqrt(half / math.pi) * 2, 1.5
    else:
        total, term, start = 0.0, math.exp(-half), 1.0
    for i in range(dof // 2):
        total += term
        term *= half / (start + i)
    return min(1.0, total)


@F.pandas_udf(T.DoubleType())
def _p_value(test: pd.Series, statistic: pd.Series, n_ref: pd.Series, n_cur: pd.Series,
             n_values: pd.Series) -> pd.Series:
    def one(t, s, n, m, k):
        if s is None or math.isnan(s):
            return None
        if t == KS:
            return _kolmogorov_tail(math.sqrt(n * m / (n + m)) * s)
        if t == CHI_SQUARE:
            return _chi_square_tail(s, int(k) - 1)
        if t == Z_TEST:
            return math.erfc(abs(s) / math.sqrt(2))
        return None
    return pd.Series([one(*r) for r in zip(test, statistic, n_ref, n_cur, n_values)], dtype="float64")


def detect_drift(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None,
                 numeric: Sequence[str] = NUMERIC) -> DataFrame:
    """One row per shared column: test, raw statistic, score, and whether it drifted.

    `score` is a p-value for small references and a distance for large ones;
    `score_kind` says which.
    """
    shared = shared_columns(reference, current, columns)
    if not shared:
        raise ValueError("the two frames share none of the drift columns")
    counts = staged(value_counts(reference, current, shared, numeric), "value-counts")
    # One row per column, so always small; it decides which statistics are computed at all.
    profile = Settled(column_profile(counts).withColumn("statistic", choose_test()))
    ordered = [r["feature"] for r in profile.rows if r["statistic"] in (KS, WASSERSTEIN)]
    discrete = [r["feature"] for r in profile.rows if r["statistic"] not in (KS, WASSERSTEIN)]
    table = profile.frame
    for names, statistics in (
            (ordered, lambda c: ordered_statistics(c, profile.frame, len(ordered))),
            (discrete, lambda c: discrete_statistics(c, profile.frame))):
        if names:
            table = table.join(F.broadcast(statistics(counts.where(F.col("feature").isin(names)))), "feature", "left")
    for name in ("ks", "wasserstein", "chi_square", "z", "jensen_shannon"):
        if name not in table.columns:
            table = table.withColumn(name, F.lit(None).cast("double"))
    test = F.col("statistic")
    value = (F.when(test == KS, F.col("ks")).when(test == CHI_SQUARE, F.col("chi_square"))
             .when(test == Z_TEST, F.col("z")).when(test == WASSERSTEIN, F.col("wasserstein"))
             .otherwise(F.col("jensen_shannon")))
    is_distance = test.isin(WASSERSTEIN, JENSEN_SHANNON)
    scored = table.withColumn("value", value).withColumn("_p", _p_value(
        test, F.col("value"), F.col("n_ref"), F.col("n_cur"), F.col("n_values")))
    score = F.when(is_distance, F.col("value")).otherwise(F.col("_p"))
    drifted = F.when(is_distance, score >= DISTANCE_LIMIT).otherwise(score < P_VALUE_LIMIT)
    return scored.select(
        "feature", F.coalesce(drifted, F.lit(False)).alias("drifted"), "statistic", "value",
        score.alias("score"), F.when(is_distance, "distance").otherwise("p_value").alias("score_kind"),
        "n_ref", "n_cur", "n_values")


def dataset_drift(drift: DataFrame, share: float = DRIFT_SHARE) -> DataFrame:
    """Number and share of drifted columns, and whether the share reaches the limit."""
    n = F.sum(F.col("drifted").cast("int"))
    return drift.agg(F.count("*").alias("n_features"), n.alias("n_drifted_features"),
                     (n / F.count("*")).alias("drift_share"),
                     (n / F.count("*") >= share).alias("dataset_drift"))


def mean_shift(reference: DataFrame, current: DataFrame, columns: Sequence[str] = NUMERIC,
               limit: float = MEAN_SHIFT_LIMIT) -> DataFrame:
    """Relative shift of each column's mean, flagged above `limit`."""
    def means(df: DataFrame, name: str) -> DataFrame:
        avgs = df.agg(*[F.avg(c).alias(c) for c in columns])
        return avgs.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias(name))
                                              for c in columns])))
    both = means(reference, "mean_ref").join(F.broadcast(means(current, "mean_cur")), "feature")
    shift = F.try_divide(F.abs(F.col("mean_ref") - F.col("mean_cur")), F.col("mean_ref"))
    return both.withColumn("shift", shift).withColumn(
        "drifted", F.coalesce(F.col("shift") > limit, F.lit(False)))
