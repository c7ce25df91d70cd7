import random

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import decisions, drift

NUM = ("tenure_months", "monthly_charges", "total_charges")


def normal(spark, n, params, seed=42):
    rng = random.Random(seed)
    rows = [tuple(float(min(max(rng.gauss(m, s), lo), hi)) for m, s, lo, hi in params) for _ in range(n)]
    return spark.createDataFrame(rows, "tenure_months double, monthly_charges double, total_charges double")


BASE = [(36, 10, 1, 72), (65, 20, 20, 200), (3000, 1500, 0, 10000)]
SHIFT = [(6, 3, 1, 72), (80, 15, 20, 200), (500, 300, 0, 10000)]


@pytest.mark.parametrize("n,test", [(500, drift.KS), (1500, drift.WASSERSTEIN)])
def test_shifted_and_identical(spark, n, test):
    ref, cur = normal(spark, n, BASE).persist(), normal(spark, 300, SHIFT, 1)
    found = drift.detect_drift(ref, cur, NUM).collect()
    assert {r["statistic"] for r in found} == {test} and all(r["drifted"] for r in found)
    same = drift.detect_drift(ref, ref, NUM)
    assert drift.dataset_drift(same).first()["n_drifted_features"] == 0


def test_statistics_match_definition(spark):
    rng = random.Random(3)
    a = [round(rng.gauss(0, 1), 1) for _ in range(300)]
    b = [round(rng.gauss(0.3, 1.2), 1) for _ in range(200)]
    ref, cur = (spark.createDataFrame([(x,) for x in v], "v double") for v in (a, b))
    points = sorted(set(a + b))

    def cdf(v, x):
        return sum(y <= x for y in v) / len(v)
    gaps = [abs(cdf(a, x) - cdf(b, x)) for x in points]
    mean = sum(a) / len(a)
    std = (sum((x - mean) ** 2 for x in a) / len(a)) ** 0.5
    area = sum(g * (y - x) for g, x, y in zip(gaps, points, points[1:]))
    counts = drift.value_counts(ref, cur, ["v"], ["v"])
    r = drift.ordered_statistics(counts, drift.column_profile(counts), 1).first()
    assert r["ks"] == pytest.approx(max(gaps)) and r["wasserstein"] == pytest.approx(area / std)


def test_discrete_tests(spark):
    ref = spark.createDataFrame([("a", "x")] * 60 + [("b", "y")] * 30 + [("c", "y")] * 10, "three string, two string")
    cur = spark.createDataFrame([("a", "x")] * 20 + [("b", "y")] * 40 + [("c", "x")] * 40, "three string, two string")
    r = {x["feature"]: x for x in drift.detect_drift(ref, cur, ["three", "two"], []).collect()}
    assert r["three"]["statistic"] == drift.CHI_SQUARE and r["two"]["statistic"] == drift.Z_TEST
    assert r["three"]["value"] == pytest.approx(40 ** 2 / 20 + 10 ** 2 / 40 + 30 ** 2 / 40)
    assert r["three"]["drifted"] and r["two"]["score"] == pytest.approx(1.0) and not r["two"]["drifted"]


def test_tails_agree_with_tables():
    assert drift._chi_square_tail(5.991464547107979, 2) == pytest.approx(0.05)
    assert drift._chi_square_tail(7.814727903251179, 3) == pytest.approx(0.05)
    assert drift._chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert drift._chi_square_tail(18.307038053275146, 10) == pytest.approx(0.05)
    assert drift._kolmogorov_tail(1.3580986393225505) == pytest.approx(0.05)
    assert drift._chi_square_tail(float("inf"), 2) == 0.0


def test_new_value_and_gaps(spark):
    ref = spark.createDataFrame([(x,) for x in ["a", "b", "c"] * 20 + [None]], "v string")
    cur = spark.createDataFrame([(x,) for x in ["a", "b"] * 20], "v string")
    r = drift.detect_drift(ref, cur, ["v", "absent"], []).first()
    assert (r["n_ref"], r["n_cur"], r["score"], r["drifted"]) == (60, 40, 0.0, True)


def table(spark, drifted):
    names = NUM + ("contract", "internet_service", "payment_method")
    return spark.createDataFrame([(n, n in drifted) for n in names], "feature string, drifted boolean")


@pytest.mark.parametrize("drifted,base,now,strategy,reasons,observed", [
    ((), None, None, None, 0, 0), (("contract",), .5, .48, None, 0, 0),
    (("tenure_months",), None, None, "mixed", 1, 0), (("contract", "payment_method"), .5, .5, "mixed", 1, 0),
    (("contract",), .6, .5, "reexperiment", 1, 0), ((), .6, .5, None, 0, 1),
    (("tenure_months", "total_charges"), .6, .5, "reexperiment", 4, 0)])
def test_decision(spark, drifted, base, now, strategy, reasons, observed):
    r = decisions.retrain_decision(table(spark, drifted), base, now).first()
    assert (r["strategy"], len(r["reasons"]), len(r["observations"])) == (strategy, reasons, observed)
    assert r["should_retrain"] == bool(reasons)


def test_mean_shift(spark):
    a = spark.createDataFrame([(10.0,), (10.0,)], "v double")
    r = drift.mean_shift(a, a.select((F.col("v") * 1.2).alias("v")), ["v"]).first()
    assert r["drifted"] and r["shift"] == pytest.approx(0.2)
