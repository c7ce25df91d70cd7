import random

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import metrics as m


def frame(spark, rows):
    return spark.createDataFrame(rows, "label int, pred int, score double")


def brute(rows):
    """AUC by pairs and average precision by definition."""
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, last = 0.0, 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(p >= t for p in pos)
        ap += (tp / len(pos) - last) * tp / sum(s >= t for _, s in rows)
        last = tp / len(pos)
    return auc, ap


def test_perfect(spark):
    r = m.evaluate(frame(spark, [(0, 0, .1), (0, 0, .2), (1, 1, .8), (1, 1, .9)]), pred="pred").first()
    assert (r["f1"], r["auc_roc"], r["auc_pr"], r["total_business_cost"]) == (1.0, 1.0, 1.0, 0)


def test_all_wrong(spark):
    r = m.evaluate(frame(spark, [(0, 1, .8), (0, 1, .8), (1, 0, .2), (1, 0, .2), (1, 0, .2)]), pred="pred").first()
    assert (r["recall"], r["f1"], r["missed_churners"], r["business_cost_fn"]) == (0.0, 0.0, 3, 4500)


def test_mixed_cost_and_field_count(spark):
    df = m.evaluate(frame(spark, [(1, 1, .9), (1, 0, .3), (1, 0, .3), (0, 1, .7), (0, 0, .2)]), pred="pred")
    assert len(df.columns) == 15
    assert df.first()["total_business_cost"] == 2 * 1500 + 50


def test_given_prediction_differs_from_threshold(spark):
    df = frame(spark, [(1, 0, .9), (0, 1, .1)])
    assert m.evaluate(df, pred="pred").first()["tp"] == 0
    assert m.evaluate(df).first()["tp"] == 1


def test_one_class_gives_null_auc(spark):
    r = m.evaluate(frame(spark, [(0, 0, .1), (0, 1, .9)])).first()
    assert r["auc_roc"] is None and r["auc_pr"] == 0.0 and (r["tn"], r["fp"]) == (1, 1)


@pytest.mark.parametrize("levels", [3, 1000])
def test_rank_metrics_match_definition(spark, levels):
    rng = random.Random(levels)
    rows = [(int(rng.random() < 0.3), rng.randrange(levels) / levels) for _ in range(400)]
    df = spark.createDataFrame([(y, 0, s) for y, s in rows], "label int, pred int, score double")
    r = m.rank_metrics(df).first()
    auc, ap = brute(rows)
    assert r["auc_roc"] == pytest.approx(auc) and r["auc_pr"] == pytest.approx(ap)
    by = m.rank_metrics(df.withColumn("g", F.lit("x")).unionByName(df.withColumn("g", F.lit("y"))), by=["g"],
                        groups=None).collect()
    assert len(by) == 2 and all(x["auc_roc"] == pytest.approx(auc) for x in by)


def test_sweep_uses_exact_thresholds_and_skips_empty_ones(spark):
    rows = [(1, 0, 0.06), (0, 0, 0.3), (1, 0, 0.3)]
    got = {round(r["threshold"], 2): r for r in m.threshold_sweep(frame(spark, rows)).collect()}
    assert max(got) == 0.29 or max(got) == 0.3
    assert m.SWEEP[1] != 0.06 and got[0.06]["fn"] == 1      # 0.06 lies under the sweep's second threshold
    assert got[0.05]["fn"] == 0


def test_thresholds_prefer_the_lowest_and_honour_precision(spark):
    rows = [(1, 0, .6)] * 2 + [(0, 0, .2)] * 3
    sweep = m.threshold_sweep(frame(spark, rows)).persist()
    best = m.best_thresholds(sweep).first()
    assert best["best_f1"] == 1.0 and 0.2 < best["f1_optimal"] < 0.22
    assert m.best_thresholds(sweep, 2.0).first()["best_cost"] == best["best_cost"]
    none = m.best_thresholds(m.threshold_sweep(frame(spark, [(0, 0, 0.01)]))).first()
    assert (none["cost_optimal"], none["f1_optimal"], none["best_cost"]) == (0.5, 0.5, None)


@pytest.mark.parametrize("values,failed", [((.7, .8, .6, .85), 0), ((.3, .8, .6, .85), 1),
                                           ((.7, .4, .6, .85), 1), ((.1, .1, .1, .5), 4)])
def test_gates(spark, values, failed):
    df = spark.createDataFrame([values], "f1 double, recall double, auc_pr double, auc_roc double")
    r = m.check_gates(df).first()
    assert len(r["failures"]) == failed and r["passed"] == (failed == 0)


def test_small_slices_are_left_out(spark):
    df = spark.createDataFrame([("a", 1, 1)] * 12 + [("b", 0, 1)] * 9, "s string, label int, pred int")
    r = m.slice_metrics(df, ["s"]).collect()
    assert [(x["slice"], x["n"], x["f1"]) for x in r] == [("s=a", 12, 1.0)]


def test_an_undefined_metric_fails_its_gate(spark):
    from ebbtide.operators.metrics import check_gates, slice_metrics
    row = check_gates(spark.createDataFrame([(0.9, None)], "f1 double, auc_roc double"), {"f1": 0.5, "auc_roc": 0.7}).first()
    assert not row.passed and len(row.failures) == 1
    frame = spark.createDataFrame([(1, 1, None)] * 5 + [(1, 0, "a")] * 5, "label int, pred int, s string")
    assert [r.slice for r in slice_metrics(frame, ["s"], min_rows=1).collect()] == ["s=a"]
