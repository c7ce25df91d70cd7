from collections import Counter

import pytest
from rows import customer
from pyspark.sql import functions as F

from ebbtide.functions import bounded
from ebbtide.operators import sampling, splits


def source():
    fiber = dict(internet_service="Fiber optic", contract="Month-to-month")
    out = [customer(i, **fiber, payment_method="Electronic check", tenure_months=6, monthly_charges=95.0, churn=1)
           for i in range(650)]
    out += [customer(1000 + i, **fiber, payment_method="Mailed check", tenure_months=10, monthly_charges=80.0,
                     churn=int(i < 200)) for i in range(350)]
    out += [customer(2000 + i, internet_service="DSL" if i % 2 else "No", contract="One year" if i % 2 else "Two year",
                     payment_method="Bank transfer (automatic)", tenure_months=24 + i % 36,
                     monthly_charges=45.0 + i % 15, churn=int(i % 8 == 0)) for i in range(6100)]
    return out


def test_three_way_split_sizes_and_order(make):
    df = make(source())
    out = splits.three_way_split(df).persist()
    sizes = {r["batch"]: r["count"] for r in out.groupBy("batch").count().collect()}
    assert sizes == {"stress": 800, "current": 943, "train": 7100 - 800 - 943}
    rate = {r["batch"]: r["r"] for r in out.groupBy("batch").agg(F.avg("churn").alias("r")).collect()}
    assert rate["stress"] > max(rate["current"], rate["train"])
    assert out.select("customer_id").distinct().count() == 7100
    stress = Counter(r["s"] for r in out.where("batch = 'stress'").select(splits.stress_score().alias("s")).collect())
    assert stress == {4: 550, 3: 250}        # the empty third quota is filled with the worst rows left
    assert out.where("batch = 'current'").groupBy("contract").count().count() >= 2
    out.unpersist()


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_sample_does_not_depend_on_partitioning(spark, make, partitions):
    df = make(source()[:2000:3]).repartition(partitions)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = {r[0] for r in sampling.mark_sample(df, strata=["churn"], size=100).where("sampled").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = sampling.mark_sample(make(source()[:2000:3]), strata=["churn"], size=100).where("sampled")
    assert len(got) == 100 and got == {r[0] for r in want.collect()}


def test_stratum_shares_follow_largest_remainders(spark):
    df = spark.createDataFrame([("a", 7), ("b", 2), ("c", 1)], "stratum string, n long")
    take = {r["stratum"]: r["take"] for r in sampling.allocate(df, size=4).collect()}
    assert take == {"a": 3, "b": 1, "c": 0}
    many = {r["stratum"]: r["take"] for r in sampling.allocate(df, size=4, small=False).collect()}
    assert many == take


def test_sample_with_most_rows_under_one_key(spark):
    """One key holds most rows, with different contents: still exact."""
    df = spark.range(3000).select(F.when(F.col("id") < 2000, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                  F.col("id").alias("v"))
    for size in (1, 37, 999, 1500, 3000):
        out = sampling.mark_sample(df, size=size, key=["k"])
        assert out.count() == 3000 and out.where("sampled").count() == size


def test_sample_with_identical_rows(spark, monkeypatch):
    monkeypatch.setattr(sampling, "COPIES_PER_TASK", 100)
    df = spark.range(3000).select(F.when(F.col("id") < 2000, -1).otherwise(F.col("id")).alias("k"), F.lit("x").alias("t"))
    for size in (1, 37, 1500, 2999):
        out = sampling.mark_sample(df, size=size, key=["k"])
        assert out.count() == 3000 and out.where("sampled").count() == size
        assert out.where("k = -1").count() == 2000


def test_rows_that_differ_by_microseconds(spark):
    stamp = F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id"))
    df = spark.range(100).select(F.when(F.col("id") < 60, -1).otherwise(F.col("id")).alias("k"), stamp.alias("t"))
    for size in (10, 30, 37, 50):
        out = sampling.mark_sample(df, size=size, key=["k"])
        assert out.count() == 100 and out.where("sampled").count() == size
        assert out.select("t").distinct().count() == 100


def test_share_of_a_tie_is_dealt_across_different_rows(spark):
    tied = spark.createDataFrame([("h", 3, i // 2) for i in range(8)], "tie string, take long, v long")
    out = sampling.split_copies(tied, "tie", "take", "hit")
    assert out.count() == 8 and out.where("hit").count() == 3


def test_many_strata_without_broadcast(spark, monkeypatch):
    df = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 90).alias("s"))
    want = {r["k"] for r in sampling.mark_sample(df, strata=["s"], size=200, key=["k"]).where("sampled").collect()}
    monkeypatch.setattr(sampling, "Settled", lambda f, limit=10: bounded.Settled(f, limit))
    got = {r["k"] for r in sampling.mark_sample(df, strata=["s"], size=200, key=["k"]).where("sampled").collect()}
    assert len(want) == 200 and got == want


def test_duplicate_ids_in_the_stress_batch(make):
    rows = source()[:900] + [dict(r) for r in source()[:300]]
    out = splits.three_way_split(make(rows), {4: 50, 3: 50, 2: 50}, 201, 100)
    sizes = {r["batch"]: r["count"] for r in out.groupBy("batch").count().collect()}
    assert sizes == {"stress": 201, "current": 100, "train": 1200 - 301}


def test_quotas_above_the_size_are_kept(make):
    out = splits.stress_batch(make(source()[:1000]), {4: 50, 3: 50}, size=60)
    assert out.count() == 100


def test_holdout_half_and_folds(make):
    df = make(source()[:1003])
    assert splits.holdout_split(df, 0.2).where("holdout").count() == 201
    assert splits.sample_share(df, 0.5).count() == 501
    folds = Counter((r["churn"], r["fold"]) for r in sampling.assign_folds(df).collect())
    for y in (0, 1):
        sizes = [folds[y, f] for f in range(3)]
        assert max(sizes) - min(sizes) <= 1
    with pytest.raises(ValueError):
        sampling.mark_sample(df, size=2000)


def test_number_stress_ranks_every_row(spark, sample):
    from ebbtide.queries import QUERIES
    df = sample(300)
    rows = splits.rank_stress(df).select("customer_id").collect()
    got = {r.customer_id: r.stress_rank for r in splits.number_stress(df.repartition(5)).collect()}
    assert got == {r.customer_id: i + 1 for i, r in enumerate(rows)}
    assert splits.number_stress(df.limit(0)).count() == 0
    assert QUERIES["w02_mixed_sort_ranks"](spark, "/root/testdata/sf0.001").count() == 150


def test_the_sample_reads_a_flag_instead_of_the_stress_order(make):
    plan = splits.three_way_split(make(source()))._jdf.queryExecution().optimizedPlan().toString()
    assert "_stress" in plan and "LOG2" not in plan.upper()
