import math
import random
import statistics

import pytest
from rows import customer
from pyspark.sql import functions as F

from ebbtide import session
from ebbtide.operators import features as fe
from ebbtide.operators.ordered import exact_medians
from ebbtide.sources.artefacts import load_artefact, save_artefact


def rows(df):
    return {r["customer_id"]: r.asDict() for r in df.collect()}


def test_matrix_has_every_row_and_64_features(sample):
    df = sample(100)
    p = fe.fit_features(df)
    assert len(p.feature_cols) == 64 and not {"churn", "customer_id"} & set(p.feature_cols)
    x = fe.transform_features(df, p)
    assert x.count() == 100
    for c in ("gender", "senior_citizen", "partner", "dependents"):
        assert {r[0] for r in x.select(c).distinct().collect()} <= {0, 1}


def test_saved_parameters_give_the_same_matrix(spark, sample, tmp_path):
    df = sample(100)
    p = fe.fit_features(df)
    save_artefact(spark, str(tmp_path), "features", p.to_dict())
    again = fe.FeatureParams.from_dict(load_artefact(spark, str(tmp_path), "features"))
    assert rows(fe.transform_features(df, p)) == rows(fe.transform_features(df, again))


def test_single_category_keeps_its_dummy(make, sample):
    p = fe.fit_features(sample(100))
    x = fe.transform_features(make([customer(contract="Two year")]), p).first()
    assert x["contract_Two year"] == 1 and x["contract_One year"] == 0


def test_high_charge_uses_the_fitted_median_or_the_frame(make, sample):
    p = fe.fit_features(sample(100))
    one = make([customer(monthly_charges=199.0)])
    assert fe.transform_features(one, p).first()["is_high_charge"] == 1
    assert fe.transform_features(one, p, high_charge="batch").first()["is_high_charge"] == 0


def test_gaps_get_their_own_medians(make):
    df = make([customer(i, total_charges=t, tenure_months=10, monthly_charges=10.0)
               for i, t in enumerate([101.0, 202.0, 404.0, None])])
    p = fe.fit_features(df)
    x = rows(fe.transform_features(df, p))["C00003"]
    assert (x["total_charges"], x["total_vs_expected"]) == (202.0, 2.0)


def test_unknown_values_have_defaults(make, sample):
    p = fe.fit_features(sample(100))
    x = fe.transform_features(make([customer(contract="Weekly", gender="x", senior_citizen="1", partner="No",
                                             dependents="No")]), p).first()
    assert (x["contract_risk"], x["gender"], x["senior_alone"]) == (1, 0, 1)
    assert x["contract_One year"] == x["contract_Two year"] == 0


def test_tenure_outside_bins_fails(make):
    with pytest.raises(Exception, match="outside the bins"):
        fe.add_domain_features(make([customer(tenure_months=-5)]), None).collect()


@pytest.mark.parametrize("n", [1, 2, 5, 2000])
def test_exact_median_matches_builtin(spark, n):
    df = spark.range(n).select((F.rand(7) * 1000).alias("a"), F.lit(3).alias("b"),
                               F.when(F.col("id") % 3 == 0, F.col("id")).alias("c"), F.lit(None).cast("double").alias("z"))
    df = df.persist()
    want = df.agg(*[F.median(c).alias(c) for c in df.columns]).first().asDict()
    got = exact_medians(df, df.columns)
    assert got["z"] is None
    for c in "abc":
        assert got[c] == pytest.approx(want[c])


@pytest.mark.parametrize("left", [200_000, 50, 0])
def test_medians_by_rounds(spark, monkeypatch, left):
    """With few rows left over, a column is settled in two rounds; with none, in four."""
    from ebbtide.operators import ordered
    monkeypatch.setattr(ordered, "FEW_VALUES_LEFT", left)
    rng = random.Random(6)
    rows = [(rng.choice([None, 1.5, rng.gauss(0, 1e3)]), rng.choice([-0.0, 0.0, float("nan")]), None, rng.choice([1e-310, -1e300, 1e300, 5.0])) for _ in range(1500)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    got = exact_medians(df, df.columns)
    for i, c in enumerate(df.columns):
        own = [r[i] for r in rows if r[i] is not None and r[i] == r[i]]
        assert got[c] == (statistics.median(own) if own else None)
    assert exact_medians(df.limit(0), ["a"]) == {"a": None}
    assert not {"percentile_approx", "approx_percentile"} & set(ordered._bucket_counts.__code__.co_names + exact_medians.__code__.co_names)


def test_fitting_reads_its_input_once(spark, sample):
    """Medians take up to four rounds; what the domain features are made of is still read once."""
    df, read = sample(60).coalesce(1), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    fitted = fe.fit_features(df.mapInArrow(counted, df.schema))
    assert read.value == 60
    assert fitted == fe.fit_features(df)


def test_median_images_are_whole(spark):
    """Values that differ in their last bit only, of both signs, beside infinities."""
    near = [1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0), -1.0, math.nextafter(-1.0, 0)]
    for values in (near, near[:3], [*near, math.inf, math.inf, math.inf], [-math.inf] * 3 + near[:2], [5e-324, -5e-324, 0.0]):
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(2)
        assert exact_medians(df, ["x"])["x"] == statistics.median(values)


def test_label_codes_by_map_and_by_join(spark, monkeypatch):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("c", "x"), (None, "z")], "p string, q string")
    want = {("b", "x"): (1, 0), ("a", "y"): (0, 1), ("c", "x"): (2, 0), (None, "z"): (None, 2)}
    assert sorted(map(tuple, fe.label_encode(df, ["p", "q"]).collect()), key=str) == sorted(want.values(), key=str)
    types = fe.label_encode(df, ["p", "q"]).dtypes
    monkeypatch.setattr(fe, "LITERAL_CODES", 2)
    assert sorted(map(tuple, fe.label_encode(df, ["p", "q"]).collect()), key=str) == sorted(want.values(), key=str)
    assert fe.label_encode(df, ["p", "q"]).dtypes == types == [("p", "int"), ("q", "int")]
    gaps = df.withColumn("p", F.lit(None).cast("string"))
    assert fe.label_encode(gaps, ["p", "q"]).dtypes == types and fe.label_encode(gaps, ["p", "q"]).where("p IS NOT NULL").isEmpty()


@pytest.mark.parametrize("limit", [100_000, 2])
def test_sparse_vocabulary_equals_the_dummies(spark, monkeypatch, limit):
    from ebbtide.functions import bounded
    monkeypatch.setattr(bounded.Settled.__init__, "__defaults__", (limit,))
    df = spark.createDataFrame([("b", "x", 1), ("a", "y", 2), ("c", "x", 3), (None, "z", 4)], "p string, q string, k int")
    fitted = fe.fit_vocabulary(df, ["p", "q"])
    later = df.unionByName(spark.createDataFrame([("unseen", None, 5), ("a", "x", 6)], df.schema))
    got = {r.k: (r.p.toArray().tolist(), r.q.toArray().tolist()) for r in fitted.encode(later).collect()}
    categories = {"p": ["a", "b", "c"], "q": ["x", "y", "z"]}
    dummies = later.select("k", *[c.alias(f"d{i}") for i, c in enumerate(fe.one_hot(categories).values())]).collect()
    for r in dummies:
        assert [sorted(v) for v in got[r.k]] == [sorted([r.d0, r.d1]), sorted([r.d2, r.d3])]
    assert len({str(v) for v in got.values()}) == 6 - 1  # (unseen, NULL) and (a, x) are both all zero


def test_a_vocabulary_of_a_million_values(spark):
    df = spark.range(1_000_000, numPartitions=8).select(F.concat(F.lit("v"), "id").alias("c"), F.lit(None).cast("string").alias("n"), "id")
    fitted = fe.fit_vocabulary(df, ["c", "n"])
    assert dict(fitted.sizes) == {"c": 1_000_000, "n": 0}
    some = fitted.encode(df.where("id % 100000 = 7")).collect()
    assert len(some) == 10 and len({int(r.c.indices[0]) for r in some}) == 10 and all(r.c.size == 999_999 for r in some)
    codes = fe.label_encode(df, ["c", "n"])
    assert codes.dtypes[:2] == [("c", "int"), ("n", "int")]
    assert codes.agg(F.min("c"), F.max("c"), F.countDistinct("c"), F.count("n")).first()[:] == (0, 999_999, 1_000_000, 0)


def test_too_many_categories_is_an_error(sample):
    with pytest.raises(ValueError, match="categories"):
        fe.fit_categories(sample(20), ["customer_id"], limit=5)


def test_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, k double")
    out = fe.scale(df, fe.fit_scaling(df, ["a", "k"])).orderBy("a").collect()
    assert [tuple(r) for r in out] == [(-1.0, 0.0), (1.0, 0.0)]


def test_wide_projections_are_compiled_also_in_a_session_built_elsewhere(spark, sample):
    other = spark.newSession()
    other.conf.unset(session.METHOD_LIMIT)
    other.conf.set(session.METHOD_LIMIT, session.SPARKS_METHOD_LIMIT)
    rows = other.createDataFrame(sample(3).toArrow())
    fe.add_domain_features(rows, 1.0)
    assert other.conf.get(session.METHOD_LIMIT) == "8000"
    other.conf.set(session.METHOD_LIMIT, "20000")
    fe.add_domain_features(rows, 1.0)
    assert other.conf.get(session.METHOD_LIMIT) == "20000"
