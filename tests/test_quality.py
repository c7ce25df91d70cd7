import pytest
from rows import customer
from pyspark.sql import functions as F

from ebbtide.functions.columns import number
from ebbtide.operators import quality as q


def test_valid_row_passes(make):
    assert q.validate(make([customer()])).count() == 1


@pytest.mark.parametrize("bad", [{"gender": "Unknown"}, {"tenure_months": -1}, {"contract": "Three year"},
                                 {"churn": 2}, {"partner": None}, {"monthly_charges": 200.01}])
def test_bad_row_fails(make, bad):
    with pytest.raises(q.ValidationError) as e:
        q.validate(make([customer(), customer(1, **bad)]))
    assert list(e.value.violations.values()) == [1]


def test_null_total_passes_but_not_as_request(make):
    df = make([customer(total_charges=None)])
    assert q.validate(df).count() == 1
    assert [r["check"] for r in q.violations(df, q.REQUEST).collect()] == ["not_null"]


def test_request_profile_checks_ranges_only(make):
    df = make([customer(gender="Unknown", tenure_months=73)])
    assert [r["column"] for r in q.violations(df, q.REQUEST).collect()] == ["tenure_months"]


def test_extra_columns_pass_and_missing_fail(make):
    df = make([customer()])
    assert q.validate(df.selectExpr("*", "1 AS extra")).columns[-1] == "extra"
    with pytest.raises(q.ValidationError):
        q.validate(df.drop("contract"))
    assert q.validate(df.drop("churn"), profile=q.INFERENCE).count() == 1


def test_quarantine_keeps_every_row(make):
    valid, rejected = q.quarantine(make([customer(), customer(1, churn=2, gender="x"), customer(2)]))
    assert valid.count() == 2
    assert [r["n_violations"] for r in rejected.collect()] == [2]


def test_text_that_is_no_number_is_a_type_violation(make):
    df = make([customer()]).selectExpr("* EXCEPT (monthly_charges)", "'12d' AS monthly_charges")
    assert [r["check"] for r in q.violations(df).collect()] == ["type"]


def test_numbers_are_not_read_through_text(spark, sample):
    for df in (q.mark_valid(sample(3)), q.coerce(sample(3)), q.rule_report(sample(3))):
        assert "RLIKE" not in df._jdf.queryExecution().optimizedPlan().toString().upper()
    odd = [None, 0.0, -0.0, 1e-300, 1.7976931348623157e308, 70.35, float("nan"), float("inf"), float("-inf")]
    df = spark.createDataFrame([(v, None if v is None else 7, None if v is None else repr(v)) for v in odd],
                               "monthly_charges double, total_charges long, text string")
    for name in ("monthly_charges", "total_charges"):
        got, text = df.select(q.coerced(df, name).alias("a"), number(F.col(name)).alias("b")).toArrow().to_pydict().values()
        assert list(map(repr, got)) == list(map(repr, text))
    texts = df.select(F.col("text").alias("monthly_charges"))
    assert [r[0] for r in texts.select(q.coerced(texts, "monthly_charges")).collect()][5:] == [70.35, None, float("inf"), float("-inf")]
