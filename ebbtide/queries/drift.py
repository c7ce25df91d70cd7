"""Drift between two batches and the retraining decision."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DRIFT_COLUMNS, NUMERIC
from ..operators import drift as dr
from ..operators.decisions import retrain_decision
from ..operators.metrics import confusion, rates
from .drift_sql import drift_ctes
from .metrics_sql import RATES_SQL, confusion_sql
from .registry import DOCS, EVENTS, SCORED, event_halves, query, r6, scored_customers, scored_documents

_TEXT = ("contract", "internet_service", "payment_method")
_SIDES = SCORED + ", ref AS (SELECT * FROM sc WHERE stress_score < 3), cur AS (SELECT * FROM sc WHERE stress_score >= 3)"
CUSTOMER_DRIFT = _SIDES + "," + drift_ctes(NUMERIC, _TEXT + ("gender",))
EVENT_DRIFT = EVENTS + "," + drift_ctes(["value"], ["event_type"])
DOC_DRIFT = (DOCS + ", ref AS (SELECT * FROM sc WHERE label = 0), cur AS (SELECT * FROM sc WHERE label = 1),"
             + drift_ctes(["score"], ["lang"]))


def customer_sides(spark, d):
    df = scored_customers(spark, d)
    return df.where("stress_score < 3"), df.where("stress_score >= 3")


def document_sides(spark, d):
    df = scored_documents(spark, d)
    return df.where("label = 0"), df.where("label = 1")


SUBJECTS = (("", CUSTOMER_DRIFT, customer_sides, NUMERIC, DRIFT_COLUMNS + ("gender",)),
            ("_of_events", EVENT_DRIFT, event_halves, ("value",), ("value", "event_type")),
            ("_of_documents", DOC_DRIFT, document_sides, ("score",), ("score", "lang")))


def _statistics(spark, d, load, numeric, columns):
    """(ordered, discrete) statistics of the named columns, whatever test they would get."""
    ref, cur = load(spark, d)
    number = [c for c in columns if c in numeric]
    text = [c for c in columns if c not in numeric]

    def with_profile(names, function, *more):
        counts = dr.value_counts(ref, cur, names, numeric)
        return function(counts, dr.column_profile(counts), *more)
    return (lambda: with_profile(number, dr.ordered_statistics, len(number)),
            lambda: with_profile(text, dr.discrete_statistics))


for _suffix, _sql, _load, _numeric, _columns in SUBJECTS:
    _is_text = "feature IN (" + ", ".join(f"'{c}'" for c in _columns if c not in _numeric) + ")"

    @query(f"d01_value_counts{_suffix}", _sql + """ SELECT feature, count(*) AS n_values, CAST(sum(r) AS BIGINT) AS ref,
        CAST(sum(c) AS BIGINT) AS cur FROM vc GROUP BY feature""")
    def _(spark, d, load=_load, numeric=_numeric, columns=_columns):
        ref, cur = load(spark, d)
        shared = dr.shared_columns(ref, cur, (*columns, "absent"))
        return dr.value_counts(ref, cur, shared, numeric).groupBy("feature").agg(
            F.count("*").alias("n_values"), F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))

    @query(f"d02_kolmogorov_smirnov{_suffix}", _sql + " SELECT feature, round(ks, 9) AS ks FROM os")
    def _(spark, d, args=(_load, _numeric, _columns)):
        return _statistics(spark, d, *args)[0]().select("feature", F.round("ks", 9).alias("ks"))

    @query(f"d03_chi_square{_suffix}", _sql + f" SELECT feature, round(chi_square, 6) AS chi_square FROM zs WHERE {_is_text}")
    def _(spark, d, args=(_load, _numeric, _columns)):
        return _statistics(spark, d, *args)[1]().select("feature", r6("chi_square").alias("chi_square"))

    @query(f"d04_two_proportion_z{_suffix}", _sql + f" SELECT feature, round(z, 6) AS z FROM zs WHERE {_is_text}")
    def _(spark, d, args=(_load, _numeric, _columns)):
        return _statistics(spark, d, *args)[1]().select("feature", r6("z").alias("z"))

    @query(f"d05_wasserstein{_suffix}", _sql + " SELECT feature, round(wasserstein, 6) AS wasserstein FROM os")
    def _(spark, d, args=(_load, _numeric, _columns)):
        return _statistics(spark, d, *args)[0]().select("feature", r6("wasserstein").alias("wasserstein"))

    @query(f"d06_jensen_shannon{_suffix}", _sql + f" SELECT feature, round(jensen_shannon, 6) AS jensen_shannon FROM zs WHERE {_is_text}")
    def _(spark, d, args=(_load, _numeric, _columns)):
        return _statistics(spark, d, *args)[1]().select("feature", r6("jensen_shannon").alias("jensen_shannon"))

    @query(f"d07_test_selection{_suffix}", _sql + " SELECT feature, n_ref, n_cur, n_values, statistic FROM ch")
    def _(spark, d, load=_load, numeric=_numeric, columns=_columns):
        profile = dr.column_profile(dr.value_counts(*load(spark, d), columns, numeric))
        return profile.select("feature", "n_ref", "n_cur", "n_values", dr.choose_test().alias("statistic"))

    @query(f"d08_dataset_drift{_suffix}", _sql + """ SELECT count(*) AS n_features,
        count(*) FILTER (WHERE drifted) AS n_drifted_features,
        round(CAST(count(*) FILTER (WHERE drifted) AS DOUBLE) / count(*), 6) AS drift_share,
        CAST(count(*) FILTER (WHERE drifted) AS DOUBLE) / count(*) >= 0.5 AS dataset_drift FROM dr""")
    def _(spark, d, load=_load, numeric=_numeric, columns=_columns):
        return dr.dataset_drift(dr.detect_drift(*load(spark, d), columns, numeric)).withColumn(
            "drift_share", r6("drift_share"))

    @query(f"d09_detect_drift{_suffix}", _sql + """ SELECT feature, drifted, statistic, round(value, 6) AS value,
        n_ref, n_cur, n_values FROM dr""")
    def _(spark, d, load=_load, numeric=_numeric, columns=_columns):
        return dr.detect_drift(*load(spark, d), columns, numeric).select(
            "feature", "drifted", "statistic", r6("value").alias("value"), "n_ref", "n_cur", "n_values")


@query("d10_mean_shift", _SIDES + " " + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, round(abs(r.m - c.m) / r.m, 6) AS shift, abs(r.m - c.m) / r.m > 0.1 AS drifted
    FROM (SELECT avg({c}) AS m FROM ref) r, (SELECT avg({c}) AS m FROM cur) c""" for c in NUMERIC))
def _(spark, d):
    return dr.mean_shift(*customer_sides(spark, d)).select("feature", r6("shift").alias("shift"), "drifted")


# --- decision: baseline F1 at threshold 0.20 on the reference, current F1 at 0.50 on the batch ----------

_F1S = (", rp AS (SELECT *, CASE WHEN score >= 0.2 THEN 1 ELSE 0 END AS p2 FROM ref), c1 AS ("
        + confusion_sql("rp", "p2") + "), c2 AS (" + confusion_sql("cur") + "), f1s AS (SELECT "
        f"(SELECT {RATES_SQL['f1']} FROM c1) AS baseline, (SELECT {RATES_SQL['f1']} FROM c2) AS current), "
        """sm AS (SELECT baseline - current AS f1_drop, (SELECT count(*) FILTER (WHERE drifted) FROM dr) AS n_drifted,
        (SELECT count(*) FILTER (WHERE drifted AND feature IN ('tenure_months', 'monthly_charges', 'total_charges'))
         FROM dr) AS n_key FROM f1s),
        ru AS (SELECT *, f1_drop > 0.05 AND n_drifted > 0 AS rule3 FROM sm)""")
DECISION = CUSTOMER_DRIFT + _F1S


def decide(spark, d):
    ref, cur = customer_sides(spark, d)
    table = dr.detect_drift(ref, cur, DRIFT_COLUMNS + ("gender",))
    f1 = rates()["f1"].alias("f1")
    baseline = confusion(ref.withColumn("pred", (F.col("score") >= 0.2).cast("int"))).select(f1).scalar()
    return retrain_decision(table, baseline, confusion(cur).select(f1).scalar())


@query("r01_key_drift", DECISION + """ SELECT 'Rule 1: ' || feature || ' drifted (high importance)' AS reason FROM dr
    WHERE drifted AND feature IN ('tenure_months', 'monthly_charges', 'total_charges')""")
def _(spark, d):
    return decide(spark, d).select(F.explode("reasons").alias("reason")).where("reason LIKE 'Rule 1%'")


@query("r02_many_drifted", DECISION + """ SELECT 'Rule 2: ' || CAST(n_drifted AS VARCHAR) || ' features drifted' AS reason
    FROM ru WHERE n_drifted >= 2""")
def _(spark, d):
    return decide(spark, d).select(F.explode("reasons").alias("reason")).where("reason LIKE 'Rule 2%'")


@query("r03_f1_drop", DECISION + " SELECT round(f1_drop, 6) AS f1_drop, n_drifted, rule3 AS has_rule3 FROM ru")
def _(spark, d):
    rule3 = F.exists("reasons", lambda r: r.startswith("Rule 3"))
    return decide(spark, d).select(r6("f1_drop").alias("f1_drop"), "n_drifted", rule3.alias("has_rule3"))


@query("r04_recommendation", DECISION + """ SELECT n_key > 0 OR n_drifted >= 2 OR rule3 AS should_retrain,
    CASE WHEN rule3 THEN 'reexperiment' WHEN n_key > 0 OR n_drifted >= 2 THEN 'mixed' END AS strategy,
    n_key + CASE WHEN n_drifted >= 2 THEN 1 ELSE 0 END + CASE WHEN rule3 THEN 1 ELSE 0 END AS n_reasons FROM ru""")
def _(spark, d):
    return decide(spark, d).select("should_retrain", "strategy", F.size("reasons").cast("long").alias("n_reasons"))
