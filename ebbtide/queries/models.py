"""Fitted models, attribution, retraining and scoring.

Fitting has no SQL equivalent, so these return rows only; tree counts are kept
small, but for the re-experiment, which fits the whole grid of the workflow.
Attribution of a fixed linear margin has one.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import attribution, boosting, models, tuning
from ..operators.features import add_domain_features, fit_features, transform_features
from ..operators.metrics import compare_models, evaluate
from ..plans import naive, retraining, selection, training
from ..session import shared_dir, staged
from ..sources.tables import named_batch, train_batch, write_table
from ..streaming import scoring
from .features import FT
from .registry import customers, query, r6, split_customers

SMALL = {"n_estimators": 4, "max_depth": 3}
SMALL_CANDIDATES = {
    "Logistic Regression": ("LogisticRegression", {"max_iter": 20}),
    "Random Forest": ("RandomForestClassifier", SMALL),
    "XGBoost (GBM)": ("XGBClassifier", SMALL),
    "LightGBM": ("LGBMClassifier", {**SMALL, "n_estimators": 5}),
}
SMALL_SPACES = {
    "LogisticRegression": {"C": tuning.Range(1e-2, 1.0, log=True), "solver": ("lbfgs",)},
    "XGBClassifier": {"n_estimators": tuning.Range(2, 4, 1), "max_depth": tuning.Range(2, 3, 1),
                      "scale_pos_weight": tuning.Range(0.7, 2.5, of_balance=True)},
}


def _features(spark, d):
    """(feature parameters, feature frame cut off from the view's lineage)."""
    return _features_of(spark, d)[1:]


def _features_of(spark, d):
    """(customers, stored once; feature parameters; feature frame cut off from the view's lineage)."""
    shared_dir(spark)
    df = staged(customers(spark, d), "customers")
    params = fit_features(df)
    return df, params, transform_features(df, params).checkpoint()


def _path(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _scored(df):
    return df.select("customer_id", "churn", r6("churn_probability").alias("churn_probability"))


@query("t01_estimator_factory")
def _(spark, d):
    params, x = _features(spark, d)
    kinds, parts = {}, []
    for name in models.DEFAULTS:
        small = {"max_iter": 20} if name == "LogisticRegression" else SMALL
        fitted = models.train_model(x, params.feature_cols, name, small)
        kinds[name] = type(fitted.model).__name__
        parts.append(staged(fitted.score(x).select(F.lit(name).alias("model"), F.col("churn").alias("label"),
                                                   F.col("churn_probability").alias("score")), "scores"))
    # One plan for all models, over their stored scores.
    scored = evaluate(reduce(DataFrame.unionByName, parts), by=["model"], groups=len(kinds))
    auc = {r["model"]: r["auc_roc"] for r in scored.collect()}
    rows = [(name, kind, auc.get(name)) for name, kind in kinds.items()]
    return spark.createDataFrame(rows, "model_class string, spark_model string, auc_roc double")


for _id, _name, _class, _params in (
        ("t03", "logistic_regression", "LogisticRegression", {"max_iter": 50}),
        ("t04", "random_forest", "RandomForestClassifier", {"n_estimators": 10, "max_depth": 4}),
        ("t05", "gradient_boosting", "LGBMClassifier", SMALL)):
    @query(f"{_id}_{_name}")
    def _(spark, d, model_class=_class, given=_params):
        params, x = _features(spark, d)
        return _scored(models.train_model(x, params.feature_cols, model_class, given).score(x))


@query("t06_fit_gate_refit")
def _(spark, d):
    result = training.train_and_monitor(
        spark, split_customers(spark, d).checkpoint(), _path(spark, "home"),
        model_class="XGBClassifier", params=SMALL, gates={"auc_roc": 0.0})
    return result.scored.select("customer_id", "churn", "churn_prediction", "churn_probability")


@query("t07_candidate_models")
def _(spark, d):
    data = selection.prepare(customers(spark, d))
    return compare_models(selection.score_candidates(data, SMALL_CANDIDATES), len(SMALL_CANDIDATES))


@query("t08_random_search")
def _(spark, d):
    params, x = _features(spark, d)
    rows = []
    for name, space in SMALL_SPACES.items():
        found = tuning.tune_model(x, params.feature_cols, name, n_trials=2, space=space)
        rows += [(name, str(sorted(p.items())), float(f1), f1 == found.best_f1) for p, f1 in found.trials]
    return spark.createDataFrame(rows, "model_class string, params string, cv_f1 double, is_best boolean")


@query("t09_grid_search")
def _(spark, d):
    params, x = _features(spark, d)
    configs = [{"n_estimators": n, "max_depth": k} for n, k in ((2, 2), (4, 3))]
    _, best, scores = tuning.grid_search(x, params.feature_cols, configs)
    return spark.createDataFrame([(str(c), float(s), s == best) for c, s in zip(configs, scores)],
                                 "config string, f1 double, is_best boolean")


@query("t10_batch_score")
def _(spark, d):
    df, params, x = _features_of(spark, d)
    model = models.train_model(x, params.feature_cols, "LGBMClassifier", SMALL)
    return models.score_customers(df, params, model, 0.2, digits=4)


@query("t11_stream_score")
def _(spark, d):
    df, params, x = _features_of(spark, d)
    model = models.train_model(x, params.feature_cols, "LGBMClassifier", SMALL)
    source, out = _path(spark, "requests"), _path(spark, "answers")
    write_table(df, source, "json")
    scored, _ = scoring.score_requests(scoring.request_stream(spark, source), params, model, "1", 0.2)
    scoring.write_stream(scored, out, _path(spark, "progress")).start().awaitTermination()
    return spark.read.parquet(out)


def _retrained(spark, d, strategy: str, batch: str = "current", configs=retraining.GRID):
    shared_dir(spark)
    splits = split_customers(spark, d).checkpoint()
    history, fresh = train_batch(splits), named_batch(splits, batch)
    params = fit_features(history)
    production = models.train_model(transform_features(history, params).checkpoint(), params.feature_cols,
                                    "LGBMClassifier", SMALL)
    result = retraining.retrain(history, fresh, params, production, baseline_f1=0.5, force=True,
                                strategy=strategy, model_params=SMALL, configs=configs, rounds=3)
    return result, transform_features(fresh, params)


for _id, _strategy in (("t12", "mixed"), ("t13", "finetune"), ("t14", "reexperiment")):
    @query(f"{_id}_retrain_{_strategy}")
    def _(spark, d, strategy=_strategy):
        result, fresh = _retrained(spark, d, strategy)
        return _scored(result.model.score(fresh))


@query("t15_retrain_workflow")
def _(spark, d):
    result, _ = _retrained(spark, d, None, "stress", [SMALL])
    row = (result.should_retrain, result.recommended, result.strategy, " | ".join(result.reasons),
           result.passed, " | ".join(result.failures), float(result.metrics["f1"]))
    return spark.createDataFrame([row], "should_retrain boolean, recommended string, strategy string, "
                                 "reasons string, passed boolean, failures string, f1 double")


@query("t16_naive_baseline")
def _(spark, d):
    return naive.naive_baseline(customers(spark, d), SMALL)


# --- attribution of a fixed linear margin ------------------------------------------------------------

WEIGHTS = {"tenure_months": -0.03, "monthly_charges": 0.02, "contract_risk": 0.5, "is_fiber": 0.4,
           "service_count": -0.1, "protection_count": -0.2, "is_auto_pay": -0.3, "senior_alone": 0.25}
_LINEAR = (FT + ", mn AS (SELECT " + ", ".join(f"avg({c}) AS a_{c}" for c in WEIGHTS) + " FROM ft), att AS ("
           + " UNION ALL ".join(
               f"SELECT customer_id, {i} AS pos, '{c}' AS feature, CAST({w} AS DOUBLE) * ({c} - a_{c}) AS shap_value, "
               f"CAST({c} AS DOUBLE) AS feature_value FROM ft, mn" for i, (c, w) in enumerate(WEIGHTS.items())) + ")")


def linear(spark, d):
    df = add_domain_features(customers(spark, d), None)
    means = df.agg(*[F.avg(c).alias(c) for c in WEIGHTS]).first().asDict()
    return attribution.linear_attribution(df, WEIGHTS, means, ["customer_id"])


_LONG = "customer_id, feature, round(shap_value, 6) AS shap_value, feature_value"


@query("x01_linear_attribution", _LINEAR + f" SELECT {_LONG} FROM att")
def _(spark, d):
    return linear(spark, d).select("customer_id", F.inline("contributions")).withColumn("shap_value", r6("shap_value"))


@query("x02_tree_attribution")
def _(spark, d):
    params, x = _features(spark, d)
    model = models.train_model(x, params.feature_cols, "LGBMClassifier", SMALL)
    attributed = attribution.tree_attribution(model.score(x), model, ["customer_id", "churn_probability"])
    total = F.aggregate("contributions", F.lit(0.0), lambda a, c: a + c["shap_value"]) + F.col("base_value")
    return attributed.select("customer_id", "churn_probability", boosting.sigmoid(total).alias("from_contributions"))


_IMPORTANCE = _LINEAR + ", im AS (SELECT feature, avg(abs(shap_value)) AS importance FROM att GROUP BY feature)"
for _name, _top in (("a08_mean_absolute_attribution", 15), ("x03_global_importance", 15), ("w04_top_features", 5)):
    @query(_name, _IMPORTANCE + f""" SELECT feature, round(importance, 6) AS importance FROM im
        ORDER BY im.importance DESC, feature LIMIT {_top}""")
    def _(spark, d, top=_top):
        return attribution.feature_importance(linear(spark, d), top).withColumn("importance", r6("importance"))


for _name, _top in (("x04_customer_contributors", 10), ("w05_top_contributions", 5)):
    @query(_name, _LINEAR + f""", rk AS (SELECT *, row_number() OVER (PARTITION BY customer_id
        ORDER BY abs(shap_value) DESC, pos) AS rn FROM att) SELECT {_LONG}, CASE WHEN shap_value > 0
        THEN 'toward churn' ELSE 'away from churn' END AS direction FROM rk WHERE rn <= {_top}""")
    def _(spark, d, top=_top):
        best = attribution.top_contributors(linear(spark, d), top)
        return best.select("customer_id", F.inline("top_contributors")).withColumn("shap_value", r6("shap_value"))


