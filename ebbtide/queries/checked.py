"""What must hold of fitted models, whatever their numbers: rows, ranges, gates, decisions and stages, each with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import GATES, GATE_NAMES
from ..operators import attribution, boosting, models, runs, tuning
from ..operators.features import FeatureParams, fit_features, transform_features
from ..plans import naive, retraining, scoring as scoring_job, selection, training
from ..session import shared_dir
from ..sources.artefacts import load_artefact, save_artefact
from ..sources.tables import named_batch, train_batch, write_table
from ..streaming import scoring
from .models import SMALL, SMALL_CANDIDATES, _features, _features_of, _path
from .registry import ORACLES, SPLIT, VIEW, customers, query, sample_ctes, split_customers
from .splits import _share

CONFIGS = [{"n_estimators": n, "max_depth": k} for n, k in ((2, 2), (3, 2), (3, 3), (4, 3))]
_EACH = VIEW + " SELECT customer_id, churn, TRUE AS holds FROM cust"
_CURRENT = SPLIT + " SELECT customer_id, churn, TRUE AS holds FROM split WHERE batch = 'current'"


def _values(names: str, rows: list[tuple], casts: str) -> str:
    listed = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v).upper() if isinstance(v, bool) else repr(v) for v in r) + ")" for r in rows)
    return f"SELECT {casts} FROM (VALUES {listed}) AS t({names})"


def _probabilities(scored):
    return scored.select("customer_id", "churn", F.col("churn_probability").between(0, 1).alias("holds"))


for _id, _class, _params in (("t01_naive_learner", "GradientBoostingClassifier", SMALL), ("t03_logistic_regression", "LogisticRegression", {"max_iter": 20}),
                             ("t04_random_forest", "RandomForestClassifier", SMALL), ("t05_gradient_boosting", "LGBMClassifier", SMALL)):
    @query(f"{_id}_checked", _EACH)
    def _(spark, d, model_class=_class, given=_params):
        """A probability for every customer, and the margin's sigmoid is that probability."""
        params, x = _features(spark, d)
        model = models.train_model(x, params.feature_cols, model_class, given)
        both = model.margin(model.score(x))
        near = F.abs(boosting.sigmoid(F.col("margin")) - F.col("churn_probability")) < 1e-5
        return both.select("customer_id", "churn", (F.col("churn_probability").between(0, 1) & near).alias("holds"))


@query("t06_gates_checked", _values("gate, minimum, agrees", [(g, float(v), True) for g, v in GATES.items()],
                                    "gate, CAST(minimum AS DOUBLE) AS minimum, agrees"))
def _(spark, d):
    """The deployment gates as they are: a gate is named as failed exactly where its metric is below the minimum."""
    run = training.train_and_monitor(spark, split_customers(spark, d).checkpoint(), _path(spark, "home"), model_class="XGBClassifier", params=SMALL)
    named = {g: any(f.startswith(GATE_NAMES[g] + " ") for f in run.failures) for g in GATES}
    deployed = (run.version is not None) == run.passed == (run.scored is not None)
    rows = [(g, float(least), deployed and named[g] == (run.metrics[g] < least)) for g, least in GATES.items()]
    return spark.createDataFrame(rows, "gate string, minimum double, agrees boolean")


@query("t07_candidates_checked", VIEW + "," + sample_ctes("cs", "cust", "CAST(churn AS VARCHAR)", _share(0.2))
       + ", m AS (" + _values("model", [(m,) for m in SMALL_CANDIDATES], "model") + """)
    SELECT model, count(*) AS n, CAST(sum(churn) AS BIGINT) AS churners, TRUE AS holds FROM cs, m WHERE taken GROUP BY model""")
def _(spark, d):
    """Every candidate is scored on the same hold-out rows."""
    scored = selection.score_candidates(selection.prepare(customers(spark, d)), SMALL_CANDIDATES)
    return scored.groupBy("model").agg(F.count("*").alias("n"), F.sum("label").cast("long").alias("churners"),
                                       F.min(F.col("score").between(0, 1)).alias("holds"))


_RACE = [(c, i, n, share, True) for c in ("LogisticRegression", "XGBClassifier") for i, (n, share) in enumerate(tuning.rung_sizes(1))]


@query("t08_race_checked", _values("model_class, rung, n_trials, share, holds", _RACE,
                                   "model_class, CAST(rung AS INTEGER) AS rung, CAST(n_trials AS BIGINT) AS n_trials, CAST(share AS DOUBLE) AS share, holds"))
def _(spark, d):
    """The settings and rows of each rung; those that go on lead their rung, and the winner leads the last."""
    params, x = _features(spark, d)
    spaces = {"LogisticRegression": {"C": tuning.Range(1e-2, 1.0, log=True), "solver": ("lbfgs",)},
              "XGBClassifier": {"n_estimators": tuning.Range(2, 4, 1), "max_depth": tuning.Range(2, 3, 1)}}
    rows = []
    for name, space in spaces.items():
        found = tuning.tune_model(x, params.feature_cols, name, 1, space=space)
        after = [[t for t, _ in trials] for _, trials in found.rungs[1:]] + [[found.best_params]]
        for i, ((share, trials), ahead) in enumerate(zip(found.rungs, after)):
            lead = [t for t, _ in trials][:len(ahead)]
            holds = all(t in lead for t in ahead) and all(0 <= s <= 1 for _, s in trials) and "solver" not in trials[0][0]
            rows.append((name, i, len(trials), share, holds))
    return spark.createDataFrame(rows, "model_class string, rung int, n_trials long, share double, holds boolean")


def _config(c) -> str:
    return f"{c['n_estimators']} trees of depth {c['max_depth']}"


@query("t09_grid_checked", _values("config, holds", [(_config(c), True) for c in CONFIGS], "config, holds"))
def _(spark, d):
    params, x = _features(spark, d)
    _, best, scores = tuning.grid_search(x, params.feature_cols, CONFIGS)
    rows = [(_config(c), 0 <= s <= best == max(scores)) for c, s in zip(CONFIGS, scores)]
    return spark.createDataFrame(rows, "config string, holds boolean")


@query("t10_batch_score_checked", _EACH)
def _(spark, d):
    """Every customer once, columns kept, the prediction that the threshold gives, four digits."""
    df, params, x = _features_of(spark, d)
    model = models.train_model(x, params.feature_cols, "LGBMClassifier", SMALL)
    out = models.score_customers(df, params, model, 0.2, digits=4)
    p = F.col("churn_probability")
    holds = p.between(0, 1) & (F.rint(p * 10_000) / 10_000 == p) & ((F.col("churn_prediction") == (p >= 0.2).cast("int")) | (F.abs(p - 0.2) <= 0.0001))
    return out.select("customer_id", "churn", (holds & F.lit(out.columns[:len(df.columns)] == df.columns)).alias("holds"))


@query("t11_stream_checked", VIEW + """ SELECT customer_id, CASE WHEN total_charges IS NULL OR total_charges NOT BETWEEN 0 AND 10000
    OR monthly_charges NOT BETWEEN 0 AND 200 OR tenure_months NOT BETWEEN 0 AND 72 THEN 'rejected' ELSE 'scored' END AS kind FROM cust""")
def _(spark, d):
    """Every request of the stream once, scored or rejected."""
    df, params, x = _features_of(spark, d)
    model = models.train_model(x, params.feature_cols, "LGBMClassifier", SMALL)
    source, home = _path(spark, "requests"), _path(spark, "answers")
    write_table(df, source, "json")
    scoring.write_once(scoring.request_stream(spark, source, files_per_trigger=2), params, model, "1", home, _path(spark, "progress"), 0.2).start().awaitTermination()
    kinds = [scoring.read_committed(spark, home, k).select("customer_id", F.lit(k).alias("kind")) for k in (scoring.SCORED, scoring.REJECTED)]
    return kinds[0].unionByName(kinds[1])


def _history(spark, d, batch):
    shared_dir(spark)
    splits = split_customers(spark, d).checkpoint()
    history, fresh = train_batch(splits), named_batch(splits, batch)
    params = fit_features(history)
    return history, fresh, params, models.train_model(transform_features(history, params).checkpoint(), params.feature_cols, "LGBMClassifier", SMALL)


for _id, _strategy in (("t12", "mixed"), ("t13", "finetune"), ("t14", "reexperiment")):
    @query(f"{_id}_{_strategy}_checked", _CURRENT)
    def _(spark, d, strategy=_strategy):
        """A retrained model, of four settings in a re-experiment, saved and loaded, scores every row of the batch alike."""
        history, fresh, params, production = _history(spark, d, "current")
        result = retraining.retrain(history, fresh, params, production, force=True, strategy=strategy, model_params=SMALL, configs=CONFIGS, rounds=3)
        path = _path(spark, "model")
        result.model.save(spark, path)
        x = transform_features(fresh, params)
        twice = boosting.load_model(spark, path).score(result.model.score(x), "again")
        same = (F.abs(F.col("again") - F.col("churn_probability")) < 1e-12) & F.lit(result.passed == (not result.failures))
        return twice.select("customer_id", "churn", (F.col("churn_probability").between(0, 1) & same).alias("holds"))


@query("t15_decision_checked", _values("step, holds", [("decided", True), ("trained", True), ("gated", True)], "step, holds"))
def _(spark, d):
    """An unforced review: it trains exactly where a rule fires, and passes exactly where no gate fails."""
    history, fresh, params, production = _history(spark, d, "stress")
    r = retraining.retrain(history, fresh, params, production, baseline_f1=0.5, model_params=SMALL, configs=CONFIGS, rounds=3)
    rows = [("decided", r.should_retrain == (r.recommended is not None) == bool(r.reasons)), ("trained", (r.model is not None) == r.should_retrain),
            ("gated", r.model is None or r.passed == (not r.failures))]
    return spark.createDataFrame(rows, "step string, holds boolean")


@query("t16_naive_checked", _values("metric, holds", [("accuracy", True), ("f1", True), ("recall", True), ("cost", True)], "metric, holds"))
def _(spark, d):
    r = naive.naive_baseline(customers(spark, d), SMALL).first()
    rows = [(m, 0 <= r[m] <= 1) for m in ("accuracy", "f1", "recall")] + [("cost", r["cost"] == 1500 * r["missed"])]
    return spark.createDataFrame(rows, "metric string, holds boolean")


@query("x02_tree_attribution_checked", _EACH)
def _(spark, d):
    """Contributions and base value sum to the margin, for boosted trees and for a model continued from them, in blocks of trees."""
    params, x = _features(spark, d)
    model = models.train_model(x, params.feature_cols, "LGBMClassifier", SMALL)
    more = boosting.continue_boosting(model, x, rounds=2, max_depth=3)
    out = None
    for m, nodes in ((model, attribution.BLOCK_NODES), (more, 40)):
        rows = attribution.tree_attribution(m.margin(x), m, ["customer_id", "churn", "margin"], nodes)
        total = F.aggregate("contributions", F.lit(0.0), lambda a, c: a + c["shap_value"]) + F.col("base_value")
        rows = rows.select("customer_id", "churn", (F.abs(total - F.col("margin")) < 1e-9).alias("holds"))
        out = rows if out is None else out.join(rows.select("customer_id", F.col("holds").alias("_too")), "customer_id").select(
            "customer_id", "churn", (F.col("holds") & F.col("_too")).alias("holds"))
    return out


_LINE = "md5(concat_ws(',', coalesce('V' || l_orderkey, 'N'), coalesce('V' || l_linenumber, 'N'), coalesce('V' || l_returnflag, 'N')))"


@query("g06_text_fingerprint", f"""WITH h AS (SELECT {_LINE} AS h FROM lineitem) SELECT count(*) AS n_rows,
    CAST(sum(CAST('0x' || substr(h, 1, 15) AS BIGINT)) AS VARCHAR) AS sum_1, CAST(sum(CAST('0x' || substr(h, 16, 15) AS BIGINT)) AS VARCHAR) AS sum_2 FROM h""")
def _(spark, d):
    return runs.text_fingerprint(spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_returnflag"))


@query("io06_all_medians", ORACLES["e01_median_fit"])
def _(spark, d):
    """All 13 medians as they come back from a stored artefact."""
    path = _path(spark, "params")
    save_artefact(spark, path, "features", fit_features(customers(spark, d)).to_dict())
    stored = FeatureParams.from_dict(load_artefact(spark, path, "features")).medians
    return spark.createDataFrame([(c, round(m, 6)) for c, m in stored.items()], "feature string, median double")


@query("p01_production_loop", SPLIT + """ SELECT 'scored' AS what, count(*) AS n FROM split WHERE batch = 'current'
    UNION ALL SELECT 'predicted by the stored threshold', count(*) FROM split WHERE batch = 'current'
    UNION ALL SELECT what, n FROM (VALUES ('in production', 1), ('archived', 1), ('finetuned', 1), ('runs', 2)) AS t(what, n)""")
def _(spark, d):
    """Train and deploy, finetune and promote, then score with what is live. Gates are wide, so that the steps do not depend on the fit."""
    home, wide = _path(spark, "home"), {"auc_roc": 0.0}
    splits = split_customers(spark, d).checkpoint()
    training.train_and_monitor(spark, splits, home, model_class="XGBClassifier", params=SMALL, gates=wide)
    current = named_batch(splits, "current")
    retraining.retrain_production(spark, home, train_batch(splits), current, force=True, strategy="finetune", rounds=2, gates=wide)
    done = scoring_job.score_batch(spark, home, current, _path(spark, "scored"))
    stages = [r.stage for r in runs.current_versions(runs.read_events(spark, f"{home}/versions")).collect()]
    p = F.col("churn_probability")
    agrees = done.scored.where((F.col("churn_prediction") == (p >= done.threshold).cast("int")) | (F.abs(p - done.threshold) <= 0.0001)).count()
    logged = spark.read.schema(runs.RUN_SCHEMA).parquet(f"{home}/runs").select("run_id").distinct().count()
    live = isinstance(training.load_live(spark, home)[0], boosting.ContinuedModel)
    rows = [("scored", done.summary["n"]), ("predicted by the stored threshold", agrees), ("in production", stages.count("production")),
            ("archived", stages.count("archived")), ("finetuned", int(live)), ("runs", logged)]
    return spark.createDataFrame(rows, "what string, n long")
