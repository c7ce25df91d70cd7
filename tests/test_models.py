import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import attribution as at, boosting, features as fe, models, runs, tuning
from ebbtide.plans import retraining, scoring as scoring_job, selection, training
from ebbtide.sources.tables import write_table
from ebbtide.streaming import scoring

SMALL = {"n_estimators": 4, "max_depth": 3}


@pytest.fixture(scope="module")
def planted(make):
    """Customers whose churn follows contract and tenure."""
    import random

    from rows import customer
    rng = random.Random(5)
    rows = []
    for i in range(600):
        r = customer(i, rng)
        risk = 0.75 if r["contract"] == "Month-to-month" and r["tenure_months"] < 40 else 0.1
        rows.append({**r, "churn": int(rng.random() < risk)})
    return make(rows).persist()


@pytest.fixture(scope="module")
def fitted(planted):
    params = fe.fit_features(planted)
    return params, fe.transform_features(planted, params).persist()


@pytest.fixture(scope="module")
def boosted(fitted):
    params, x = fitted
    return models.train_model(x, params.feature_cols, "LGBMClassifier", SMALL)


def probabilities(df):
    return [r[0] for r in df.select("churn_probability").collect()]


@pytest.mark.parametrize("name,params", [("LogisticRegression", {"max_iter": 30}), ("RandomForestClassifier", SMALL),
                                         ("XGBClassifier", SMALL)])
def test_models_find_the_signal(spark, fitted, tmp_path, name, params):
    from ebbtide.operators.metrics import evaluate
    p, x = fitted
    model = models.train_model(x, p.feature_cols, name, params)
    scored = model.score(x)
    values = probabilities(scored)
    assert len(values) == 600 and 0 <= min(values) and max(values) <= 1
    auc = evaluate(scored.withColumnsRenamed({"churn": "label", "churn_probability": "score"})).first()["auc_roc"]
    assert auc > 0.75
    model.save(spark, str(tmp_path / "m"))
    assert probabilities(models.FittedModel.load(spark, str(tmp_path / "m")).score(x)) == pytest.approx(values)


def test_factory_and_weights(spark, fitted):
    recipe = models.build_estimator("LGBMClassifier", {"n_estimators": 50, "max_depth": 3}, 5.0)
    assert recipe.weighting == 5.0 and recipe.estimator.getMaxIter() == 50 and recipe.estimator.getMaxDepth() == 3
    assert models.build_estimator("XGBClassifier", {"scale_pos_weight": 2.0}, 5.0).weighting == 2.0
    with pytest.raises(ValueError, match="no learner"):
        models.build_estimator("SVC")
    with pytest.raises(ValueError, match="unknown parameter"):
        models.build_estimator("LGBMClassifier", {"nonsense": 1})
    with pytest.warns(UserWarning, match="num_leaves"):
        models.build_estimator("LGBMClassifier", {"num_leaves": 7})
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "churn int")
    assert models.class_balance(df).first()["scale_pos_weight"] == 4.5
    w = [r[0] for r in df.select(models.row_weight("balanced", 3, 1)).collect()]
    assert sorted(w) == pytest.approx([4 / 6] * 3 + [2.0])
    assert models.class_balance(df.where("churn = 0")).first()["scale_pos_weight"] == 1.0


def test_scoring_keeps_the_customer_columns(planted, fitted, boosted):
    out = models.score_customers(planted, fitted[0], boosted, 0.2, digits=4)
    assert out.columns == [*planted.columns, "churn_prediction", "churn_probability"]
    for r in out.limit(50).collect():
        assert round(r["churn_probability"] * 10000) / 10000 == r["churn_probability"]
        assert r["gender"] in ("Male", "Female")


def subset_game(x, leaves, base):
    """Shapley values by enumerating coalitions of the features that occur."""
    names = sorted({f for leaf in leaves for f in leaf.features})

    def value(known):
        total = 0.0
        for leaf in leaves:
            w = 1.0
            for f, lo, hi, ratio in zip(leaf.features, leaf.low, leaf.high, leaf.ratio):
                w *= float(lo < x[f] <= hi) if f in known else ratio
            total += w * leaf.value
        return total
    phi = {}
    for f in names:
        rest = [g for g in names if g != f]
        phi[f] = sum(math.factorial(k) * math.factorial(len(rest) - k) / math.factorial(len(names))
                     * (value(set(s) | {f}) - value(set(s)))
                     for k in range(len(rest) + 1) for s in itertools.combinations(rest, k))
    assert value(set()) == pytest.approx(base)
    return phi


def test_tree_attribution_equals_the_subset_game(spark, fitted):
    params, x = fitted
    model = models.train_model(x, params.feature_cols, "XGBClassifier", {"n_estimators": 2, "max_depth": 3})
    leaves, base = at.tree_leaves(model, spark)
    for r in x.limit(3).collect():
        values = np.array([float(r[c]) for c in params.feature_cols])
        got = at.shapley_values(values.reshape(1, -1), leaves)[0]
        for f, v in subset_game(values, leaves, base).items():
            assert got[f] == pytest.approx(v, abs=1e-12)


@pytest.mark.parametrize("name", ["LGBMClassifier", "RandomForestClassifier"])
def test_tree_attribution_sums_to_the_margin(fitted, name):
    params, x = fitted
    model = models.train_model(x, params.feature_cols, name, SMALL)
    scored = at.tree_attribution(model.score(x), model, ["customer_id", "churn_probability"])
    for r in scored.limit(40).collect():
        total = r["base_value"] + sum(c["shap_value"] for c in r["contributions"])
        p = total if name.startswith("Random") else 1 / (1 + math.exp(-total))
        assert p == pytest.approx(r["churn_probability"], abs=1e-9)
    assert at.feature_importance(scored).first()["feature"] in (
        "contract_risk", "is_month_to_month", "tenure_months", "new_month_to_month", "contract_Two year", "contract_One year",
        "charge_per_tenure", "service_density", "charges_x_tenure")


def test_linear_attribution_sums_to_the_margin(fitted):
    params, x = fitted
    model = models.train_model(x, params.feature_cols, "LogisticRegression", {"max_iter": 30})
    rows = at.linear_model_attribution(model.score(x), model, ["churn_probability"]).limit(20).collect()
    for r in rows:
        total = model.model.intercept + sum(c["shap_value"] for c in r["contributions"])
        assert 1 / (1 + math.exp(-total)) == pytest.approx(r["churn_probability"], abs=1e-9)
    top = at.top_contributors(at.linear_model_attribution(x, model, ["customer_id"])).first()["top_contributors"]
    sizes = [abs(c["shap_value"]) for c in top]
    assert len(top) == 10 and sizes == sorted(sizes, reverse=True)
    assert all((c["direction"] == "toward churn") == (c["shap_value"] > 0) for c in top)


def log_loss(df):
    p = F.least(F.greatest("churn_probability", F.lit(1e-9)), F.lit(1 - 1e-9))
    return df.agg(F.avg(F.when(F.col("churn") == 1, -F.log(p)).otherwise(-F.log(1 - p)))).first()[0]


def test_continued_boosting_improves_the_fit(spark, fitted, boosted, tmp_path, monkeypatch):
    monkeypatch.setattr(boosting, "CHECKPOINT_EVERY", 2)
    _, x = fitted
    more = boosting.continue_boosting(boosted, x, rounds=5, rate=0.3, max_depth=3)
    start = models.FittedModel(boosted.model, boosted.model_class, boosted.feature_cols)
    assert log_loss(more.score(x)) < log_loss(start.score(x))
    more.save(spark, str(tmp_path / "c"))
    again = boosting.ContinuedModel.load(spark, str(tmp_path / "c"))
    assert probabilities(again.score(x)) == pytest.approx(probabilities(more.score(x)))


def test_a_continued_model_is_saved_loaded_continued_and_explained(spark, fitted, boosted, tmp_path):
    params, x = fitted
    linear = models.train_model(x, params.feature_cols, "LogisticRegression", {"max_iter": 20})
    for i, base in enumerate((boosted, linear)):
        once = boosting.continue_boosting(base, x, rounds=2, rate=0.3, max_depth=3)
        twice = boosting.continue_boosting(once, x, rounds=3, rate=0.2, max_depth=2)
        assert list(twice.extra.treeWeights) == [0.3, 0.3, 0.2, 0.2, 0.2] and log_loss(twice.score(x)) < log_loss(once.score(x))
        twice.save(spark, str(tmp_path / str(i)))
        again = boosting.load_model(spark, str(tmp_path / str(i)))
        assert probabilities(again.score(x)) == pytest.approx(probabilities(twice.score(x)), abs=1e-12)
        for nodes in (at.BLOCK_NODES, 16):  # the second takes the trees one by one
            rows = at.tree_attribution(again.margin(x), again, ["customer_id", "margin"], nodes).limit(60).collect()
            for r in rows:
                assert r["base_value"] + sum(c["shap_value"] for c in r["contributions"]) == pytest.approx(r["margin"], abs=1e-9)
    with pytest.raises(ValueError, match="limit its depth"):
        at.tree_attribution(x, boosted, ["customer_id"], 3)


def test_margins_are_log_odds(fitted, boosted):
    params, x = fitted
    forest = models.train_model(x, params.feature_cols, "RandomForestClassifier", SMALL)
    linear = models.train_model(x, params.feature_cols, "LogisticRegression", {"max_iter": 20})
    for model in (boosted, forest, linear):
        for r in model.margin(model.score(x)).select("churn_probability", "margin").limit(50).collect():
            assert 1 / (1 + math.exp(-r.margin)) == pytest.approx(r.churn_probability, abs=1e-9)


def test_forests_grow_without_a_limit_unless_asked(spark):
    assert models.build_estimator("RandomForestClassifier").estimator.getMaxDepth() == models.SPARK_MAX_DEPTH
    assert models.build_estimator("RandomForestClassifier", {"max_depth": 7}).estimator.getMaxDepth() == 7
    with pytest.warns(UserWarning, match="Spark's limit"):
        models.build_estimator("RandomForestClassifier", {"max_depth": 64})


def test_random_search(fitted):
    params, x = fitted
    trials = tuning.draw_trials("XGBClassifier", 20, balance=2.0, seed=1)
    assert trials == tuning.draw_trials("XGBClassifier", 20, balance=2.0, seed=1)
    assert all(1.4 <= t["scale_pos_weight"] <= 5.0 and t["n_estimators"] % 50 == 0 for t in trials)
    space = {"C": tuning.Range(0.01, 1.0, log=True), "solver": ("lbfgs",)}
    found = tuning.tune_model(x, params.feature_cols, "LogisticRegression", n_trials=2, space=space)
    assert found.best_f1 == max(s for _, s in found.trials) > 0.4
    # Five settings for a budget of two runs; those that lead go on to four times the rows, and the winner has the best F1 on all.
    assert [(len(t), part) for part, t in found.rungs] == [(10, 1 / 16), (2, 1 / 4), (1, 1.0)] and found.ignored == ("solver",)
    for (_, early), (_, late) in zip(found.rungs, found.rungs[1:]):
        assert [t for t, _ in early][:len(late)] == sorted((t for t, _ in late), key=[t for t, _ in early].index)
    assert all("solver" not in t for t, _ in found.rungs[0][1])
    for budget in (1, 2, 5, 50, 80):
        sizes = tuning.rung_sizes(budget)
        assert sizes[-1][1] == 1 and sizes[0][0] >= 4 * budget and sum(n * part for n, part in sizes) <= max(budget, 1) + 1
    with pytest.raises(ValueError, match="no search space"):
        tuning.draw_trials("SVC", 1, 1.0)


def test_stream_equals_batch(spark, planted, fitted, boosted, tmp_path):
    source = planted.withColumn("total_charges", F.when(F.col("churn") == 1, F.col("total_charges")))
    write_table(source, str(tmp_path / "in"), "json")
    stream, rejected = scoring.score_requests(scoring.request_stream(spark, str(tmp_path / "in")), fitted[0], boosted, "7", 0.2)
    scoring.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")).start().awaitTermination()
    batch, bad = scoring.score_requests(source, fitted[0], boosted, "7", 0.2)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rejected.isStreaming and got.count() + bad.count() == 600 and bad.count() > 0
    assert got.exceptAll(batch.select(got.columns)).isEmpty()


def test_a_killed_stream_has_every_request_once(spark, planted, fitted, boosted, tmp_path, monkeypatch):
    source = planted.withColumn("total_charges", F.when(F.col("churn") == 1, F.col("total_charges")))
    for part in range(3):
        write_table(source.where(F.col("tenure_months") % 3 == part), str(tmp_path / "in" / str(part)), "json")
    home, create, failed = str(tmp_path / "out"), scoring.Folder.create, []

    def once(self, name, text):
        if not failed:
            failed.append(name)
            raise OSError("killed between the rows and their commit")
        return create(self, name, text)

    def run(files):
        stream = scoring.request_stream(spark, str(tmp_path / "in" / "*"), files_per_trigger=files)
        query = scoring.write_once(stream, fitted[0], boosted, "7", home, str(tmp_path / "cp"), 0.2).start()
        query.awaitTermination()

    monkeypatch.setattr(scoring.Folder, "create", once)
    with pytest.raises(Exception, match="killed|foreach"):
        run(1)
    with pytest.raises(ValueError, match="no batch"):
        scoring.read_committed(spark, home)
    run(1)
    run(1)  # nothing new
    good, bad = scoring.read_committed(spark, home), scoring.read_committed(spark, home, scoring.REJECTED)
    batch, refused = scoring.score_requests(source, fitted[0], boosted, "7", 0.2)
    assert good.count() == batch.count() and good.select(batch.columns).exceptAll(batch).isEmpty()
    assert sorted(r[0] for r in bad.select("customer_id").collect()) == sorted(r[0] for r in refused.select("customer_id").collect())
    assert good.count() + bad.count() == 600 and bad.count() > 0 and good.select("batch_id").distinct().count() >= 3
    assert bad.columns[:-1] == refused.columns


def test_a_micro_batch_is_marked_once_for_both_writes(spark, planted, fitted, boosted, tmp_path, monkeypatch):
    write_table(planted.coalesce(1), str(tmp_path / "in"), "json")
    mark, seen = scoring.mark_valid, []
    monkeypatch.setattr(scoring, "mark_valid", lambda df, profile: seen.append(df) or mark(df, profile))
    monkeypatch.setattr(scoring, "quarantine", None)  # would check the rules again
    stream = scoring.request_stream(spark, str(tmp_path / "in"))
    scoring.write_once(stream, fitted[0], boosted, "7", str(tmp_path / "out"), str(tmp_path / "cp"), 0.2).start().awaitTermination()
    assert len(seen) == 1 and scoring.read_committed(spark, str(tmp_path / "out")).count() == 600


@pytest.mark.parametrize("strategy", retraining.STRATEGIES)
def test_retraining(planted, fitted, boosted, strategy):
    fresh = planted.where("tenure_months < 30")
    promoted = []
    result = retraining.retrain(planted, fresh, fitted[0], boosted, baseline_f1=0.99, strategy=strategy,
                                model_params=SMALL, configs=[SMALL], rounds=2, promote=promoted.append)
    assert result.should_retrain and result.recommended == "reexperiment"
    assert result.passed == (not result.failures) == bool(promoted)
    assert result.metrics["threshold"] == 0.20


def test_the_reexperiment_query_fits_the_whole_grid(spark, planted, monkeypatch):
    """Every setting of the workflow's grid, with all its trees and on the same rows; the test fits one tree of each."""
    from ebbtide.queries import QUERIES, models as registered
    splits = planted.withColumn("batch", F.when(F.col("tenure_months") > 55, "current").otherwise("train"))
    n_current = splits.where("batch = 'current'").count()
    n_pooled = 600 - math.ceil(0.3 * n_current)
    fit, asked = tuning.fit_model, []

    def one_tree(df, feature_cols, recipe, label):
        e = recipe.estimator
        asked.append((e.getMaxIter(), e.getMaxDepth(), e.getStepSize(), df.count()))
        return fit(df, feature_cols, models.build_estimator(recipe.model_class, {**recipe.params, "n_estimators": 1}), label)

    monkeypatch.setattr(tuning, "fit_model", one_tree)
    monkeypatch.setattr(registered, "split_customers", lambda spark, d: splits)
    assert QUERIES["t14_retrain_reexperiment"](spark, "").count() == n_current
    n = n_pooled - math.ceil(0.2 * n_pooled)
    assert sorted(asked) == [(300, 4, 0.05, n), (500, 6, 0.02, n), (500, 6, 0.05, n), (700, 8, 0.05, n)]


def test_a_grid_is_the_same_side_by_side(fitted):
    """Scores come in the order of the configs; of equal ones the first wins."""
    p, x = fitted
    configs = [{"n_estimators": 1, "max_depth": 1}, {**SMALL, "num_leaves": 7}, {**SMALL, "num_leaves": 9}]
    best, f1, scores = tuning.grid_search(x, p.feature_cols, configs, parallelism=3)
    _, alone, one_by_one = tuning.grid_search(x, p.feature_cols, configs, parallelism=1)
    assert scores == pytest.approx(one_by_one) and f1 == alone == max(scores) == scores[1] == scores[2]
    assert best.params["num_leaves"] == 7


def test_dry_run_and_quiet_batch(planted, fitted, boosted):
    dry = retraining.retrain(planted, planted.where("tenure_months < 30"), fitted[0], boosted, dry_run=True)
    assert dry.should_retrain and dry.model is None
    quiet = retraining.retrain(planted, planted, fitted[0])
    assert not quiet.should_retrain and quiet.model is None
    with pytest.raises(ValueError, match="no retraining strategy"):
        retraining.retrain(planted, planted, fitted[0], strategy="other")


def test_full_run_deploys_and_stress_run_does_not(spark, planted, tmp_path):
    splits = planted.withColumn("batch", F.when(F.col("tenure_months") < 8, "stress").when(
        F.col("tenure_months") > 60, "current").otherwise("train"))
    home = str(tmp_path)
    run = training.train_and_monitor(spark, splits, home, "current", "XGBClassifier", SMALL, gates={"auc_roc": 0.6})
    assert run.passed and run.version == 1 and run.scored.count() == splits.where("batch = 'current'").count()
    model, params = training.load_production(spark, home)
    assert len(params.feature_cols) == 64
    stress = training.train_and_monitor(spark, splits, home, "stress", "XGBClassifier", SMALL, gates={"auc_roc": 0.6},
                                        load_production=lambda: training.load_production(spark, home))
    assert stress.version is None and stress.scored.count() == splits.where("batch = 'stress'").count()
    assert stress.monitored_with == "production"
    failed = training.train_and_monitor(spark, splits, home, "current", "XGBClassifier", SMALL, gates={"f1": 1.01})
    assert not failed.passed and failed.scored is None and len(failed.failures) == 1
    # The stored settings decide where nothing is given; a stress run without a live model falls back to its refit.
    assert training.resolve_settings(spark, home)["params"] == SMALL and training.resolve_settings(spark, str(tmp_path / "x"))["model_class"] == "LGBMClassifier"
    logged = {r.key: r.value for r in spark.read.schema(runs.RUN_SCHEMA).parquet(f"{home}/runs").where("run_name = 'training-run'").orderBy("seq").collect()}
    assert {"n_features", "n_train", "production_f1", "threshold_f1_optimal", "gate_status"} <= set(logged)


def test_the_production_loop_closes(spark, planted, tmp_path):
    """Selection, training from its settings, a review that finetunes and promotes, scoring with the stored threshold."""
    home, candidates = str(tmp_path), {"Forest": ("RandomForestClassifier", SMALL), "Boosted": ("XGBClassifier", SMALL)}
    spaces = {c: {"n_estimators": tuning.Range(3, 5, 1), "max_depth": tuning.Range(2, 3, 1)} for c in ("RandomForestClassifier", "XGBClassifier")}
    found = selection.select_model(planted, candidates, 2, spaces, keep=2, home=home)
    assert found["comparison"].count() == 2 and found["gain"].count() == 2 and found["settings"]["model_class"] in spaces
    splits = planted.withColumn("batch", F.when(F.col("tenure_months") > 55, "current").otherwise("train"))
    stress = training.train_and_monitor(spark, splits.withColumn("batch", F.when(F.col("batch") == "current", "stress").otherwise("train")),
                                        home, "stress", gates={"auc_roc": 0.6})
    assert stress.monitored_with == "refit" and stress.version is None
    # A boosted model goes live, whatever the selection chose: forests cannot be continued in log-odds without bounds.
    run = training.train_and_monitor(spark, splits, home, model_class="XGBClassifier", params=SMALL, gates={"auc_roc": 0.6})
    assert run.version == 1
    batch = planted.where("tenure_months < 30")
    quiet = retraining.retrain_production(spark, home, planted, planted)
    assert quiet.model is None and quiet.version is None and quiet.baseline_f1 == pytest.approx(run.production_metrics["f1"])
    tuned = retraining.retrain_production(spark, home, planted, batch, strategy="finetune", rounds=2, gates={"auc_roc": 0.6})
    assert tuned.version == 2 and tuned.passed
    live, params = training.load_live(spark, home)
    assert isinstance(live, boosting.ContinuedModel)
    for kind in ("parquet", "csv"):
        out = scoring_job.score_batch(spark, home, splits.where("batch = 'current'").drop("batch"), f"{home}/out-{kind}", kind)
        assert out.threshold == 0.2 and out.summary["n"] == out.scored.count() == splits.where("batch = 'current'").count()
        assert out.scored.where("churn_prediction <> CAST(churn_probability >= 0.2 AS INT) AND abs(churn_probability - 0.2) > 0.0001").isEmpty()
    stages = runs.current_versions(runs.read_events(spark, f"{home}/versions")).collect()
    assert {r.version: r.stage for r in stages} == {1: "archived", 2: "production"}
    assert spark.read.schema(runs.RUN_SCHEMA).parquet(f"{home}/runs").where("experiment = 'attrition-retraining'").count() > 5
    with pytest.raises(training.NoProductionModel):
        scoring_job.score_batch(spark, f"{home}/nothing", planted, f"{home}/none")


def test_a_rung_holds_its_own_rows_only(spark, monkeypatch):
    """Trials of a rung read its rows, not the whole table behind a filter; classes are counted once a rung."""
    from ebbtide.operators import tuning
    rows = spark.range(240).select(F.concat(F.lit("C"), "id").alias("customer_id"), (F.col("id") % 3 == 0).cast("int").alias("churn"), (F.col("id") * 7 % 11).cast("double").alias("x"))
    plans, counted, fold_classes = [], [], tuning._fit_folds
    monkeypatch.setattr(tuning, "_fit_folds", lambda *a: counted.append(1) or fold_classes(*a))
    monkeypatch.setattr(tuning, "_cross_f1", lambda rows, *a: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or 0.5)
    found = tuning.tune_model(rows, ["x"], "LogisticRegression", 1)
    assert len(plans) == sum(len(trials) for _, trials in found.rungs) and not any("Filter" in p for p in plans)
    assert len(counted) == len(found.rungs)
    one = spark.createDataFrame([(0, 1), (0, 1), (1, 0), (1, 1), (2, 0)], "fold int, churn int")
    assert fold_classes(one, 3, "churn") == [0, 1]
    assert fold_classes(one.where("churn = 1"), 3, "churn") == []
