"""Train, evaluate, gate, refit, monitor and score: the deployment run."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import (DRIFT_COLUMNS, LABEL, MIN_PRECISION, PRODUCTION_THRESHOLD, SEED, TEST_SHARE)
from ..operators import runs
from ..operators.attribution import feature_importance, linear_model_attribution, tree_attribution
from ..operators.boosting import load_model
from ..operators.drift import dataset_drift, detect_drift
from ..operators.features import FeatureParams, fit_features, transform_features
from ..operators.lookup import describe_batches
from ..operators.metrics import (best_thresholds, check_gates, evaluate, predict_at, slice_metrics,
                                 threshold_sweep)
from ..operators.models import class_balance, score_customers, train_model
from ..operators.quality import validate
from ..operators.splits import holdout_split
from ..session import shared_dir
from ..sources.artefacts import find_artefact, load_artefact, save_artefact
from ..sources.tables import check_batch_name, named_batch, train_batch, write_table

MODEL_NAME = "attrition-production"
DEFAULT_CLASS = "LGBMClassifier"


@dataclass
class TrainingResult:
    passed: bool
    failures: list[str]
    metrics: dict
    production_metrics: dict
    thresholds: dict
    batches: DataFrame
    slices: DataFrame | None
    importance: DataFrame | None = None
    model: object = None
    params: FeatureParams | None = None
    drift: DataFrame | None = None
    drift_summary: dict = field(default_factory=dict)
    scored: DataFrame | None = None
    batch_metrics: dict = field(default_factory=dict)
    version: int | None = None
    monitored_with: str = "refit"


def _labelled(scored: DataFrame) -> DataFrame:
    return scored.withColumnsRenamed({LABEL: "label", "churn_probability": "score"})


def resolve_settings(spark: SparkSession, home: str, model_class: str | None = None, params: Mapping | None = None) -> dict:
    """Model class and parameters of a run: as given, else as stored by the last selection or deployment, else the default."""
    stored = find_artefact(spark, home, "settings") or {}
    if model_class is None:
        model_class = stored.get("model_class", DEFAULT_CLASS)
        params = stored.get("params") if params is None else params
    return {**stored, "model_class": model_class, "params": dict(params or {}), "stored": bool(stored)}


def train_and_monitor(spark: SparkSession, splits: DataFrame, home: str, batch: str = "current",
                      model_class: str | None = None, params: Mapping | None = None,
                      threshold: float = PRODUCTION_THRESHOLD, load_production: Callable | None = None,
                      gates: Mapping | None = None, seed: int = SEED) -> TrainingResult:
    """One full run over the split table; everything it stores goes under `home`.

    Without a model class, the stored settings decide. Features are fitted on the training fold only. A failed gate stops
    the run before anything is deployed or scored. The stress batch is monitored with the existing production model and
    changes nothing; where none can be loaded, with this run's refit. `load_production` replaces the loader.
    """
    settings = resolve_settings(spark, home, model_class, params)
    model_class, params = settings["model_class"], settings["params"]
    deploy = check_batch_name(batch) == "current"
    shared_dir(spark)
    train = validate(train_batch(splits), "train")
    current = validate(named_batch(splits, batch), batch)
    # Checkpoints keep the plans of the many jobs below short and survive lost executors.
    split = holdout_split(train, TEST_SHARE, [LABEL], seed).checkpoint()
    fit_part, check_part = split.where("NOT holdout"), split.where("holdout")
    fitted = fit_features(fit_part.drop("holdout"))
    train_x = transform_features(fit_part, fitted).checkpoint()
    check_x = transform_features(check_part, fitted).checkpoint()
    weight = (params or {}).get("scale_pos_weight") or class_balance(train_x).first()["scale_pos_weight"]
    trial = train_model(train_x, fitted.feature_cols, model_class, params, weight)
    scored = _labelled(trial.score(check_x)).checkpoint()
    gated = check_gates(evaluate(scored), **({"gates": gates} if gates else {})).first().asDict()
    at_production = evaluate(scored, threshold=threshold).first().asDict()
    best = best_thresholds(threshold_sweep(scored), MIN_PRECISION).first().asDict()
    slice_column = "contract_One year"
    # A vocabulary without this contract has no such column, and then no slices.
    sliced = [slice_column] if slice_column in scored.columns else []
    slices = slice_metrics(scored.withColumn("pred", predict_at(F.col("score"))), sliced) if sliced else None
    explained = (linear_model_attribution if trial.scaling else tree_attribution)(check_x, trial, [])
    failures, passed = list(gated.pop("failures")), gated.pop("passed")
    result = TrainingResult(passed, failures, gated, at_production, best,
                            describe_batches(splits), slices, feature_importance(explained))
    run_id = uuid.uuid4().hex
    rows = {b["batch"]: b["n_rows"] for b in result.batches.collect()}  # three batches
    runs.log_run(spark, f"{home}/runs", "attrition-training", run_id, "training-run",
                 {"model": model_class, "seed": seed, "threshold": threshold, "monitor_batch": batch,
                  "n_features": len(fitted.feature_cols), "n_train": rows.get("train", 0), "n_batch": rows.get(batch, 0),
                  "scale_pos_weight": weight, "stored_settings": settings["stored"],
                  "gate_status": "passed" if passed else "failed", **params},
                 {**gated, **{f"production_{k}": v for k, v in at_production.items()},
                  "threshold_cost_optimal": best["cost_optimal"], "threshold_f1_optimal": best["f1_optimal"]})
    if not passed:
        return result
    result.params = fit_features(train)
    full_x = transform_features(train, result.params).checkpoint()
    result.model = train_model(full_x, result.params.feature_cols, model_class, params, weight)
    if deploy:
        save_artefact(spark, home, "settings", {
            **{k: v for k, v in settings.items() if k != "stored"}, "threshold_cost": round(threshold, 2),
            "threshold_f1": round(best["f1_optimal"], 2), "holdout_metrics_default": gated,
            "holdout_metrics_production": at_production})
        result.version = deploy_model(spark, home, run_id, result.model, result.params)
    else:
        try:
            result.model, result.params = load_production() if load_production else load_live(spark, home)
            result.monitored_with = "production"
        except NoProductionModel:
            result.monitored_with = "refit"
    result.drift = detect_drift(train, current, DRIFT_COLUMNS)
    result.drift_summary = dataset_drift(result.drift).first().asDict()
    write_table(score_customers(current, result.params, result.model, threshold),
                f"{home}/scored/{batch}", mode="overwrite")
    result.scored = spark.read.parquet(f"{home}/scored/{batch}")
    result.batch_metrics = evaluate(_labelled(result.scored), threshold=threshold).first().asDict()
    save_artefact(spark, home, "metrics", {
        "monitor_batch": batch, "holdout_default": gated, "holdout_production": at_production,
        f"{batch}_production": result.batch_metrics})
    runs.record_lineage(spark, f"{home}/lineage", f"{home}/models/{run_id}", "batch=train",
                        runs.fingerprint(train), f"batch={batch}", runs.fingerprint(current), run_id,
                        extra={"metrics": gated, "production_threshold": threshold, "monitor_batch": batch})
    return result


class NoProductionModel(RuntimeError):
    """No version of the production model is live."""


def load_live(spark: SparkSession, home: str) -> tuple:
    """(model, feature parameters) of the live production version, of whichever kind it is."""
    live = runs.production_version(runs.current_versions(
        runs.read_events(spark, f"{home}/versions"))).where(F.col("model") == MODEL_NAME).first()
    if live is None:
        raise NoProductionModel(f"no version of '{MODEL_NAME}' is in production under {home}")
    path = f"{home}/models/{live['run_id']}"
    return load_model(spark, path), FeatureParams.from_dict(load_artefact(spark, path, "features"))


load_production = load_live


def deploy_model(spark: SparkSession, home: str, run_id: str, model, params: FeatureParams) -> int:
    """Saves a model with its feature parameters and takes it to production as the next version."""
    model.save(spark, f"{home}/models/{run_id}")
    save_artefact(spark, f"{home}/models/{run_id}", "features", params.to_dict())
    return runs.register_and_promote(spark, f"{home}/versions", MODEL_NAME, run_id)
