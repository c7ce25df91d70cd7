"""Drift-triggered retraining: decide, retrain by strategy, evaluate, gate."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import DRIFT_COLUMNS, LABEL, MIN_PRECISION, PRODUCTION_THRESHOLD, SEED
from ..operators.boosting import continue_boosting
from ..operators.decisions import retrain_decision
from ..operators.drift import detect_drift
from ..operators import runs
from ..operators.features import FeatureParams, fit_features, transform_features
from ..operators.lookup import pool
from ..operators.metrics import best_thresholds, check_gates, evaluate, threshold_sweep
from ..operators.models import train_model
from ..operators.quality import validate
from ..operators.splits import holdout_split, sample_share
from ..operators.tuning import grid_search
from ..session import shared_dir
from ..sources.artefacts import find_artefact
from .training import NoProductionModel, deploy_model, load_live

STRATEGIES = ("finetune", "mixed", "reexperiment")
HOLDOUT_SHARE = 0.3
# The small grid of a re-experiment.
GRID = ({"n_estimators": 300, "max_depth": 4, "num_leaves": 15},
        {"n_estimators": 500, "max_depth": 6, "num_leaves": 31},
        {"n_estimators": 700, "max_depth": 8, "num_leaves": 63},
        {"n_estimators": 500, "max_depth": 6, "num_leaves": 31, "learning_rate": 0.02})


@dataclass
class RetrainResult:
    should_retrain: bool
    recommended: str | None
    reasons: list[str]
    observations: list[str]
    drift: DataFrame
    current_f1: float | None
    strategy: str | None = None
    model: object = None
    metrics: dict | None = None
    thresholds: dict | None = None
    passed: bool | None = None
    failures: list[str] | None = None
    baseline_f1: float | None = None
    version: int | None = None


def retrain_mixed(history: DataFrame, fresh: DataFrame, feature_cols, params: Mapping | None = None,
                  share: float = 0.5, seed: int = SEED):
    """From scratch on an exact share of the history plus all new rows."""
    return train_model(pool(sample_share(history, share, seed), fresh), feature_cols, params=params)


def retrain_reexperiment(history: DataFrame, fresh: DataFrame, feature_cols, configs=GRID,
                         seed: int = SEED):
    return grid_search(pool(history, fresh), feature_cols, configs, seed=seed)[0]


def retrain(history: DataFrame, batch: DataFrame, params: FeatureParams, production=None,
            baseline_f1: float | None = None, dry_run: bool = False, force: bool = False,
            strategy: str | None = None, threshold: float = PRODUCTION_THRESHOLD,
            model_params: Mapping | None = None, configs=GRID, rounds: int = 150,
            promote: Callable[[object], None] | None = None, seed: int = SEED, gates: Mapping | None = None,
            log: Callable[[dict, dict], None] | None = None) -> RetrainResult:
    """Reviews one batch against the history and, if called for, retrains.

    A dry run only decides. `promote` is called with the new model when it passes
    the gates at the production threshold; `log` with the run's parameters and metrics.
    """
    if strategy is not None and strategy not in STRATEGIES:
        raise ValueError(f"{strategy!r} is no retraining strategy; those are {', '.join(STRATEGIES)}")
    history, batch = validate(history, "historical"), validate(batch, "batch")
    shared_dir(history.sparkSession)
    fresh = transform_features(batch, params).checkpoint()
    drift = detect_drift(history, batch, DRIFT_COLUMNS).checkpoint()
    current_f1 = None
    if production is not None:
        current_f1 = evaluate(_named(production.score(fresh)).checkpoint(), threshold=threshold).first()["f1"]
    d = retrain_decision(drift, baseline_f1, current_f1).first()
    result = RetrainResult(d["should_retrain"], d["strategy"], list(d["reasons"]),
                           list(d["observations"]), drift, current_f1)
    if dry_run or not (d["should_retrain"] or force):
        return result
    split = holdout_split(fresh, HOLDOUT_SHARE, [LABEL], seed).checkpoint()
    train, check = split.where("NOT holdout").drop("holdout"), split.where("holdout").drop("holdout")
    result.strategy = strategy or d["strategy"] or "mixed"
    old = transform_features(history, params).checkpoint()
    if result.strategy == "finetune":
        if production is None:
            raise RuntimeError("finetune needs the production model")
        result.model = continue_boosting(production, train, rounds, seed=seed)
    elif result.strategy == "mixed":
        result.model = retrain_mixed(old, train, params.feature_cols, model_params, seed=seed)
    else:
        result.model = retrain_reexperiment(old, train, params.feature_cols, configs, seed)
    scored = _named(result.model.score(check)).checkpoint()
    gated = check_gates(evaluate(scored, threshold=threshold), **({"gates": gates} if gates else {})).first().asDict()
    result.failures, result.passed = list(gated.pop("failures")), gated.pop("passed")
    result.metrics = gated
    result.thresholds = best_thresholds(threshold_sweep(scored), MIN_PRECISION).first().asDict()
    if log is not None:
        log({"strategy": result.strategy, "historical_rows": old.count(), "new_rows": train.count(), "new_holdout": check.count(),
             "gate_status": "passed" if result.passed else "failed"},
            {**gated, "threshold_cost": threshold, "threshold_f1": result.thresholds["f1_optimal"]})
    if result.passed and promote is not None:
        promote(result.model)
    return result


def retrain_production(spark: SparkSession, home: str, history: DataFrame, batch: DataFrame, name: str = "current",
                       **options) -> RetrainResult:
    """Reviews a batch against the live model under `home` and its stored baseline F1; a model that passes goes live.

    The run is logged, saved and promoted as the next version. Without a live model, the batch is still reviewed by drift,
    and a finetune is an error. Feature parameters are those of the live model; options are those of `retrain`.
    """
    stored = find_artefact(spark, home, "settings") or {}
    baseline = (stored.get("holdout_metrics_production") or {}).get("f1")
    try:
        production, params = load_live(spark, home)
    except NoProductionModel:
        production, params = None, fit_features(validate(history, "historical"))
    run_id, deployed = uuid.uuid4().hex, []

    def log(parameters: dict, metrics: dict) -> None:
        runs.log_run(spark, f"{home}/runs", "attrition-retraining", run_id, f"retrain-{name}-{parameters['strategy']}", {"batch": name, **parameters}, metrics)

    result = retrain(history, batch, params, production, baseline, log=log,
                     promote=lambda model: deployed.append(deploy_model(spark, home, run_id, model, params)), **options)
    result.baseline_f1, result.version = baseline, deployed[0] if deployed else None
    return result


def _named(scored: DataFrame) -> DataFrame:
    """What evaluation reads: label and score."""
    return scored.select(F.col(LABEL).alias("label"), F.col("churn_probability").alias("score"))
