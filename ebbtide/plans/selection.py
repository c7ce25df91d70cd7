"""Model selection: same rows, same split, same metric for every candidate; then tuning."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..config import LABEL, MIN_PRECISION, SEED
from ..operators.features import FeatureParams, fit_features, transform_features
from ..operators.metrics import (best_thresholds, compare_models, leaderboard, threshold_sweep,
                                 tuning_gain)
from ..operators.models import build_estimator, class_balance, fit_model
from ..operators.splits import holdout_split
from ..operators.tuning import tune_model
from ..session import shared_dir
from ..sources.artefacts import save_artefact

# Candidates by name.
CANDIDATES = {
    "Logistic Regression": ("LogisticRegression", {}),
    "Random Forest": ("RandomForestClassifier", {"n_estimators": 200}),
    "XGBoost (GBM)": ("XGBClassifier", {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 4,
                                        "subsample": 0.8, "colsample_bytree": 0.8}),
    "LightGBM": ("LGBMClassifier", {"n_estimators": 500, "learning_rate": 0.05, "max_depth": 6,
                                    "num_leaves": 31}),
}
TUNED = 3


@dataclass
class Prepared:
    train: DataFrame
    check: DataFrame
    params: FeatureParams
    balance: float


def prepare(df: DataFrame, share: float = 0.2, seed: int = SEED) -> Prepared:
    """Split first, features fitted on the training fold only."""
    shared_dir(df.sparkSession)
    split = holdout_split(df, share, [LABEL], seed).checkpoint()
    fit_part = split.where("NOT holdout").drop("holdout")
    params = fit_features(fit_part)
    train = transform_features(fit_part, params).checkpoint()
    check = transform_features(split.where("holdout").drop("holdout"), params).checkpoint()
    return Prepared(train, check, params, class_balance(train, factor=1.0).first()["scale_pos_weight"])


def score_candidates(data: Prepared, candidates: Mapping[str, tuple[str, Mapping]] = CANDIDATES) -> DataFrame:
    """Long table of hold-out scores: model, label, score."""
    parts = []
    for name, (model_class, params) in candidates.items():
        model = fit_model(data.train, data.params.feature_cols,
                          build_estimator(model_class, params, data.balance))
        parts.append(model.score(data.check).select(
            F.lit(name).alias("model"), F.col(LABEL).alias("label"), F.col("churn_probability").alias("score")))
    return reduce(DataFrame.unionByName, parts)


def select_model(df: DataFrame, candidates: Mapping[str, tuple[str, Mapping]] = CANDIDATES,
                 n_trials: int | None = None, spaces: Mapping | None = None, keep: int = TUNED,
                 seed: int = SEED, home: str | None = None) -> dict:
    """Compare, tune the best `keep`, and pick the winner with its thresholds.

    With `home`, the winner's settings are stored there, and later training runs start from them.
    """
    data = prepare(df, seed=seed)
    default = compare_models(score_candidates(data, candidates), len(candidates)).checkpoint()
    finalists = [r["model"] for r in leaderboard(default, keep).where("tuned").collect()]
    tuned_specs: dict[str, tuple[str, Mapping]] = {}
    for name in finalists:
        model_class = candidates[name][0]
        found = tune_model(data.train, data.params.feature_cols, model_class, n_trials, seed=seed,
                           space=(spaces or {}).get(model_class))
        tuned_specs[name] = (model_class, found.best_params)
    tuned_scores = score_candidates(data, tuned_specs).checkpoint()
    tuned = compare_models(tuned_scores, len(tuned_specs)).checkpoint()
    gain = tuning_gain(default, tuned)
    winner = tuned.orderBy(F.desc("f1"), "model").first()
    best = best_thresholds(threshold_sweep(tuned_scores.where(F.col("model") == winner["model"])),
                           MIN_PRECISION).first()
    model_class, params = tuned_specs[winner["model"]]
    entry = {"model_class": model_class, "params": dict(params), "f1_score": round(winner["f1"], 4),
             "recall": round(winner["recall"], 4), "auc_roc": round(winner["auc_roc"], 4),
             "threshold_cost": round(best["cost_optimal"], 2), "threshold_f1": round(best["f1_optimal"], 2)}
    if home is not None:
        save_artefact(df.sparkSession, home, "settings", entry)
    return {"comparison": default, "tuned": tuned, "gain": gain, "settings": entry}

