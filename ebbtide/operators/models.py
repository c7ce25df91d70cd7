"""Classifiers on Spark ML: estimator factory, weighting, fit, score, save and load."""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, LogisticRegression,
                                       LogisticRegressionModel, RandomForestClassificationModel,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import DEFAULT_THRESHOLD, LABEL, SEED
from ..sources.artefacts import load_artefact, save_artefact
from .features import FeatureParams, fit_scaling, transform_features
from .metrics import predict_at

BOOSTED = ("LGBMClassifier", "XGBClassifier", "GradientBoostingClassifier")
# Default parameters by model class.
DEFAULTS = {
    "LGBMClassifier": {"n_estimators": 500, "learning_rate": 0.05, "max_depth": 6, "num_leaves": 31,
                       "min_child_samples": 20, "subsample": 0.8, "colsample_bytree": 0.8,
                       "random_state": SEED},
    "XGBClassifier": {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 4,
                      "min_child_weight": 1.0, "gamma": 0.0, "subsample": 0.8,
                      "colsample_bytree": 0.8, "random_state": SEED},
    "GradientBoostingClassifier": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3,
                                   "random_state": SEED},
    "RandomForestClassifier": {"n_estimators": 100, "class_weight": "balanced", "random_state": SEED},
    "LogisticRegression": {"class_weight": "balanced", "max_iter": 5000, "C": 1.0,
                           "random_state": SEED},
}
# Parameters of the learners named above that Spark's trees and solver have no counterpart for.
NO_COUNTERPART = ("num_leaves", "reg_alpha", "reg_lambda", "max_delta_step", "objective",
                  "eval_metric", "tree_method", "n_jobs", "verbosity", "solver", "min_samples_split")
SPARK_MAX_DEPTH = 30
UNANIMOUS = 1e-6  # least share of a forest's votes in a margin


def _subset(value) -> str:
    return value if isinstance(value, str) else ("all" if value >= 1 else str(float(value)))


def _depth(value) -> int:
    if value is not None and int(value) > SPARK_MAX_DEPTH:
        warnings.warn(f"max_depth {value} is above Spark's limit; trees stop at {SPARK_MAX_DEPTH}", stacklevel=3)
    return SPARK_MAX_DEPTH if value is None else min(int(value), SPARK_MAX_DEPTH)


_TREE_PARAMS = {
    "learning_rate": ("stepSize", float),
    "max_depth": ("maxDepth", lambda v: _depth(v)),
    "subsample": ("subsamplingRate", float),
    "colsample_bytree": ("featureSubsetStrategy", _subset),
    "max_features": ("featureSubsetStrategy", _subset),
    "gamma": ("minInfoGain", float),
    "min_child_weight": ("minInstancesPerNode", lambda v: max(1, math.ceil(v))),
    "min_child_samples": ("minInstancesPerNode", int),
    "min_samples_leaf": ("minInstancesPerNode", int),
    "random_state": ("seed", int),
}


@dataclass(frozen=True)
class Recipe:
    """An unfitted classifier: the Spark estimator, its class weighting and scaling."""

    model_class: str
    params: Mapping
    estimator: Estimator
    weighting: str | float | None
    scaled: bool = False
    inverse_penalty: float | None = None


def spark_params(model_class: str, params: Mapping) -> dict:
    """Parameters under their Spark names; those without a counterpart are left out with a warning."""
    out = {}
    for name, value in params.items():
        if name in ("class_weight", "scale_pos_weight"):
            continue
        if name in NO_COUNTERPART:
            warnings.warn(f"{model_class}: '{name}' has no Spark counterpart and is ignored", stacklevel=2)
        elif model_class == "LogisticRegression":
            if name == "max_iter":
                out["maxIter"] = int(value)
            elif name not in ("C", "random_state"):
                raise ValueError(f"unknown parameter '{name}' for {model_class}")
        elif name == "n_estimators":
            out["maxIter" if model_class in BOOSTED else "numTrees"] = int(value)
        elif name in _TREE_PARAMS:
            target, convert = _TREE_PARAMS[name]
            out[target] = convert(value)
        else:
            raise ValueError(f"unknown parameter '{name}' for {model_class}")
    return out


def build_estimator(model_class: str = "LGBMClassifier", params: Mapping | None = None,
                    scale_pos_weight: float | None = None) -> Recipe:
    if model_class not in DEFAULTS:
        raise ValueError(f"no learner stands for {model_class!r}; known are {sorted(DEFAULTS)}")
    merged = {**DEFAULTS[model_class], **(params or {})}
    if model_class in ("LGBMClassifier", "XGBClassifier") and scale_pos_weight is not None:
        merged.setdefault("scale_pos_weight", scale_pos_weight)
    if model_class == "RandomForestClassifier" and "max_depth" not in merged:
        merged["max_depth"] = None  # without a limit asked for, trees grow as deep as Spark lets them
    spark_params(model_class, params or {})     # warns about what the caller asked for
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        translated = spark_params(model_class, merged)
    common = dict(featuresCol="features", labelCol=LABEL)
    weighting = merged.get("scale_pos_weight", merged.get("class_weight"))
    if model_class == "LogisticRegression":
        return Recipe(model_class, merged, LogisticRegression(**common, standardization=False, **translated),
                      weighting, True, float(merged["C"]))
    learner = RandomForestClassifier if model_class == "RandomForestClassifier" else GBTClassifier
    return Recipe(model_class, merged, learner(**common, **translated), weighting)


def class_balance(df: DataFrame, label: str = LABEL, factor: float = 1.5) -> DataFrame:
    """n_neg, n_pos and factor * neg / pos (1 without positives)."""
    y = F.col(label)
    counts = df.agg(F.coalesce(F.sum((y == 0).cast("long")), F.lit(0)).alias("n_neg"),
                    F.coalesce(F.sum((y == 1).cast("long")), F.lit(0)).alias("n_pos"))
    weight = F.when(F.col("n_pos") > 0, F.col("n_neg") / F.col("n_pos") * factor).otherwise(1.0)
    return counts.withColumn("scale_pos_weight", weight)


def row_weight(weighting: str | float | None, n_neg: int, n_pos: int, label: str = LABEL) -> Column:
    """'balanced' gives n / (2 n_class), a number weighs positives only."""
    if weighting is None:
        return F.lit(1.0)
    n = n_neg + n_pos
    if weighting == "balanced":
        pos, neg = (n / (2.0 * k) if k else 1.0 for k in (n_pos, n_neg))
    else:
        pos, neg = float(weighting), 1.0
    return F.when(F.col(label) == 1, F.lit(pos)).otherwise(F.lit(neg))


def assemble(df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(feature_cols), outputCol="features").transform(df)


@dataclass
class FittedModel:
    """A Spark ML model with the feature columns and scaling it was fitted on."""

    model: Model
    model_class: str
    feature_cols: Sequence[str]
    scaling: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    params: Mapping = field(default_factory=dict)

    def vectors(self, df: DataFrame) -> DataFrame:
        """Adds `features`; the feature columns themselves keep their raw values."""
        if not self.scaling:
            return assemble(df, self.feature_cols)
        names = {c: f"_scaled_{i}" for i, c in enumerate(self.feature_cols)}
        scaled = df.withColumns({names[c]: (F.col(f"`{c}`") - F.lit(m)) / F.lit(s)
                                 for c, (m, s) in self.scaling.items()})
        return assemble(scaled, list(names.values())).drop(*names.values())

    def score(self, df: DataFrame, column: str = "churn_probability") -> DataFrame:
        """The rows of `df` plus the probability of the positive class."""
        out = self.model.transform(self.vectors(df))
        return out.select(*[F.col(f"`{c}`") for c in df.columns],
                          F.get(vector_to_array("probability"), F.lit(1)).alias(column))

    def margin(self, df: DataFrame, column: str = "margin") -> DataFrame:
        """The rows of `df` plus the log-odds of the positive class, taken from the raw prediction, not back from the probability.

        A forest votes probabilities; its log-odds are bounded, as a vote can be unanimous.
        """
        out = self.model.transform(self.vectors(df))
        if self.model_class == "RandomForestClassifier":
            p = F.get(vector_to_array("probability"), F.lit(1))
            inside = F.least(F.greatest(p, F.lit(UNANIMOUS)), F.lit(1 - UNANIMOUS))
            value = F.log(inside / (1 - inside))
        else:
            value = F.get(vector_to_array("rawPrediction"), F.lit(1)) * (2.0 if self.model_class in BOOSTED else 1.0)
        return out.select(*[F.col(f"`{c}`") for c in df.columns], value.alias(column))

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        save_artefact(spark, path, "spec", {
            "model_class": self.model_class, "feature_cols": list(self.feature_cols),
            "scaling": {k: list(v) for k, v in self.scaling.items()}, "params": dict(self.params)})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FittedModel":
        spec = load_artefact(spark, path, "spec")
        kind = ({"LogisticRegression": LogisticRegressionModel,
                 "RandomForestClassifier": RandomForestClassificationModel}
                .get(spec["model_class"], GBTClassificationModel))
        return cls(kind.load(f"{path}/model"), spec["model_class"], spec["feature_cols"],
                   {k: tuple(v) for k, v in spec["scaling"].items()}, spec["params"])


def fit_model(df: DataFrame, feature_cols: Sequence[str], recipe: Recipe, label: str = LABEL) -> FittedModel:
    """Fits on a feature frame; class counts and scaling come from the same frame."""
    counts = class_balance(df, label).first()
    scaling = fit_scaling(df, feature_cols) if recipe.scaled else {}
    fitted = FittedModel(None, recipe.model_class, list(feature_cols), scaling, recipe.params)
    weighted = fitted.vectors(df).withColumn(
        "weight", row_weight(recipe.weighting, counts["n_neg"], counts["n_pos"], label))
    estimator = recipe.estimator.copy({recipe.estimator.weightCol: "weight",
                                       recipe.estimator.labelCol: label})
    if recipe.inverse_penalty is not None:
        total = weighted.agg(F.sum("weight")).first()[0]
        estimator = estimator.copy({estimator.regParam: 1.0 / (recipe.inverse_penalty * total)})
    fitted.model = estimator.fit(weighted.select("features", label, "weight"))
    return fitted


def train_model(df: DataFrame, feature_cols: Sequence[str], model_class: str = "LGBMClassifier",
                params: Mapping | None = None, scale_pos_weight: float | None = None,
                label: str = LABEL) -> FittedModel:
    """Fits one class; without a given positive weight it is 1.5 * neg / pos."""
    if scale_pos_weight is None:
        scale_pos_weight = class_balance(df, label).first()["scale_pos_weight"]
    return fit_model(df, feature_cols, build_estimator(model_class, params, scale_pos_weight), label)


def score_customers(df: DataFrame, params: FeatureParams, model, threshold: float = DEFAULT_THRESHOLD,
                    digits: int | None = None) -> DataFrame:
    """Customer rows, unchanged, plus churn_prediction and churn_probability.

    The row travels along as one struct, so nothing has to be joined back. The
    prediction uses the unrounded probability; `digits` rounds half to even.
    """
    packed = df.withColumn("_row", F.struct(*df.columns))
    scored = model.score(transform_features(packed, params, keep=("_row",)))
    p = F.col("churn_probability")
    shown = p if digits is None else F.rint(p * 10 ** digits) / 10 ** digits
    return scored.select("_row.*", predict_at(p, threshold).alias("churn_prediction"),
                         shown.alias("churn_probability"))


def prediction_summary(scored: DataFrame, label: str = LABEL) -> DataFrame:
    """Predicted and actual positives, as counts and rates."""
    actual = ([F.sum(label).cast("long").alias("actual"), F.avg(label).alias("actual_rate")]
              if label in scored.columns else [])
    return scored.agg(F.count("*").alias("n"), F.sum("churn_prediction").cast("long").alias("predicted"),
                      F.avg("churn_prediction").alias("predicted_rate"), *actual)

