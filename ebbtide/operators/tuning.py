"""Seeded random search as a race over stratified folds, and a small grid search."""

from __future__ import annotations

import math
import random
import warnings
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from ..config import LABEL, SEED
from .metrics import confusion, predict_at, rates
from .models import NO_COUNTERPART, FittedModel, Recipe, build_estimator, class_balance, fit_model, spark_params
from .sampling import assign_folds
from ..session import shared_dir
from .splits import holdout_split


@dataclass(frozen=True)
class Range:
    """Search range: whole numbers by `step`, or floats, uniform or log-uniform.

    `of_balance` multiplies the bounds by the negative-to-positive ratio.
    """

    low: float
    high: float
    step: int | None = None
    log: bool = False
    of_balance: bool = False

    def draw(self, rng: random.Random, balance: float) -> float | int:
        low, high = ((self.low * balance, self.high * balance) if self.of_balance
                     else (self.low, self.high))
        if self.step:
            return int(low) + self.step * rng.randrange((int(high) - int(low)) // self.step + 1)
        if self.log:
            return math.exp(rng.uniform(math.log(low), math.log(high)))
        return rng.uniform(low, high)


# Search spaces and budgets by model class.
SPACES: dict[str, Mapping[str, Range | Sequence]] = {
    "LGBMClassifier": {
        "n_estimators": Range(100, 800, 50), "learning_rate": Range(0.01, 0.2, log=True),
        "max_depth": Range(3, 10, 1), "num_leaves": Range(15, 127, 1),
        "min_child_samples": Range(5, 50, 1), "subsample": Range(0.6, 1.0),
        "colsample_bytree": Range(0.6, 1.0), "reg_alpha": Range(1e-8, 10.0, log=True),
        "reg_lambda": Range(1e-8, 10.0, log=True),
        "scale_pos_weight": Range(0.5, 2.0, of_balance=True)},
    "RandomForestClassifier": {
        "n_estimators": Range(50, 500, 50), "max_depth": Range(3, 20, 1),
        "min_samples_split": Range(2, 20, 1), "min_samples_leaf": Range(1, 10, 1),
        "max_features": ("sqrt", "log2")},
    "XGBClassifier": {
        "n_estimators": Range(100, 1000, 50), "learning_rate": Range(0.01, 0.2, log=True),
        "max_depth": Range(2, 8, 1), "min_child_weight": Range(1.0, 12.0),
        "gamma": Range(1e-8, 5.0, log=True), "subsample": Range(0.6, 1.0),
        "colsample_bytree": Range(0.6, 1.0), "max_delta_step": Range(0, 5, 1),
        "reg_alpha": Range(1e-8, 10.0, log=True), "reg_lambda": Range(1e-8, 10.0, log=True),
        "scale_pos_weight": Range(0.7, 2.5, of_balance=True)},
    "LogisticRegression": {"C": Range(1e-3, 10.0, log=True), "solver": ("lbfgs", "saga")},
}
BUDGETS = {"LGBMClassifier": 50, "RandomForestClassifier": 50, "XGBClassifier": 80,
           "LogisticRegression": 50}
FOLDS = 3
ETA, RUNGS = 4, 3


def draw_trials(model_class: str, n_trials: int, balance: float, seed: int = SEED,
                space: Mapping | None = None) -> list[dict]:
    if space is None and model_class not in SPACES:
        raise ValueError(f"no search space for {model_class!r}")
    rng = random.Random(seed)
    return [{name: (r.draw(rng, balance) if isinstance(r, Range) else rng.choice(list(r)))
             for name, r in (space or SPACES[model_class]).items()} for _ in range(n_trials)]


@dataclass(frozen=True)
class TuningResult:
    """Best parameters, their mean F1 over folds of all rows, the trials that reached all rows, and all rungs of the race.

    `ignored` are parameters of the space that Spark's learners have no counterpart for; they are part of no trial.
    """

    best_params: dict
    best_f1: float
    trials: list[tuple[dict, float]]
    rungs: list[tuple[float, list[tuple[dict, float]]]]
    ignored: tuple[str, ...] = ()


def rung_sizes(budget: int, eta: int = ETA, rungs: int = RUNGS) -> list[tuple[int, float]]:
    """(trials, share of the rows) of each rung, cheapest first, whose cost is at most `budget` runs over all rows.

    The first rung holds at least `eta` times the budget, where there are several rungs.
    """
    first = max(budget, budget * eta ** (rungs - 1) // rungs)
    return [(max(1, first // eta ** r), float(eta) ** (r + 1 - rungs)) for r in range(rungs)]


def tune_model(df: DataFrame, feature_cols: Sequence[str], model_class: str,
               n_trials: int | None = None, folds: int = FOLDS, seed: int = SEED,
               space: Mapping | None = None, parallelism: int = 4, label: str = LABEL,
               eta: int = ETA, rungs: int = RUNGS) -> TuningResult:
    """A race of random settings by mean F1 over stratified folds; `n_trials` is its budget in runs over all rows.

    Successive halving: many settings start on a small share of the rows, the best 1 / eta of each rung go on to eta times
    the rows, and the last rung has them all. Shares are nested, as they are cut by a hash of the row's place in its fold.
    Weights of a trial are made in its pipeline. Nothing is fitted that is not scored.
    """
    counts = class_balance(df, label, factor=1.0).first()
    n_neg, n_pos = counts["n_neg"], counts["n_pos"]
    sizes = rung_sizes(n_trials or BUDGETS[model_class], eta, rungs)
    if space is None and model_class not in SPACES:
        raise ValueError(f"no search space for {model_class!r}")
    given = space or SPACES[model_class]
    ignored = tuple(name for name in given if name in NO_COUNTERPART)
    racing = draw_trials(model_class, sizes[0][0], counts["scale_pos_weight"], seed, {k: v for k, v in given.items() if k not in ignored})
    base = build_estimator(model_class)
    shared_dir(df.sparkSession)
    folded = assign_folds(df, folds, [label], seed=seed)
    share = F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]), F.lit(1 << 20)) / float(1 << 20)
    ready = VectorAssembler(inputCols=list(feature_cols), outputCol="features").transform(
        folded.withColumn("share", share)).select("features", label, "fold", "share").checkpoint()
    history, scored = [], []
    for i, (size, part) in enumerate(sizes):
        # Every trial reads its rung's rows many times: they are cut out once, and so are the classes of each fold.
        rows = ready.where(F.col("share") < part).checkpoint() if part < 1 else ready
        fit = _fit_folds(rows, folds, label)
        with ThreadPoolExecutor(parallelism) as pool:
            scores = list(pool.map(lambda t: _cross_f1(rows, _trial(base, model_class, t, n_neg, n_pos, part, folds, label), folds, label, fit), racing))
        scored = sorted(zip(racing, scores), key=lambda x: -x[1])
        history.append((part, scored))
        if i + 1 < len(sizes):
            racing = [t for t, _ in scored[:sizes[i + 1][0]]]
    return TuningResult(scored[0][0], scored[0][1], scored, history, ignored)


def _trial(base: Recipe, model_class: str, trial: Mapping, n_neg: int, n_pos: int, part: float, folds: int, label: str) -> Pipeline:
    weighting = trial.get("scale_pos_weight", base.weighting)
    counts = n_neg + n_pos
    heavy, light = 1.0, 1.0
    if weighting == "balanced":
        heavy, light = (counts / (2.0 * n) if n else 1.0 for n in (n_pos, n_neg))
    elif weighting is not None:
        heavy = float(weighting)
    weigh = SQLTransformer(statement=f"SELECT *, CASE WHEN `{label}` = 1 THEN {heavy!r}D ELSE {light!r}D END AS weight FROM __THIS__")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        named = spark_params(model_class, trial)
    learner = base.estimator.copy({base.estimator.labelCol: label, base.estimator.weightCol: "weight"})
    stages = [weigh, learner]
    if base.scaled:
        # Balanced weights of the training folds sum to their row count.
        named["regParam"] = folds / (trial.get("C", base.inverse_penalty) * counts * part * (folds - 1))
        learner = learner.copy({learner.featuresCol: "scaled"})
        stages = [weigh, StandardScaler(inputCol="features", outputCol="scaled", withMean=True), learner]
    stages[-1] = learner.copy({learner.getParam(k): v for k, v in named.items()})
    return Pipeline(stages=stages)


def _fit_folds(rows: DataFrame, folds: int, label: str) -> list[int]:
    """The folds that can be scored: two classes in the rows of the others, positives in their own."""
    held = {(r["fold"], r[label]) for r in rows.groupBy("fold", label).agg(F.count("*").alias("n")).collect()}  # two rows a fold
    return [k for k in range(folds) if len({y for f, y in held if f != k}) == 2 and (k, 1) in held]


def _cross_f1(rows: DataFrame, pipeline: Pipeline, folds: int, label: str, fit: Sequence[int]) -> float:
    """Mean F1 of the positive class over the folds; one that is not among `fit` counts 0."""
    f1 = MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0)
    total = 0.0
    for k in fit:
        train, check = rows.where(F.col("fold") != k), rows.where(F.col("fold") == k)
        total += f1.evaluate(pipeline.fit(train).transform(check))
    return total / folds


def f1_of(scored: DataFrame, label: str = LABEL, score: str = "churn_probability",
          threshold: float = 0.5) -> float:
    predicted = scored.withColumn("pred", predict_at(F.col(score), threshold))
    return confusion(predicted, label, "pred").select(rates()["f1"]).first()[0]


def grid_search(df: DataFrame, feature_cols: Sequence[str], configs: Sequence[Mapping],
                model_class: str = "LGBMClassifier", share: float = 0.2, seed: int = SEED,
                label: str = LABEL, parallelism: int = 4) -> tuple[FittedModel, float, list[float]]:
    """Fits every config on 1 - share of the rows, keeps the best F1 on the rest, the first of equals.

    Boosting is a long row of short jobs, one a level of each tree, so configs are fitted beside each other.
    """
    shared_dir(df.sparkSession)
    split = holdout_split(df, share, [label], seed).checkpoint()
    train, check = split.where("NOT holdout"), split.where("holdout")
    weight = class_balance(train, label, factor=1.0).first()["scale_pos_weight"]
    # Built before the threads start: what they warn about is set for the whole process.
    recipes = [build_estimator(model_class, config, weight) for config in configs]

    def fitted(recipe: Recipe) -> tuple[FittedModel, float]:
        model = fit_model(train, feature_cols, recipe, label)
        return model, f1_of(model.score(check), label)

    with ThreadPoolExecutor(parallelism) as pool:
        found = list(pool.map(fitted, recipes))
    best, best_f1 = max(found, key=lambda x: x[1], default=(None, 0.0))
    return best, best_f1, [f1 for _, f1 in found]
