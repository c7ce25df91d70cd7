"""Continued boosting: more trees on top of a fitted model, from new rows only.

A continued model is a base model's margin plus a weighted sum of regression trees. Continuing it once more adds trees to
the same sum, so that saving, loading, scoring and attribution know one format however often it was continued.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import LABEL, SEED
from ..session import shared_dir
from ..sources.artefacts import load_artefact, save_artefact
from .models import FittedModel, assemble, class_balance, row_weight

ROUNDS = 150
CHECKPOINT_EVERY = 10
_EDGE = 1e-6


def sigmoid(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


@dataclass
class ContinuedModel:
    """A base model's log-odds plus a weighted sum of regression trees."""

    base: FittedModel
    extra: GBTRegressionModel
    model_class: str = "ContinuedModel"
    scaling: Mapping = field(default_factory=dict)  # the trees read raw values; the base scales its own

    @property
    def feature_cols(self) -> Sequence[str]:
        return self.base.feature_cols

    def margin(self, df: DataFrame, column: str = "margin") -> DataFrame:
        started = self.base.margin(df, "_start")
        added = self.extra.transform(assemble(started, self.feature_cols))
        return added.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_start") + F.col(self.extra.getPredictionCol())).alias(column))

    def score(self, df: DataFrame, column: str = "churn_probability") -> DataFrame:
        return self.margin(df, "_margin").select(*[F.col(f"`{c}`") for c in df.columns], sigmoid(F.col("_margin")).alias(column))

    def save(self, spark: SparkSession, path: str) -> None:
        self.base.save(spark, f"{path}/base")
        self.extra.write().overwrite().save(f"{path}/extra")
        save_artefact(spark, path, "spec", {"model_class": self.model_class})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ContinuedModel":
        return cls(FittedModel.load(spark, f"{path}/base"), GBTRegressionModel.load(f"{path}/extra"))


def load_model(spark: SparkSession, path: str) -> FittedModel | ContinuedModel:
    """The model that was saved at `path`, of either kind."""
    kind = load_artefact(spark, path, "spec")["model_class"]
    return (ContinuedModel if kind == "ContinuedModel" else FittedModel).load(spark, path)


def _ensemble(spark: SparkSession, trees: Sequence, rates: Sequence[float]) -> GBTRegressionModel:
    """One model that sums the trees, so scoring is a single transform."""
    gateway, jvm = spark.sparkContext._gateway, spark._jvm
    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    array, weights = gateway.new_array(kind, len(trees)), gateway.new_array(jvm.double, len(trees))
    for i, (tree, rate) in enumerate(zip(trees, rates)):
        array[i], weights[i] = tree._java_obj, float(rate)
    java = jvm.org.apache.spark.ml.regression.GBTRegressionModel("continued", array, weights)
    model = GBTRegressionModel(java)
    return model.setFeaturesCol("features").setPredictionCol("_added")


def continue_boosting(base: FittedModel | ContinuedModel, df: DataFrame, rounds: int = ROUNDS, rate: float = 0.05,
                      max_depth: int = 6, min_rows: int = 20, label: str = LABEL,
                      seed: int = SEED) -> ContinuedModel:
    """Adds `rounds` trees by logistic boosting (Newton steps as weighted regressions).

    The running margin is checkpointed every few rounds: the plan stays short and
    a lost executor costs at most those rounds.
    """
    spark = df.sparkSession
    shared_dir(spark)
    counts = class_balance(df, label, factor=1.0).first()
    weight = row_weight(counts["scale_pos_weight"], counts["n_neg"], counts["n_pos"], label)
    state = (assemble(base.margin(df, "_start"), base.feature_cols)
             .select("features", F.col(label).cast("double").alias("y"), weight.alias("w"), F.col("_start").alias("margin"))).checkpoint()
    first, trees, rates = base, [], []
    if isinstance(base, ContinuedModel):
        first, trees, rates = base.base, list(base.extra.trees), list(base.extra.treeWeights)
    p = sigmoid(F.col("margin"))
    curve = F.greatest(p * (1 - p), F.lit(_EDGE))
    for i in range(rounds):
        target = state.withColumn("step", (F.col("y") - p) / curve).withColumn("h", F.col("w") * curve)
        tree = DecisionTreeRegressor(featuresCol="features", labelCol="step", weightCol="h",
                                     predictionCol="leaf", maxDepth=max_depth,
                                     minInstancesPerNode=min_rows, seed=seed + i).fit(target)
        trees.append(tree)
        rates.append(rate)
        state = tree.transform(state).withColumn("margin", F.col("margin") + rate * F.col("leaf")).drop("leaf")
        if (i + 1) % CHECKPOINT_EVERY == 0 and i + 1 < rounds:
            state = state.checkpoint()
    return ContinuedModel(first, _ensemble(spark, trees, rates))
