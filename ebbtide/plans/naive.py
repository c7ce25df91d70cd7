"""The naive baseline: drop gaps, label-encode, unstratified split, accuracy."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..config import ID, LABEL, SEED
from ..operators.features import label_encode
from ..operators.lookup import missed_positives
from ..operators.metrics import confusion, predict_at, rates
from ..operators.models import build_estimator, fit_model
from ..operators.splits import holdout_split
from ..sources.tables import drop_null_rows, text_columns


def naive_baseline(df: DataFrame, params: Mapping | None = None, seed: int = SEED) -> DataFrame:
    """One row: accuracy as reported, and the F1, recall and missed positives that are not."""
    whole = drop_null_rows(df)
    encoded = label_encode(whole, text_columns(whole, exclude=[ID])).persist()
    split = holdout_split(encoded, 0.2, [], seed)
    features = [c for c in encoded.columns if c not in (ID, LABEL)]
    model = fit_model(split.where("NOT holdout"), features,
                      build_estimator("GradientBoostingClassifier", {"n_estimators": 100, **(params or {})}))
    scored = model.score(split.where("holdout")).withColumn(
        "pred", predict_at(F.col("churn_probability"))).withColumnRenamed(LABEL, "label")
    r = rates()
    quality = confusion(scored).select(*[r[k].alias(k) for k in ("accuracy", "f1", "recall")])
    missed = missed_positives(scored).first()
    return quality.withColumn("missed", F.lit(missed["missed"])).withColumn("cost", F.lit(missed["cost"]))
