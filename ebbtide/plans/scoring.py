"""Batch scoring with the live production model, as a job of its own."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT_THRESHOLD
from ..operators.models import prediction_summary, score_customers
from ..sources.artefacts import find_artefact
from ..sources.tables import CSV, write_table
from .training import load_live

DIGITS = 4


@dataclass
class ScoringResult:
    scored: DataFrame
    threshold: float
    summary: dict


def score_batch(spark: SparkSession, home: str, customers: DataFrame, path: str, format: str = "parquet") -> ScoringResult:
    """Scores customers with the live model, its feature parameters and the stored threshold, and writes them to `path`.

    The threshold is the stored cost threshold, 0.50 without one. The output holds every input column, the prediction and
    the probability to four digits; the summary counts predicted and, where the label is known, actual positives.
    """
    model, params = load_live(spark, home)
    threshold = float((find_artefact(spark, home, "settings") or {}).get("threshold_cost", DEFAULT_THRESHOLD))
    out = score_customers(customers, params, model, threshold, digits=DIGITS)
    write_table(out, path, format, mode="overwrite")
    scored = spark.read.schema(out.schema).options(**(CSV if format == "csv" else {})).format(format).load(path)
    return ScoringResult(scored, threshold, prediction_summary(scored).first().asDict())
