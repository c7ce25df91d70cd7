"""Micro-batch scoring: validate the request, derive features, score, stamp the version.

The transform is the one the batch path uses and keeps no state, so the output
mode is append and the result for a set of files equals the batch result.

`write_once` keeps scored and refused rows of a micro-batch together: both are written
under the batch's number, and then one commit file makes them visible. A batch that is
replayed after a failure writes over its own leftovers, or is skipped if it was committed.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..config import DEFAULT_THRESHOLD
from ..operators.features import FeatureParams
from ..operators.models import score_customers
from ..operators.quality import REQUEST, mark_valid, quarantine, split_marked
from ..operators.versions import Folder
from ..sources.schema import CUSTOMER_SCHEMA

DIGITS = 4


def request_stream(spark: SparkSession, path: str, fmt: str = "json", files_per_trigger: int = 1000) -> DataFrame:
    """Requests from files as they arrive; the schema is declared, not inferred."""
    return (spark.readStream.schema(CUSTOMER_SCHEMA).format(fmt)
            .option("maxFilesPerTrigger", files_per_trigger).load(path))


def score_requests(requests: DataFrame, params: FeatureParams, model, version: str,
                   threshold: float = DEFAULT_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(scored, rejected) for a batch or a stream of requests."""
    valid, rejected = quarantine(requests, REQUEST)
    return _answers(valid, params, model, version, threshold), rejected


def _answers(valid: DataFrame, params: FeatureParams, model, version: str, threshold: float) -> DataFrame:
    scored = score_customers(valid, params, model, threshold, DIGITS)
    return scored.withColumn("model_version", F.lit(version))


def write_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> DataStreamWriter:
    """Append sink that works off what is there and then stops when started with it."""
    return (df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True))


SCORED, REJECTED = "scored", "rejected"
_NAME = re.compile(r"(\d+)\.json")


def write_once(requests: DataFrame, params: FeatureParams, model, version: str, home: str, checkpoint: str,
               threshold: float = DEFAULT_THRESHOLD) -> DataStreamWriter:
    """Scores a stream to `home`, every request once, as scored or as rejected with its reasons."""
    def commit(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        log = Folder(spark, f"{home}/commits")
        if f"{number}.json" in log.names():
            return
        # Rows are held with their mark: both writes then read a flag, and their plans hold no rules.
        held = mark_valid(batch, REQUEST).persist()
        try:
            valid, rejected = split_marked(held, REQUEST)
            for name, rows in ((SCORED, _answers(valid, params, model, version, threshold)), (REJECTED, rejected)):
                rows.write.mode("overwrite").parquet(f"{home}/{name}/batch_id={number}")
        finally:
            held.unpersist()
        log.create(f"{number}.json", json.dumps({"batch_id": number, "model_version": version}))

    return requests.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def read_committed(spark: SparkSession, home: str, name: str = SCORED) -> DataFrame:
    """The rows of all committed batches, with their `batch_id`; what a failed batch left behind is not among them."""
    numbers = sorted(int(m[1]) for n in Folder(spark, f"{home}/commits").names() if (m := _NAME.fullmatch(n)))
    if not numbers:
        raise ValueError(f"no batch is committed under {home}")
    paths = [f"{home}/{name}/batch_id={n}" for n in numbers]
    return spark.read.option("basePath", f"{home}/{name}").parquet(*paths)
