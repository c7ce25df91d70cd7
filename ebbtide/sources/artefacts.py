"""Small fitted parameters and reports as one-row JSON tables."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import SparkSession

_SCHEMA = "name string, payload string"


def save_artefact(spark: SparkSession, path: str, name: str, payload: Mapping) -> None:
    row = [(name, json.dumps(payload))]
    spark.createDataFrame(row, _SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/{name}")


def load_artefact(spark: SparkSession, path: str, name: str) -> dict:
    row = spark.read.schema(_SCHEMA).json(f"{path}/{name}").first()
    return json.loads(row["payload"])


def find_artefact(spark: SparkSession, path: str, name: str) -> dict | None:
    """The artefact, or None where nothing was stored under its name; one that can't be read is an error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    stored = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    return load_artefact(spark, path, name) if stored else None
