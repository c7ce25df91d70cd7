"""Run, version and provenance tables: append-only rows and queries over them."""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Iterator, Mapping, Sequence
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .versions import append_events, now_ms, read_events, register_and_promote  # noqa: F401

RUN_SCHEMA = ("experiment string, run_id string, run_name string, start_ms bigint, "
              "kind string, key string, value string, seq bigint")
# Metrics shown in the run listing, and the model name used when a run has none.
LISTED_METRICS = {"f1": "f1", "recall": "recall", "precision": "precision", "auc_roc": "auc_roc",
                  "missed_churners": "missed", "total_business_cost": "cost"}
DEFAULT_MODEL = "LightGBM"
RUN_ID_CHARS = 12
CHECKSUM_CHARS = 16
WHOLE_FILE, CHUNK = 64 << 20, 4 << 20


def log_run(spark: SparkSession, path: str, experiment: str, run_id: str, run_name: str,
            params: Mapping | None = None, metrics: Mapping | None = None,
            start_ms: int | None = None) -> None:
    """Appends one row per parameter and metric of a run."""
    start, seq = start_ms if start_ms is not None else now_ms(), time.time_ns()
    rows = [(experiment, run_id, run_name, start, kind, str(k), None if v is None else str(v), seq)
            for kind, values in (("param", params), ("metric", metrics)) for k, v in (values or {}).items()]
    spark.createDataFrame(rows, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def wide_runs(rows: DataFrame, keys: Sequence[str] = (*LISTED_METRICS, "model")) -> DataFrame:
    """One row per run; the listed keys become columns. The last value logged wins, a metric over a parameter."""
    seq = F.coalesce("seq", F.lit(0)) if "seq" in rows.columns else F.lit(0)
    return (rows.withColumn("_order", F.struct(F.col("kind") == "metric", seq))
            .groupBy("experiment", "run_id", "run_name", "start_ms")
            .pivot("key", list(keys)).agg(F.max_by("value", "_order")))


def _minute(ms: Column) -> Column:
    """UTC minute; a timestamp without zone, so the session zone does not shift it."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.date_format(start + F.make_dt_interval(secs=ms / 1000), "yyyy-MM-dd HH:mm")


def list_runs(wide: DataFrame) -> DataFrame:
    """Runs by experiment, newest first; metrics that were not logged count as 0."""
    def metric(key: str, name: str) -> Column:
        value = F.coalesce(F.col(key).try_cast("double"), F.lit(0.0))
        return (value.cast("long") if name in ("missed", "cost") else value).alias(name)

    return wide.orderBy("experiment", F.desc("start_ms")).select(
        "experiment", F.coalesce("run_name", F.lit("unnamed")).alias("run_name"),
        F.substring("run_id", 1, RUN_ID_CHARS).alias("run_id"),
        *[metric(k, n) for k, n in LISTED_METRICS.items()],
        F.coalesce("model", F.lit(DEFAULT_MODEL)).alias("model"), _minute(F.col("start_ms")).alias("time"))


def current_versions(events: DataFrame) -> DataFrame:
    """Stage of every version from its event log.

    A version has the stage of its last event, except that only the latest
    production event of a model is live: earlier ones are archived.
    """
    last = events.groupBy("model", "version").agg(
        F.max_by("stage", "seq").alias("stage"), F.max("seq").alias("seq"),
        F.min_by("run_id", "seq").alias("run_id"), F.min_by("created_ms", "seq").alias("created_ms"))
    live = events.where("stage = 'production'").groupBy("model").agg(F.max("seq").alias("live_seq"))
    stage = F.when((F.col("stage") == "production") & (F.col("seq") < F.col("live_seq")), "archived")
    return last.join(live, "model", "left").select(
        "model", "version", F.coalesce(stage, F.when(F.col("stage") == "registered", "none"),
                                       F.col("stage")).alias("stage"), "run_id", "created_ms")


def production_version(versions: DataFrame) -> DataFrame:
    """Latest production version of each model."""
    return versions.where("stage = 'production'").groupBy("model").agg(
        F.max("version").alias("version"), F.max_by("run_id", "version").alias("run_id"))


def list_versions(versions: DataFrame) -> DataFrame:
    return versions.select("model", "version", "stage",
                           F.substring("run_id", 1, RUN_ID_CHARS).alias("run_id"),
                           _minute(F.col("created_ms")).alias("created"))


def checksum(content: Column) -> Column:
    return F.substring(F.sha2(content, 256), 1, CHECKSUM_CHARS)


def file_checksums(spark: SparkSession, path: str, whole: int = WHOLE_FILE, chunk: int = CHUNK) -> DataFrame:
    """SHA-256 prefix of every file under a path, hashed on the executors.

    Files up to `whole` bytes are rows of the binary source. Larger ones, which need not fit a row (2 GB), are opened by
    the task that has their path and hashed `chunk` bytes at a time. Spark's file sources do not list empty files.
    """
    files = spark.read.format("binaryFile").load(path)
    small = files.where(F.col("length") <= whole).select("path", "length", checksum(F.col("content")).alias("checksum"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for uri in b.column("path").to_pylist():
                system, place = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))
                digest = hashlib.sha256()
                with system.open_input_stream(place) as data:
                    while part := data.read(chunk):
                        digest.update(part)
                found.append(digest.hexdigest()[:CHECKSUM_CHARS])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.string())], names=["path", "length", "checksum"])

    large = files.where(F.col("length") > whole).select("path", "length")  # contents are not read for these two
    return small.unionByName(large.repartition("path").mapInArrow(stream, "path string, length long, checksum string"))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive digest of a table: rows, xor and sum of row hashes.

    Unlike a file checksum it does not depend on how the rows are laid out in files.
    """
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.agg(F.count("*").alias("n_rows"), F.bit_xor(h).alias("xor_hash"),
                  F.sum(h.cast("decimal(38,0)")).cast("string").alias("sum_hash"))


def text_fingerprint(df: DataFrame) -> DataFrame:
    """n_rows, and two sums over the md5 of each row's values as text (null is N, others V and the value, joined by commas): an order-insensitive digest that any engine can repeat."""
    parts = [F.coalesce(F.concat(F.lit("V"), F.col(f"`{c}`").cast("string")), F.lit("N")) for c in df.columns]
    h = F.md5(F.concat_ws(",", *parts))
    half = [F.conv(F.substring(h, at, 15), 16, 10).cast("decimal(38,0)") for at in (1, 16)]
    return df.agg(F.count("*").alias("n_rows"), *[F.sum(x).cast("string").alias(f"sum_{i}") for i, x in enumerate(half, 1)])


def fingerprint(df: DataFrame) -> str:
    r = table_fingerprint(df).first()
    return f"{r['n_rows']}-{(r['xor_hash'] or 0) & (2 ** 64 - 1):016x}-{r['sum_hash']}"


def record_lineage(spark: SparkSession, path: str, model_file: str, train_data: str, train_checksum: str,
                   current_data: str, current_checksum: str, run_id: str | None = None,
                   environment: Mapping | None = None, extra: Mapping | None = None) -> dict:
    """Appends one provenance record; environment fields are taken as given."""
    record = {"timestamp": datetime.now(timezone.utc).isoformat(), "model_file": model_file,
              "train_data": train_data, "train_checksum": train_checksum, "current_data": current_data,
              "current_checksum": current_checksum, "run_id": run_id, **(environment or {})}
    schema = ", ".join(f"`{k}` string" for k in record) + ", extra string"
    row = [(*[None if v is None else str(v) for v in record.values()], json.dumps(extra or {}))]
    spark.createDataFrame(row, schema).coalesce(1).write.mode("append").json(path)
    return {**record, **(extra or {})}
