"""Session settings that the operators count on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# UTC for stored timestamps, adaptive plans for runtime join and skew handling.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call sites are looked up for every Column otherwise, which slows plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # The JVM never compiles a method above 8,000 bytes; wide projections beyond it run in split methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
SPARKS_METHOD_LIMIT = "65535"

_STAGED: list[str] = []


def build_session(app_name: str = "ebbtide", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def compiled(df: DataFrame) -> DataFrame:
    """`df`, in whose session wide projections are compiled too, also where it was not built here; a limit that was set stays."""
    conf = df.sparkSession.conf
    if conf.get(METHOD_LIMIT, SPARKS_METHOD_LIMIT) == SPARKS_METHOD_LIMIT:
        conf.set(METHOD_LIMIT, SETTINGS[METHOD_LIMIT])
    return df


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one where none is named, as in tests."""
    context = spark.sparkContext
    path = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = _local_dir(spark)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes `df` once to the shared folder and reads it back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/ebbtide-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> int:
    """Deletes what `staged` wrote in this process and gives the number of tables; call it when no result is still to be read."""
    hadoop, n = spark.sparkContext._jsc.hadoopConfiguration(), len(_STAGED)
    while _STAGED:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        path.getFileSystem(hadoop).delete(path, True)
    return n


def _local_dir(spark: SparkSession) -> str:
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if spark.sparkContext.getCheckpointDir():
        return spark.sparkContext.getCheckpointDir()
    return tempfile.mkdtemp(prefix="ebbtide-")
