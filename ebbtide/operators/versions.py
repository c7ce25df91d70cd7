"""The version log: numbered commits that many writers add to, each created only if its number is free.

A commit is a small JSON file of events (registered, staging, production). A writer reads the log, decides on its version
and events, and creates the file with the next number; if another writer was first, it reads again and retries. So no
number and no version is given twice, and a reader never sees half a commit. Every FOLD commits, a snapshot keeps the
events that the stages still follow from, and readers start there.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.bounded import Settled

EVENT_SCHEMA = "model string, version int, seq bigint, stage string, run_id string, created_ms bigint"
STAGES = ("registered", "staging", "production")
FOLD, ATTEMPTS, EVENTS_A_COMMIT = 20, 200, 1000
_COMMIT, _SNAPSHOT = re.compile(r"(\d{20})\.json"), re.compile(r"snapshot-(\d{20})\.json")


def now_ms() -> int:
    return int(datetime.now(timezone.utc).timestamp() * 1000)


class Folder:
    """The files of one log, through the file system that Spark has for its path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.jvm = spark, spark._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        raw = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = raw.getFileSystem(self.conf)
        self.path = self.fs.makeQualified(raw)

    def names(self) -> list[str]:
        if not self.fs.exists(self.path):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.path)]

    def file(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.path, name)

    def create(self, name: str, text: str) -> bool:
        """Writes the file whole, or not at all where the name is taken."""
        hidden, target = self.file(f".{uuid.uuid4().hex}"), self.file(name)
        self.fs.mkdirs(self.path)
        out = self.fs.create(hidden)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self.fs.getScheme() == "file":  # its rename replaces; a link to a taken name fails
                files, at = self.jvm.java.nio.file.Files, lambda p: self.jvm.java.io.File(p.toUri().getPath()).toPath()
                files.createLink(at(target), at(hidden))
            else:
                options = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
                none = self.spark.sparkContext._gateway.new_array(options, 1)
                none[0] = options.valueOf("NONE")
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path.toUri(), self.conf).rename(hidden, target, none)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
            return False
        finally:
            self.fs.delete(hidden, False)


def _listed(folder: Folder) -> tuple[int, list[str]]:
    """(the last commit's number, 0 without any; files that hold the log's events)."""
    names = [n for n in folder.names() if not n.startswith(".")]
    commits = {int(m[1]): n for n in names if (m := _COMMIT.fullmatch(n))}
    snapshots = {int(m[1]): n for n in names if (m := _SNAPSHOT.fullmatch(n))}
    other = sorted(set(names) - set(commits.values()) - set(snapshots.values()))
    if other:  # a damaged log must not start anew
        raise ValueError(f"cannot read a version log with other files in it: {', '.join(other[:3])}")
    start, last = max(snapshots, default=0), max(commits, default=0)
    missing = set(range(start + 1, last + 1)) - set(commits)
    if missing:
        raise ValueError(f"cannot read a version log without its commit {min(missing)}")
    return max(start, last), ([snapshots[start]] if start else []) + [commits[n] for n in sorted(commits) if n > start]


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, Folder(spark, path))[1]


def _read(spark: SparkSession, folder: Folder) -> tuple[int, DataFrame]:
    last, names = _listed(folder)
    if not names:
        return last, spark.createDataFrame([], EVENT_SCHEMA)
    return last, spark.read.schema(EVENT_SCHEMA).option("mode", "FAILFAST").json([folder.file(n).toString() for n in names])


def live_events(events: DataFrame) -> DataFrame:
    """The events that stages, runs and times of all versions follow from: each version's first and last, each model's last production."""
    version, model = Window.partitionBy("model", "version"), Window.partitionBy("model")
    live = F.max(F.when(F.col("stage") == "production", F.col("seq"))).over(model)
    kept = (F.col("seq") == F.min("seq").over(version)) | (F.col("seq") == F.max("seq").over(version)) | (F.col("seq") == live)
    return events.withColumn("_kept", F.coalesce(kept, F.lit(False))).where("_kept").drop("_kept")


def append_events(spark: SparkSession, path: str, model: str, version: int | None, stages: Sequence[str],
                  run_id: str | None = None) -> int:
    """Adds stages of one version in one commit and gives the version; without one, it is the model's next.

    Any number of writers may do so at once.
    """
    if not 0 < len(stages) < EVENTS_A_COMMIT:
        raise ValueError("a commit holds one to 999 stages")
    folder = Folder(spark, path)
    for _ in range(ATTEMPTS):
        last, events = _read(spark, folder)
        taken = version
        if taken is None:
            taken = events.where(F.col("model") == model).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0] + 1
        n = last + 1
        rows = [{"model": model, "version": taken, "seq": n * EVENTS_A_COMMIT + i, "stage": s, "run_id": run_id, "created_ms": now_ms()}
                for i, s in enumerate(stages)]
        if folder.create(f"{n:020}.json", "".join(json.dumps(r) + "\n" for r in rows)):
            if n % FOLD == 0:
                _fold(spark, folder, n)
            return taken
    raise RuntimeError(f"no free commit in {ATTEMPTS} attempts")


def _fold(spark: SparkSession, folder: Folder, n: int) -> None:
    """A snapshot of commits up to n; any writer may be the one that makes it."""
    events = _read(spark, folder)[1].where(F.col("seq") < (n + 1) * EVENTS_A_COMMIT)
    rows = Settled(live_events(events)).listed()  # at most three events a version
    folder.create(f"snapshot-{n:020}.json", "".join(json.dumps(r) + "\n" for r in rows))


def register_and_promote(spark: SparkSession, path: str, model: str, run_id: str) -> int:
    """Next version of the model, taken through staging to production."""
    return append_events(spark, path, model, None, STAGES, run_id)
