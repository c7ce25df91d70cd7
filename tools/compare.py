"""Runs registered queries next to their SQL in DuckDB and compares rows, types and values.

    python tools/compare.py [--sf 0.01] [name-part ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from ebbtide.queries import ORACLES, QUERIES  # noqa: E402
from ebbtide.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SPARK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
               "boolean": "BOOLEAN", "float": "FLOAT"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return repr([_norm(x) for x in v])
    return repr(v)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str) -> tuple[str, str]:
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        return ("rows" if rows else "EMPTY"), f"{len(rows)} rows, no SQL"
    result = con.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return "FAIL", f"columns {sorted(set(names) ^ set(df.columns))}"
    wrong = {f.name: (f.dataType.simpleString(), types[f.name]) for f in df.schema
             if SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) != types[f.name]}
    got, want = _sorted_rows(df.columns, rows), _sorted_rows(names, expected)
    if len(got) != len(want):
        return "FAIL", f"{len(got)} rows, expected {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return "FAIL", f"{len(bad)} of {len(got)} rows differ, e.g.\n   got  {bad[0][0]}\n   want {bad[0][1]}"
    if not rows:
        return "EMPTY", "no rows"
    return ("TYPES", str(wrong)) if wrong else ("ok", f"{len(rows)} rows")


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("--plain", action="store_true", help="a session with Spark's own defaults")
    args.add_argument("--skip", default="", help="leave out queries whose name starts with this")
    args.add_argument("names", nargs="*")
    a = args.parse_args()
    sf_dir = f"/root/testdata/sf{a.sf}"
    if a.plain:
        spark = SparkSession.builder.master("local[8]").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    else:
        spark = build_session("compare", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8",
                                            "spark.ui.enabled": "false", "spark.driver.memory": "8g",
                                            "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in QUERIES:
        if (a.names and not any(n in name for n in a.names)) or (a.skip and name.startswith(a.skip)):
            continue
        start = time.time()
        try:
            status, note = compare(spark, con, sf_dir, name)
        except Exception as e:  # noqa: BLE001 - report and go on
            status, note = "ERROR", f"{type(e).__name__}: {str(e)[:600]}"
        bad += status not in ("ok", "rows")
        print(f"{status:6s} {time.time() - start:6.2f}s {name}: {note}", flush=True)
    print(f"{bad} not ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
