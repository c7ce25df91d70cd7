"""Run, version and provenance tables, filled from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.bounded import Settled
from ..operators import runs as g
from ..operators.metrics import confusion, costs, rates
from ..session import shared_dir
from ..sources.tables import write_table
from .metrics_sql import RATES_SQL, confusion_sql
from .registry import SCORED, VIEW, customers, query, scored_customers

# Events as a version log: 40 versions of 7 models.
_STAGE = ("CASE event_type WHEN 'signup' THEN 'registered' WHEN 'view' THEN 'registered' "
          "WHEN 'purchase' THEN 'production' ELSE 'staging' END")
_EVENTS = (f"SELECT concat('m', CAST(user_id % 7 AS {{s}})) AS model, CAST(user_id % 40 AS INT) AS version, "
           f"event_id AS seq, {_STAGE} AS stage, md5(CAST(user_id AS {{s}})) AS run_id, "
           "1704067200000 + event_id * 61000 AS created_ms FROM events")
_VERSIONS = "WITH ev AS (" + _EVENTS.format(s="VARCHAR") + """),
la AS (SELECT model, version, arg_max(stage, seq) AS stage, max(seq) AS seq, arg_min(run_id, seq) AS run_id,
    arg_min(created_ms, seq) AS created_ms FROM ev GROUP BY model, version),
li AS (SELECT model, max(seq) AS live FROM ev WHERE stage = 'production' GROUP BY model),
ve AS (SELECT la.model, version, CASE WHEN stage = 'production' AND seq < live THEN 'archived'
    WHEN stage = 'registered' THEN 'none' ELSE stage END AS stage, run_id, created_ms
    FROM la LEFT JOIN li ON li.model = la.model)"""


def version_events(spark, d):
    spark.read.parquet(f"{d}/events.parquet").createOrReplaceTempView("version_source")
    return spark.sql(_EVENTS.format(s="STRING").replace("FROM events", "FROM version_source"))


@query("g01_append_runs", VIEW + """, c AS (SELECT contract, count(*) AS n, sum(churn) AS p FROM cust GROUP BY contract)
    SELECT 'contracts' AS experiment, contract AS run_name, 'metric' AS kind, 'rows' AS "key", CAST(n AS VARCHAR) AS value FROM c
    UNION ALL SELECT 'contracts', contract, 'metric', 'churners', CAST(p AS VARCHAR) FROM c
    UNION ALL SELECT 'contracts', contract, 'param', 'seed', '42' FROM c""")
def _(spark, d):
    path = f"{shared_dir(spark)}/runs-{uuid.uuid4().hex}"
    counts = customers(spark, d).groupBy("contract").agg(F.count("*").alias("n"), F.sum("churn").alias("p"))
    for r in Settled(counts).listed():      # one run per contract type
        g.log_run(spark, path, "contracts", uuid.uuid4().hex, r["contract"], {"seed": 42},
                  {"rows": r["n"], "churners": r["p"]})
    return spark.read.schema(g.RUN_SCHEMA).parquet(path).select("experiment", "run_name", "kind", "key", "value")


@query("g02_version_stages", _VERSIONS + " SELECT model, version, stage, run_id, created_ms FROM ve")
def _(spark, d):
    return g.current_versions(version_events(spark, d))


@query("g03_version_listing", _VERSIONS + """ SELECT model, version, stage, substr(run_id, 1, 12) AS run_id,
    strftime(make_timestamp(created_ms * 1000), '%Y-%m-%d %H:%M') AS created FROM ve""")
def _(spark, d):
    return g.list_versions(g.current_versions(version_events(spark, d)))


@query("w06_production_version", _VERSIONS + """ SELECT model, max(version) AS version, arg_max(run_id, version) AS run_id
    FROM ve WHERE stage = 'production' GROUP BY model""")
def _(spark, d):
    return g.production_version(g.current_versions(version_events(spark, d)))


_RUNS = SCORED + ", c AS (" + confusion_sql("sc", by="contract, payment_method") + f""")
    SELECT contract AS experiment, payment_method AS run_name,
    substr(md5(contract || '|' || payment_method), 1, 12) AS run_id, {RATES_SQL['f1']} AS f1,
    {RATES_SQL['recall']} AS recall, {RATES_SQL['precision']} AS precision, CAST(0 AS DOUBLE) AS auc_roc,
    fn AS missed, fn * 1500 + fp * 50 AS cost, 'LightGBM' AS model,
    strftime(make_timestamp((1704067200000 + (tn + fp + fn + tp) * 60000) * 1000), '%Y-%m-%d %H:%M') AS time FROM c"""


def run_rows(spark, d):
    """Long run rows: one run per contract and payment method, without AUC and model."""
    counts = confusion(scored_customers(spark, d), by=["contract", "payment_method"])
    shown = {**{k: rates()[k] for k in ("f1", "recall", "precision")},
             "missed_churners": F.col("fn"), "total_business_cost": costs()["total_business_cost"]}
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in shown.items()])
    return counts.select(
        F.col("contract").alias("experiment"), F.md5(F.concat_ws("|", "contract", "payment_method")).alias("run_id"),
        F.col("payment_method").alias("run_name"), (F.lit(1704067200000) + n * 60000).alias("start_ms"),
        F.lit("metric").alias("kind"), F.inline(entries))


for _name in ("g04_run_listing", "w07_newest_runs"):
    @query(_name, _RUNS)
    def _(spark, d):
        return g.list_runs(g.wide_runs(run_rows(spark, d)))


@query("g05_file_checksum")
def _(spark, d):
    path = f"{shared_dir(spark)}/files-{uuid.uuid4().hex}"
    write_table(customers(spark, d), path, "csv")
    return g.file_checksums(spark, path)


@query("g05_text_checksum", "SELECT doc_id, substr(sha256(text), 1, 16) AS checksum FROM documents")
def _(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet")
    return docs.select("doc_id", g.checksum(F.col("text")).alias("checksum"))


@query("g06_table_fingerprint")
def _(spark, d):
    return g.table_fingerprint(spark.read.parquet(f"{d}/lineitem.parquet"))


@query("g07_lineage_record")
def _(spark, d):
    path = f"{shared_dir(spark)}/lineage-{uuid.uuid4().hex}"
    df = customers(spark, d)
    g.record_lineage(spark, path, "model", "churned", g.fingerprint(df.where("churn = 1")),
                     "kept", g.fingerprint(df.where("churn = 0")), "run-1", {"git_commit": "none"},
                     {"threshold": 0.2})
    return spark.read.json(path)
