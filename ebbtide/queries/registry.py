"""Registered queries and the equivalent SQL, with the subjects they run on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.metrics import predict_at
from ..operators.splits import stress_score
from ..session import staged
from ..sources.customer_view import customer_view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


def r6(column: Column | str) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


# --- subject 1: customers derived from `customer` and `orders` ---------------------------------

def _pick_sql(index: str, *labels: str) -> str:
    return "CASE " + " ".join(f"WHEN {index} = {i} THEN '{v}'" for i, v in enumerate(labels)) + " END"


def _bit(d: int) -> str:
    return _pick_sql(f"CAST(floor(k / {d}) AS BIGINT) % 2", "No", "Yes")


def _add_on(d: int) -> str:
    return _pick_sql(f"CAST(floor(k / {d}) AS BIGINT) % 3", "No", "No internet service", "Yes")


CUST_COLUMNS = {
    "customer_id": "c_name", "gender": _pick_sql("k % 2", "Male", "Female"),
    "senior_citizen": _bit(2), "partner": _bit(4), "dependents": _bit(8),
    "tenure_months": "CAST(tenure AS INT)", "phone_service": _bit(16),
    "multiple_lines": _pick_sql("CAST(floor(k / 5) AS BIGINT) % 3", "No", "No phone service", "Yes"),
    "internet_service": _pick_sql("nk % 3", "DSL", "Fiber optic", "No"),
    "online_security": _add_on(3), "online_backup": _add_on(9), "device_protection": _add_on(27),
    "tech_support": _add_on(81), "streaming_tv": _add_on(243), "streaming_movies": _add_on(7),
    "contract": "CASE WHEN seg IN ('AUTOMOBILE', 'BUILDING') THEN 'Month-to-month' "
                "WHEN seg IN ('FURNITURE', 'HOUSEHOLD') THEN 'One year' ELSE 'Two year' END",
    "paperless_billing": _bit(32),
    "payment_method": _pick_sql("CAST(floor(nk / 3) AS BIGINT) % 4", "Electronic check", "Mailed check",
                                "Bank transfer (automatic)", "Credit card (automatic)"),
    "monthly_charges": "CAST(mc AS DOUBLE) / 100",
    "total_charges": "CASE WHEN tenure = 0 THEN NULL ELSE "
                     "CAST(mc * tenure + (k * 7919) % 2000 AS DOUBLE) / 100 END",
    "churn": "CAST(churn AS INT)",
}
VIEW = """WITH a AS (SELECT max(o_orderdate) AS anchor FROM orders),
o AS (SELECT o_custkey, max(o_orderdate) AS last_order, count(*) AS n,
      sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders GROUP BY o_custkey),
b AS (SELECT c.c_custkey AS k, c.c_name, c.c_nationkey AS nk, c.c_mktsegment AS seg,
      (c.c_custkey * 37) % 73 AS tenure, CAST(floor(o.cents / (o.n * 5000)) AS BIGINT) AS mc,
      CASE WHEN o.last_order < a.anchor - INTERVAL '365' DAY THEN 1 ELSE 0 END AS churn
      FROM customer c JOIN o ON o.o_custkey = c.c_custkey CROSS JOIN a),
cust AS (SELECT """ + ", ".join(f"{e} AS {c}" for c, e in CUST_COLUMNS.items()) + " FROM b)"
KEY_SQL = "CAST(split_part(customer_id, '#', 2) AS BIGINT)"
STRESS_SQL = ("(CASE WHEN contract = 'Month-to-month' THEN 1 ELSE 0 END"
              " + CASE WHEN internet_service = 'Fiber optic' THEN 1 ELSE 0 END"
              " + CASE WHEN payment_method = 'Electronic check' THEN 1 ELSE 0 END"
              " + CASE WHEN tenure_months <= 12 THEN 1 ELSE 0 END)")
# `sc` adds a deterministic score with many ties, a label and predictions at 0.50.
SCORED = VIEW + f""",
sc AS (SELECT *, churn AS label, {STRESS_SQL} AS stress_score,
       CAST({STRESS_SQL} * 20 + {KEY_SQL} % 20 AS DOUBLE) / 100 AS score,
       CASE WHEN CAST({STRESS_SQL} * 20 + {KEY_SQL} % 20 AS DOUBLE) / 100 >= 0.5 THEN 1 ELSE 0 END AS pred
       FROM cust)"""

customers = customer_view


def customer_key() -> Column:
    return F.substring_index("customer_id", "#", -1).cast("long")


def scored_customers(spark: SparkSession, d: str) -> DataFrame:
    score = (stress_score() * 20 + customer_key() % 20).cast("double") / 100
    return (customer_view(spark, d).withColumn("label", F.col("churn"))
            .withColumn("stress_score", stress_score()).withColumn("score", score)
            .withColumn("pred", predict_at(F.col("score"))))


# --- subject 2: labelled documents -------------------------------------------------------------

DOCS = """WITH sc AS (SELECT d.doc_id, d.lang, d.source, l.quality AS label,
      CAST(least(d.n_chars, 4000) AS DOUBLE) / 4000 AS score,
      CASE WHEN CAST(least(d.n_chars, 4000) AS DOUBLE) / 4000 >= 0.5 THEN 1 ELSE 0 END AS pred
      FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""


def scored_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang", "source", "n_chars")
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    score = F.least(F.col("n_chars"), F.lit(4000)).cast("double") / 4000
    return (docs.join(labels, "doc_id").withColumn("score", score)
            .withColumn("pred", predict_at(F.col("score"))))


# --- subject 3: events, first against second half of their time range ---------------------------

EVENTS = """WITH mid AS (SELECT TIMESTAMP '2024-01-16 00:00:00' AS t),
ref AS (SELECT value, event_type FROM events, mid WHERE ts < t),
cur AS (SELECT value, event_type FROM events, mid WHERE ts >= t)"""


def event_halves(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    events = spark.read.parquet(f"{d}/events.parquet").select("ts", "value", "event_type")
    middle = F.expr("TIMESTAMP_NTZ '2024-01-16 00:00:00'")
    return (events.where(F.col("ts") < middle).drop("ts"), events.where(F.col("ts") >= middle).drop("ts"))


# --- batches of the customers, sized by their number --------------------------------------------

BATCH_BASE = 15_000
SIZES = {"q4": 250, "q3": 250, "q2": 300, "stress": 800, "current": 943}


def batch_sizes(df: DataFrame) -> dict[str, int]:
    n = df.count()
    return {k: int(n * v / BATCH_BASE + 0.5) for k, v in SIZES.items()}


def _size(name: str) -> str:
    return f"CAST(floor(n * CAST({SIZES[name]} AS DOUBLE) / {BATCH_BASE} + 0.5) AS BIGINT)"


ORDER_SQL = ("stress_score DESC, monthly_charges DESC NULLS LAST, tenure_months ASC NULLS LAST, "
             "md5(concat_ws('|', customer_id, '42')), customer_id")
QUOTA_SQL = (f"CASE stress_score WHEN 4 THEN {_size('q4')} WHEN 3 THEN {_size('q3')} "
             f"WHEN 2 THEN {_size('q2')} ELSE 0 END")
# `stress` holds the stress batch, `rest` the other customers.
STRESS = VIEW + f""",
n AS (SELECT count(*) AS n FROM cust),
ss AS (SELECT *, {STRESS_SQL} AS stress_score FROM cust),
rk AS (SELECT ss.*, n.n, row_number() OVER (PARTITION BY stress_score ORDER BY {ORDER_SQL}) AS rn FROM ss, n),
qt AS (SELECT *, CASE WHEN rn <= {QUOTA_SQL} THEN 0 ELSE 1 END AS spare FROM rk),
fl AS (SELECT *, row_number() OVER (ORDER BY spare, {ORDER_SQL}) AS pos FROM qt),
stress AS (SELECT * FROM fl WHERE spare = 0 OR pos <= {_size('stress')}),
rest AS (SELECT * FROM fl WHERE NOT (spare = 0 OR pos <= {_size('stress')}))"""


def sample_ctes(name: str, source: str, stratum: str, total: str, key: str = "customer_id",
                columns: str = "*") -> str:
    """CTEs ending in `<name>`: the source rows with `taken` (exact stratified sample)."""
    p = name
    return f"""
{p}_s AS (SELECT {columns}, {stratum} AS stratum, md5(concat_ws('|', CAST({key} AS VARCHAR), '42')) AS h FROM {source}),
{p}_c AS (SELECT stratum, count(*) AS n_s FROM {p}_s GROUP BY stratum),
{p}_t AS (SELECT CAST(sum(n_s) AS BIGINT) AS all_rows, {total} AS want FROM {p}_c),
{p}_q AS (SELECT stratum, (want * n_s) // all_rows AS base, (want * n_s) % all_rows AS rem, want FROM {p}_c, {p}_t),
{p}_r AS (SELECT stratum, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, stratum)
          <= want - sum(base) OVER () THEN 1 ELSE 0 END AS take FROM {p}_q),
{name} AS (SELECT s.*, row_number() OVER (PARTITION BY s.stratum ORDER BY h, {key}) <= r.take AS taken
          FROM {p}_s s JOIN {p}_r r ON r.stratum = s.stratum)"""


STRATUM_SQL = "concat_ws('__', CAST(churn AS VARCHAR), contract, internet_service)"
# `split` tags every customer with its batch.
SPLIT = STRESS + "," + sample_ctes("cs", "rest", STRATUM_SQL,
                                   "(SELECT " + _size("current") + " FROM n)") + """,
split AS (SELECT """ + ", ".join(CUST_COLUMNS) + """, 'stress' AS batch FROM stress
          UNION ALL SELECT """ + ", ".join(CUST_COLUMNS) + """,
          CASE WHEN taken THEN 'current' ELSE 'train' END AS batch FROM cs)"""


def split_customers(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.splits import three_way_split
    df = staged(customer_view(spark, d), "customers")  # the split reads it in every step of its cuts
    s = batch_sizes(df)
    return three_way_split(df, {4: s["q4"], 3: s["q3"], 2: s["q2"]}, s["stress"], s["current"])
