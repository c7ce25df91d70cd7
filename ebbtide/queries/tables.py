"""Sources, sinks, projections, predicates and row validation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..functions.bounded import Settled
from ..functions.columns import flag
from ..operators import quality
from ..operators.features import fit_features
from ..operators.lookup import batch_summary
from ..operators.metrics import predict_at
from ..operators.splits import stress_score
from ..session import shared_dir
from ..sources import tables as t
from ..sources.artefacts import load_artefact, save_artefact
from ..sources.schema import CANONICAL, RAW_HEADINGS
from .registry import (CUST_COLUMNS, SCORED, SPLIT, STRESS_SQL, VIEW, batch_sizes,
                       customers, query, r6, scored_customers, split_customers)

ALL_CUST = VIEW + " SELECT * FROM cust"


def _scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("io01_csv_scan", ALL_CUST)
def _(spark, d):
    path = _scratch(spark, "csv")
    t.write_table(customers(spark, d), path, "csv")
    return t.read_customers(spark, path, "csv")


@query("io02_canonicalise", ALL_CUST)
def _(spark, d):
    raw = customers(spark, d).withColumnsRenamed({v: k for k, v in RAW_HEADINGS.items()})
    return t.canonicalise(raw.withColumn("Extra", F.lit(1)))


@query("io03_named_batch", SPLIT + " SELECT customer_id, churn FROM split WHERE batch = 'stress'")
def _(spark, d):
    return t.named_batch(split_customers(spark, d), "stress").select("customer_id", "churn")


_BATCHES = (SPLIT + " SELECT batch, count(*) AS n_rows, round(CAST(sum(churn) AS DOUBLE) / count(*), 6)"
            " AS churn_rate FROM split GROUP BY batch")


@query("io04_ensure_splits", _BATCHES)
def _(spark, d):
    df, path = customers(spark, d), _scratch(spark, "splits")
    s = batch_sizes(df)
    options = dict(quotas={4: s["q4"], 3: s["q3"], 2: s["q2"]}, stress_size=s["stress"],
                   current_size=s["current"])
    t.ensure_splits(spark, path, df, **options)
    stored = t.ensure_splits(spark, path, df, **options)
    return batch_summary(stored).withColumn("churn_rate", r6("churn_rate"))


@query("io05_table_sink", ALL_CUST)
def _(spark, d):
    path = _scratch(spark, "table")
    t.write_table(customers(spark, d), path)
    return spark.read.parquet(path)


_MEDIANS = {"tenure_months": "tenure_months", "monthly_charges": "monthly_charges",
            "total_charges": "total_charges"}


@query("io06_parameter_round_trip", VIEW + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(CAST(median({e}) AS DOUBLE), 6) AS median FROM cust"
    for c, e in _MEDIANS.items()))
def _(spark, d):
    path = _scratch(spark, "params")
    save_artefact(spark, path, "features", fit_features(customers(spark, d)).to_dict())
    medians = load_artefact(spark, path, "features")["medians"]
    return spark.createDataFrame([(c, round(medians[c], 6)) for c in _MEDIANS],
                                 "feature string, median double")


@query("io07_from_records", VIEW + " SELECT contract, count(*) AS n FROM cust GROUP BY contract")
def _(spark, d):
    rows = Settled(customers(spark, d).groupBy("contract").agg(F.count("*").alias("n"))).listed()
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("contract", T.StringType()), T.StructField("n", T.LongType())])
    return t.from_records(spark, rows, schema)


@query("c01_rename", 'SELECT c_custkey AS customer_key, c_name AS customer_id FROM customer')
def _(spark, d):
    df = spark.read.parquet(f"{d}/customer.parquet")
    return t.rename(df, {"c_custkey": "customer_key", "c_name": "customer_id", "absent": "x"}).select(
        "customer_key", "customer_id")


@query("c02_ordered_projection", VIEW + " SELECT churn, customer_id, contract FROM cust")
def _(spark, d):
    return t.project_present(customers(spark, d), ["churn", "absent", "customer_id", "contract"])


@query("c02_projection_with_fill", VIEW + " SELECT customer_id, 0 AS absent, contract FROM cust")
def _(spark, d):
    return t.project_present(customers(spark, d), ["customer_id", "absent", "contract"], fill=0)


_TEXT = (f"CASE {{k}} % 5 WHEN 0 THEN ' ' WHEN 1 THEN 'n/a ' || {{k}} "
         f"WHEN 2 THEN ' ' || {{k}} || '.50 ' ELSE CAST({{k}} AS STRING) END")


@query("c03_lossy_number", "SELECT c_custkey, TRY_CAST(trim(" + _TEXT.format(k="c_custkey").replace(
    "STRING", "VARCHAR") + ") AS DOUBLE) AS value FROM customer")
def _(spark, d):
    df = spark.read.parquet(f"{d}/customer.parquet")
    return df.select("c_custkey", F.expr(_TEXT.format(k="c_custkey")).alias("value")).transform(
        lambda x: t.coerce_numbers(x, ["value"]))


@query("c04_strict_integer", VIEW + " SELECT customer_id, churn FROM cust")
def _(spark, d):
    return customers(spark, d).select("customer_id", F.col("churn").cast("string").alias("churn")).select(
        "customer_id", t.strict_int("churn").alias("churn"))


@query("c05_drop_column", VIEW + " SELECT " + ", ".join(c for c in CUST_COLUMNS if c != "churn") + " FROM cust")
def _(spark, d):
    return customers(spark, d).drop("churn")


@query("c06_drop_null_rows", VIEW + " SELECT customer_id, total_charges FROM cust WHERE total_charges IS NOT NULL")
def _(spark, d):
    return t.drop_null_rows(customers(spark, d)).select("customer_id", "total_charges")


@query("c07_predicate_flag", VIEW + """ SELECT customer_id,
    CASE WHEN total_charges > 1000 THEN 1 ELSE 0 END AS big FROM cust""")
def _(spark, d):
    return customers(spark, d).select("customer_id", flag(F.col("total_charges") > 1000).alias("big"))


@query("c08_membership_flag", VIEW + """ SELECT customer_id, CASE WHEN payment_method IN
    ('Bank transfer (automatic)', 'Credit card (automatic)') THEN 1 ELSE 0 END AS auto FROM cust""")
def _(spark, d):
    auto = F.col("payment_method").isin("Bank transfer (automatic)", "Credit card (automatic)")
    return customers(spark, d).select("customer_id", flag(auto).alias("auto"))


@query("c09_row_filter", VIEW + f" SELECT customer_id FROM cust WHERE {STRESS_SQL} = 3")
def _(spark, d):
    return customers(spark, d).where(stress_score() == 3).select("customer_id")


@query("c10_text_columns", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def _(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    return orders.groupBy(*t.text_columns(orders)).agg(F.count("*").alias("n"))


@query("c11_threshold", SCORED + """ SELECT customer_id,
    CASE WHEN score >= 0.2 THEN 1 ELSE 0 END AS churn_prediction FROM sc""")
def _(spark, d):
    return scored_customers(spark, d).select(
        "customer_id", predict_at(F.col("score"), 0.2).alias("churn_prediction"))


# --- row validation on customers with single fields overridden --------------------------------------

_SPOIL = {
    "gender": ("97", "'Unknown'", "gender"), "partner": ("71", "NULL", "partner"),
    "tenure_months": ("89", "-1", "tenure_months"), "contract": ("83", "'Three year'", "contract"),
    "total_charges": ("79", "NULL", "total_charges"), "churn": ("73", "2", "churn"),
    "monthly_charges": ("61", "'abc'", "CASE WHEN {k} % 67 = 0 THEN '250.5' ELSE CAST(monthly_charges AS {s}) END"),
}


def _spoil(column: str, key: str, text: str) -> str:
    if column not in _SPOIL:
        return column
    every, bad, good = _SPOIL[column]
    return f"CASE WHEN {key} % {every} = 0 THEN {bad} ELSE {good.format(k=key, s=text)} END AS {column}"


BAD = VIEW + ", bad AS (SELECT " + ", ".join(
    _spoil(c, "CAST(split_part(customer_id, '#', 2) AS BIGINT)", "VARCHAR") for c in CUST_COLUMNS) + " FROM cust)"


def spoiled(spark, d) -> DataFrame:
    return customers(spark, d).selectExpr(
        *[_spoil(c, "CAST(substring_index(customer_id, '#', -1) AS BIGINT)", "STRING") for c in CUST_COLUMNS])


def _rule_sql(rule: quality.Rule) -> str:
    c = rule.column
    typed = f"TRY_CAST({c} AS DOUBLE)" if c in ("monthly_charges", "total_charges") else c
    if rule.check == "type":
        return f"{c} IS NOT NULL AND {typed} IS NULL"
    if rule.check == "not_null":
        return f"{c} IS NULL"
    if rule.check == "allowed":
        return f"{c} NOT IN (" + ", ".join(repr(v) for v in rule.argument) + ")"
    return f"NOT ({typed} BETWEEN {rule.argument[0]} AND {rule.argument[1]})"


def _violations_sql(profile: quality.Profile, checks=None) -> str:
    return " UNION ALL ".join(
        f"SELECT customer_id, '{r.column}' AS \"column\", '{r.check}' AS \"check\", "
        f"CAST({r.column} AS VARCHAR) AS value FROM bad WHERE {_rule_sql(r)}"
        for r in profile.rules() if checks is None or r.check in checks)


def _report_sql(profile: quality.Profile) -> str:
    return " UNION ALL ".join(
        f"SELECT '{r.name}' AS rule, count(*) FILTER (WHERE {_rule_sql(r)}) AS n_violations, "
        "count(*) AS n_rows FROM bad" for r in profile.rules())


@query("v01_required_columns", VIEW + " SELECT c.col AS column_name, c.col <> 'churn' AS present, "
       "(SELECT count(*) FROM cust) AS n_rows FROM (VALUES " + ", ".join(f"('{c}')" for c in CANONICAL) + ") AS c(col)")
def _(spark, d):
    df = customers(spark, d).drop("churn").withColumn("extra", F.lit(1))
    try:
        quality.require_columns(df)
        missing = set()
    except quality.ValidationError as e:
        missing = {k.split(".")[0] for k in e.violations}
    listed = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(c not in missing).alias("present"))
                       for c in CANONICAL])
    return df.agg(F.count("*").alias("n_rows")).select(F.inline(listed), "n_rows")


@query("v02_type_coercion", BAD + """ SELECT customer_id, TRY_CAST(monthly_charges AS DOUBLE) AS monthly_charges,
    tenure_months FROM bad""")
def _(spark, d):
    return quality.coerce(spoiled(spark, d)).select("customer_id", "monthly_charges", "tenure_months")


for _name, _checks in (("v03_not_null", ("not_null",)), ("v04_allowed_set", ("allowed",)),
                       ("v05_range", ("range",))):
    @query(_name, BAD + " " + _violations_sql(quality.CUSTOMER, _checks))
    def _(spark, d, checks=_checks):
        return quality.violations(spoiled(spark, d)).where(F.col("check").isin(*checks))


@query("v06_fail_fast", VIEW + " SELECT count(*) AS n_valid FROM cust")
def _(spark, d):
    return quality.validate(customers(spark, d), "customers").agg(F.count("*").alias("n_valid"))


@query("v06_fail_fast_on_bad_rows", BAD + " SELECT * FROM (" + _report_sql(quality.CUSTOMER)
       + ") WHERE n_violations > 0")
def _(spark, d):
    df = spoiled(spark, d)
    try:
        quality.validate(df)
        found = {}
    except quality.ValidationError as e:
        found = e.violations
    listed = F.array(*[F.struct(F.lit(k).alias("rule"), F.lit(v).cast("long").alias("n_violations"))
                       for k, v in found.items()])
    return df.agg(F.count("*").alias("n_rows")).select(F.inline(listed), "n_rows")


@query("v07_all_violations", BAD + " " + _violations_sql(quality.INFERENCE))
def _(spark, d):
    return quality.violations(spoiled(spark, d).drop("churn"), quality.INFERENCE)


@query("v07_quarantine", BAD + " SELECT customer_id, count(*) AS n_violations FROM ("
       + _violations_sql(quality.CUSTOMER) + ") GROUP BY customer_id")
def _(spark, d):
    _, rejected = quality.quarantine(spoiled(spark, d))
    return rejected.select("customer_id", F.col("n_violations").cast("long").alias("n_violations"))


@query("v08_request_contract", BAD + " " + _violations_sql(quality.REQUEST))
def _(spark, d):
    return quality.violations(spoiled(spark, d), quality.REQUEST)


@query("v09_rule_report", BAD + " " + _report_sql(quality.CUSTOMER))
def _(spark, d):
    return quality.rule_report(spoiled(spark, d))
