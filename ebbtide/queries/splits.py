"""Splitting, sampling, lookups, unions and plain aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import NUMERIC
from ..functions.columns import stratum
from ..operators import lookup, sampling, splits
from ..operators.features import encode_binary, impute
from ..operators.heads import head_per_group
from ..operators.metrics import predict_at, tuning_gain
from ..operators.models import class_balance
from ..operators.ordered import exact_medians
from .registry import (DOCS, ORDER_SQL, QUOTA_SQL, SCORED, SPLIT, STRATUM_SQL, STRESS, STRESS_SQL, VIEW,
                       _size, batch_sizes, customers, query, r6, sample_ctes, scored_customers,
                       scored_documents, split_customers)


def _quotas(df):
    s = batch_sizes(df)
    return {4: s["q4"], 3: s["q3"], 2: s["q2"]}, s


@query("s01_stress_score", VIEW + f" SELECT customer_id, {STRESS_SQL} AS stress_score FROM cust")
def _(spark, d):
    return customers(spark, d).select("customer_id", splits.stress_score().alias("stress_score"))


@query("s02_stress_ranking", VIEW + f""" SELECT customer_id, {STRESS_SQL} AS stress_score, monthly_charges,
    tenure_months FROM cust""")
def _(spark, d):
    return splits.rank_stress(customers(spark, d)).select(
        "customer_id", "stress_score", "monthly_charges", "tenure_months")


@query("s03_quota_top_k", STRESS + " SELECT customer_id, stress_score FROM qt WHERE spare = 0")
def _(spark, d):
    df = customers(spark, d)
    quotas, _ = _quotas(df)
    scored = df.withColumn("stress_score", splits.stress_score())
    return head_per_group(scored, "stress_score", quotas, splits.stress_order()).select("customer_id", "stress_score")


@query("s04_shortfall_backfill", STRESS + " SELECT customer_id, stress_score FROM stress")
def _(spark, d):
    df = customers(spark, d)
    quotas, s = _quotas(df)
    return splits.stress_batch(df, quotas, s["stress"]).select("customer_id", "stress_score")


@query("s05_stratum_key", VIEW + f" SELECT {STRATUM_SQL} AS stratum, count(*) AS n FROM cust GROUP BY 1")
def _(spark, d):
    return customers(spark, d).groupBy(stratum(splits.STRATA).alias("stratum")).agg(F.count("*").alias("n"))


@query("s06_exact_stratified_size", VIEW + ", n AS (SELECT count(*) AS n FROM cust)," + sample_ctes(
    "cs", "cust", STRATUM_SQL, "(SELECT " + _size("current") + " FROM n)")
    + " SELECT customer_id, taken FROM cs")
def _(spark, d):
    df = customers(spark, d)
    return sampling.mark_sample(df, "taken", strata=splits.STRATA, size=batch_sizes(df)["current"]).select(
        "customer_id", "taken")


def _share(x: float, rounding: str = "ceil") -> str:
    return f"CAST({rounding}(sum(n_s) * CAST({x} AS DOUBLE)) AS BIGINT)"


@query("s07_stratified_share", VIEW + "," + sample_ctes("cs", "cust", "CAST(churn AS VARCHAR)", _share(0.2))
       + " SELECT customer_id, churn, taken AS holdout FROM cs")
def _(spark, d):
    return splits.holdout_split(customers(spark, d), 0.2).select("customer_id", "churn", "holdout")


@query("s07_stratified_share_of_documents", DOCS + "," + sample_ctes(
    "cs", "sc", "lang", _share(0.3), key="doc_id") + " SELECT doc_id, lang, taken AS holdout FROM cs")
def _(spark, d):
    return splits.holdout_split(scored_documents(spark, d), 0.3, ["lang"], key="doc_id").select(
        "doc_id", "lang", "holdout")


@query("s07_stratified_share_of_lineitems", "WITH li AS (SELECT l_orderkey, l_linenumber, l_returnflag, "
       "CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS line FROM lineitem),"
       + sample_ctes("cs", "li", "l_returnflag", _share(0.2), key="line")
       + " SELECT l_returnflag, taken AS holdout, count(*) AS n, sum(l_orderkey)::BIGINT AS key_sum"
         " FROM cs GROUP BY 1, 2")
def _(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_returnflag")
    marked = sampling.mark_sample(lines, "holdout", strata=["l_returnflag"], share=0.2,
                                  key=["l_orderkey", "l_linenumber"])
    return marked.groupBy("l_returnflag", "holdout").agg(
        F.count("*").alias("n"), F.sum("l_orderkey").alias("key_sum"))


@query("s08_three_way_split", SPLIT + " SELECT customer_id, batch FROM split")
def _(spark, d):
    return split_customers(spark, d).select("customer_id", "batch")


@query("s09_unstratified_split", VIEW + "," + sample_ctes("cs", "cust", "''", _share(0.2))
       + " SELECT customer_id, taken AS holdout FROM cs")
def _(spark, d):
    return splits.holdout_split(customers(spark, d), 0.2, []).select("customer_id", "holdout")


@query("s10_exact_sample", VIEW + "," + sample_ctes("cs", "cust", "''", _share(0.5, "floor"))
       + " SELECT customer_id FROM cs WHERE taken")
def _(spark, d):
    return splits.sample_share(customers(spark, d)).select("customer_id")


_THIRD = repr(1.0 / 3)


@query("s11_stratified_folds", VIEW + "," + sample_ctes("f0", "cust", "CAST(churn AS VARCHAR)", _share(_THIRD))
       + ", r0 AS (SELECT customer_id, churn FROM f0 WHERE NOT taken),"
       + sample_ctes("f1", "r0", "CAST(churn AS VARCHAR)", _share(0.5))
       + """ SELECT customer_id, 0 AS fold FROM f0 WHERE taken
       UNION ALL SELECT customer_id, CASE WHEN taken THEN 1 ELSE 2 END FROM f1""")
def _(spark, d):
    return sampling.assign_folds(customers(spark, d)).select("customer_id", "fold")


@query("j01_anti_selection", STRESS + " SELECT customer_id FROM rest")
def _(spark, d):
    df = customers(spark, d)
    quotas, s = _quotas(df)
    return lookup.without(df, splits.stress_batch(df, quotas, s["stress"])).select("customer_id")


@query("j02_key_alignment", SCORED + " SELECT customer_id, label, score FROM sc")
def _(spark, d):
    df = scored_customers(spark, d)
    return lookup.align_by_key(df.select("customer_id", "label"), df.select("customer_id", "score"))


_GROUP = SCORED + """, g AS (SELECT contract AS model, t, sum(CASE WHEN label = 1 AND score >= t THEN 1 ELSE 0 END) AS tp,
    sum(CASE WHEN label = 0 AND score >= t THEN 1 ELSE 0 END) AS fp,
    sum(CASE WHEN label = 1 AND score < t THEN 1 ELSE 0 END) AS fn
    FROM sc, (VALUES (CAST(0.5 AS DOUBLE)), (CAST(0.2 AS DOUBLE))) AS th(t) GROUP BY ALL),
f AS (SELECT model, t, CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) AS f1 FROM g)"""


@query("j03_default_vs_tuned", _GROUP + """ SELECT d.model, round(d.f1, 6) AS default_f1, round(u.f1, 6) AS tuned_f1,
    round(u.f1 - d.f1, 6) AS improvement, u.f1 = max(u.f1) OVER () AS is_production
    FROM f d JOIN f u ON u.model = d.model AND d.t = 0.5 AND u.t = 0.2""")
def _(spark, d):
    from ..operators.metrics import confusion, rates
    df = scored_customers(spark, d)

    def f1_at(t):
        return confusion(df.withColumn("pred", predict_at(F.col("score"), t)), by=["contract"]).select(
            F.col("contract").alias("model"), rates()["f1"].alias("f1"))
    gain = tuning_gain(f1_at(0.5), f1_at(0.2))
    return gain.select("model", r6("default_f1").alias("default_f1"), r6("tuned_f1").alias("tuned_f1"),
                       r6("improvement").alias("improvement"), "is_production")


_DELTA = SPLIT + """, s AS (SELECT batch, count(*) AS n_rows, CAST(sum(churn) AS DOUBLE) / count(*) AS churn_rate
    FROM split GROUP BY batch)"""


@query("j04_delta_to_base", _DELTA + """ SELECT batch, round(churn_rate - (SELECT churn_rate FROM s
    WHERE batch = 'train'), 6) AS churn_delta FROM s""")
def _(spark, d):
    return lookup.describe_batches(split_customers(spark, d)).select("batch", r6("churn_delta").alias("churn_delta"))


@query("j05_parameter_application", VIEW + """, m AS (SELECT median(total_charges) AS m FROM cust)
    SELECT customer_id, round(coalesce(total_charges, m), 6) AS total_charges,
    CASE WHEN gender = 'Male' THEN 1 ELSE 0 END AS gender FROM cust, m""")
def _(spark, d):
    df = customers(spark, d)
    ready = encode_binary(impute(df, exact_medians(df, ["total_charges"])))
    return ready.select("customer_id", r6("total_charges").alias("total_charges"), "gender")


@query("a01_batch_summary", _DELTA + " SELECT batch, n_rows, round(churn_rate, 6) AS churn_rate FROM s")
def _(spark, d):
    return lookup.batch_summary(split_customers(spark, d)).withColumn("churn_rate", r6("churn_rate"))


@query("a01_churn_by_contract", VIEW + """ SELECT contract, count(*) AS n_rows,
    round(CAST(sum(churn) AS DOUBLE) / count(*), 6) AS churn_rate FROM cust GROUP BY contract""")
def churn_by_contract(spark, d):
    return lookup.batch_summary(customers(spark, d), ["contract"]).withColumn("churn_rate", r6("churn_rate"))


@query("a02_churn_rate_delta", _DELTA + """ SELECT batch, n_rows, round(churn_rate, 6) AS churn_rate,
    round(churn_rate - (SELECT churn_rate FROM s WHERE batch = 'train'), 6) AS churn_delta FROM s""")
def _(spark, d):
    return lookup.describe_batches(split_customers(spark, d)).select(
        "batch", "n_rows", r6("churn_rate").alias("churn_rate"), r6("churn_delta").alias("churn_delta"))


@query("a03_class_balance", VIEW + """, c AS (SELECT count(*) FILTER (WHERE churn = 0) AS n_neg,
    count(*) FILTER (WHERE churn = 1) AS n_pos FROM cust)
    SELECT n_neg, n_pos, round(CASE WHEN n_pos > 0 THEN CAST(n_neg AS DOUBLE) / n_pos * 1.5 ELSE 1.0 END, 6)
    AS scale_pos_weight FROM c""")
def _(spark, d):
    return class_balance(customers(spark, d)).withColumn("scale_pos_weight", r6("scale_pos_weight"))


@query("a04_null_presence", VIEW + " " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS n_null,
    count(*) FILTER (WHERE {c} IS NULL) > 0 AS has_null FROM cust""" for c in NUMERIC))
def _(spark, d):
    return lookup.null_counts(customers(spark, d), NUMERIC)


@query("a05_exact_median", "SELECT " + ", ".join(
    f"round(median({c}), 6) AS {c}" for c in ("l_extendedprice", "l_quantity", "l_discount")) + " FROM lineitem")
def _(spark, d):
    m = exact_medians(spark.read.parquet(f"{d}/lineitem.parquet"), ["l_extendedprice", "l_quantity", "l_discount"])
    return spark.createDataFrame([tuple(round(v, 6) for v in m.values())],
                                 "l_extendedprice double, l_quantity double, l_discount double")


@query("a06_sorted_values", VIEW + " SELECT payment_method, count(*) AS n FROM cust GROUP BY 1 ORDER BY 1")
def _(spark, d):
    return lookup.sorted_values(customers(spark, d), "payment_method")


@query("a07_prediction_summary", SCORED + """ SELECT count(*) AS n, CAST(sum(pred) AS BIGINT) AS predicted,
    round(CAST(sum(pred) AS DOUBLE) / count(*), 6) AS predicted_rate, CAST(sum(label) AS BIGINT) AS actual,
    round(CAST(sum(label) AS DOUBLE) / count(*), 6) AS actual_rate FROM sc""")
def _(spark, d):
    from ..operators.models import prediction_summary
    df = scored_customers(spark, d).withColumnRenamed("pred", "churn_prediction")
    return (prediction_summary(df).withColumn("predicted_rate", r6("predicted_rate"))
            .withColumn("actual_rate", r6("actual_rate")))


@query("a09_missed_positives", SCORED + """ SELECT count(*) FILTER (WHERE label = 1 AND pred = 0) AS missed,
    count(*) FILTER (WHERE label = 1 AND pred = 0) * 1500 AS cost FROM sc""")
def _(spark, d):
    return lookup.missed_positives(scored_customers(spark, d))


@query("w01_head_per_group", STRESS + f" SELECT customer_id, stress_score, rn <= {QUOTA_SQL} AS in_head FROM rk WHERE rn <= 5")
def _(spark, d):
    df = customers(spark, d).withColumn("stress_score", splits.stress_score())
    quotas, _ = _quotas(df)
    top = head_per_group(df, "stress_score", {i: 5 for i in range(5)}, splits.stress_order())
    head = head_per_group(df, "stress_score", quotas, splits.stress_order()).select(
        "customer_id", F.lit(True).alias("in_head"))
    return top.join(head, "customer_id", "left").select(
        "customer_id", "stress_score", F.coalesce("in_head", F.lit(False)).alias("in_head"))


@query("w02_mixed_sort", VIEW + f""" SELECT customer_id, stress_score FROM (SELECT *, {STRESS_SQL} AS stress_score FROM cust)
    ORDER BY {ORDER_SQL}""")
def _(spark, d):
    return splits.rank_stress(customers(spark, d)).select("customer_id", "stress_score")


@query("w02_mixed_sort_ranks", VIEW + f""" SELECT customer_id, stress_score, row_number() OVER (ORDER BY {ORDER_SQL}) AS stress_rank
    FROM (SELECT *, {STRESS_SQL} AS stress_score FROM cust)""")
def _(spark, d):
    return splits.number_stress(customers(spark, d)).select("customer_id", "stress_score", "stress_rank")


@query("u01_union_of_parts", STRESS + " SELECT customer_id, spare FROM stress")
def _(spark, d):
    df = customers(spark, d)
    quotas, s = _quotas(df)
    scored = df.withColumn("stress_score", splits.stress_score())
    head = head_per_group(scored, "stress_score", quotas, splits.stress_order()).select(
        "customer_id", F.lit(0).alias("spare"))
    rest = splits.stress_batch(df, quotas, s["stress"]).join(head, "customer_id", "left_anti").select(
        "customer_id", F.lit(1).alias("spare"))
    return head.unionByName(rest)


@query("u02_pooled_batches", SPLIT + " SELECT customer_id FROM split WHERE batch IN ('train', 'current')")
def _(spark, d):
    df = split_customers(spark, d)
    return lookup.pool(df.where("batch = 'train'"), df.where("batch = 'current'")).select("customer_id")
