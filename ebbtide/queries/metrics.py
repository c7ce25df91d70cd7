"""Evaluation of scored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as m
from .metrics_sql import RATES_SQL, confusion_sql, rank_ctes
from .registry import DOCS, SCORED, query, r6, scored_customers, scored_documents

SUBJECTS = (("", SCORED, scored_customers), ("_of_documents", DOCS, scored_documents))
_COUNTS = ("tn", "fp", "fn", "tp")
_FIELDS = ("threshold", "accuracy", "f1", "recall", "precision", "auc_roc", "auc_pr")
# 15 metric fields over tn, fp, fn, tp and the rank metrics.
_ALL15 = ("CAST({t} AS DOUBLE) AS threshold, " + ", ".join(f"round({e}, 6) AS {k}" for k, e in RATES_SQL.items())
          + ", round(auc_roc, 6) AS auc_roc, round(auc_pr, 6) AS auc_pr, tp, fp, fn, tn, fn AS missed_churners, "
          "fn * 1500 AS business_cost_fn, fp * 50 AS business_cost_fp, fn * 1500 + fp * 50 AS total_business_cost")
_GATES_SQL = """CASE WHEN f1 < 0.48 THEN 1 ELSE 0 END + CASE WHEN recall < 0.55 THEN 1 ELSE 0 END
    + CASE WHEN auc_pr < 0.40 THEN 1 ELSE 0 END + CASE WHEN auc_roc < 0.70 THEN 1 ELSE 0 END"""
_SWEEP_TABLE = "(VALUES " + ", ".join(f"(CAST('{t!r}' AS DOUBLE))" for t in m.SWEEP) + ") AS th(t)"


def _sweep_ctes(source: str) -> str:
    # Every threshold is counted against every distinct score here; the Spark side counts rows once.
    return f"""hs AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
    FROM {source} GROUP BY score),
ct AS (SELECT t, CAST(sum(CASE WHEN score >= t THEN pos ELSE 0 END) AS BIGINT) AS tp,
    CAST(sum(CASE WHEN score >= t THEN neg ELSE 0 END) AS BIGINT) AS fp,
    CAST(sum(CASE WHEN score < t THEN pos ELSE 0 END) AS BIGINT) AS fn FROM hs, {_SWEEP_TABLE} GROUP BY t),
sw AS (SELECT t, fn * 1500 + fp * 50 AS cost, CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) AS f1, fn, fp,
    CAST(tp AS DOUBLE) / (tp + fp) AS precision FROM ct WHERE tp + fp > 0)"""


def _rounded(df, names):
    return df.select([r6(c).alias(c) if c in names else F.col(c) for c in df.columns])


for _suffix, _src, _load in SUBJECTS:
    @query(f"m01_confusion{_suffix}", _src + " " + confusion_sql("sc"))
    def _(spark, d, load=_load):
        return m.confusion(load(spark, d))

    @query(f"m02_rates{_suffix}", _src + ", c AS (" + confusion_sql("sc") + ") SELECT "
           + ", ".join(f"round({e}, 6) AS {k}" for k, e in RATES_SQL.items()) + " FROM c")
    def _(spark, d, load=_load):
        return m.confusion(load(spark, d)).select(*[F.round(e, 6).alias(k) for k, e in m.rates().items()])

    @query(f"m03_auc_roc{_suffix}", _src + "," + rank_ctes("sc") + " SELECT round(auc_roc, 9) AS auc_roc FROM rank")
    def _(spark, d, load=_load):
        return m.rank_metrics(load(spark, d)).select(F.round("auc_roc", 9).alias("auc_roc"))

    @query(f"m04_average_precision{_suffix}", _src + "," + rank_ctes("sc")
           + " SELECT round(auc_pr, 9) AS auc_pr FROM rank")
    def _(spark, d, load=_load):
        return m.rank_metrics(load(spark, d)).select(F.round("auc_pr", 9).alias("auc_pr"))

    @query(f"m05_business_cost{_suffix}", _src + ", c AS (" + confusion_sql("sc") + """) SELECT
        fn * 1500 AS business_cost_fn, fp * 50 AS business_cost_fp, fn * 1500 + fp * 50 AS total_business_cost FROM c""")
    def _(spark, d, load=_load):
        return m.confusion(load(spark, d)).select(*[e.alias(k) for k, e in m.costs().items()])

    @query(f"m06_all_metrics{_suffix}", _src + ", c AS (" + confusion_sql("sc") + ")," + rank_ctes("sc")
           + " SELECT " + _ALL15.format(t="0.5") + " FROM c, rank")
    def _(spark, d, load=_load):
        return _rounded(m.evaluate(load(spark, d)), _FIELDS)

    @query(f"m06_all_metrics_at_production{_suffix}", _src + ", sd AS (SELECT *, "
           "CASE WHEN score >= 0.2 THEN 1 ELSE 0 END AS p2 FROM sc), c AS (" + confusion_sql("sd", "p2") + "),"
           + rank_ctes("sc") + " SELECT " + _ALL15.format(t="0.2") + " FROM c, rank")
    def _(spark, d, load=_load):
        return _rounded(m.evaluate(load(spark, d), threshold=0.2), _FIELDS)

    @query(f"m07_threshold_sweep{_suffix}", _src + ", " + _sweep_ctes("sc") + """ SELECT round(t, 2) AS threshold, cost,
        round(f1, 6) AS f1, fn, fp, round(precision, 6) AS precision FROM sw""")
    def _(spark, d, load=_load):
        return _rounded(m.threshold_sweep(load(spark, d)).drop("exact_threshold"), ("f1", "precision"))

    @query(f"m08_cost_optimal{_suffix}", _src + ", " + _sweep_ctes("sc") + """,
        pick AS (SELECT * FROM sw WHERE precision >= 0.25 OR NOT EXISTS (SELECT 1 FROM sw WHERE precision >= 0.25)),
        best AS (SELECT * FROM pick ORDER BY cost, t LIMIT 1)
        SELECT t AS cost_optimal, cost AS best_cost FROM best""")
    def _(spark, d, load=_load):
        return m.best_thresholds(m.threshold_sweep(load(spark, d)), 0.25).select("cost_optimal", "best_cost")

    @query(f"m09_f1_optimal{_suffix}", _src + ", " + _sweep_ctes("sc")
           + " SELECT t AS f1_optimal, round(f1, 6) AS best_f1 FROM sw ORDER BY f1 DESC, t LIMIT 1")
    def _(spark, d, load=_load):
        best = m.best_thresholds(m.threshold_sweep(load(spark, d)))
        return best.select("f1_optimal", r6("best_f1").alias("best_f1"))

    @query(f"m10_default_cost{_suffix}", _src + ", " + _sweep_ctes("sc")
           + " SELECT cost AS default_cost FROM sw WHERE round(t, 2) = 0.5")
    def _(spark, d, load=_load):
        return m.best_thresholds(m.threshold_sweep(load(spark, d))).select("default_cost")

    @query(f"m12_gates{_suffix}", _src + ", c AS (" + confusion_sql("sc") + ")," + rank_ctes("sc")
           + ", g AS (SELECT " + ", ".join(f"{e} AS {k}" for k, e in RATES_SQL.items()) + ", auc_roc, auc_pr FROM c, rank)"
           + f" SELECT {_GATES_SQL} AS n_failures, ({_GATES_SQL}) = 0 AS passed FROM g")
    def _(spark, d, load=_load):
        return m.check_gates(m.evaluate(load(spark, d))).select(F.size("failures").alias("n_failures"), "passed")


def _slice_sql(columns) -> str:
    long = " UNION ALL ".join(f"SELECT '{c}=' || {c} AS slice, label, pred FROM sc" for c in columns)
    return (", lg AS (" + long + "), c AS (" + confusion_sql("lg", by="slice") + ") SELECT slice, tn + fp + fn + tp AS n, "
            "round(CAST(tp + fn AS DOUBLE) / (tn + fp + fn + tp), 6) AS churn_rate, "
            f"round({RATES_SQL['f1']}, 6) AS f1, round({RATES_SQL['recall']}, 6) AS recall "
            "FROM c WHERE tn + fp + fn + tp >= 10")


@query("m11_slices", SCORED + _slice_sql(["contract", "internet_service", "payment_method"]))
def _(spark, d):
    out = m.slice_metrics(scored_customers(spark, d), ["contract", "internet_service", "payment_method"])
    return _rounded(out, ("churn_rate", "f1", "recall"))


@query("m11_slices_of_documents", DOCS + _slice_sql(["lang", "source"]))
def _(spark, d):
    return _rounded(m.slice_metrics(scored_documents(spark, d), ["lang", "source"]), ("churn_rate", "f1", "recall"))


@query("m12_gate_messages", SCORED + ", c AS (" + confusion_sql("sc") + ")," + rank_ctes("sc")
       + ", g AS (SELECT " + ", ".join(f"{e} AS {k}" for k, e in RATES_SQL.items()) + ", auc_roc, auc_pr FROM c, rank)"
       + " SELECT unnest(list_filter([CASE WHEN f1 < 0.48 THEN printf('F1 %.3f < 0.48', f1) END,"
         " CASE WHEN recall < 0.55 THEN printf('Recall %.3f < 0.55', recall) END,"
         " CASE WHEN auc_pr < 0.40 THEN printf('AUC-PR %.3f < 0.4', auc_pr) END,"
         " CASE WHEN auc_roc < 0.70 THEN printf('AUC-ROC %.3f < 0.7', auc_roc) END], lambda x: x IS NOT NULL)) AS failure FROM g")
def _(spark, d):
    return m.check_gates(m.evaluate(scored_customers(spark, d))).select(F.explode("failures").alias("failure"))


# Three candidate scores side by side.
CANDIDATES = {"charges": "monthly_charges / 100", "short tenure": "CAST(72 - tenure_months AS DOUBLE) / 72",
              "stress": "score"}
_LONG = SCORED + ", lc AS (" + " UNION ALL ".join(
    f"SELECT '{k}' AS model, label, {e} AS score FROM sc" for k, e in CANDIDATES.items()) + """),
lp AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred FROM lc),
c AS (""" + confusion_sql("lp", by="model") + ")," + rank_ctes("lp", "model") + """,
cmp AS (SELECT c.model, """ + ", ".join(f"{RATES_SQL[k]} AS {k}" for k in ("f1", "recall", "precision")) + """,
    auc_roc, fn AS missed, fn * 1500 AS cost FROM c JOIN rank ON rank.model = c.model)"""


def candidates(spark, d):
    df = scored_customers(spark, d)
    entries = F.array(*[F.struct(F.lit(k).alias("model"), F.expr(e).alias("score")) for k, e in CANDIDATES.items()])
    return df.select("label", F.inline(entries))


@query("m13_candidate_comparison", _LONG + """ SELECT model, round(f1, 6) AS f1, round(recall, 6) AS recall,
    round(precision, 6) AS precision, round(auc_roc, 6) AS auc_roc, missed, cost FROM cmp""")
def _(spark, d):
    return _rounded(m.compare_models(candidates(spark, d), len(CANDIDATES)), ("f1", "recall", "precision", "auc_roc"))


@query("w03_leaderboard", _LONG + """ SELECT model, round(f1, 6) AS f1, CAST(row_number() OVER (ORDER BY f1 DESC, model) AS INT) AS rank,
    row_number() OVER (ORDER BY f1 DESC, model) = 1 AS is_winner, row_number() OVER (ORDER BY f1 DESC, model) <= 2 AS tuned FROM cmp""")
def _(spark, d):
    board = m.leaderboard(m.compare_models(candidates(spark, d), len(CANDIDATES)), keep=2)
    return board.select("model", r6("f1").alias("f1"), "rank", "is_winner", "tuned")


@query("t02_class_weight", SCORED + """, n AS (SELECT count(*) AS n, sum(label) AS p FROM sc)
    SELECT customer_id, round(CASE WHEN label = 1 THEN n / (2.0 * p) ELSE n / (2.0 * (n - p)) END, 9) AS balanced,
    CASE WHEN label = 1 THEN CAST(2.5 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS weighted FROM sc, n""")
def _(spark, d):
    from ..operators.models import class_balance, row_weight
    df = scored_customers(spark, d)
    c = class_balance(df).first()
    return df.select("customer_id", F.round(row_weight("balanced", c["n_neg"], c["n_pos"]), 9).alias("balanced"),
                     row_weight(2.5, c["n_neg"], c["n_pos"]).alias("weighted"))
