"""Domain features, imputation, encoding and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import BINARY, MULTI
from ..operators import features as fe
from ..operators.ordered import exact_medians
from ..sources.schema import ALLOWED
from ..sources.tables import text_columns
from .registry import VIEW, customers, query, r6

_F = "CASE WHEN {} THEN 1 ELSE 0 END"
_SERVICES = " + ".join(_F.format(f"{c} = 'Yes'") for c in fe.SERVICES)
_PROTECTION = " + ".join(_F.format(f"{c} = 'Yes'") for c in fe.PROTECTION)
_M2M, _FIBER = "contract = 'Month-to-month'", "internet_service = 'Fiber optic'"
_HIGH, _CHECK = "monthly_charges > hc", "payment_method = 'Electronic check'"
_AUTO = "payment_method IN ('Bank transfer (automatic)', 'Credit card (automatic)')"
_BOTH = "streaming_tv = 'Yes' AND streaming_movies = 'Yes'"
# The 34 features as SQL over the customer columns and `hc`, the median charge.
FEATURE_SQL = {
    "contract_risk": "CASE contract WHEN 'Month-to-month' THEN 2 WHEN 'One year' THEN 1 WHEN 'Two year' THEN 0 ELSE 1 END",
    "is_month_to_month": _F.format(_M2M), "is_fiber": _F.format(_FIBER),
    "no_internet": _F.format("internet_service = 'No'"),
    "service_count": f"({_SERVICES})", "service_count_sq": f"({_SERVICES}) * ({_SERVICES})",
    "protection_count": f"({_PROTECTION})", "has_protection_bundle": _F.format(f"({_PROTECTION}) >= 2"),
    "has_both_streaming": _F.format(_BOTH), "is_new_customer": _F.format("tenure_months <= 12"),
    "is_loyal_customer": _F.format("tenure_months >= 37"),
    "tenure_bin": "CASE WHEN tenure_months <= 12 THEN 0 WHEN tenure_months <= 36 THEN 1 ELSE 2 END",
    "is_high_charge": _F.format(_HIGH), "fiber_month_to_month": _F.format(f"{_FIBER} AND {_M2M}"),
    "high_charge_fiber": _F.format(f"{_HIGH} AND {_FIBER}"),
    "highest_risk": _F.format(f"{_M2M} AND {_FIBER} AND {_HIGH}"),
    "is_electronic_check": _F.format(_CHECK), "is_auto_pay": _F.format(_AUTO),
    "is_mailed_check": _F.format("payment_method = 'Mailed check'"),
    "senior_alone": _F.format("senior_citizen = 'Yes' AND partner = 'No' AND dependents = 'No'"),
    "charge_per_tenure": "monthly_charges / (tenure_months + 1)",
    "total_vs_expected": "total_charges / (monthly_charges * tenure_months + 1)",
    "charge_per_service": f"monthly_charges / (({_SERVICES}) + 1)",
    "service_density": f"CAST(({_SERVICES}) AS DOUBLE) / (tenure_months + 1)",
    "charges_x_tenure": "monthly_charges * ln(1 + tenure_months)",
    "month_to_month_echeck": _F.format(f"{_M2M} AND {_CHECK}"),
    "fiber_echeck": _F.format(f"{_FIBER} AND {_CHECK}"),
    "new_fiber_customer": _F.format(f"tenure_months <= 12 AND {_FIBER}"),
    "new_month_to_month": _F.format(f"tenure_months <= 12 AND {_M2M}"),
    "high_charge_monthly": _F.format(f"{_HIGH} AND {_M2M}"),
    "monthly_no_protection": _F.format(f"{_M2M} AND ({_PROTECTION}) < 2"),
    "fiber_no_support": _F.format(f"{_FIBER} AND tech_support = 'No'"),
    "loyal_auto_pay": _F.format(f"tenure_months >= 37 AND {_AUTO}"),
    "streaming_fiber": _F.format(f"{_FIBER} AND {_BOTH}"),
}
# Quotients are the same double in both engines; logarithms and medians may differ in the last bit.
QUOTIENTS = ("charge_per_tenure", "total_vs_expected", "charge_per_service", "service_density")
ROUNDED = ("total_charges", "total_vs_expected", "charges_x_tenure")
# `ft` adds all features to the customers, `md` holds the median of each imputed column.
FT = (VIEW + ", hcm AS (SELECT median(monthly_charges) AS hc FROM cust), ft AS (SELECT cust.*, "
      + ", ".join(f"{e} AS {c}" for c, e in FEATURE_SQL.items()) + " FROM cust, hcm)")
MD = FT + ", md AS (SELECT " + ", ".join(
    f"CAST(median({c}) AS DOUBLE) AS m_{c}" for c in fe.IMPUTED) + " FROM ft)"
BINARY_SQL = {c: f"CASE WHEN {c} IN ('Yes', 'Male') THEN 1 ELSE 0 END" for c in BINARY}
# Every category occurs in the customer view at each scale, so the first by name is dropped.
DUMMY_SQL = {f"{c}_{v}": f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END"
             for c in MULTI for v in sorted(ALLOWED[c])[1:]}


def with_features(spark, d):
    df = customers(spark, d)
    limit = exact_medians(df, ["monthly_charges"])["monthly_charges"]
    return fe.add_domain_features(df, limit)


for _i, _c in enumerate(fe.DOMAIN_FEATURES, start=1):
    _out = (_c if _c in QUOTIENTS else "round(charges_x_tenure, 6)" if _c == "charges_x_tenure"
            else f"CAST({_c} AS INT)")

    @query(f"f{_i:02d}_{_c}", FT + f" SELECT customer_id, {_out} AS {_c} FROM ft")
    def _(spark, d, c=_c):
        shown = (F.col(c) if c in QUOTIENTS else r6(c) if c == "charges_x_tenure"
                 else F.col(c).cast("int"))
        needs_limit = any(part in c for part in ("high_charge", "highest_risk"))
        df = with_features(spark, d) if needs_limit else fe.add_domain_features(customers(spark, d), None)
        return df.select("customer_id", shown.alias(c))


@query("e01_median_fit", MD + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(m_{c}, 6) AS median FROM md" for c in fe.IMPUTED))
def _(spark, d):
    medians = fe.fit_features(customers(spark, d)).medians
    return spark.createDataFrame([(c, round(m, 6)) for c, m in medians.items()],
                                 "feature string, median double")


@query("e02_median_impute", MD + """ SELECT customer_id, round(coalesce(total_charges, m_total_charges), 6) AS total_charges,
    round(coalesce(total_vs_expected, m_total_vs_expected), 6) AS total_vs_expected FROM ft, md""")
def _(spark, d):
    df = fe.add_domain_features(customers(spark, d), None)
    filled = fe.impute(df, exact_medians(df, ["total_charges", "total_vs_expected"]))
    return filled.select("customer_id", r6("total_charges").alias("total_charges"),
                         r6("total_vs_expected").alias("total_vs_expected"))


@query("e03_binary_encode", VIEW + " SELECT customer_id, " + ", ".join(
    f"{e} AS {c}" for c, e in BINARY_SQL.items()) + " FROM cust")
def _(spark, d):
    return fe.encode_binary(customers(spark, d)).select("customer_id", *BINARY)


@query("e04_one_hot", VIEW + " SELECT customer_id, " + ", ".join(
    f'{e} AS "{c}"' for c, e in DUMMY_SQL.items()) + " FROM cust")
def _(spark, d):
    df = customers(spark, d)
    return df.select("customer_id", *[e.alias(c) for c, e in fe.one_hot(fe.fit_categories(df)).items()])


@query("e05_align_features", VIEW + " SELECT customer_id, 0 AS unseen, tenure_months FROM cust")
def _(spark, d):
    return fe.align(customers(spark, d), ["customer_id", "unseen", "tenure_months"])


def _matrix_sql(c: str) -> str:
    if c in fe.IMPUTED:
        filled = f"coalesce(CAST({c} AS DOUBLE), m_{c})"
        return f"round({filled}, 6)" if c in ROUNDED else filled
    return BINARY_SQL.get(c) or DUMMY_SQL.get(c) or c


MATRIX = (*fe.PLAIN_FEATURES, *fe.DOMAIN_FEATURES, *DUMMY_SQL)


@query("e06_feature_matrix", MD + " SELECT customer_id, churn, " + ", ".join(
    f'{_matrix_sql(c)} AS "{c}"' for c in MATRIX) + " FROM ft, md")
def _(spark, d):
    df = customers(spark, d)
    params = fe.fit_features(df)
    return fe.transform_features(df, params).select("customer_id", "churn", *[
        (r6(c) if c in ROUNDED else F.col(f"`{c}`")).alias(c) for c in params.feature_cols])


_TEXT = ("gender", "senior_citizen", "partner", "dependents", "phone_service", "multiple_lines",
         "internet_service", "online_security", "online_backup", "device_protection", "tech_support",
         "streaming_tv", "streaming_movies", "contract", "paperless_billing", "payment_method")


@query("e07_label_encode", VIEW + " SELECT customer_id, " + ", ".join(
    f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INT) AS {c}" for c in _TEXT) + " FROM cust")
def _(spark, d):
    df = customers(spark, d)
    names = text_columns(df, exclude=["customer_id"])
    return fe.label_encode(df, names).select("customer_id", *names)


@query("e07_label_codes_of_names", """SELECT 'p_name' AS "column", p_name AS value,
    CAST(row_number() OVER (ORDER BY p_name) - 1 AS INT) AS code FROM (SELECT DISTINCT p_name FROM part)
    UNION ALL SELECT 'p_type', p_type, CAST(row_number() OVER (ORDER BY p_type) - 1 AS INT)
    FROM (SELECT DISTINCT p_type FROM part)""")
def _(spark, d):
    return fe.label_codes(spark.read.parquet(f"{d}/part.parquet"), ["p_name", "p_type"])


_SCALED = ("tenure_months", "monthly_charges", "total_charges")


@query("e08_standardise", VIEW + ", st AS (SELECT " + ", ".join(
    f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED) + " FROM cust) SELECT customer_id, " + ", ".join(
    f"round(({c} - a_{c}) / s_{c}, 6) AS {c}" for c in _SCALED) + " FROM cust, st")
def _(spark, d):
    df = customers(spark, d)
    return fe.scale(df, fe.fit_scaling(df, _SCALED)).select(
        "customer_id", *[r6(c).alias(c) for c in _SCALED])
