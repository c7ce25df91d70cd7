"""Domain features, imputation and encoding of the customer table.

`fit_features` reads a training frame into a small `FeatureParams`;
`transform_features` is then a pure projection, the same for batch and stream.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, functions as F

from ..config import BINARY, ID, LABEL, MULTI, NUMERIC
from ..functions.bounded import Settled
from ..functions.columns import both, count_equal, flag, lookup
from ..session import compiled, staged
from ..sources.tables import project_present
from .ordered import exact_medians, running_sums

# Encodings and feature inputs.
CONTRACT_RISK = {"Month-to-month": 2, "One year": 1, "Two year": 0}
BINARY_MAP = {"Yes": 1, "No": 0, "Male": 1, "Female": 0}
SENIOR_MAP = {"Yes": 1, "No": 0, "1": 1, "0": 0}
SERVICES = ("online_security", "online_backup", "device_protection",
            "tech_support", "streaming_tv", "streaming_movies")
PROTECTION = ("online_security", "online_backup", "device_protection", "tech_support")
AUTO_PAY = ("Bank transfer (automatic)", "Credit card (automatic)")
NEW_UP_TO, MID_UP_TO, LAST_BIN = 12, 36, 999
IMPUTED = NUMERIC + ("charge_per_tenure", "total_vs_expected", "charge_per_service",
                     "service_count", "service_count_sq", "protection_count",
                     "contract_risk", "tenure_bin", "service_density", "charges_x_tenure")
MAX_CATEGORIES = 10_000
LITERAL_CODES = 64  # of a column: up to these, codes are an expression


def _tenure_bin(tenure: Column) -> Column:
    outside = F.raise_error(F.concat(F.lit("tenure_months outside the bins: "),
                                     F.coalesce(tenure.cast("string"), F.lit("NULL"))))
    return (F.when((tenure > -1) & (tenure <= NEW_UP_TO), 0)
            .when((tenure > NEW_UP_TO) & (tenure <= MID_UP_TO), 1)
            .when((tenure > MID_UP_TO) & (tenure <= LAST_BIN), 2)
            .otherwise(outside.cast("int")))


def feature_layers(high_charge_above: float | None) -> list[dict[str, Column]]:
    """The 34 domain features, in dependency layers of independent columns."""
    c = F.col
    tenure, monthly, payment = c("tenure_months"), c("monthly_charges"), c("payment_method")
    flags = {
        "contract_risk": lookup(c("contract"), CONTRACT_RISK, 1),
        "is_month_to_month": flag(c("contract") == "Month-to-month"),
        "is_fiber": flag(c("internet_service") == "Fiber optic"),
        "no_internet": flag(c("internet_service") == "No"),
        "service_count": count_equal(SERVICES, "Yes"),
        "protection_count": count_equal(PROTECTION, "Yes"),
        "has_both_streaming": flag((c("streaming_tv") == "Yes") & (c("streaming_movies") == "Yes")),
        "is_new_customer": flag(tenure <= NEW_UP_TO),
        "is_loyal_customer": flag(tenure >= MID_UP_TO + 1),
        "tenure_bin": _tenure_bin(tenure),
        "is_high_charge": flag(monthly > F.lit(high_charge_above).cast("double")),
        "is_electronic_check": flag(payment == "Electronic check"),
        "is_auto_pay": flag(payment.isin(*AUTO_PAY)),
        "is_mailed_check": flag(payment == "Mailed check"),
        "senior_alone": both(lookup(c("senior_citizen").cast("string"), SENIOR_MAP, 0),
                             flag(c("partner") == "No"), flag(c("dependents") == "No")),
        "charge_per_tenure": monthly / (tenure + 1),
        "total_vs_expected": c("total_charges") / (monthly * tenure + 1),
        "charges_x_tenure": monthly * F.log1p(tenure),
    }
    combined = {
        "service_count_sq": c("service_count") * c("service_count"),
        "has_protection_bundle": flag(c("protection_count") >= 2),
        "fiber_month_to_month": both(c("is_fiber"), c("is_month_to_month")),
        "high_charge_fiber": both(c("is_high_charge"), c("is_fiber")),
        "highest_risk": both(c("is_month_to_month"), c("is_fiber"), c("is_high_charge")),
        "charge_per_service": monthly / (c("service_count") + 1),
        "service_density": c("service_count") / (tenure + 1),
        "month_to_month_echeck": both(c("is_month_to_month"), c("is_electronic_check")),
        "fiber_echeck": both(c("is_fiber"), c("is_electronic_check")),
        "new_fiber_customer": both(c("is_new_customer"), c("is_fiber")),
        "new_month_to_month": both(c("is_new_customer"), c("is_month_to_month")),
        "high_charge_monthly": both(c("is_high_charge"), c("is_month_to_month")),
        "fiber_no_support": both(c("is_fiber"), flag(c("tech_support") == "No")),
        "loyal_auto_pay": both(c("is_loyal_customer"), c("is_auto_pay")),
        "streaming_fiber": both(c("is_fiber"), c("has_both_streaming")),
    }
    last = {"monthly_no_protection": both(c("is_month_to_month"),
                                          flag(c("has_protection_bundle") == 0))}
    return [flags, combined, last]


# Order of the domain features in the matrix.
DOMAIN_FEATURES = (
    "contract_risk", "is_month_to_month", "is_fiber", "no_internet", "service_count",
    "service_count_sq", "protection_count", "has_protection_bundle", "has_both_streaming",
    "is_new_customer", "is_loyal_customer", "tenure_bin", "is_high_charge",
    "fiber_month_to_month", "high_charge_fiber", "highest_risk", "is_electronic_check",
    "is_auto_pay", "is_mailed_check", "senior_alone", "charge_per_tenure", "total_vs_expected",
    "charge_per_service", "service_density", "charges_x_tenure", "month_to_month_echeck",
    "fiber_echeck", "new_fiber_customer", "new_month_to_month", "high_charge_monthly",
    "monthly_no_protection", "fiber_no_support", "loyal_auto_pay", "streaming_fiber")
# Order of the plain columns in the matrix.
PLAIN_FEATURES = ("gender", "senior_citizen", "partner", "dependents", "tenure_months",
                  "phone_service", "paperless_billing", "monthly_charges", "total_charges")


def add_domain_features(df: DataFrame, high_charge_above: float | None) -> DataFrame:
    df = compiled(df)
    for layer in feature_layers(high_charge_above):
        df = df.withColumns(layer)
    return df


@dataclass(frozen=True)
class FeatureParams:
    """Fitted state of the feature step; its size depends on the schema only."""

    medians: Mapping[str, float]
    high_charge_above: float | None
    categories: Mapping[str, Sequence[str]]
    feature_cols: Sequence[str]
    binary_map: Mapping[str, int] = field(default_factory=lambda: dict(BINARY_MAP))

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, payload: Mapping) -> "FeatureParams":
        return cls(**payload)


def fit_categories(df: DataFrame, columns: Sequence[str] = MULTI,
                   limit: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted distinct values of each column, from one scan.

    Each value becomes a matrix column, so more than `limit` of them is an error.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                        for c in columns])
    found = Settled(df.select(F.inline(entries)).where("value IS NOT NULL").distinct(), limit)
    if not found.small:
        raise ValueError(f"more than {limit} categories to encode in {list(columns)}")
    return {c: sorted(r["value"] for r in found.rows if r["column"] == c) for c in columns}


def dummy_names(categories: Mapping[str, Sequence[str]]) -> list[str]:
    return [f"{c}_{v}" for c, values in categories.items() for v in values[1:]]


def one_hot(categories: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """One 0/1 column per fitted category, the first of each column dropped."""
    return {f"{c}_{v}": flag(F.col(c) == v) for c, values in categories.items() for v in values[1:]}


def impute(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    """Fills gaps; the filled columns are doubles, as a median may be fractional."""
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")),
                                         F.lit(float(v)))
                           for c, v in medians.items() if c in df.columns})


def encode_binary(df: DataFrame, columns: Iterable[str] = BINARY,
                  mapping: Mapping[str, int] = BINARY_MAP) -> DataFrame:
    return df.withColumns({c: lookup(F.col(c).cast("string"), mapping, 0)
                           for c in columns if c in df.columns})


def fit_features(df: DataFrame, max_categories: int = MAX_CATEGORIES) -> FeatureParams:
    """Medians of the imputed columns, the high-charge limit and the categories, of which each becomes a column.

    Columns of more than `max_categories` values belong in a `Vocabulary`, whose vectors are sparse.

    All medians are kept, not only those of columns with gaps in this frame, so
    that a gap that first appears at scoring time is filled too.
    """
    # Medians take several rounds: what they and the categories read is made once.
    read = staged(add_domain_features(df, None).select(
        *[F.col(c).cast("double").alias(c) for c in IMPUTED], *[F.col(c).cast("string").alias(c) for c in MULTI]), "fit")
    medians = exact_medians(read, IMPUTED)
    categories = fit_categories(read, limit=max_categories)
    return FeatureParams(
        {c: m for c, m in medians.items() if m is not None}, medians["monthly_charges"], categories,
        [*PLAIN_FEATURES, *DOMAIN_FEATURES, *dummy_names(categories)])


def transform_features(df: DataFrame, params: FeatureParams, high_charge: str = "fit",
                       keep: Sequence[str] = (ID, LABEL)) -> DataFrame:
    """`keep` columns that exist, then the fitted feature columns in fitted order.

    `high_charge='fit'` compares charges with the fitted median; 'batch' takes
    the median of this frame, which a one-row frame can never exceed.
    """
    if high_charge not in ("fit", "batch"):
        raise ValueError(f"unknown high_charge mode '{high_charge}'")
    above = (params.high_charge_above if high_charge == "fit"
             else exact_medians(df, ["monthly_charges"])["monthly_charges"])
    # Dummies are read from the text columns before encoding; ratios before imputation.
    wide = add_domain_features(df, above).withColumns(one_hot(params.categories))
    ready = encode_binary(impute(wide, params.medians), mapping=params.binary_map)
    kept = [c for c in keep if c in df.columns]
    return align(ready, [*kept, *params.feature_cols])


def align(df: DataFrame, columns: Sequence[str], fill=0) -> DataFrame:
    """Exactly `columns`, in order: absent ones filled, others dropped."""
    return project_present(df, columns, fill)


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, code): codes 0..k-1 in value order, for every text column."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                        for c in columns])
    values = (df.select(F.inline(entries)).where("value IS NOT NULL").distinct()
              .withColumn("one", F.lit(1).cast("long")))
    ranked = running_sums(values, ["column"], "value", ["one"], groups=len(columns))
    return ranked.select("column", "value", F.col("one_before").cast("int").alias("code"))


def label_encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replaces each text column by its code, an int; a value that is NULL stays NULL, also where all are.

    Codes of few values become an expression; more of them a dictionary that is joined, as a broadcast only if its size
    was checked.
    """
    codes = Settled(label_codes(df, columns))
    out = df
    for c in columns:
        if codes.small:
            mine = {r["value"]: r["code"] for r in codes.rows if r["column"] == c}
            if len(mine) <= LITERAL_CODES:
                out = out.withColumn(c, lookup(F.col(c).cast("string"), mine, None).cast("int") if mine else F.lit(None).cast("int"))
                continue
        out = _joined_codes(out, codes, c, "_code").withColumn(c, F.col("_code")).drop("_code")
    return out.select(df.columns)


def _joined_codes(df: DataFrame, codes: Settled, column: str, name: str) -> DataFrame:
    """`df` with the code of `column`'s value; hot and missing values meet their dictionary row in a join that AQE can split."""
    mine = codes.frame.where(F.col("column") == column).select(F.col("value").alias("_value"), F.col("code").alias(name))
    return df.join(F.broadcast(mine) if codes.small else mine, F.col(column).cast("string") == F.col("_value"), "left").drop("_value")


@dataclass(frozen=True)
class Vocabulary:
    """A dictionary (column, value, code) of any size, stored as a table, and the number of values of each column."""

    codes: DataFrame
    sizes: Mapping[str, int]

    def encode(self, df: DataFrame) -> DataFrame:
        """Each column becomes a sparse vector with a place for every value but the first; missing and unknown values are all zero.

        The same vectors, whatever values a later frame holds. Only sizes reach the driver.
        """
        out, settled = df, Settled(self.codes)
        for c, size in self.sizes.items():
            # The encoder leaves out its last place: places run backwards, so that this is the first value.
            place = F.coalesce(F.lit(size - 1) - F.col("_code"), F.lit(max(size - 1, 0))).cast("double")
            nominal = {"ml_attr": {"type": "nominal", "num_vals": max(size, 2)}}
            out = (_joined_codes(out, settled, c, "_code").withColumn("_place", place.alias("_place", metadata=nominal)).drop("_code", c))
            encoder = OneHotEncoder(inputCol="_place", outputCol=c, dropLast=True).fit(out)
            out = encoder.transform(out).drop("_place")
        return out.select(df.columns)


def fit_vocabulary(df: DataFrame, columns: Sequence[str]) -> Vocabulary:
    """The distinct values of text columns with codes in value order, made and stored without passing through one place."""
    codes = staged(label_codes(df, columns), "vocabulary")
    sizes = {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count("*").alias("n")).collect()}
    return Vocabulary(codes, {c: sizes.get(c, 0) for c in columns})


def fit_scaling(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation of each column; a constant column scales by 1."""
    row = df.agg(*[x for i, c in enumerate(columns) for x in (
        F.avg(f"`{c}`").alias(f"m{i}"), F.stddev_pop(f"`{c}`").alias(f"s{i}"))]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def scale(df: DataFrame, scaling: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(f"`{c}`") - F.lit(m)) / F.lit(s)
                           for c, (m, s) in scaling.items()})
