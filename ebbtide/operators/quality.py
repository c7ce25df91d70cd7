"""Declarative row validation: every rule is a Column, every report is one scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import flag, number
from ..sources.schema import ALLOWED, CANONICAL, NULLABLE, RANGES, type_of


class ValidationError(ValueError):
    """Schema or row violations; `violations` maps a rule name to its count."""

    def __init__(self, message: str, violations: dict[str, int] | None = None):
        super().__init__(message)
        self.violations = violations or {}


@dataclass(frozen=True)
class Rule:
    column: str
    check: str          # type | not_null | allowed | range
    argument: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.column}.{self.check}"

    def violated(self, df: DataFrame) -> Column:
        raw = F.col(self.column)
        value = coerced(df, self.column)
        if self.check == "type":
            return raw.isNotNull() & value.isNull()
        if self.check == "not_null":
            return raw.isNull()
        if self.check == "allowed":
            return F.coalesce(~value.isin(*self.argument), F.lit(False))
        return F.coalesce(~value.between(*self.argument), F.lit(False))


@dataclass(frozen=True)
class Profile:
    """A set of required columns and the rules over them; extra columns pass."""

    name: str
    columns: tuple[str, ...]
    nullable: tuple[str, ...] = NULLABLE
    check_sets: bool = True

    def rules(self) -> list[Rule]:
        out = []
        for c in self.columns:
            if not isinstance(type_of(c), T.StringType):
                out.append(Rule(c, "type"))
            if c not in self.nullable:
                out.append(Rule(c, "not_null"))
            if c in ALLOWED and self.check_sets:
                out.append(Rule(c, "allowed", ALLOWED[c]))
            if c in RANGES:
                out.append(Rule(c, "range", RANGES[c]))
        return out


CUSTOMER = Profile("customer", CANONICAL)
INFERENCE = Profile("inference", tuple(c for c in CANONICAL if c != "churn"))
REQUEST = Profile("request", tuple(c for c in CANONICAL if c not in ("customer_id", "churn")),
                  nullable=(), check_sets=False)


def coerced(df: DataFrame, column: str) -> Column:
    """The column in its declared type; what cannot be converted becomes NULL, as does NaN.

    Doubles and whole numbers are taken as they are: the way through text gives the same and costs many times as much.
    """
    target, value = type_of(column), F.col(column)
    if isinstance(target, T.StringType):
        return value.cast("string")
    if isinstance(target, T.IntegerType):
        return value.try_cast("int")
    have = next((f.dataType for f in df.schema if f.name.lower() == column.lower()), None)
    if isinstance(have, T.DoubleType):
        return F.when(~F.isnan(value), value)
    return value.cast("double") if isinstance(have, T.IntegralType) else number(value)


def require_columns(df: DataFrame, profile: Profile = CUSTOMER) -> None:
    missing = [c for c in profile.columns if c not in df.columns]
    if missing:
        raise ValidationError(f"missing columns: {missing}", {f"{c}.present": 1 for c in missing})


def coerce(df: DataFrame, profile: Profile = CUSTOMER) -> DataFrame:
    require_columns(df, profile)
    return df.withColumns({c: coerced(df, c) for c in profile.columns})


def violations(df: DataFrame, profile: Profile = CUSTOMER, key: str = "customer_id") -> DataFrame:
    """One row per violated rule of every row: (key, column, check, value)."""
    require_columns(df, profile)
    found = F.array_compact(F.array(*[
        F.when(r.violated(df), F.struct(F.lit(r.column).alias("column"), F.lit(r.check).alias("check"),
                                      F.col(r.column).cast("string").alias("value")))
        for r in profile.rules()]))
    return df.select(F.col(key), F.inline(found))


def rule_report(df: DataFrame, profile: Profile = CUSTOMER) -> DataFrame:
    """(rule, n_violations, n_rows) for every rule, from a single aggregate."""
    require_columns(df, profile)
    rules = profile.rules()
    counts = df.agg(F.count("*").alias("n_rows"), *[
        F.coalesce(F.sum(r.violated(df).cast("int")), F.lit(0)).cast("long").alias(f"v{i}")
        for i, r in enumerate(rules)])
    listed = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"v{i}").alias("n_violations"))
                       for i, r in enumerate(rules)])
    return counts.select("n_rows", F.inline(listed)).select("rule", "n_violations", "n_rows")


def mark_valid(df: DataFrame, profile: Profile = CUSTOMER) -> DataFrame:
    """Adds `n_violations` and `is_valid`; the quarantine split is a filter on it."""
    require_columns(df, profile)
    n = sum((flag(r.violated(df)) for r in profile.rules()), F.lit(0))
    return df.withColumn("n_violations", n).withColumn("is_valid", F.col("n_violations") == 0)


def quarantine(df: DataFrame, profile: Profile = CUSTOMER) -> tuple[DataFrame, DataFrame]:
    return split_marked(mark_valid(df, profile), profile)


def split_marked(marked: DataFrame, profile: Profile = CUSTOMER) -> tuple[DataFrame, DataFrame]:
    """(valid, coerced; the others with `n_violations`) of the rows that `mark_valid` marked."""
    valid = coerce(marked.where("is_valid").drop("n_violations", "is_valid"), profile)
    return valid, marked.where("NOT is_valid").drop("is_valid")


def validate(df: DataFrame, name: str = "data", profile: Profile = CUSTOMER) -> DataFrame:
    """Coerced frame, or ValidationError after one counting job."""
    bad = rule_report(df, profile).where("n_violations > 0").collect()
    if bad:
        counts = {r["rule"]: r["n_violations"] for r in bad}
        raise ValidationError(f"{name}: schema violations {counts}", counts)
    return coerce(df, profile)
