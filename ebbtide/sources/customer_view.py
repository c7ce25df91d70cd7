"""Customer table derived from the `customer` and `orders` tables.

The order tables hold no attrition data, so each canonical column is a fixed
function of the customer key, nation and segment and of the order history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_ADD_ON = ("No", "No internet service", "Yes")


def _digit(column: Column, divisor: int, base: int) -> Column:
    return F.floor(column / divisor).cast("long") % base


def _pick(index: Column, labels: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in labels]), (index + 1).cast("int"))


def customer_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    anchor = orders.agg(F.max("o_orderdate")).scalar()
    history = orders.groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("last_order"),
        F.count("*").alias("n"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))
    base = customer.join(history, F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_custkey").alias("k"),
        F.col("c_name"),
        F.col("c_nationkey").alias("nk"),
        F.col("c_mktsegment").alias("seg"),
        ((F.col("c_custkey") * 37) % 73).alias("tenure"),
        F.floor(F.col("cents") / (F.col("n") * 5000)).cast("long").alias("mc"),
        F.when(F.col("last_order") < anchor - F.expr("INTERVAL '365' DAY"), 1)
        .otherwise(0).alias("left"))
    k, nk = F.col("k"), F.col("nk")

    def yes(divisor: int) -> Column:
        return _pick(_digit(k, divisor, 2), ("No", "Yes"))

    def add_on(divisor: int) -> Column:
        return _pick(_digit(k, divisor, 3), _ADD_ON)

    columns = {
        "customer_id": F.col("c_name"),
        "gender": _pick(k % 2, ("Male", "Female")),
        "senior_citizen": yes(2),
        "partner": yes(4),
        "dependents": yes(8),
        "tenure_months": F.col("tenure").cast("int"),
        "phone_service": yes(16),
        "multiple_lines": _pick(_digit(k, 5, 3), ("No", "No phone service", "Yes")),
        "internet_service": _pick(nk % 3, ("DSL", "Fiber optic", "No")),
        "online_security": add_on(3),
        "online_backup": add_on(9),
        "device_protection": add_on(27),
        "tech_support": add_on(81),
        "streaming_tv": add_on(243),
        "streaming_movies": add_on(7),
        "contract": F.when(F.col("seg").isin("AUTOMOBILE", "BUILDING"), "Month-to-month")
        .when(F.col("seg").isin("FURNITURE", "HOUSEHOLD"), "One year").otherwise("Two year"),
        "paperless_billing": yes(32),
        "payment_method": _pick(_digit(nk, 3, 4), ("Electronic check", "Mailed check",
                                                   "Bank transfer (automatic)",
                                                   "Credit card (automatic)")),
        "monthly_charges": F.col("mc").cast("double") / 100,
        "total_charges": F.when(F.col("tenure") != 0, (
            F.col("mc") * F.col("tenure") + (k * 7919) % 2000).cast("double") / 100),
        "churn": F.col("left").cast("int"),
    }
    return base.select([c.alias(name) for name, c in columns.items()])
