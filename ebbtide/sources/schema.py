"""Canonical customer schema: types, value domains and raw headings."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw headings and their canonical names, in canonical order.
RAW_HEADINGS = {
    "CustomerID": "customer_id",
    "Gender": "gender",
    "Senior Citizen": "senior_citizen",
    "Partner": "partner",
    "Dependents": "dependents",
    "Tenure Months": "tenure_months",
    "Phone Service": "phone_service",
    "Multiple Lines": "multiple_lines",
    "Internet Service": "internet_service",
    "Online Security": "online_security",
    "Online Backup": "online_backup",
    "Device Protection": "device_protection",
    "Tech Support": "tech_support",
    "Streaming TV": "streaming_tv",
    "Streaming Movies": "streaming_movies",
    "Contract": "contract",
    "Paperless Billing": "paperless_billing",
    "Payment Method": "payment_method",
    "Monthly Charges": "monthly_charges",
    "Total Charges": "total_charges",
    "Churn Value": "churn",
}
CANONICAL = tuple(RAW_HEADINGS.values())

# Allowed sets and inclusive ranges.
YES_NO = ("Yes", "No")
INTERNET_ADD_ON = ("Yes", "No", "No internet service")
ALLOWED = {
    "gender": ("Male", "Female"),
    "senior_citizen": YES_NO,
    "partner": YES_NO,
    "dependents": YES_NO,
    "phone_service": YES_NO,
    "multiple_lines": ("Yes", "No", "No phone service"),
    "internet_service": ("DSL", "Fiber optic", "No"),
    "online_security": INTERNET_ADD_ON,
    "online_backup": INTERNET_ADD_ON,
    "device_protection": INTERNET_ADD_ON,
    "tech_support": INTERNET_ADD_ON,
    "streaming_tv": INTERNET_ADD_ON,
    "streaming_movies": INTERNET_ADD_ON,
    "contract": ("Month-to-month", "One year", "Two year"),
    "paperless_billing": YES_NO,
    "payment_method": ("Electronic check", "Mailed check",
                       "Bank transfer (automatic)", "Credit card (automatic)"),
    "churn": (0, 1),
}
RANGES = {"tenure_months": (0, 72), "monthly_charges": (0, 200), "total_charges": (0, 10_000)}
NULLABLE = ("total_charges",)

_TYPES = {"tenure_months": T.IntegerType(), "churn": T.IntegerType(),
          "monthly_charges": T.DoubleType(), "total_charges": T.DoubleType()}
CUSTOMER_SCHEMA = T.StructType(
    [T.StructField(c, _TYPES.get(c, T.StringType()), True) for c in CANONICAL])


def type_of(column: str) -> T.DataType:
    return CUSTOMER_SCHEMA[column].dataType
