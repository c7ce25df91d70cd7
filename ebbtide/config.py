"""Constants of the customer-attrition domain, all overridable by argument."""

from __future__ import annotations

LABEL = "churn"
ID = "customer_id"

# Column groups of the canonical customer table.
NUMERIC = ("tenure_months", "monthly_charges", "total_charges")
BINARY = ("gender", "senior_citizen", "partner", "dependents",
          "phone_service", "paperless_billing")
MULTI = ("multiple_lines", "internet_service", "online_security", "online_backup",
         "device_protection", "tech_support", "streaming_tv", "streaming_movies",
         "contract", "payment_method")

# Sampling and batch sizes.
SEED = 42
TEST_SHARE = 0.20
TENURE_CUTOFF = 12
STRESS_SIZE = 800
CURRENT_SIZE = 943
STRESS_QUOTAS = {4: 250, 3: 250, 2: 300}

# Deployment gates, thresholds and business cost.
GATES = {"f1": 0.48, "recall": 0.55, "auc_pr": 0.40, "auc_roc": 0.70}
GATE_NAMES = {"f1": "F1", "recall": "Recall", "auc_pr": "AUC-PR", "auc_roc": "AUC-ROC"}
DEFAULT_THRESHOLD = 0.50
PRODUCTION_THRESHOLD = 0.20
MIN_PRECISION = 0.40
COST_FN = 1500
COST_FP = 50

# Drift columns and decision limits.
DRIFT_COLUMNS = ("tenure_months", "monthly_charges", "total_charges",
                 "contract", "internet_service", "payment_method")
KEY_DRIFT_COLUMNS = ("tenure_months", "monthly_charges", "total_charges")
SMALL_REFERENCE_ROWS = 1000
FEW_VALUES = 5
P_VALUE_LIMIT = 0.05
DISTANCE_LIMIT = 0.1
DRIFT_SHARE = 0.5
F1_DROP_LIMIT = 0.05
MEAN_SHIFT_LIMIT = 0.10
