"""Column roles, raw schema and bound tables.

Everything in the FIXED VALUES block must equal the values of the application this
library re-implements (column names, bounds, thresholds, score bands); they are data,
not logic, and are listed plainly in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ----------------------------------------------------------------------------------
# FIXED VALUES (must match the original application exactly)
# ----------------------------------------------------------------------------------
TARGET = "default_payment_next_month"
DOTTED_TARGET = "default.payment.next.month"
ID_COL = "ID"

CATEGORICAL_COLS = ["SEX", "EDUCATION", "MARRIAGE"]
PAY_STATUS_COLS = ["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]
BILL_COLS = ["BILL_AMT1", "BILL_AMT2", "BILL_AMT3", "BILL_AMT4", "BILL_AMT5", "BILL_AMT6"]
PAY_AMT_COLS = ["PAY_AMT1", "PAY_AMT2", "PAY_AMT3", "PAY_AMT4", "PAY_AMT5", "PAY_AMT6"]
NUMERIC_COLS = ["LIMIT_BAL", "AGE"] + BILL_COLS + PAY_AMT_COLS

# the 23 input fields in their published order, then the target
FEATURE_INPUT_COLS = (["LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE"]
                      + PAY_STATUS_COLS + BILL_COLS + PAY_AMT_COLS)
EXPECTED_COLUMNS = FEATURE_INPUT_COLS + [TARGET]

# generic header X1..X23, Y  ->  real names (X1 = LIMIT_BAL ... X23 = PAY_AMT6, Y = target)
GENERIC_NAMES = {f"X{i + 1}": name for i, name in enumerate(FEATURE_INPUT_COLS)}
GENERIC_NAMES["Y"] = TARGET

# training-side validation ranges (inclusive)
VALID_RANGES = {
    "LIMIT_BAL": (0, 1_000_000),
    "SEX": (1, 2),
    "EDUCATION": (0, 6),
    "MARRIAGE": (0, 3),
    "AGE": (18, 100),
    "PAY_0": (-2, 9),
    "PAY_2": (-2, 9),
    "PAY_3": (-2, 9),
    "PAY_4": (-2, 9),
    "PAY_5": (-2, 9),
    "PAY_6": (-2, 9),
    "default_payment_next_month": (0, 1),
}

# scoring-time ranges (inclusive); note the larger LIMIT_BAL bound
SCORING_RANGES = {
    "LIMIT_BAL": (0, 1_500_000),
    "SEX": (1, 2),
    "EDUCATION": (0, 6),
    "MARRIAGE": (0, 3),
    "AGE": (18, 100),
    "PAY_0": (-2, 9),
    "PAY_2": (-2, 9),
    "PAY_3": (-2, 9),
    "PAY_4": (-2, 9),
    "PAY_5": (-2, 9),
    "PAY_6": (-2, 9),
}
REQUIRED_FIELDS = list(FEATURE_INPUT_COLS)

# request-schema constraints: (ge, le); None = unbounded. LIMIT_BAL has only ge=0.
REQUEST_CONSTRAINTS = {
    "LIMIT_BAL": (0, None),
    "SEX": (1, 2),
    "EDUCATION": (0, 6),
    "MARRIAGE": (0, 3),
    "AGE": (18, 100),
    "PAY_0": (-2, 9),
    "PAY_2": (-2, 9),
    "PAY_3": (-2, 9),
    "PAY_4": (-2, 9),
    "PAY_5": (-2, 9),
    "PAY_6": (-2, 9),
    "BILL_AMT1": (None, None),
    "BILL_AMT2": (None, None),
    "BILL_AMT3": (None, None),
    "BILL_AMT4": (None, None),
    "BILL_AMT5": (None, None),
    "BILL_AMT6": (None, None),
    "PAY_AMT1": (0, None),
    "PAY_AMT2": (0, None),
    "PAY_AMT3": (0, None),
    "PAY_AMT4": (0, None),
    "PAY_AMT5": (0, None),
    "PAY_AMT6": (0, None),
}

# recodes in cleaning
EDUCATION_OTHER_CODES = [0, 5, 6]  # -> 4
EDUCATION_OTHER = 4
MARRIAGE_OTHER_CODES = [0]         # -> 3
MARRIAGE_OTHER = 3

# derived features, in creation order
DERIVED_COLS = ["util_ratio_1", "util_ratio_avg", "pay_ratio_1", "pay_ratio_avg",
                "delinquency_count", "max_delinquency", "bill_trend", "pay_trend"]
RATIO_COLS = ["util_ratio_1", "util_ratio_avg", "pay_ratio_1", "pay_ratio_avg"]
RATIO_CLIP = (-5.0, 10.0)
LIMIT_EPS = 1e-6

# score bands: score <= 30 Low, <= 60 Medium, else High
BAND_LOW_MAX = 30
BAND_MEDIUM_MAX = 60
BANDS = ["Low", "Medium", "High"]

# validation / monitoring thresholds
MISSING_ISSUE_THRESHOLD = 0.05
CLASS_RATE_BOUNDS = (0.05, 0.50)
BATCH_MAX_MISSING = 0.05
KS_THRESHOLD = 0.1
PSI_THRESHOLD = 0.2
PSI_BINS = 10
PSI_EPS = 1e-6
DRIFT_MIN_ROWS = 20
DEFAULT_THRESHOLD = 0.5
THRESHOLD_GRID = (0.05, 0.95, 91)
TOP_DRIVERS = 5
AUC_DROP_ALERT = 0.03
# ----------------------------------------------------------------------------------

SCALE_COLS = NUMERIC_COLS + PAY_STATUS_COLS

# model feature order: cleaned inputs then derived features
MODEL_FEATURES = FEATURE_INPUT_COLS + DERIVED_COLS

INT_COLS = {"SEX", "EDUCATION", "MARRIAGE", "AGE", *PAY_STATUS_COLS, TARGET}


def raw_schema(with_id: bool = True, with_target: bool = True) -> T.StructType:
    """Explicit schema for CSV/JSON scans (never inferred)."""
    fields = []
    if with_id:
        fields.append(T.StructField(ID_COL, T.LongType(), True))
    for c in FEATURE_INPUT_COLS:
        fields.append(T.StructField(c, T.IntegerType() if c in INT_COLS else T.DoubleType(), True))
    if with_target:
        fields.append(T.StructField(TARGET, T.IntegerType(), True))
    return T.StructType(fields)
