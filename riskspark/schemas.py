"""Table schemas and fixed values.

The fixed values below must equal the reference's for results to agree; they
are stated plainly and together.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference)
# ---------------------------------------------------------------------------
DEVICE_TYPES = ["mobile", "desktop", "tablet", "pos_terminal"]
LOCATIONS = ["Lagos", "Abuja", "Kano", "Port Harcourt", "Ibadan", "London", "New York"]
REQUEST_TRANSACTION_TYPES = ["purchase", "withdrawal", "transfer", "refund", "payment"]
FEEDBACK_SOURCES = ["chargeback", "dispute", "manual_review"]
LABEL_VALUES = [0, 1]
TARGET = "is_fraud"
PREDICTION_COLUMN = "predicted_fraud"
MOBILE = "mobile"
NULL_SHARE_LIMIT = 0.10          # a column with more nulls than this loses its null rows
CLIP_LOWER_Q = 0.01
CLIP_UPPER_Q = 0.99
SERIOUS_DRIFT_THRESHOLD = 0.50
NEGLIGIBLE_DRIFT_THRESHOLD = 0.15
LOW_RECALL_THRESHOLD = 0.70
DEFAULT_RECALL = 1.0
SPLIT_TEST_SIZE = 0.2
SPLIT_VAL_SIZE = 0.1
SEED = 42
TOP_REASONS = 10
TOP_IMPORTANCE = 5
MODEL_PREFIX = "fraud-"
PRODUCTION = "production"
PREVIOUS_PRODUCTION = "previous-production"
# Drift defaults of the statistics library the reference calls (public docs).
DRIFT_SMALL_SAMPLE = 1000        # reference rows at or below: hypothesis tests
DRIFT_P_THRESHOLD = 0.05
DRIFT_DISTANCE_THRESHOLD = 0.1
DRIFT_CATEGORY_MAX_VALUES = 5    # numeric columns with this few values are categories
DATASET_DRIFT_SHARE = 0.5
WASSERSTEIN_STD_FLOOR = 0.001
SHARE_ZERO_FILL = 0.0001         # empty category share before Jensen-Shannon
ALERT_HEADERS = {
    "serious": "*SERIOUS DRIFT DETECTED — Immediate retraining triggered*",
    "negligible": "*Negligible drift — Scheduled for Sunday retraining*",
    "none": "*No significant drift — Pipeline healthy*",
}
ALERT_DEFAULT_HEADER = "*Drift check complete*"
RETRAIN_REASON = "serious_drift"
MODEL_NAMES = ["RandomForest", "XGBoost", "LogisticRegression"]

# ---------------------------------------------------------------------------
# Table schemas
# ---------------------------------------------------------------------------
RAW_TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("transaction_amount", T.DoubleType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("transaction_time", T.StringType()),
    T.StructField("transaction_location", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("previous_transactions_count", T.IntegerType()),
    T.StructField("is_fraud", T.IntegerType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType()),
    T.StructField("transaction_amount", T.DoubleType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("transaction_time", T.TimestampType()),
    T.StructField("transaction_location", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("previous_transactions_count", T.IntegerType()),
    T.StructField("is_fraud", T.IntegerType()),
    T.StructField("filename", T.StringType()),
])

# Request rows: the raw transaction without the label.
REQUEST = T.StructType([f for f in RAW_TRANSACTION.fields if f.name != TARGET])

PREDICTIONS = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("predicted_label", T.IntegerType(), False),
    T.StructField("confidence_score", T.DoubleType(), False),
    T.StructField("model_name", T.StringType(), False),
    T.StructField("model_version", T.StringType(), False),
    T.StructField("predicted_at", T.TimestampType()),
])

FEEDBACK = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("actual_label", T.IntegerType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("confirmed_at", T.TimestampType()),
])

RUNS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("kind", T.StringType(), False),      # param | metric | tag
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.StringType()),
    T.StructField("logged_at", T.TimestampType()),
])

VERSIONS = T.StructType([
    T.StructField("model_name", T.StringType(), False),
    T.StructField("model_version", T.IntegerType(), False),
    T.StructField("run_id", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("path", T.StringType()),
])

ALIASES = T.StructType([
    T.StructField("model_name", T.StringType(), False),
    T.StructField("alias", T.StringType(), False),
    T.StructField("model_version", T.IntegerType()),
    T.StructField("set_at", T.TimestampType(), False),
    T.StructField("seq", T.LongType(), False),
])

TABLES = {
    "transactions": TRANSACTIONS,
    "predictions": PREDICTIONS,
    "fraud_feedback": FEEDBACK,
}
