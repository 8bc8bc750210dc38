"""SQL building blocks for the DuckDB oracles: the derived tables written in
SQL, mirroring ``sources/derived.py``."""

from riskspark import schemas as S

_LOC = ", ".join(f"'{v}'" for v in S.LOCATIONS)
_DEV = ", ".join(f"'{v}'" for v in S.DEVICE_TYPES)
_SRC = ", ".join(f"'{v}'" for v in S.FEEDBACK_SOURCES)

EV = """ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
)"""

TX = f"""tx AS (
  SELECT 'txn_' || CAST(event_id AS VARCHAR) AS transaction_id,
         'cust_' || CAST(user_id AS VARCHAR) AS customer_id,
         value AS transaction_amount,
         event_type AS transaction_type,
         ts AS transaction_time,
         ([{_LOC}])[k % 7 + 1] AS transaction_location,
         ([{_DEV}])[k % 4 + 1] AS device_type,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER)
           AS previous_transactions_count,
         CAST(CASE WHEN event_type = 'error' AND k < 50 THEN 1 ELSE 0 END AS INTEGER) AS is_fraud
  FROM ev
)"""


def rule_score(w_err: int = 40, k_mod: int = 37, v_mod: int = 23) -> str:
    return (f"(CAST((CASE WHEN event_type = 'error' THEN {w_err} ELSE 0 END) + k % {k_mod} "
            f"+ CAST(floor(value) AS BIGINT) % {v_mod} AS DOUBLE) / 100.0)")


PRED = f"""pred AS (
  SELECT 'txn_' || CAST(event_id AS VARCHAR) AS transaction_id,
         CAST(CASE WHEN {rule_score()} > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS predicted_label,
         {rule_score()} AS confidence_score,
         'fraud-RuleScore' AS model_name, '1' AS model_version, ts AS predicted_at
  FROM ev
)"""

FB = f"""fb AS (
  SELECT 'txn_' || CAST(event_id AS VARCHAR) AS transaction_id,
         CAST(CASE WHEN event_type = 'error' AND k < 50 THEN 1 ELSE 0 END AS INTEGER) AS actual_label,
         ([{_SRC}])[k % 3 + 1] AS source,
         ts + to_days(CAST(k % 7 + 1 AS INTEGER)) AS confirmed_at
  FROM ev WHERE event_id % 10 < 3
  UNION ALL
  SELECT 'txn_' || CAST(event_id AS VARCHAR),
         CAST(CASE WHEN event_type = 'error' AND k < 50 THEN 1 ELSE 0 END AS INTEGER),
         'manual_review', ts + to_days(10)
  FROM ev WHERE event_id % 50 = 0
)"""

# Engineered features over a frame named ``src`` with the transaction columns.
FEATURES = """
  ln(1 + transaction_amount) AS log_transaction_amount,
  CAST(year(transaction_time) AS INTEGER) AS transaction_year,
  CAST(month(transaction_time) AS INTEGER) AS transaction_month,
  CAST(day(transaction_time) AS INTEGER) AS transaction_day,
  CAST(hour(transaction_time) AS INTEGER) AS transaction_hour,
  CAST(isodow(transaction_time) - 1 AS INTEGER) AS transaction_day_of_week,
  transaction_amount * (CASE WHEN device_type = 'mobile' THEN 1 ELSE 0 END) AS amount_by_device"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def idnum(col: str = "transaction_id") -> str:
    return f"CAST(substr({col}, 5) AS BIGINT)"


def scored(models: dict | None = None) -> str:
    """SQL twin of ``derived.scored_events``."""
    models = models or {"rule_a": (40, 37, 23)}
    parts = []
    for name, (a, b, c) in models.items():
        s = rule_score(a, b, c)
        parts.append(
            f"SELECT '{name}' AS model, 'txn_' || CAST(event_id AS VARCHAR) AS transaction_id, "
            f"ts AS scored_at, "
            f"CAST(CASE WHEN event_type = 'error' AND k < 50 THEN 1 ELSE 0 END AS INTEGER) AS label, "
            f"{s} AS score, CAST(CASE WHEN {s} > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS pred FROM ev")
    return "sc AS (" + " UNION ALL ".join(parts) + ")"
