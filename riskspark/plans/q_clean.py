"""Queries for cleaning, features and validation (A1-A3, F1-F5, P3, P5-P8,
V1-V3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.operators import clean as CL
from riskspark.operators.features import ENGINEERED, engineer
from riskspark.operators.validate import engineered_rules, failure_cases, raw_rules
from riskspark.plans import inject as I
from riskspark.plans import sql as Q
from riskspark.plans.catalog import query
from riskspark.sources.derived import Workspace

R6 = 6


def _r(c, n=R6):
    return F.round(F.col(c), n).alias(c)


# ---------------------------------------------------------------------------
# features: F1-F5
# ---------------------------------------------------------------------------
@query("features", sql=Q.with_(Q.EV, Q.TX) + f"""
SELECT transaction_id, round(log_transaction_amount, 6) AS log_transaction_amount,
       transaction_year, transaction_month, transaction_day, transaction_hour,
       transaction_day_of_week, round(amount_by_device, 6) AS amount_by_device
FROM (SELECT transaction_id, {Q.FEATURES} FROM tx)""")
def features(spark, sf_dir):
    f = engineer(Workspace(spark, sf_dir).transactions())
    return f.select("transaction_id", _r("log_transaction_amount"), *ENGINEERED[1:6],
                    _r("amount_by_device"))


# ---------------------------------------------------------------------------
# Flagship: clean -> features -> amount and fraud rate by device and weekday
# ---------------------------------------------------------------------------
FLAGSHIP_SQL = Q.with_(Q.EV, Q.TX, """d AS (SELECT DISTINCT * FROM tx)""",
                       """b AS (SELECT quantile_cont(transaction_amount, 0.01) AS lo,
                                       quantile_cont(transaction_amount, 0.99) AS hi FROM d)""",
                       """c AS (SELECT d.* REPLACE (CASE WHEN transaction_amount IS NULL THEN NULL
                                  ELSE least(greatest(transaction_amount, lo), hi) END AS transaction_amount)
                                FROM d, b)""") + f"""
SELECT device_type, transaction_day_of_week,
       count(*) AS n_transactions,
       round(sum(transaction_amount), 6) AS total_amount,
       round(avg(transaction_amount), 6) AS avg_amount,
       round(avg(log_transaction_amount), 6) AS avg_log_amount,
       CAST(sum(is_fraud) AS BIGINT) AS n_fraud,
       round(avg(is_fraud), 6) AS fraud_rate
FROM (SELECT device_type, is_fraud, transaction_amount, {Q.FEATURES} FROM c)
GROUP BY device_type, transaction_day_of_week"""


def flagship(spark, sf_dir):
    tx = Workspace(spark, sf_dir).transactions()
    cleaned, _, _ = CL.clean(tx, validate=False)
    f = engineer(cleaned)
    return (f.groupBy("device_type", "transaction_day_of_week").agg(
        F.count(F.lit(1)).alias("n_transactions"),
        F.round(F.sum("transaction_amount"), R6).alias("total_amount"),
        F.round(F.avg("transaction_amount"), R6).alias("avg_amount"),
        F.round(F.avg("log_transaction_amount"), R6).alias("avg_log_amount"),
        F.sum("is_fraud").cast("long").alias("n_fraud"),
        F.round(F.avg("is_fraud"), R6).alias("fraud_rate")))


query("fraud_by_device_weekday", sql=FLAGSHIP_SQL)(flagship)


# ---------------------------------------------------------------------------
# dedup_clean: A3 + P5 on injected repeats and all-NULL rows
# ---------------------------------------------------------------------------
@query("dedup_clean", sql=Q.with_(Q.EV, Q.TX, f"r AS ({I.repeats_sql()})") + f"""
SELECT DISTINCT * FROM r
WHERE NOT ({' AND '.join(f'{c} IS NULL' for c in I.TX_COLS)})""")
def dedup_clean(spark, sf_dir):
    r = I.with_repeats(Workspace(spark, sf_dir).transactions())
    return CL.drop_all_null(CL.dedup(r))


# ---------------------------------------------------------------------------
# null_share (A1) and null_drop
# ---------------------------------------------------------------------------
@query("null_share", sql=Q.with_(Q.EV, Q.TX, f"n AS (SELECT {I.null_rules_sql()} FROM tx)") + "SELECT " +
       ", ".join(f"round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS {c}"
                 for c in I.TX_COLS) + " FROM n")
def null_share(spark, sf_dir):
    n = I.with_nulls(Workspace(spark, sf_dir).transactions())
    shares = CL.null_shares(n)
    return shares.select(*[_r(c) for c in I.TX_COLS])


def _null_drop_sql() -> str:
    ctes = [Q.EV, Q.TX, f"s0 AS (SELECT {I.null_rules_sql()} FROM tx)"]
    for i, c in enumerate(I.TX_COLS):
        ctes.append(
            f"s{i + 1} AS (SELECT * FROM s{i} WHERE NOT ({c} IS NULL AND "
            f"(SELECT avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) FROM s{i}) > {S.NULL_SHARE_LIMIT}))")
    return Q.with_(*ctes) + f"SELECT * FROM s{len(I.TX_COLS)}"


@query("null_drop", sql=_null_drop_sql())
def null_drop(spark, sf_dir):
    n = I.with_nulls(Workspace(spark, sf_dir).transactions())
    out, _ = CL.drop_sparse_nulls(n)
    return out


# ---------------------------------------------------------------------------
# clip_bounds (A2, P7) and clip_apply (P7 + P8 after the full clean)
# ---------------------------------------------------------------------------
@query("clip_bounds", sql=Q.with_(Q.EV, Q.TX) + """
SELECT round(quantile_cont(transaction_amount, 0.01), 6) AS lower,
       round(quantile_cont(transaction_amount, 0.99), 6) AS upper FROM tx""")
def clip_bounds(spark, sf_dir):
    tx = Workspace(spark, sf_dir).transactions()
    return CL.clip_bounds_df(tx).select(_r("lower"), _r("upper"))


def _clip_apply_sql() -> str:
    ctes = [Q.EV, Q.TX, f"r AS ({I.repeats_sql()})",
            f"d AS (SELECT DISTINCT * FROM r WHERE NOT ({' AND '.join(f'{c} IS NULL' for c in I.TX_COLS)}))",
            f"s0 AS (SELECT {I.null_rules_sql()} FROM d)"]
    for i, c in enumerate(I.TX_COLS):
        ctes.append(
            f"s{i + 1} AS (SELECT * FROM s{i} WHERE NOT ({c} IS NULL AND "
            f"(SELECT avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) FROM s{i}) > {S.NULL_SHARE_LIMIT}))")
    last = f"s{len(I.TX_COLS)}"
    ctes.append(f"""b AS (SELECT quantile_cont(transaction_amount, 0.01) AS lo,
                            quantile_cont(transaction_amount, 0.99) AS hi FROM {last})""")
    return Q.with_(*ctes) + f"""
SELECT transaction_id,
       round(CASE WHEN transaction_amount IS NULL THEN NULL
             ELSE least(greatest(transaction_amount, lo), hi) END, 6) AS transaction_amount,
       device_type, transaction_location
FROM {last}, b"""


@query("clip_apply", sql=_clip_apply_sql())
def clip_apply(spark, sf_dir):
    tx = Workspace(spark, sf_dir).transactions()
    # repeats and all-NULL rows first, then NULLs by rule, then the full clean
    raw = I.with_nulls(CL.drop_all_null(CL.dedup(I.with_repeats(tx))))
    cleaned, _, _ = CL.clean(raw, validate=False)
    return cleaned.select("transaction_id", _r("transaction_amount"), "device_type",
                          "transaction_location")


# ---------------------------------------------------------------------------
# failure_cases: V1-V3 on injected bad values (raw rules), one pass
# ---------------------------------------------------------------------------
def _failure_sql() -> str:
    i = "transaction_id"
    dev = ", ".join(f"'{d}'" for d in S.DEVICE_TYPES)
    isin_label = f"isin({S.DEVICE_TYPES})".replace("'", "''")
    return Q.with_(Q.EV, Q.TX, f"b AS ({I.bad_values_sql()})") + f"""
SELECT {i} AS row_key, 'transaction_amount' AS "column", 'not_nullable' AS "check",
       CAST(NULL AS VARCHAR) AS failure_case FROM b WHERE transaction_amount IS NULL
UNION ALL
SELECT {i}, 'transaction_amount', 'greater_than(0)', CAST(transaction_amount AS VARCHAR)
FROM b WHERE transaction_amount IS NOT NULL AND NOT transaction_amount > 0
UNION ALL
SELECT {i}, 'transaction_time', 'not_nullable', NULL FROM b WHERE transaction_time IS NULL
UNION ALL
SELECT {i}, 'device_type', 'not_nullable', NULL FROM b WHERE device_type IS NULL
UNION ALL
SELECT {i}, 'device_type', '{isin_label}', device_type
FROM b WHERE device_type IS NOT NULL AND device_type NOT IN ({dev})
UNION ALL
SELECT {i}, 'is_fraud', 'not_nullable', NULL FROM b WHERE is_fraud IS NULL
UNION ALL
SELECT {i}, 'is_fraud', 'isin([0, 1])', CAST(is_fraud AS VARCHAR)
FROM b WHERE is_fraud IS NOT NULL AND is_fraud NOT IN (0, 1)"""


@query("failure_cases", sql=_failure_sql())
def failure_case_table(spark, sf_dir):
    b = I.with_bad_values(Workspace(spark, sf_dir).transactions())
    return failure_cases(b, raw_rules(), "transaction_id")


@query("engineered_failures", sql=Q.with_(Q.EV, Q.TX) + f"""
SELECT transaction_id AS row_key, 'transaction_hour' AS "column", 'in_range(0, 23)' AS "check",
       CAST(hour(transaction_time) + 20 AS VARCHAR) AS failure_case
FROM tx WHERE hour(transaction_time) + 20 > 23""")
def engineered_failures(spark, sf_dir):
    """V2: the engineered rules over features whose hour is shifted by 20."""
    f = engineer(Workspace(spark, sf_dir).transactions())
    f = f.withColumn("transaction_hour", F.col("transaction_hour") + 20)
    return failure_cases(f, engineered_rules(), "transaction_id")


# ---------------------------------------------------------------------------
# last_day: P3 with an explicit as-of time (no NOW())
# ---------------------------------------------------------------------------
AS_OF = "2024-01-30 12:00:00"


@query("last_day", sql=Q.with_(Q.EV, Q.TX) + f"""
SELECT transaction_id, transaction_time, round(transaction_amount, 6) AS transaction_amount,
       device_type
FROM tx WHERE transaction_time >= TIMESTAMP '{AS_OF}' - INTERVAL 1 DAY""")
def last_day(spark, sf_dir):
    tx = Workspace(spark, sf_dir).transactions()
    since = F.lit(AS_OF).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY")
    return tx.filter(F.col("transaction_time") >= since).select(
        "transaction_id", "transaction_time", _r("transaction_amount"), "device_type")


# ---------------------------------------------------------------------------
# since_start: P4 + S4, a bound parameter in SQL over the stored table
# ---------------------------------------------------------------------------
START = "2024-01-20 00:00:00"


@query("since_start", sql=Q.with_(Q.EV, Q.TX) + f"""
SELECT device_type, count(*) AS n, round(sum(transaction_amount), 6) AS total_amount
FROM tx WHERE transaction_time > TIMESTAMP '{START}' GROUP BY device_type""")
def since_start(spark, sf_dir):
    from riskspark.sources.readers import read_sql
    Workspace(spark, sf_dir).transactions().createOrReplaceTempView("transactions")
    return read_sql(spark, """
        SELECT device_type, count(*) AS n, round(sum(transaction_amount), 6) AS total_amount
        FROM transactions WHERE transaction_time > CAST(:start AS TIMESTAMP_NTZ)
        GROUP BY device_type""", params={"start": START})
