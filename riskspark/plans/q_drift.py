"""Drift queries (D1-D12) on engineered transactions split in time:
reference = before 2024-01-16, current = the rest. Both sides carry the rule
model's prediction as ``predicted_fraud`` (D10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.operators import drift as D
from riskspark.operators.features import engineer
from riskspark.operators.join import feedback_join, performance
from riskspark.plans import sql as Q
from riskspark.plans.catalog import query
from riskspark.sources.derived import Workspace

SPLIT_AT = "2024-01-16 00:00:00"

NUM_COLS = ["transaction_amount", "previous_transactions_count", "is_fraud",
            "log_transaction_amount", "transaction_year", "transaction_month", "transaction_day",
            "transaction_hour", "transaction_day_of_week", "amount_by_device", "predicted_fraud"]
CAT_COLS = ["transaction_type", "transaction_location", "device_type"]


def frames(spark, sf_dir):
    ws = Workspace(spark, sf_dir)
    f = engineer(ws.transactions())
    p = ws.predictions().select("transaction_id", F.col("predicted_label").alias("predicted_fraud"))
    f = f.join(p, "transaction_id")
    split = F.lit(SPLIT_AT).cast("timestamp_ntz")
    return f.filter(F.col("transaction_time") < split), f.filter(F.col("transaction_time") >= split)


def _r(c, n=6):
    return F.round(F.col(c), n).alias(c)


# ---------------------------------------------------------------------------
# SQL twins
# ---------------------------------------------------------------------------
_F = f"""f AS (SELECT t.*, {Q.FEATURES}, p.predicted_label AS predicted_fraud,
  CASE WHEN transaction_time < TIMESTAMP '{SPLIT_AT}' THEN 1 ELSE 0 END AS _ref
  FROM tx t JOIN pred p USING (transaction_id))"""
_NUML = ("nl AS (UNPIVOT (SELECT _ref, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUM_COLS)
         + " FROM f) ON " + ", ".join(NUM_COLS) + ' INTO NAME "column" VALUE value)')
_CATL = ("sl AS (UNPIVOT (SELECT _ref, " + ", ".join(CAT_COLS) + " FROM f) ON "
         + ", ".join(CAT_COLS) + ' INTO NAME "column" VALUE value)')
_NCNT = """nc AS (SELECT "column", value, sum(_ref) AS n_ref, sum(1 - _ref) AS n_cur FROM nl GROUP BY ALL)"""
_SCNT = """scn AS (SELECT "column", value, sum(_ref) AS n_ref, sum(1 - _ref) AS n_cur FROM sl GROUP BY ALL)"""
_NTOT = """nt AS (SELECT "column", sum(n_ref) AS tot_ref, sum(n_cur) AS tot_cur,
                  sum(CASE WHEN n_ref > 0 THEN 1 ELSE 0 END) AS nun FROM nc GROUP BY 1)"""
_STOT = """st AS (SELECT "column", sum(n_ref) AS tot_ref, sum(n_cur) AS tot_cur,
                  sum(CASE WHEN n_ref > 0 THEN 1 ELSE 0 END) AS nun FROM scn GROUP BY 1)"""
_CDF = """cdf AS (SELECT "column", value, n_ref, n_cur,
  sum(n_ref) OVER w / tot_ref AS fr, sum(n_cur) OVER w / tot_cur AS fc,
  lead(value) OVER (PARTITION BY "column" ORDER BY value) AS next_v
  FROM nc JOIN nt USING ("column")
  WINDOW w AS (PARTITION BY "column" ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
_CAT = """cat AS (
  SELECT "column", n_ref, n_cur, tot_ref, tot_cur FROM nc JOIN nt USING ("column") WHERE nun <= 5
  UNION ALL SELECT "column", n_ref, n_cur, tot_ref, tot_cur FROM scn JOIN st USING ("column"))"""
_JS = """js AS (SELECT "column", sqrt(greatest(sum(
    (CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END)
  + (CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END)) / 2, 0)) AS js
  FROM (SELECT "column", n_ref / tot_ref AS p, n_cur / tot_cur AS q FROM cat) GROUP BY 1)"""
_WS = """ws AS (SELECT "column", sum(abs(fr - fc) * coalesce(next_v - value, 0)) AS w FROM cdf GROUP BY 1)"""
_STD = """sd AS (SELECT "column", stddev_pop(value) AS s FROM nl WHERE _ref = 1 GROUP BY 1)"""
_BASE = [Q.EV, Q.TX, Q.PRED, _F, _NUML, _CATL, _NCNT, _SCNT, _NTOT, _STOT]


def _num_stats(spark, sf_dir):
    """KS and Wasserstein inputs from one checkpointed pass over the rows
    (the running counts and the reference std both read the counts)."""
    ref, cur = frames(spark, sf_dir)
    ncounts, _ = D.value_counts_both(ref, cur, NUM_COLS, [])
    return D.numeric_stats(ref, cur, NUM_COLS, ncounts) \
        .filter(F.col("nunique_ref") > S.DRIFT_CATEGORY_MAX_VALUES)


@query("drift_ks", sql=Q.with_(*_BASE, _CDF) + """
SELECT "column", round(max(abs(fr - fc)), 6) AS ks_d,
       CAST(max(tot_ref) AS BIGINT) AS n_ref, CAST(max(tot_cur) AS BIGINT) AS n_cur
FROM cdf JOIN nt USING ("column") WHERE nun > 5 GROUP BY 1""")
def drift_ks(spark, sf_dir):
    s = _num_stats(spark, sf_dir)
    return s.select("column", _r("ks_d"), F.col("tot_ref").cast("long").alias("n_ref"),
                    F.col("tot_cur").cast("long").alias("n_cur"))


@query("drift_wasserstein", sql=Q.with_(*_BASE, _CDF, _WS, _STD) + """
SELECT "column", round(w / greatest(s, 0.001), 6) AS wasserstein_norm
FROM ws JOIN sd USING ("column") JOIN nt USING ("column") WHERE nun > 5""")
def drift_wasserstein(spark, sf_dir):
    s = _num_stats(spark, sf_dir)
    norm = F.col("wasserstein") / F.greatest(F.col("ref_std"), F.lit(S.WASSERSTEIN_STD_FLOOR))
    return s.select("column", F.round(norm, 6).alias("wasserstein_norm"))


def _cat_stats(spark, sf_dir):
    ref, cur = frames(spark, sf_dir)
    # one pass over the rows for both kinds; the statistics read the counts
    ncounts, scounts = D.value_counts_both(ref, cur, NUM_COLS, CAT_COLS)
    few = [r["column"] for r in D.nunique_ref(ncounts)
           .filter(F.col("nunique_ref") <= S.DRIFT_CATEGORY_MAX_VALUES).collect()]
    s = D.categorical_stats(ref, cur, CAT_COLS, counts=scounts)
    if few:
        s = s.unionByName(D.categorical_stats(ref, cur, few, "double", ncounts))
    return s


@query("drift_js", sql=Q.with_(*_BASE, _CAT, _JS) + """
SELECT "column", round(js, 6) AS js FROM js""")
def drift_js(spark, sf_dir):
    return _cat_stats(spark, sf_dir).select("column", _r("js"))


@query("drift_chi2", sql=Q.with_(*_BASE, _CAT) + """
SELECT "column", round(sum(CASE WHEN n_ref = 0 THEN (CASE WHEN n_cur > 0 THEN 'inf'::DOUBLE ELSE 0 END)
       ELSE power(n_cur - n_ref * (tot_cur / tot_ref), 2) / (n_ref * (tot_cur / tot_ref)) END), 6) AS chi2,
       CAST(count(*) - 1 AS BIGINT) AS chi2_dof
FROM cat GROUP BY 1""")
def drift_chi2(spark, sf_dir):
    return _cat_stats(spark, sf_dir).select("column", _r("chi2"), F.col("chi2_dof").cast("long"))


_PER = f"""per AS (
  SELECT "column", 'wasserstein' AS stattest, w / greatest(s, 0.001) AS statistic
  FROM ws JOIN sd USING ("column") JOIN nt USING ("column") WHERE nun > 5
  UNION ALL SELECT "column", 'jensenshannon', js FROM js)"""
_SUMMARY = Q.with_(*_BASE, _CDF, _WS, _STD, _CAT, _JS, _PER)


@query("drift_summary", sql=_SUMMARY + f"""
SELECT "column", stattest, round(statistic, 6) AS statistic,
       statistic >= {S.DRIFT_DISTANCE_THRESHOLD} AS drifted FROM per""")
def drift_summary(spark, sf_dir):
    ref, cur = frames(spark, sf_dir)
    per = D.column_drift(ref, cur, method="distance")
    return per.select("column", "stattest", _r("statistic"), "drifted")


@query("dataset_drift", sql=_SUMMARY + f"""
SELECT CAST(count(*) AS BIGINT) AS number_of_columns,
       CAST(sum(CASE WHEN statistic >= {S.DRIFT_DISTANCE_THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT)
         AS number_of_drifted_columns,
       round(avg(CASE WHEN statistic >= {S.DRIFT_DISTANCE_THRESHOLD} THEN 1.0 ELSE 0.0 END), 6)
         AS share_of_drifted_columns,
       avg(CASE WHEN statistic >= {S.DRIFT_DISTANCE_THRESHOLD} THEN 1.0 ELSE 0.0 END)
         >= {S.DATASET_DRIFT_SHARE} AS dataset_drift
FROM per""")
def dataset_drift(spark, sf_dir):
    ref, cur = frames(spark, sf_dir)
    s = D.dataset_summary(D.column_drift(ref, cur, method="distance"))
    return s.select("number_of_columns", "number_of_drifted_columns",
                    _r("share_of_drifted_columns"), "dataset_drift")


def _severity_row(spark, sf_dir):
    """One row: drift share and flags, the feedback performance (one pass
    over the prediction-feedback join) and the severity."""
    ref, cur = frames(spark, sf_dir)
    per = D.column_drift(ref, cur, method="distance")
    d = per.agg(
        F.avg(F.col("drifted").cast("double")).alias("share"),
        F.max(F.when(F.col("column") == S.TARGET, F.col("drifted"))).alias("target_drift"),
        F.max(F.when(F.col("column") == S.PREDICTION_COLUMN, F.col("drifted"))).alias("prediction_drift"))
    ws = Workspace(spark, sf_dir)
    perf = performance(feedback_join(ws.predictions(), ws.feedback(), ordered=False))
    j = d.withColumn("_k", F.lit(1)).join(perf.withColumn("_k", F.lit(1)), "_k").drop("_k")
    sev = D.severity_expr(F.col("share"), F.col("prediction_drift"), F.col("target_drift"),
                          F.col("recall"))
    return j.withColumn("drift_severity", sev)


@query("severity", sql=Q.with_(*_BASE, Q.FB, _CDF, _WS, _STD, _CAT, _JS, _PER) + f""",
d AS (SELECT avg(CASE WHEN statistic >= {S.DRIFT_DISTANCE_THRESHOLD} THEN 1.0 ELSE 0.0 END) AS share,
             bool_or(CASE WHEN "column" = 'is_fraud' THEN statistic >= {S.DRIFT_DISTANCE_THRESHOLD} END) AS target_drift,
             bool_or(CASE WHEN "column" = 'predicted_fraud' THEN statistic >= {S.DRIFT_DISTANCE_THRESHOLD} END)
               AS prediction_drift FROM per),
c AS (SELECT sum(CASE WHEN f.actual_label = 1 AND p.predicted_label = 1 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN f.actual_label = 1 AND p.predicted_label = 0 THEN 1 ELSE 0 END) AS fn
      FROM pred p JOIN fb f USING (transaction_id)),
r AS (SELECT CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall FROM c)
SELECT round(share, 6) AS share_of_drifted_columns, target_drift, prediction_drift,
       round(recall, 6) AS recall,
       CASE WHEN share >= {S.SERIOUS_DRIFT_THRESHOLD} OR coalesce(prediction_drift, false)
                 OR coalesce(target_drift, false) OR coalesce(recall < {S.LOW_RECALL_THRESHOLD}, false)
            THEN 'serious' WHEN share >= {S.NEGLIGIBLE_DRIFT_THRESHOLD} THEN 'negligible'
            ELSE 'none' END AS drift_severity,
       (share >= {S.SERIOUS_DRIFT_THRESHOLD} OR coalesce(prediction_drift, false)
        OR coalesce(target_drift, false) OR coalesce(recall < {S.LOW_RECALL_THRESHOLD}, false))
         AS retraining_recommended
FROM d, r""")
def severity(spark, sf_dir):
    row = _severity_row(spark, sf_dir)
    return row.select(F.round("share", 6).alias("share_of_drifted_columns"), "target_drift",
                      "prediction_drift", F.round("recall", 6).alias("recall"), "drift_severity",
                      (F.col("drift_severity") == "serious").alias("retraining_recommended"))


# ---------------------------------------------------------------------------
# Alert text and decision (D15, D16) over the severity row
# ---------------------------------------------------------------------------
def _alert_sql() -> str:
    from riskspark.operators.alerts import LOW_RECALL_LINE, SEVERITY_MARK, SUNDAY_LINE
    from riskspark.plans.catalog import ORACLES
    hdr = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.ALERT_HEADERS.items())
    mark = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SEVERITY_MARK.items())
    yn = "(CASE WHEN {0} IS NULL THEN 'Not measured' WHEN {0} THEN 'Yes' ELSE 'No' END)"
    return f"""WITH sev AS ({ORACLES['severity']}),
perf AS ({ORACLES['feedback_performance']})
SELECT drift_severity, retraining_recommended AS retraining_triggered,
  CASE WHEN drift_severity = 'serious' THEN '{S.RETRAIN_REASON}' END AS trigger_reason,
  concat_ws(chr(10),
    CASE drift_severity {hdr} ELSE '{S.ALERT_DEFAULT_HEADER}' END,
    (CASE drift_severity {mark} ELSE 'ℹ️' END) || ' *Severity*: `' || upper(drift_severity) || '`',
    '📊 *Feature drift score*: `' || printf('%.1f%%', share_of_drifted_columns * 100) || '` of columns drifted',
    '🎯 *Target drift* (is_fraud): `' || {yn.format('target_drift')} || '`',
    '🤖 *Prediction drift*: `' || {yn.format('prediction_drift')} || '`',
    CASE WHEN available THEN '📉 *Performance*: recall=`' || printf('%.2f%%', perf.recall * 100)
      || '` | precision=`' || printf('%.2f%%', precision * 100) || '` | f1=`' || printf('%.2f%%', f1 * 100)
      || '`' END,
    CASE WHEN available AND low_recall_detected THEN '{LOW_RECALL_LINE}' END,
    '🔄 *Immediate retraining triggered*: `' || (CASE WHEN retraining_recommended THEN 'Yes' ELSE 'No' END) || '`',
    CASE WHEN drift_severity = 'negligible' AND NOT retraining_recommended THEN '{SUNDAY_LINE}' END
  ) AS text
FROM sev, perf"""


def alert_row(spark, sf_dir):
    """D15/D16 from the severity row and the feedback performance."""
    from riskspark.operators.alerts import alert_text
    # the severity row already carries the performance: the join runs once
    j = _severity_row(spark, sf_dir).select(
        "drift_severity", F.round("share", 6).alias("share_of_drifted_columns"), "target_drift",
        "prediction_drift", "available", _r("recall"), _r("precision"), _r("f1"),
        "low_recall_detected",
        (F.col("drift_severity") == "serious").alias("retraining_recommended"))
    trig = F.col("retraining_recommended")
    text = alert_text(F.col("drift_severity"), F.col("share_of_drifted_columns"), F.col("target_drift"),
                      F.col("prediction_drift"), F.col("available"), F.col("recall"), F.col("precision"),
                      F.col("f1"), F.col("low_recall_detected"), trig)
    return j.select("drift_severity", trig.alias("retraining_triggered"),
                    F.when(F.col("drift_severity") == "serious", F.lit(S.RETRAIN_REASON)).alias("trigger_reason"),
                    text.alias("text"))
