"""Alert rows and retraining decisions (D15, D16, F11-F13) as column
expressions over the run record, so a table of runs becomes a table of
alerts in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.functions.columns import percent_text, yes_no

# Fixed alert marks of the reference.
SEVERITY_MARK = {"serious": "🚨", "negligible": "⚠️", "none": "✅"}
DEFAULT_MARK = "ℹ️"
LOW_RECALL_LINE = "⚠️ *Recall below 0.70 — model may be missing fraud cases*"
SUNDAY_LINE = "📅 Retraining will run on Sunday midnight schedule."


def _by_severity(sev: Column, table: dict, default: str) -> Column:
    e = None
    for k, v in table.items():
        e = F.when(sev == k, F.lit(v)) if e is None else e.when(sev == k, F.lit(v))
    return e.otherwise(F.lit(default))


def decision(record: DataFrame, severity: str = "drift_severity") -> DataFrame:
    """Retrain now only for serious drift (reason ``serious_drift``);
    negligible waits for the weekly run."""
    sev = F.col(severity)
    return record.select(
        "*",
        (sev == "serious").alias("retraining_triggered"),
        F.when(sev == "serious", F.lit(S.RETRAIN_REASON)).alias("trigger_reason"),
        F.when(sev == "serious", F.lit("immediate"))
         .when(sev == "negligible", F.lit("scheduled")).otherwise(F.lit("none")).alias("action"))


def alert_text(severity: Column, drift_score: Column, target_drift: Column, prediction_drift: Column,
               perf_available: Column, recall: Column, precision: Column, f1: Column,
               low_recall: Column, triggered: Column) -> Column:
    """The message lines joined by newlines."""
    header = _by_severity(severity, S.ALERT_HEADERS, S.ALERT_DEFAULT_HEADER)
    mark = _by_severity(severity, SEVERITY_MARK, DEFAULT_MARK)
    lines = [
        header,
        F.concat(mark, F.lit(" *Severity*: `"), F.upper(severity), F.lit("`")),
        F.concat(F.lit("📊 *Feature drift score*: `"), percent_text(drift_score, 1),
                 F.lit("` of columns drifted")),
        F.concat(F.lit("🎯 *Target drift* (is_fraud): `"), yes_no(target_drift), F.lit("`")),
        F.concat(F.lit("🤖 *Prediction drift*: `"), yes_no(prediction_drift), F.lit("`")),
        F.when(F.coalesce(perf_available, F.lit(False)), F.concat(
            F.lit("📉 *Performance*: recall=`"), percent_text(recall, 2),
            F.lit("` | precision=`"), percent_text(precision, 2),
            F.lit("` | f1=`"), percent_text(f1, 2), F.lit("`"))),
        F.when(F.coalesce(perf_available, F.lit(False)) & F.coalesce(low_recall, F.lit(False)),
               F.lit(LOW_RECALL_LINE)),
        F.concat(F.lit("🔄 *Immediate retraining triggered*: `"),
                 F.when(triggered, F.lit("Yes")).otherwise(F.lit("No")), F.lit("`")),
        F.when((severity == "negligible") & ~triggered, F.lit(SUNDAY_LINE)),
    ]
    return F.concat_ws("\n", *lines)


def alerts(record: DataFrame) -> DataFrame:
    """D15 over D13 records (``riskspark.operators.drift.RESULT_SCHEMA``)."""
    d = decision(record)
    text = alert_text(F.col("drift_severity"), F.col("data_drift.drift_score"),
                      F.col("target_drift.drift_detected"), F.col("prediction_drift.drift_detected"),
                      F.col("performance.available"), F.col("performance.recall"),
                      F.col("performance.precision"), F.col("performance.f1"),
                      F.col("performance.low_recall_detected"), F.col("retraining_triggered"))
    return d.select("run_id", "drift_severity", "retraining_triggered", "trigger_reason", "action",
                    text.alias("text"))
