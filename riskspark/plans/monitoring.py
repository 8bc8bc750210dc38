"""The monitoring flow (reference lifecycle 3.3, D10-D17).

baseline + current (features, no scaling) → score both sides with the
production model if there is one (D10) → drift report (D1-D9) → feedback
join and performance (D11) → severity and record (D12, D13) → decision and
alert rows (D15, D16). ``monitor`` compares any two frames on demand (D17).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.operators import bundle as B
from riskspark.operators import drift as D
from riskspark.operators.alerts import alerts
from riskspark.operators.clean import clean
from riskspark.operators.features import engineer
from riskspark.operators.join import feedback_join, performance
from riskspark.operators.registry import Registry


def load_current(raw: DataFrame, validate: bool = False) -> DataFrame:
    """The training feature engineering on fresh rows. The clip bounds
    computed here are not saved (C6)."""
    cleaned, _, _ = clean(raw, validate=validate)
    return engineer(cleaned)


def score_for_drift(ref: DataFrame, cur: DataFrame, registry: Registry | None,
                    target: str = S.TARGET) -> tuple[DataFrame, DataFrame]:
    """Add ``predicted_fraud`` to both sides with the bundle in
    production (its calibration and threshold); unchanged if there is none.
    The rows themselves stay as they are: the bundle's own clip only concerns
    the score."""
    if registry is None:
        return ref, cur
    prod = registry.production()
    if prod is None:
        return ref, cur
    bundle = B.load(prod[2])

    def add(df):
        scored = bundle.transform(df.withColumn("_row", F.struct(*df.columns)))
        return scored.select("_row.*", F.col(B.LABEL).alias(S.PREDICTION_COLUMN))

    return add(ref), add(cur)


def performance_dict(predictions: DataFrame | None, feedback: DataFrame | None) -> dict:
    if predictions is None or feedback is None:
        return {"available": False, "reason": "No feedback data yet"}
    r = performance(feedback_join(predictions, feedback, ordered=False)).first()
    if r is None or not r["available"]:
        return {"available": False, "reason": "No feedback data yet"}
    return {"available": True, "precision": r["precision"], "recall": r["recall"], "f1": r["f1"],
            "low_recall_detected": r["low_recall_detected"]}


def run_monitoring(spark: SparkSession, reference: DataFrame, current: DataFrame,
                   registry: Registry | None = None, predictions: DataFrame | None = None,
                   feedback: DataFrame | None = None, include_performance: bool = True,
                   method: str = "auto", include_ids: bool = False,
                   out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """One monitoring run: returns (record, alert) rows; appended under
    ``out`` when given."""
    ref, cur = score_for_drift(reference, current, registry)
    rep = D.drift_report(ref, cur, method=method, include_ids=include_ids)
    perf = performance_dict(predictions, feedback) if include_performance else \
        {"available": False, "reason": "Not requested"}
    record = D.run_record(spark, rep, perf, uuid.uuid4().hex)
    alert = alerts(record)
    if out:
        record.write.mode("append").parquet(f"{out.rstrip('/')}/drift_runs")
        alert.write.mode("append").parquet(f"{out.rstrip('/')}/alerts")
    return record, alert


def monitor(spark: SparkSession, reference_raw: DataFrame, current_raw: DataFrame,
            **kwargs) -> tuple[DataFrame, DataFrame]:
    """Compare any two sources on demand (both engineered the same way)."""
    return run_monitoring(spark, load_current(reference_raw), load_current(current_raw), **kwargs)
