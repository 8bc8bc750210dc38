"""Current data and on-demand comparison."""
from pyspark.sql import functions as F

from conftest import make_raw
from riskspark.operators.features import ENGINEERED
from riskspark.plans.monitoring import load_current, monitor


def test_current_data_has_the_training_features(spark):
    raw = make_raw(spark, 60).withColumn("transaction_amount", F.when(F.col("transaction_id") == "txn_5", 1e9).otherwise(F.col("transaction_amount")))
    cur = load_current(raw)
    assert set(ENGINEERED) <= set(cur.columns) and cur.count() == 60
    assert cur.agg(F.max("transaction_amount")).first()[0] < 1e9        # clipped to its own bounds
    assert cur.filter(F.abs(F.col("log_transaction_amount") - F.log1p("transaction_amount")) > 1e-12).count() == 0


def test_any_two_sources_can_be_compared(spark, tmp):
    ref = make_raw(spark, 120)
    shifted = make_raw(spark, 120, seed=7, device="desktop").withColumn("transaction_amount", F.col("transaction_amount") + 20_000)
    record, alert = monitor(spark, ref, shifted, out=f"{tmp}/m")
    r = record.first()
    assert r["data_drift"]["drifted_features"] >= 2 and r["prediction_drift"]["available"] is False
    assert r["performance"]["available"] is False and r["target_drift"]["available"] is True
    same, _ = monitor(spark, ref, ref)
    s = same.first()
    assert s["data_drift"]["drifted_features"] == 0 and s["drift_severity"] == "none" and not s["retraining_recommended"]
    assert spark.read.parquet(f"{tmp}/m/drift_runs").count() == 1 and alert.first()["text"]
