"""End to end (TestIntegration): train → promote → score a stream with the
production model → monitor drift with feedback."""
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskspark import schemas as S
from riskspark.operators import bundle as B
from riskspark.operators.registry import Registry
from riskspark.plans.monitoring import run_monitoring
from riskspark.plans.training import TrainingConfig, run_training
from riskspark.sources.derived import Workspace
from riskspark.streaming import jobs as J


def test_config_checks():
    with pytest.raises(ValueError):
        TrainingConfig(query="  ")
    with pytest.raises(ValueError):
        TrainingConfig(query="q", n_trials=0)
    with pytest.raises(ValueError):
        TrainingConfig(query="q", models=["SVM"])


def test_train_score_monitor(spark, tmp):
    ws = Workspace(spark, SF_SMALL)
    tx = ws.transactions()
    raw = tx.withColumn("transaction_time", F.date_format("transaction_time", "yyyy-MM-dd HH:mm:ss"))
    cfg = TrainingConfig(query="derived transactions", models=["LogisticRegression", "RandomForest"])
    res = run_training(spark, raw, cfg, tmp)
    assert res.best in ("LogisticRegression", "RandomForest")
    assert res.results.count() == 2
    reg = Registry(spark, f"{tmp}/registry")
    prod = reg.production_model()
    assert prod == (S.MODEL_PREFIX + res.best, 1)
    assert spark.read.parquet(f"{tmp}/baseline").count() > 0

    # M21 + R1: importance and parameters are logged with the run
    run = reg.versions().filter(F.col("model_name") == prod[0]).first()["run_id"]
    logged = {(r["kind"], r["key"]): r["value"] for r in reg.runs().filter(F.col("run_id") == run).collect()}
    assert sum(k.startswith("shap_top_feature_") for _, k in logged) == 5
    assert {("param", "maxIter"), ("param", "numTrees")} & set(logged) and float(logged["metric", "roc_auc"]) > 0.5
    assert spark.read.option("header", True).csv(f"{tmp}/runs/{run}/shap").count() == len(res.feature_names)

    # The whole evaluation lies with the run
    record = spark.read.json(f"{tmp}/runs/{run}/evaluation").first()
    assert abs(record["roc_auc"] - float(logged["metric", "roc_auc"])) < 1e-6
    assert len(record["report"]) == 5 and record["curve"][-1]["recall"] == 0.0

    # Stream requests through the production bundle, replay-safe
    req = raw.drop(S.TARGET)
    req.repartition(2).write.parquet(f"{tmp}/requests")
    cache = J.ModelCache(reg.production)
    q = J.score_stream(J.read_stream(spark, f"{tmp}/requests", req.schema), cache,
                       f"{tmp}/predictions", f"{tmp}/ck_score")
    q.awaitTermination()
    preds = spark.read.parquet(f"{tmp}/predictions")
    assert preds.count() == req.count()
    assert preds.filter((F.col("confidence_score") < 0) | (F.col("confidence_score") > 1)).count() == 0
    assert preds.filter(F.col("available") & (F.size("top_reasons") == S.TOP_REASONS)).count() == req.count()
    batch = B.score(B.load(res.paths[res.best]), req, keep=["transaction_id"])
    apart = preds.join(batch, "transaction_id").filter((F.abs(F.col("confidence_score") - F.col("score")) > 1e-12)
                                                       | (preds["predicted_label"] != batch["predicted_label"]))
    assert apart.count() == 0

    # monitoring: baseline vs a later day, feedback from the stream's log
    base = spark.read.parquet(f"{tmp}/baseline")
    split = F.lit("2024-01-16").cast("timestamp_ntz")
    ref = base.filter(F.col("transaction_time") < split)
    cur = base.filter(F.col("transaction_time") >= split)
    record, alert = run_monitoring(spark, ref, cur, registry=reg,
                                   predictions=preds.drop("batch_id", "available", "reason", "top_reasons"), feedback=ws.feedback(),
                                   out=f"{tmp}/monitoring")
    r = record.first()
    assert r["drift_severity"] in ("none", "negligible", "serious")
    assert r["prediction_drift"]["available"] is True
    assert r["performance"]["available"] is True
    a = alert.first()
    assert a["text"].splitlines()[1].endswith(f"`{r['drift_severity'].upper()}`")
    assert (a["retraining_triggered"]) == (r["drift_severity"] == "serious")
