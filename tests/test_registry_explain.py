"""Registry (R1-R4, W2, J4) and explanations."""
import math

from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.operators import registry as R
from riskspark.operators.explain import (linear_contributions, reasons_long, top_reasons,
                                         unavailable)


def test_versions_promotion_rollback(spark, tmp):
    reg = R.Registry(spark, tmp)
    r1 = reg.log_run(params={"model": "RF"}, metrics={"roc_auc": 0.80})
    v1 = reg.register_version("fraud-RF", r1)
    r2 = reg.log_run(metrics={"roc_auc": 0.90})
    v2 = reg.register_version("fraud-RF", r2)
    assert (v1, v2) == (1, 2)
    assert reg.promote("fraud-RF", v1)
    assert reg.promote("fraud-RF", v2)
    assert reg.alias_version("fraud-RF", S.PRODUCTION) == 2
    assert reg.alias_version("fraud-RF", S.PREVIOUS_PRODUCTION) == 1
    assert reg.rollback("fraud-RF") == 1
    assert reg.alias_version("fraud-RF", S.PRODUCTION) == 1
    latest = R.latest_versions(reg.versions()).first()
    assert latest["model_version"] == 2
    held = R.version_by_alias(reg.aliases(), reg.versions()).first()
    assert held["model_version"] == 1 and held["run_id"] == r1
    assert reg.production_model() == ("fraud-RF", 1)


def test_promotion_gate(spark, tmp):
    reg = R.Registry(spark, tmp)
    v1 = reg.register_version("m", reg.log_run(metrics={"roc_auc": 0.9}))
    v2 = reg.register_version("m", reg.log_run(metrics={"roc_auc": 0.8}))
    reg.promote("m", v1)
    assert not reg.promote("m", v2, require_improvement=True)
    assert reg.alias_version("m") == 1
    assert reg.promote("m", v2)                     # the reference's unconditional promotion


def test_promotion_events(spark):
    best = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "a", 3)],
                                 "period int, model_name string, model_version int")
    cur = {(r["model_name"], r["alias"]): r["model_version"]
           for r in R.current_aliases(R.promotion_events(best)).collect()}
    assert cur == {("a", "production"): 3, ("a", "previous-production"): 1, ("b", "production"): 1}


def test_audit(spark):
    preds = spark.createDataFrame([("t1", "m", 1, 0.9)], "transaction_id string, model_name string, "
                                  "model_version int, score double")
    vers = spark.createDataFrame([("m", 1, "r1", None, None)], S.VERSIONS)
    runs = spark.createDataFrame([("r1", "metric", "roc_auc", "0.93", None)], S.RUNS)
    row = R.audit(preds, vers, runs, ["roc_auc"]).first()
    assert row["run_id"] == "r1" and row["roc_auc"] == 0.93


def test_top_reasons_order_rounding_direction(spark):
    names = [f"f{i}" for i in range(12)]
    vals = [0.0, -0.5, 0.5, 0.123456, -2.0, 0.00005, 1.0, -1.0, 0.3, 0.2, 0.1, 0.01]
    df = spark.createDataFrame([("t", vals)], "transaction_id string, c array<double>")
    long = reasons_long(df.select("transaction_id", top_reasons(F.col("c"), names).alias("top_reasons")))
    got = [(r["feature"], r["impact"], r["direction"]) for r in long.orderBy("rank").collect()]
    assert len(got) == 10
    assert [g[0] for g in got[:5]] == ["f4", "f6", "f7", "f1", "f2"]       # |2| |1| |-1| ties keep order
    assert got[0] == ("f4", -2.0, "away_from_fraud")
    d = dict((g[0], g) for g in got)
    assert d["f3"][1] == 0.1235 and d["f2"][2] == "toward_fraud"


def test_linear_contributions_are_additive(spark):
    w, mean = [0.5, -1.0, 2.0], [1.0, 2.0, 3.0]
    df = spark.createDataFrame([([2.0, 0.0, 4.0],)], "x array<double>")
    c = df.select(linear_contributions(F.col("x"), w, mean).alias("c")).first()["c"]
    assert c == [0.5, 2.0, 2.0]
    assert math.isclose(sum(c), sum(wi * (xi - mi) for wi, xi, mi in zip(w, [2.0, 0.0, 4.0], mean)))


def test_unavailable_explainer(spark):
    df = spark.createDataFrame([("t",)], "transaction_id string")
    r = unavailable(df, "explainer not loaded").first()
    assert r["available"] is False and r["top_reasons"] is None
