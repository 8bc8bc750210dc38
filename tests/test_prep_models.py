"""Preparation and models (TestPreprocessingCorrectness, TestModelConfig,
TestValidator, TestInference, TestFalseNegatives, TestIntegration)."""
import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import make_raw
from riskspark.operators import prep as P
from riskspark.operators.calibrate import apply_isotonic, fit_isotonic
from riskspark.operators.clean import clean
from riskspark.operators.features import engineer
from riskspark.operators.models import MODEL_REGISTRY, best_model, estimator, fit, importance, score, spec


def _engineered(spark, n=200, ratio=0.1):
    c, _, _ = clean(make_raw(spark, n, ratio))
    return engineer(c)


def test_split_shares_and_stability(spark):
    df = spark.range(5000).select(F.concat(F.lit("txn_"), F.col("id").cast("string")).alias("transaction_id"))
    a = {r["split"]: r["count"] for r in P.split(df).groupBy("split").count().collect()}
    assert 0.15 < a["test"] / 5000 < 0.25 and 0.05 < a["val"] / 5000 < 0.11
    b = {r["split"]: r["count"] for r in P.split(df.repartition(7)).groupBy("split").count().collect()}
    assert a == b


def test_exact_split_sizes(spark):
    df = spark.range(1001).select(F.concat(F.lit("txn_"), F.col("id").cast("string")).alias("transaction_id"))
    c = {r["split"]: r["count"] for r in P.split(df, exact=True).groupBy("split").count().collect()}
    n_test = math.ceil(0.2 * 1001)
    n_val = math.ceil(0.1 * (1001 - n_test))
    assert c == {"test": n_test, "val": n_val, "train": 1001 - n_test - n_val}


def test_median_even_count_and_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "x double")
    assert P.medians(df, ["x"])["x"] == 3.0
    sqlt, fitted = P.fit_impute_scale(df, ["x"], [])
    vals = [1.0, 2.0, 4.0, 10.0, 3.0]
    mean = sum(vals) / 5
    std = math.sqrt(sum((v - mean) ** 2 for v in vals) / 5)
    assert math.isclose(fitted["mean"]["x"], mean) and math.isclose(fitted["std"]["x"], std)
    out = sorted(r[0] for r in sqlt.transform(df).select("x__scaled").collect())
    assert math.isclose(out[0], (1.0 - mean) / std)


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "c string")
    r = P.modes(df, ["c"]).first()
    assert r["mode"] == "a" and r["n"] == 2


def test_one_hot_unseen_is_zero(spark):
    train = spark.createDataFrame([("mobile",), ("desktop",)], "device_type string")
    model, names = P.fit_preprocessor(train, [], ["device_type"])
    assert names == ["device_type_desktop", "device_type_mobile"]
    new = spark.createDataFrame([("tablet",), ("mobile",)], "device_type string")
    got = {r["device_type"]: r["v"] for r in model.transform(new)
           .select("device_type", vector_to_array("features").alias("v")).collect()}
    assert got["tablet"] == [0.0, 0.0] and got["mobile"] == [0.0, 1.0]


def test_model_table():
    assert list(MODEL_REGISTRY) == ["RandomForest", "XGBoost", "LogisticRegression"]
    assert spec("RandomForest").supports_feature_importance and not spec("LogisticRegression").supports_feature_importance
    assert all(spec(m).supports_predict_proba for m in MODEL_REGISTRY)
    assert estimator("RandomForest") is not estimator("RandomForest")
    with pytest.raises(ValueError, match="SVM"):
        estimator("SVM")


def test_forest_catches_fraud_and_scores_are_probabilities(spark, tmp):
    df = P.split(_engineered(spark, 200, 0.3))
    num, cat = P.feature_columns(df)
    prep, names = P.fit_preprocessor(df, num, cat)
    m = fit("RandomForest", prep, df, numTrees=20)
    s = score(m, df, keep=["transaction_id", "is_fraud"])
    r = s.agg(F.min("score"), F.max("score"), F.count(F.lit(1)),
              F.sum(((F.col("is_fraud") == 1) & (F.col("predicted_label") == 1)).cast("int")),
              F.sum("is_fraud")).first()
    assert 0.0 <= r[0] <= r[1] <= 1.0 and r[2] == 200
    assert r[3] / r[4] >= 0.60                                  # recall on the training rows
    assert set(x[0] for x in s.select("predicted_label").distinct().collect()) <= {0, 1}
    m.write().overwrite().save(f"{tmp}/m")
    again = score(PipelineModel.load(f"{tmp}/m"), df, keep=["transaction_id"])
    a = {r[0]: r[1] for r in s.select("transaction_id", "score").collect()}
    b = {r[0]: r[1] for r in again.select("transaction_id", "score").collect()}
    assert a == b
    imp = importance(m, names, "RandomForest").collect()
    assert len(imp) == len(names) and imp[0]["importance"] >= imp[-1]["importance"]


def test_single_class_completes(spark):
    df = _engineered(spark, 60, 0.1).withColumn("is_fraud", F.lit(0))
    num, cat = P.feature_columns(df)
    prep, _ = P.fit_preprocessor(df, num, cat)
    s = score(fit("LogisticRegression", prep, df), df)
    assert s.count() == 60


def test_calibration_is_monotone(spark):
    rows = [(i / 100.0, 1 if i % 3 == 0 or i > 80 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "score double, label int")
    iso = fit_isotonic(df)
    cal = sorted((r["raw"], r["score"]) for r in
                 apply_isotonic(iso, df.withColumn("raw", F.col("score"))).collect())
    assert all(b[1] >= a[1] for a, b in zip(cal, cal[1:]))
    assert all(0.0 <= c <= 1.0 for _, c in cal)


def test_best_model_by_metric_and_ties(spark):
    res = spark.createDataFrame([("RandomForest", 0.91, 0.8), ("XGBoost", 0.94, 0.7),
                                 ("LogisticRegression", 0.85, 0.9)], "model string, roc_auc double, recall double")
    assert best_model(res).first()["model"] == "XGBoost"
    assert best_model(res, "recall").first()["model"] == "LogisticRegression"
    tie = spark.createDataFrame([("LogisticRegression", 0.9), ("RandomForest", 0.9)], "model string, roc_auc double")
    assert best_model(tie).first()["model"] == "RandomForest"


@pytest.mark.parametrize("n", [1_500, 100_000])
def test_every_category_is_encoded(spark, n):
    from riskspark.operators import categories as C
    df = spark.range(n + 200).select(F.col("id"), F.concat(F.lit("c"), (F.col("id") % n).cast("string")).alias("c"),
                                     F.when(F.col("id") % 3 == 0, None).otherwise(F.lit("x")).alias("d"))
    d = C.dictionary(df, ["c", "d"])
    assert d.agg(F.count(F.lit(1)), F.min("position"), F.max("position"), F.countDistinct("position")).first()[:] == (n + 1, 0, n, n + 1)
    names = sorted(f"c{i}" for i in range(n))
    some = {r["value"]: r["position"] for r in d.filter("position % 997 = 0").collect()}
    assert all(names[p] == v for v, p in some.items() if v != "x")
    new = df.unionByName(spark.createDataFrame([(-1, "unseen", "x"), (-2, None, None)], "id long, c string, d string"))
    e = {r["id"]: r for r in C.encode(new, d, ["c", "d"], "id").filter("id < 50 OR id >= " + str(n)).collect()}
    at = {v: i for i, v in enumerate(names)} if n == 1_500 else None
    assert e[-1]["indices"] == [n] and e[-2]["indices"] == [] and e[-2]["size"] == n + 1
    for i, r in e.items():
        if i >= 0:
            assert len(r["indices"]) == (1 if i % 3 == 0 else 2) and r["values"] == [1.0] * len(r["indices"])
            assert (i % 3 == 0) or r["indices"][-1] == n
            if at:
                assert r["indices"][0] == at[f"c{i % n}"]


def test_preparation_without_a_cap_on_categories(spark):
    df = spark.range(1_300).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("c"))
    model, names = P.fit_preprocessor(df, [], ["c"])
    assert len(names) == 1_300 and model.transform(df).select("features").first()[0].size == 1_300
    with pytest.raises(ValueError, match="1300 categories"):
        P.fit_preprocessor(df, [], ["c"], max_categories=1_000)
