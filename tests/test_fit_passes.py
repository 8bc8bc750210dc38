"""Fitting reads its rows once, not once a pass (findings F4-F8)."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators import models, prep
from riskspark.operators.models import estimator, fit
from riskspark.operators.tuning import tune
from riskspark.sources import derived


def counted(spark, rows=240):
    """A frame with a column that counts how often its rows are worked out."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf(T.DoubleType())
    def value(i):
        seen.add(1)
        return float(i % 17)

    df = spark.range(0, rows, 1, 2).select(
        F.concat(F.lit("txn_"), F.col("id")).alias("transaction_id"), value("id").alias("a"),
        (F.col("id") % 7).cast("double").alias("b"), F.concat(F.lit("c"), F.col("id") % 3).alias("c"),
        (F.col("id") % 5 == 0).cast("int").alias("is_fraud"))
    return df, seen


def test_preprocessor_reads_its_rows_once(spark):
    df, seen = counted(spark)
    model, names = prep.fit_preprocessor(df, ["a", "b"], ["c"])
    assert seen.value == 240 and names == ["a", "b", "c_c0", "c_c1", "c_c2"]
    assert model.transform(df).count() == 240


def test_forest_reads_its_rows_once_and_keeps_their_nodes(spark):
    df, seen = counted(spark)
    p, _ = prep.fit_preprocessor(df, ["a", "b"], ["c"])
    before = seen.value
    m = fit("RandomForest", p, df, numTrees=5, maxDepth=4)
    assert seen.value - before == 240
    assert estimator("RandomForest").getCacheNodeIds()
    plain = fit("RandomForest", p, df, numTrees=5, maxDepth=4, cacheNodeIds=False)
    text = [x.stages[-1].toDebugString.split("\n", 1)[1] for x in (m, plain)]
    assert text[0] == text[1]


def test_trials_share_their_rows(spark):
    train, seen = counted(spark)
    val, seen_val = counted(spark, 120)
    p, _ = prep.fit_preprocessor(train, ["a", "b"], ["c"])
    before = seen.value
    r = tune("LogisticRegression", p, train, val, n_trials=3)
    assert seen.value - before == 240 and seen_val.value == 120
    assert len(r.trials) == 3 and models.score(r.best_model, val).count() == 120


def test_stored_transactions_are_not_derived_again(spark, tmp, monkeypatch):
    rows = [(i, dt.datetime(2024, 1, 1, i), i % 2, "error", 1.5 * i, '{"k": %d}' % i) for i in range(6)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string") \
        .write.parquet(f"{tmp}/events.parquet")
    first = sorted(derived.Workspace(spark, tmp).transactions().collect())

    def again(events):
        raise AssertionError("derived again")

    monkeypatch.setattr(derived, "transactions_from_events", again)
    assert len(first) == 6 and sorted(derived.Workspace(spark, tmp).transactions().collect()) == first
