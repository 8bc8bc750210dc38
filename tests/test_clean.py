"""Cleaning and features (TestPreprocessingCorrectness, TestFraudEdgeCases)."""
import math

import pytest
from pyspark.sql import functions as F

from conftest import make_raw
from riskspark.operators import clean as CL
from riskspark.operators.features import ENGINEERED, engineer
from riskspark.operators.validate import SchemaValidationError


def test_engineered_columns_and_ranges(spark):
    cleaned, _, _ = CL.clean(make_raw(spark, 200))
    f = engineer(cleaned)
    for c in ENGINEERED:
        assert c in f.columns
    r = f.agg(F.min("transaction_month"), F.max("transaction_month"), F.min("transaction_hour"),
              F.max("transaction_hour"), F.min("transaction_day_of_week"),
              F.max("transaction_day_of_week"), F.min("log_transaction_amount")).first()
    assert 1 <= r[0] <= r[1] <= 12 and 0 <= r[2] <= r[3] <= 23 and 0 <= r[4] <= r[5] <= 6
    assert r[6] >= 0


def test_weekday_monday_is_zero(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2024-01-07 10:00:00",)], "transaction_time string") \
        .withColumn("transaction_amount", F.lit(1.0)).withColumn("device_type", F.lit("mobile"))
    got = [r[0] for r in engineer(df).orderBy("transaction_time").select("transaction_day_of_week").collect()]
    assert got == [0, 6]        # 2024-01-01 is a Monday


def test_log_and_device_amount(spark):
    df = spark.createDataFrame([(100.0, "mobile", "2024-01-01 00:00:00"), (50.0, "desktop", "2024-01-01 00:00:00")],
                               "transaction_amount double, device_type string, transaction_time string")
    rows = {r["device_type"]: r for r in engineer(df).collect()}
    assert rows["mobile"]["amount_by_device"] == 100.0
    assert rows["desktop"]["amount_by_device"] == 0.0
    assert math.isclose(rows["mobile"]["log_transaction_amount"], math.log1p(100.0))


def test_bad_time_raises_or_nulls(spark):
    df = spark.createDataFrame([("not a time", 1.0, "mobile")],
                               "transaction_time string, transaction_amount double, device_type string")
    with pytest.raises(Exception):
        engineer(df).collect()
    assert engineer(df, strict_time=False).first()["transaction_time"] is None


def test_deterministic(spark):
    a, _, _ = CL.clean(make_raw(spark, 200))
    b, _, _ = CL.clean(make_raw(spark, 200))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_repeats_removed(spark):
    raw = make_raw(spark, 50)
    dup = raw.unionByName(raw.limit(10))
    cleaned, _, _ = CL.clean(dup)
    assert cleaned.count() == 50


def test_large_amount_clipped(spark):
    raw = make_raw(spark, 100)
    big = raw.withColumn("transaction_amount", F.when(F.col("transaction_id") == "txn_0", 999999999.0)
                         .otherwise(F.col("transaction_amount")))
    cleaned, bounds, _ = CL.clean(big)
    mx = cleaned.agg(F.max("transaction_amount")).first()[0]
    assert mx <= bounds["upper"] < 999999999.0


def test_single_row_and_constant_amount_kept(spark):
    one, _, _ = CL.clean(make_raw(spark, 1))
    assert one.count() == 1
    const = make_raw(spark, 30).withColumn("transaction_amount", F.lit(15000.0))
    c, b, _ = CL.clean(const)
    assert c.count() == 30 and b["lower"] == b["upper"] == 15000.0


def test_quantile_linear_interpolation(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 10]], "transaction_amount double")
    b = CL.clip_bounds(df)
    # pandas: 1 + 0.04 * (2 - 1) and 4 + 0.96 * (10 - 4)
    assert math.isclose(b["lower"], 1.04) and math.isclose(b["upper"], 9.76)


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (5.0,), (500.0,)], "transaction_amount double")
    got = sorted([r[0] for r in CL.apply_clip(df, {"lower": 1.0, "upper": 100.0}).collect()],
                 key=lambda v: (v is not None, v))
    assert got == [None, 5.0, 100.0]


def test_missing_bounds_do_not_clip(spark):
    df = spark.createDataFrame([(1e9,)], "transaction_amount double")
    assert CL.apply_clip(df, None).first()[0] == 1e9


def test_all_null_row_raises_when_validating_else_dropped(spark):
    raw = make_raw(spark, 20)
    nul = spark.createDataFrame([tuple([None] * len(raw.columns))], raw.schema)
    with pytest.raises(SchemaValidationError):
        CL.clean(raw.unionByName(nul))
    out, _, _ = CL.clean(raw.unionByName(nul), validate=False)
    assert out.count() == 20


def test_sparse_null_sequence(spark):
    # a: 30 % null -> dropped. b: null only where a is null -> none left.
    # c: 1/10 null on the whole frame (not over 10 %), but 1/7 once a's rows
    # are gone -> dropped too: later columns see the smaller frame.
    rows = [(None if i < 3 else 1, None if i < 3 else 2, None if i == 9 else 3) for i in range(10)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    assert CL.sparse_null_columns(df) == ["a", "c"]
    out, dropped = CL.drop_sparse_nulls(df)
    assert dropped == ["a", "c"] and out.count() == 6


def test_null_shares(spark):
    df = spark.createDataFrame([(None, 1), (2, None), (3, 4), (None, 5)], "a int, b int")
    r = CL.null_shares(df).first()
    assert r["a"] == 0.5 and r["b"] == 0.25


def test_names_normalised_and_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "` Amount ` int, Other int")
    assert CL.normalize_names(df).columns == ["amount", "other"]
    with pytest.raises(ValueError):
        CL.normalize_names(spark.createDataFrame([(1, 2)], "`A` int, `a ` int"))
