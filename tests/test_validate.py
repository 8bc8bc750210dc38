"""Validation (TestSchemaValidation)."""
import pytest
from pyspark.sql import functions as F

from conftest import make_raw
from riskspark.operators.validate import (SchemaValidationError, failure_cases, raw_rules,
                                          validate_raw)


@pytest.mark.parametrize("amount", [-100.0, 0.0, None])
def test_bad_amount_raises(spark, amount):
    df = make_raw(spark, 20).withColumn(
        "transaction_amount", F.when(F.col("transaction_id") == "txn_3", F.lit(amount).cast("double"))
        .otherwise(F.col("transaction_amount")))
    with pytest.raises(SchemaValidationError):
        validate_raw(df)


def test_bad_device_raises(spark):
    with pytest.raises(SchemaValidationError):
        validate_raw(make_raw(spark, 10, device="smartwatch"))


@pytest.mark.parametrize("label", [2, None])
def test_bad_label_raises(spark, label):
    df = make_raw(spark, 20).withColumn(
        "is_fraud", F.when(F.col("transaction_id") == "txn_1", F.lit(label).cast("int"))
        .otherwise(F.col("is_fraud")))
    with pytest.raises(SchemaValidationError):
        validate_raw(df)


def test_empty_raises(spark):
    with pytest.raises(SchemaValidationError):
        validate_raw(make_raw(spark, 10).limit(0))


def test_missing_required_column_raises(spark):
    with pytest.raises(SchemaValidationError):
        validate_raw(make_raw(spark, 10).drop("device_type"))


def test_label_optional_and_extra_columns_allowed(spark):
    validate_raw(make_raw(spark, 10).drop("is_fraud").withColumn("extra", F.lit(1)))


def test_failure_cases_lists_every_failure(spark):
    df = make_raw(spark, 10).withColumn(
        "device_type", F.when(F.col("transaction_id").isin("txn_1", "txn_2"), "smartwatch")
        .otherwise(F.col("device_type"))).withColumn(
        "transaction_amount", F.when(F.col("transaction_id") == "txn_2", -1.0)
        .otherwise(F.col("transaction_amount")))
    fc = {(r["row_key"], r["column"]) for r in failure_cases(df, raw_rules(), "transaction_id").collect()}
    assert fc == {("txn_1", "device_type"), ("txn_2", "device_type"), ("txn_2", "transaction_amount")}


def test_text_values_are_coerced_then_judged(spark):
    df = make_raw(spark, 8).withColumn("transaction_amount", F.element_at(F.array(*[F.lit(v) for v in (
        "abc", "-1", "0", "1e3", " 7 ", "", "12", "NaN")]), F.substring("transaction_id", 5, 9).cast("int") + 1))
    df = df.withColumn("is_fraud", F.when(F.col("transaction_id") == "txn_6", "yes").otherwise(F.col("is_fraud").cast("string")))
    got = {(r["row_key"], r["column"], r["check"], r["failure_case"]) for r in failure_cases(df, raw_rules(), "transaction_id").collect()}
    assert got == {("txn_0", "transaction_amount", "coerce_dtype('double')", "abc"), ("txn_1", "transaction_amount", "greater_than(0)", "-1"),
                   ("txn_2", "transaction_amount", "greater_than(0)", "0"), ("txn_5", "transaction_amount", "coerce_dtype('double')", ""),
                   ("txn_6", "is_fraud", "coerce_dtype('int')", "yes")}
    with pytest.raises(SchemaValidationError) as e:
        validate_raw(df)
    assert len(e.value.failures) == 5 and e.value.failure_frame.count() == 5
