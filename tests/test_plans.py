"""Plan shape: what has to hold at scale is checked on the executed plans."""
import re

import __spark_entry__ as E
from conftest import SF_SMALL
from pyspark.sql import functions as F

from riskspark.operators.ordered import ordered_scan

Q = E.queries()


def _executed(df, mode="formatted"):
    df.write.format("noop").mode("overwrite").save()
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_time_filter_and_columns_reach_the_scan(spark):
    plan = _executed(Q["last_day"](spark, SF_SMALL))
    pushed = re.search(r"PushedFilters: \[([^\n]*)\]", plan).group(1)
    assert "transaction_time" in pushed
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(f.split(":")[0] for f in schema.split(",")) == \
        {"transaction_id", "transaction_amount", "transaction_time", "device_type"}


def test_features_stay_in_codegen_without_python(spark):
    plan = _executed(Q["features"](spark, SF_SMALL), "simple")
    assert "*(1)" in plan                       # whole-stage codegen
    assert "Python" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_ordered_scan_moves_no_row_to_one_partition(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3).alias("k"),
                                  F.col("id").cast("double").alias("v"))
    plan = _executed(ordered_scan(df, ["k"], ["id"], count_as="rn", sums={"s": "v"}, num_partitions=6))
    # nothing goes to one partition; the windows over rows hold a slice each
    assert "SinglePartition" not in plan and "BroadcastHashJoin" in plan
    rows = ordered_scan(df, [], ["id"], count_as="rn", num_partitions=6)
    singles = [ln for ln in _executed(rows).splitlines() if "SinglePartition" in ln]
    assert len(singles) <= 1                     # a row a slice


def test_curve_metrics_do_not_window_the_whole_table(spark):
    plan = _executed(Q["roc_auc"](spark, SF_SMALL), "simple")
    # every window is over slices, or over the row a slice that carries totals
    assert "Python" not in plan and "MapInPandas" not in plan
    windows = [ln for ln in plan.splitlines() if re.search(r"\bWindow\b", ln)]
    assert windows
    for ln in windows:
        assert "_os_slice" in ln


def test_dedup_is_combined_map_side(spark):
    plan = _executed(Q["dedup_clean"](spark, SF_SMALL))
    aggs = [ln for ln in plan.splitlines() if "HashAggregate" in ln]
    assert len(aggs) >= 2                        # partial + final around the shuffle


def test_clean_reads_the_deduplicated_rows_from_the_checkpoint(spark):
    plan = _executed(Q["fraud_by_device_weekday"](spark, SF_SMALL), "simple")
    # the distinct ran once, before the checkpoint; the result only groups by
    # device and weekday over the written rows, with the bounds as literals
    assert "Scan ExistingRDD" in plan
    aggs = [ln for ln in plan.splitlines() if "HashAggregate" in ln]
    assert len(aggs) == 2 and all("device_type" in ln for ln in aggs)
    assert "least(greatest(transaction_amount" in plan


def test_statistics_read_the_rows_once(spark):
    # the rows were read once into a checkpointed reduction; the result plans
    # read only that (no Parquet file scan left)
    for name in ("drift_js", "drift_chi2", "drift_wasserstein", "evaluation_by_model"):
        plan = _executed(Q[name](spark, SF_SMALL), "simple")
        assert "FileScan" not in plan, name
        assert "Scan ExistingRDD" in plan, name


def test_alert_joins_predictions_and_feedback_once(spark):
    plan = _executed(Q["alert"](spark, SF_SMALL), "simple")
    joins = [ln for ln in plan.splitlines() if re.search(r"(HashJoin|SortMergeJoin) \[transaction_id", ln)]
    assert len(joins) == 1
