"""Sources and sinks (TestExtraction, S1-S16) and streams on closed windows
(T1-T7)."""
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, make_raw
from riskspark import schemas as S
from riskspark.operators.windows import sessions, tumbling
from riskspark.sources import readers as RD
from riskspark.sources import sinks as SK
from riskspark.sources.derived import Workspace
from riskspark.streaming import jobs as J


def test_csv_roundtrip_usecols_and_names(spark, tmp):
    make_raw(spark, 30).write.option("header", True).csv(f"{tmp}/raw")
    df = RD.read_csv(spark, f"{tmp}/raw", schema=S.RAW_TRANSACTION)
    assert df.count() == 30 and df.columns == [f.name for f in S.RAW_TRANSACTION.fields]
    sub = RD.read_csv(spark, f"{tmp}/raw", schema=S.RAW_TRANSACTION, usecols=["transaction_id"])
    assert sub.columns == ["transaction_id"]


def test_empty_and_header_only_raise(spark, tmp):
    os.makedirs(f"{tmp}/h")
    with open(f"{tmp}/h/x.csv", "w") as fh:
        fh.write("transaction_id,transaction_amount\n")
    with pytest.raises(RD.EmptyExtractError):
        RD.extract(spark, "csv", f"{tmp}/h", schema="transaction_id string, transaction_amount double")


def test_unknown_source_raises():
    with pytest.raises(ValueError):
        RD.get_source("ftp")


def test_sql_source_params(spark):
    make_raw(spark, 20).createOrReplaceTempView("transactions_t")
    df = RD.extract(spark, "sql", "SELECT * FROM transactions_t WHERE transaction_amount > :lo",
                    params={"lo": 100.0})
    assert df.count() > 0
    with pytest.raises(ValueError):
        RD.read_sql(spark, "   ")


def test_nan_becomes_null(spark, tmp):
    spark.createDataFrame([(float("nan"),), (1.0,)], "x double").write.parquet(f"{tmp}/n")
    assert RD.read_parquet(spark, f"{tmp}/n").filter(F.col("x").isNull()).count() == 1


def test_requests_quarantine(spark):
    good = json.dumps({"transaction_id": "t1", "customer_id": "c", "transaction_amount": 10.5,
                       "transaction_type": "purchase", "transaction_time": "2024-01-01T00:00:00",
                       "transaction_location": "Lagos", "device_type": "mobile",
                       "previous_transactions_count": 3})
    df = spark.createDataFrame([(good,), ("{not json",), (json.dumps({"transaction_id": "t2"}),)], "value string")
    ok, bad = RD.requests_from_json(df)
    assert ok.count() == 1 and bad.count() == 2


def test_reference_fallback(spark, tmp):
    make_raw(spark, 5).write.parquet(f"{tmp}/b")
    assert RD.load_reference(spark, f"{tmp}/missing", f"{tmp}/b").count() == 5
    with pytest.raises(RuntimeError):
        RD.load_reference(spark, f"{tmp}/missing", f"{tmp}/missing2")


def test_snapshot_bounds_and_tables(spark, tmp):
    m = SK.snapshot(make_raw(spark, 12), f"{tmp}/snap", "csv", "s1").first()
    m2 = SK.snapshot(make_raw(spark, 12), f"{tmp}/snap", "csv", "s2").first()
    assert m["row_count"] == 12 and m["content_hash"] == m2["content_hash"]
    SK.save_bounds(spark, {"lower": 1.0, "upper": 9.0}, f"{tmp}/bounds")
    assert SK.load_bounds(spark, f"{tmp}/bounds") == {"lower": 1.0, "upper": 9.0}
    assert SK.load_bounds(spark, f"{tmp}/none") == {"lower": 0.0, "upper": float("inf")}
    paths = SK.create_tables(spark, f"{tmp}/db")
    assert set(paths) == {"transactions", "predictions", "fraud_feedback"}


def test_write_once_publishes_once(spark, tmp):
    df = spark.range(10)
    a = SK.write_once(df, f"{tmp}/t")
    b = SK.write_once(spark.range(99), f"{tmp}/t")
    assert a.count() == b.count() == 10


@pytest.fixture(scope="module")
def stream_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("stream"))
    tx = Workspace(spark, SF_SMALL).transactions()
    tx.repartition(4).write.parquet(f"{d}/in")
    return d, tx


def test_daily_windows_stream_matches_batch_on_closed_windows(spark, stream_dir):
    d, tx = stream_dir
    src = J.read_stream(spark, f"{d}/in", tx.schema)
    out = J.run_to_memory(J.daily_counts_stream(src), "t4", f"{d}/ck4").collect()
    batch = {r["window_start"]: r["n"] for r in tumbling(tx, "transaction_time", "1 day", "transaction_amount")
             .withColumn("window_start", F.col("window_start").cast("timestamp")).collect()}
    assert len(out) > 0
    for r in out:
        assert batch[r["window_start"]] == r["n"]


def test_sessions_stream_matches_batch_on_closed_sessions(spark, stream_dir):
    d, tx = stream_dir
    src = J.read_stream(spark, f"{d}/in", tx.schema)
    out = J.run_to_memory(J.sessions_stream(src), "t7", f"{d}/ck7").collect()
    batch = {(r["customer_id"], r["session_start"]): r["n"] for r in
             sessions(tx, "customer_id", "transaction_time", 30, tie="transaction_id")
             .withColumn("session_start", F.col("session_start").cast("timestamp")).collect()}
    assert len(out) > 0
    for r in out:
        assert batch[(r["customer_id"], r["session_start"])] == r["n"]
    # rapid repeats are counted, never dropped
    assert sum(r["n"] for r in out) <= tx.count()


def test_dedup_stream(spark, stream_dir, tmp):
    d, tx = stream_dir
    tx.limit(50).write.parquet(f"{tmp}/dup/a")
    tx.limit(50).write.parquet(f"{tmp}/dup/b")
    src = J.read_stream(spark, f"{tmp}/dup/*", tx.schema)
    out = J.run_to_memory(J.dedup_stream(src), "t3", f"{tmp}/ck3")
    assert out.count() == 50


def test_feedback_join_stream(spark, tmp):
    ws = Workspace(spark, SF_SMALL)
    ws.predictions().write.parquet(f"{tmp}/p")
    ws.feedback().write.parquet(f"{tmp}/f")
    p = J.read_stream(spark, f"{tmp}/p", ws.predictions().schema)
    f = J.read_stream(spark, f"{tmp}/f", ws.feedback().schema)
    out = J.run_to_memory(J.feedback_join_stream(p, f), "t5", f"{tmp}/ck5")
    from riskspark.operators.join import feedback_join
    assert out.count() == feedback_join(ws.predictions(), ws.feedback(), ordered=False).count()


def test_sessions_with_a_hot_customer(spark):
    """One customer holds about a third of the rows; sessions still equal a
    plain gaps-and-islands computation."""
    import datetime as dt
    import random as rnd_mod
    rnd = rnd_mod.Random(9)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        cust = "hot" if i % 3 == 0 else f"c{rnd.randint(0, 50)}"
        rows.append((f"t{i}", cust, base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 20))))
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, transaction_time timestamp_ntz")
    got = sorted((r["customer_id"], r["session_start"], r["n"]) for r in
                 sessions(df, "customer_id", "transaction_time", 30, tie="transaction_id").collect())
    exp = []
    by = {}
    for tid, c, t in rows:
        by.setdefault(c, []).append((t, tid))
    for c, evs in by.items():
        evs.sort()
        start, prev, n = evs[0][0], evs[0][0], 1
        for t, _ in evs[1:]:
            if t - prev > dt.timedelta(minutes=30):
                exp.append((c, start, n))
                start, n = t, 0
            n += 1
            prev = t
        exp.append((c, start, n))
    assert got == sorted(exp)


def test_feedback_order_splits_a_hot_timestamp(spark):
    """A third of the feedback shares one confirmed_at: the newest-first
    order holds and that timestamp spans more than one sorted partition."""
    import datetime as dt

    from pyspark.sql import functions as F

    from riskspark.operators.join import feedback_join
    hot = dt.datetime(2024, 1, 10, 12, 0)
    n = 3000
    preds = spark.createDataFrame(
        [(f"txn_{i}", i % 2, 0.5) for i in range(n)],
        "transaction_id string, predicted_label int, confidence_score double")
    fb = spark.createDataFrame(
        [(f"txn_{i}", (i // 2) % 2, "manual", hot if i % 3 == 0 else hot + dt.timedelta(minutes=i))
         for i in range(n)],
        "transaction_id string, actual_label int, source string, confirmed_at timestamp")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")        # keep the sort's own partitions visible
    try:
        out = feedback_join(preds, fb)
        rows = out.select("confirmed_at").collect()
        assert len(rows) == n
        ts = [r[0] for r in rows]
        assert all(a >= b for a, b in zip(ts, ts[1:]))
        parts = (out.withColumn("_p", F.spark_partition_id())
                 .filter(F.col("confirmed_at") == F.lit(hot)).select("_p").distinct().count())
        assert parts > 1
    finally:
        spark.conf.set(key, before)


def test_derived_table_files_follow_the_input_size(spark):
    from riskspark.session import partitions_for_size
    ev = Workspace(spark, "/root/testdata/sf0.1").events        # ~2 MB on disk
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        assert partitions_for_size(ev, 100 << 10) >= 15        # ~100 KB each
        assert partitions_for_size(ev) == 2                    # never below the configured count
    finally:
        spark.conf.set(key, before)
