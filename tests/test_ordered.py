"""The skew-safe ordered scan equals plain windows."""
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.operators.ordered import ordered_scan


def _check(df, keys, order, parts):
    r = ordered_scan(df, keys, order, count_as="rn", sums={"cs": "v"}, lags={"pv": "v"},
                     num_partitions=parts)
    w = (W.partitionBy(*keys) if keys else W.partitionBy()).orderBy(*order)
    ref = (df.withColumn("rn2", F.row_number().over(w))
             .withColumn("cs2", F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0)))
             .withColumn("pv2", F.lag("v").over(w)))
    j = r.join(ref.select("id", "rn2", "cs2", "pv2"), "id")
    assert j.count() == df.count()
    bad = j.filter((F.col("rn") != F.col("rn2")) | (F.abs(F.col("cs") - F.col("cs2")) > 1e-9)
                   | ~F.col("pv").eqNullSafe(F.col("pv2")))
    assert bad.count() == 0


def test_per_key(spark):
    df = spark.range(2000).select(F.col("id"), (F.col("id") % 7).alias("k"),
                                  (F.col("id") * 13 % 101).cast("double").alias("v"))
    _check(df, ["k"], ["v", "id"], 5)


def test_one_hot_key_spans_slices(spark):
    # one key holds 90 % of the rows
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 10 == 0, F.col("id") % 3)
                                  .otherwise(F.lit(99)).alias("k"),
                                  (F.col("id") * 7 % 53).cast("double").alias("v"))
    _check(df, ["k"], ["id"], 8)


def test_global_order_after_shuffle(spark):
    df = spark.range(1500).select((F.col("id") * 31 % 1500).alias("id"),
                                  (F.col("id") % 17).cast("double").alias("v")).repartition(5)
    _check(df, [], ["id"], 6)


def test_null_keys(spark):
    df = spark.range(500).select(F.col("id"), F.when(F.col("id") % 5 == 0, None)
                                 .otherwise(F.col("id") % 2).alias("k"),
                                 F.col("id").cast("double").alias("v"))
    _check(df, ["k"], ["id"], 4)


def test_inside_a_union(spark):
    # a union shifts task partition ids; slice ids must not depend on them
    df = spark.range(800).select((F.col("id") * 37 % 800).alias("id"),
                                 (F.col("id") % 9).cast("double").alias("v")).repartition(3)
    r = ordered_scan(df, [], ["id"], count_as="rn", num_partitions=5)
    other = spark.range(1000, 1500).select(F.col("id"), F.lit(None).cast("long").alias("rn")).repartition(7)
    u = other.unionByName(r.select("id", "rn"))
    got = u.filter(F.col("rn").isNotNull()).agg(F.countDistinct("rn"), F.min("rn"), F.max("rn")).first()
    assert tuple(got) == (800, 1, 800)
    assert u.groupBy().agg(F.sum((F.col("rn") == F.col("id") + 1).cast("int"))).first()[0] == 800


def test_slice_count_follows_the_estimated_size(spark):
    from riskspark.operators.ordered import MIN_SLICES, slice_count
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    keys = ("spark.sql.shuffle.partitions", "riskspark.slice.bytes")
    before = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("riskspark.slice.bytes", str(1 << 30))      # a small input needs few slices
    try:
        assert slice_count(df) == MIN_SLICES
        spark.conf.set("riskspark.slice.bytes", "2048")         # ~27 KB on disk: 14 slices
        assert slice_count(df) == 14
        spark.conf.set("riskspark.slice.bytes", "256")          # ~105 needed: capped
        assert slice_count(df) == 32
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_jvm_plan_and_no_need_for_exchange_reuse(spark):
    """No Python in the plan, and right without exchange reuse."""
    df = spark.range(4000).select(F.col("id"), (F.col("id") % 3).alias("k"), (F.col("id") * 7 % 53).cast("double").alias("v")).repartition(6)
    key = "spark.sql.exchange.reuse"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        _check(df, ["k"], ["v", "id"], 7)
        _check(df, [], ["id"], 7)
        plan = ordered_scan(df, ["k"], ["id"], count_as="rn", lags={"pv": "v"})._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "MapInPandas" not in plan and "MapInArrow" not in plan
    finally:
        spark.conf.set(key, before)


def test_null_values_and_empty(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else float(i % 5), i % 2) for i in range(60)], "id int, v double, k int")
    r = {x["id"]: (x["cs"], x["pv"]) for x in ordered_scan(df, ["k"], ["id"], sums={"cs": "v"}, lags={"pv": "v"}, num_partitions=7).collect()}
    for k in (0, 1):
        total, prev = 0.0, None
        for i in range(k, 60, 2):
            v = None if i % 4 == 0 else float(i % 5)
            total += v or 0.0
            assert r[i] == (total, prev)
            prev = v
    assert ordered_scan(df.limit(0), ["k"], ["id"], count_as="n").count() == 0
