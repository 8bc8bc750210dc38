"""Structured Streaming jobs.

- ``score_stream`` (T1, T2, T6): request rows arrive as files; each
  micro-batch goes through the scoring bundle in production (looked up at the
  start of every micro-batch, so a promotion is picked up without a restart,
  with its clip bounds, calibration and threshold) and its scores and reasons
  are written to the prediction log. The write replaces the micro-batch's own
  folder, so a replayed batch after a failure overwrites instead of
  duplicating: the at-least-once delivery of the reference becomes
  effectively exactly-once.
- ``dedup_stream`` (T3): repeats of a transaction id within the watermark.
- ``daily_counts_stream`` (T4): one-day tumbling windows, emitted when closed.
- ``feedback_join_stream`` (T5): predictions meet later confirmed outcomes
  within a time bound; both sides watermarked so state is bounded.
- ``sessions_stream`` (T7): per-customer session windows, counted, never
  dropped.

Event times in the driver data are ``TIMESTAMP_NTZ``; watermarks need
``TIMESTAMP``, so the time column is cast first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators import bundle as B


def as_event_time(df: DataFrame, col: str) -> DataFrame:
    if isinstance(df.schema[col].dataType, (T.TimestampNTZType, T.StringType)):
        return df.withColumn(col, F.col(col).cast("timestamp"))
    return df


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


class ModelCache:
    """The production bundle, reloaded only when the alias moves."""

    def __init__(self, resolve: Callable[[], tuple[str, int, str] | None]):
        self.resolve = resolve          # -> (model_name, version, path) or None
        self.key = None
        self.model = None

    def get(self) -> tuple[PipelineModel | None, str | None, int | None]:
        cur = self.resolve()
        if cur is None:
            return None, None, None
        name, version, path = cur
        if (name, version) != self.key:
            self.model = B.load(path)
            self.key = (name, version)
        return self.model, name, version


def score_batch(batch: DataFrame, bundle: PipelineModel, model_name: str, model_version,
                reasons: bool = True) -> DataFrame:
    s = B.score(bundle, batch, keep=["transaction_id"], reasons=reasons)
    why = ["available", "reason", B.REASONS] if reasons else []
    return s.select(
        "transaction_id", F.col(B.LABEL).cast("int").alias("predicted_label"),
        F.col(B.SCORE).alias("confidence_score"),
        F.lit(model_name).alias("model_name"), F.lit(str(model_version)).alias("model_version"),
        F.current_timestamp().alias("predicted_at"), *why)


def score_stream(requests: DataFrame, cache: ModelCache, sink: str, checkpoint: str,
                 trigger: dict | None = None, reasons: bool = True):
    """T1 + T2 + T6 + M20. Returns the started ``StreamingQuery``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        bundle, name, version = cache.get()
        if bundle is None:
            # The batch fails and is not committed, so its requests are read
            # again once a model is in production.
            raise RuntimeError("no production model: the batch is kept for a retry")
        out = score_batch(batch, bundle, name, version, reasons)
        (out.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={batch_id}"))

    w = requests.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def dedup_stream(df: DataFrame, key: str = "transaction_id", time_col: str = "transaction_time",
                 delay: str = "1 day") -> DataFrame:
    """T3."""
    return as_event_time(df, time_col).withWatermark(time_col, delay) \
        .dropDuplicatesWithinWatermark([key])


def daily_counts_stream(df: DataFrame, time_col: str = "transaction_time",
                        amount_col: str = "transaction_amount", delay: str = "1 hour",
                        length: str = "1 day") -> DataFrame:
    """T4: closed windows only in append mode."""
    e = as_event_time(df, time_col).withWatermark(time_col, delay)
    g = e.groupBy(F.window(time_col, length).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(amount_col).alias("total"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "total")


def feedback_join_stream(predictions: DataFrame, feedback: DataFrame, delay: str = "1 day",
                         within: str = "30 days") -> DataFrame:
    """T5: a stream-stream inner join with a time bound; later rows go to the
    batch join."""
    p = as_event_time(predictions, "predicted_at").withWatermark("predicted_at", delay).alias("p")
    f = as_event_time(feedback, "confirmed_at").withWatermark("confirmed_at", delay).alias("f")
    cond = ((F.col("p.transaction_id") == F.col("f.transaction_id"))
            & (F.col("f.confirmed_at") >= F.col("p.predicted_at"))
            & (F.col("f.confirmed_at") <= F.col("p.predicted_at") + F.expr(f"INTERVAL {within}")))
    return p.join(f, cond, "inner").select(
        "p.transaction_id", "p.predicted_label", "p.confidence_score", "f.actual_label",
        "f.source", "f.confirmed_at")


def sessions_stream(df: DataFrame, key: str = "customer_id", time_col: str = "transaction_time",
                    gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """T7."""
    e = as_event_time(df, time_col).withWatermark(time_col, delay)
    g = e.groupBy(key, F.session_window(time_col, gap).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def run_to_memory(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Drive a streaming frame over everything available into a memory table
    (tests and local runs)."""
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.table(name)
