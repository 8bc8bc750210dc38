"""Sinks: baseline snapshots, data snapshots, the prediction log, fitted
state and exported tables (S8, S10-S13, S15)."""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.sources.commitlog import publish


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _utcnow() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def write_once(df: DataFrame, path: str, sort_within: list[str] | None = None) -> DataFrame:
    """Write ``df`` to ``path`` unless a complete copy is there; read it back.

    The data goes to a fresh side folder first and is renamed into place, so
    a reader never sees half a table and two writers cannot mix their files.
    """
    spark = df.sparkSession
    if path_exists(spark, f"{path}/_SUCCESS"):
        return spark.read.parquet(path)
    tmp = f"{path}.tmp-{uuid.uuid4().hex}"
    w = df.sortWithinPartitions(*sort_within) if sort_within else df
    w.write.mode("errorifexists").parquet(tmp)
    publish(spark, tmp, path)
    return spark.read.parquet(path)


# S8 ---------------------------------------------------------------------------
def save_baseline(df: DataFrame, path: str) -> None:
    """Reference baseline for drift (written after promotion, C2)."""
    df.write.mode("overwrite").parquet(path)


# S10 --------------------------------------------------------------------------
def _content(stored: DataFrame, columns: list[str]):
    """Row count and order-independent content hash of a stored copy. (Observed
    metrics would save this read, but a session that has used one can no longer
    ship some of Spark ML's closures: its observation manager is not
    serializable in Spark 4.1.)"""
    h = F.xxhash64(*[F.col(c) for c in columns])
    return stored.agg(F.count(F.lit(1)).alias("row_count"),
                      F.sum(h.cast("decimal(38,0)")).cast("string").alias("content_hash")).first()


def snapshot(df: DataFrame, root: str, source: str, snapshot_id: str | None = None) -> DataFrame:
    """Store a labelled copy of extracted data; return its manifest row.

    The manifest has the row count and an order-independent content hash (sum
    of 64-bit row hashes), taken from the copy: the input is read once, and two
    identical extracts get the same hash.
    """
    spark = df.sparkSession
    sid = snapshot_id or uuid.uuid4().hex
    data_path = f"{root.rstrip('/')}/data/snapshot_id={sid}"
    df.write.mode("errorifexists").parquet(data_path)
    found = _content(spark.read.schema(df.schema).parquet(data_path), df.columns)
    manifest = spark.createDataFrame(
        [(sid, source, _utcnow(), found["row_count"], found["content_hash"], data_path)],
        "snapshot_id string, source string, created_at timestamp, row_count long, content_hash string, path string")
    manifest.write.mode("append").parquet(f"{root.rstrip('/')}/manifest")
    return manifest


# S11 --------------------------------------------------------------------------
def log_predictions(scored: DataFrame, path: str, model_name: str, model_version: str,
                    label_col: str = "predicted_label", score_col: str = "confidence_score",
                    predicted_at=None, batch_id: str | None = None) -> str:
    """Add a batch of predictions to the log (batch form of the asynchronous
    log); returns its batch id.

    The id is made from the batch's content once it is written to a side
    folder (its name begins with ``_``, so readers pass it over). The folder then becomes ``batch_id=...`` in one step unless that is there
    already: a retry, whole or after a crash half way, leaves one copy. Name
    ``batch_id`` to log equal rows on purpose a second time.
    """
    spark = scored.sparkSession
    path = path.rstrip("/")
    at = F.lit(predicted_at).cast("timestamp") if predicted_at is not None else F.current_timestamp()
    rows = scored.select(
        F.col("transaction_id"),
        F.col(label_col).cast("int").alias("predicted_label"),
        F.col(score_col).cast("double").alias("confidence_score"),
        F.lit(model_name).alias("model_name"),
        F.lit(str(model_version)).alias("model_version"))
    side = f"{path}/_side-{uuid.uuid4().hex}"
    rows.withColumn("predicted_at", at).write.parquet(side)
    if batch_id is None:
        found = _content(spark.read.schema(rows.schema).parquet(side), rows.columns)
        batch_id = hashlib.sha256(f"{found['row_count']}:{found['content_hash']}".encode()).hexdigest()[:24]
    publish(spark, side, f"{path}/batch_id={batch_id}")
    return batch_id


# S12 --------------------------------------------------------------------------
def save_bounds(spark: SparkSession, bounds: dict, path: str) -> None:
    """Clip bounds as a one-row table (fitted state, saved by ``fit`` only)."""
    spark.createDataFrame([(float(bounds["lower"]), float(bounds["upper"]))],
                          "lower double, upper double").write.mode("overwrite").parquet(path)


def load_bounds(spark: SparkSession, path: str) -> dict:
    """Missing bounds fall back to (0, +inf): no clipping (P8). Anything but a
    missing path raises: clipping is never turned off by a storage error."""
    if not path_exists(spark, path):
        return {"lower": 0.0, "upper": float("inf")}
    row = spark.read.parquet(path).first()
    return {"lower": row["lower"], "upper": row["upper"]}


# S13 --------------------------------------------------------------------------
def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


# S15 --------------------------------------------------------------------------
def create_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Declare the three tables as empty Parquet tables if absent."""
    out = {}
    for name, schema in S.TABLES.items():
        path = f"{root.rstrip('/')}/{name}"
        if not path_exists(spark, path):
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
        out[name] = path
    return out

