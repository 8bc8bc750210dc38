"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "riskspark",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with the defaults above.

    On a cluster the master comes from spark-submit; ``master`` is for local
    runs and tests only.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and derived tables.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared, reliable
    folder there). Only when it is unset — local tests — a private folder is
    created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            # Executors on other machines cannot see a folder on this one.
            raise RuntimeError("spark.checkpoint.dir is unset; name a shared folder for the cluster")
        conf = tempfile.mkdtemp(prefix="riskspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (not machine-local)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    base = base.rstrip("/")
    return "/".join([base, *parts])


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default


FILE_BYTES = 256 << 20


def partitions_for_size(df, target_bytes: int = FILE_BYTES) -> int:
    """Output partitions for writing ``df``: about ``target_bytes`` each by
    the optimizer's size estimate (for a file scan, the bytes on disk), never
    fewer than ``spark.sql.shuffle.partitions``. No action is run."""
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    size = estimated_bytes(df)
    if size is None:
        return default
    return max(default, -(-size // max(target_bytes, 1)))


def estimated_bytes(df) -> int | None:
    """The optimizer's size estimate of ``df`` (no action is run); None when
    there is none."""
    try:
        v = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(v) if isinstance(v, int) else int(v.toString())   # py4j gives int or BigInteger
    except Exception:  # noqa: BLE001
        return None
