"""Time windows on batches (T4, T7 batch forms).

Sessions use the ordered scan: the previous event of the same customer
(``lag``) decides whether a new session starts, and a running count of
starts numbers the sessions — a customer with a third of all rows is still
spread over many tasks. The grouped aggregate per session is combined
map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.ordered import ordered_scan


def tumbling(df: DataFrame, time_col: str, length: str = "1 day",
             value_col: str | None = None) -> DataFrame:
    """Count (and sum ``value_col``) per tumbling window."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if value_col:
        aggs.append(F.sum(value_col).alias("total"))
    g = df.groupBy(F.window(time_col, length).alias("w")).agg(*aggs)
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *[c for c in g.columns if c != "w"])


def sessions(df: DataFrame, key: str, time_col: str, gap_minutes: int = 30,
             tie: str | None = None) -> DataFrame:
    """Sessions per ``key``: a new session starts when the gap to the key's
    previous event exceeds ``gap_minutes``. Output: key, session_start,
    session_end (last event + gap, as Spark's ``session_window``), n."""
    order = [time_col] + ([tie] if tie else [])
    base = df.select(key, time_col, *([tie] if tie else []))
    s = ordered_scan(base, [key], order, lags={"_prev": time_col})
    gap = F.expr(f"INTERVAL {int(gap_minutes)} MINUTES")
    new = (F.col("_prev").isNull() | (F.col(time_col) > F.col("_prev") + gap)).cast("long")
    s = s.withColumn("_new", new)
    numbered = ordered_scan(s, [key], order, sums={"_sid": "_new"})
    return (numbered.groupBy(key, "_sid")
            .agg(F.min(time_col).alias("session_start"),
                 (F.max(time_col) + gap).alias("session_end"),
                 F.count(F.lit(1)).alias("n"))
            .drop("_sid"))
