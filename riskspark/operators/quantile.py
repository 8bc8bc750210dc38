"""Exact quantiles with linear interpolation (pandas ``quantile`` / numpy
``median`` / DuckDB ``quantile_cont``), distributed.

Spark's exact ``percentile`` keeps every value of a group in one buffer; at
scale that is one task holding a whole column. Without groups the ranks are
found by counting passes (``selection.py``). With groups values are first reduced
to ``(value, count)`` (map-side combined), then ranked with the range-
partitioned running sum of ``ordered.py``; the two ranks around
``h = (n-1)·q`` are picked with a grouped aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.ordered import ordered_scan
from riskspark.operators.selection import quantiles


def exact_quantiles(df: DataFrame, value: str, probs: list[float],
                    groups: list[str] | None = None,
                    names: list[str] | None = None) -> DataFrame:
    """One row per group with one column per probability.

    NULL values are ignored; a group with no values gives NULL.
    """
    groups = list(groups or [])
    names = names or [f"q_{str(p).replace('.', '_')}" for p in probs]
    if not groups:
        row = quantiles(df, value, probs).get("", [None] * len(probs))
        return df.sparkSession.createDataFrame([tuple(row)], ", ".join(f"`{n}` double" for n in names))
    vals = df.select(*groups, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    counts = vals.groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranked = ordered_scan(counts, groups, ["_v"], sums={"_cum": "_n"})
    totals = counts.groupBy(*groups).agg(F.sum("_n").alias("_total"))
    # One row per group; AQE sees its real size at run time and broadcasts it.
    j = ranked.join(totals, groups, "inner")
    aggs = []
    for p, name in zip(probs, names):
        h = (F.col("_total") - 1) * F.lit(float(p))
        lo = F.floor(h)
        hi = F.ceil(h)
        j = j.withColumn(f"_h_{name}", h)
        aggs += [
            F.min(F.when(F.col("_cum") > lo, F.col("_v"))).alias(f"_lo_{name}"),
            F.min(F.when(F.col("_cum") > hi, F.col("_v"))).alias(f"_hi_{name}"),
            F.first(F.col(f"_h_{name}") - F.floor(F.col(f"_h_{name}"))).alias(f"_f_{name}"),
        ]
    out = j.groupBy(*groups).agg(*aggs)
    cols = [F.col(g) for g in groups]
    for name in names:
        lo, hi, fr = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), F.col(f"_f_{name}")
        cols.append((lo + fr * (hi - lo)).alias(name))
    return out.select(*cols)


def quantile_values(df: DataFrame, value: str, probs: list[float]) -> list[float | None]:
    """Driver-side scalars for a handful of global quantiles (one small row)."""
    row = exact_quantiles(df, value, probs, names=[f"q{i}" for i in range(len(probs))]).first()
    if row is None:
        return [None] * len(probs)
    return [row[f"q{i}"] for i in range(len(probs))]
