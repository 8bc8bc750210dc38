"""Explanations.

Linear contributions are pure column expressions: ``w_i · (x_i − mean_i)``
with the background mean taken over the training features (the reference's
linear explainer does the same). Per row the top 10 by absolute impact are
kept (ties: feature order, as a stable sort does), rounded half-to-even to 4
places, with a direction label.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark import schemas as S

REASON = T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("impact", T.DoubleType()),
    T.StructField("direction", T.StringType()),
])


def background_mean(df: DataFrame, features: str = "features") -> list[float]:
    """Mean feature vector (one distributed aggregate)."""
    row = df.select(Summarizer.mean(F.col(features)).alias("m")).first()
    return row["m"].toArray().tolist()


def linear_contributions(x: Column, weights: list[float], mean: list[float]) -> Column:
    """Array of ``w_i·(x_i − mean_i)`` for an array column ``x``."""
    w = F.array(*[F.lit(float(v)) for v in weights])
    m = F.array(*[F.lit(float(v)) for v in mean])
    return F.transform(x, lambda v, i: F.element_at(w, i + 1) * (v - F.element_at(m, i + 1)))


def top_reasons(contrib: Column, names: list[str], k: int = S.TOP_REASONS) -> Column:
    """O4 + F6 + F7: the k largest |impact| as ``array<struct<feature, impact,
    direction>>``."""
    nm = F.array(*[F.lit(n) for n in names])
    items = F.transform(contrib, lambda v, i: F.struct(i.alias("i"), F.element_at(nm, i + 1).alias("feature"),
                                                       v.alias("impact")))

    def cmp(a, b):
        aa, bb = F.abs(a["impact"]), F.abs(b["impact"])
        return (F.when(aa > bb, F.lit(-1)).when(aa < bb, F.lit(1))
                .when(a["i"] < b["i"], F.lit(-1)).when(a["i"] > b["i"], F.lit(1)).otherwise(F.lit(0)))

    top = F.slice(F.array_sort(items, cmp), 1, k)
    return F.transform(top, lambda r: F.struct(
        r["feature"].alias("feature"), F.bround(r["impact"], 4).alias("impact"),
        F.when(r["impact"] > 0, F.lit("toward_fraud")).otherwise(F.lit("away_from_fraud"))
         .alias("direction")))


def explain_linear(scored: DataFrame, weights: list[float], mean: list[float], names: list[str],
                   features: str = "features", key: str = "transaction_id") -> DataFrame:
    """M20 for linear models: one record per row (``available`` + reasons)."""
    x = vector_to_array(F.col(features)) if isinstance(scored.schema[features].dataType,
                                                        T.UserDefinedType) else F.col(features)
    c = linear_contributions(x, weights, mean)
    return scored.select(F.col(key), F.lit(True).alias("available"),
                         F.lit(None).cast("string").alias("reason"),
                         top_reasons(c, names).alias("top_reasons"))


def unavailable(df: DataFrame, reason: str, key: str = "transaction_id") -> DataFrame:
    """M20 when no explainer exists: never raises."""
    return df.select(F.col(key), F.lit(False).alias("available"), F.lit(reason).alias("reason"),
                     F.lit(None).cast(T.ArrayType(REASON)).alias("top_reasons"))


def reasons_long(expl: DataFrame, key: str = "transaction_id") -> DataFrame:
    """One row per (row, rank) — the exploded record."""
    return expl.select(key, F.posexplode("top_reasons").alias("pos", "r")).select(
        key, (F.col("pos") + 1).alias("rank"), "r.feature", "r.impact", "r.direction")


def global_importance(contrib: DataFrame, names: list[str], model: str, col: str = "contrib") -> DataFrame:
    """Mean |contribution| per feature, highest first."""
    nm = F.array(*[F.lit(n) for n in names])
    long = contrib.select(F.posexplode(F.col(col)).alias("i", "v"))
    agg = long.groupBy("i").agg(F.avg(F.abs("v")).alias("shap_importance"))
    return agg.select(F.lit(model).alias("model"), F.element_at(nm, F.col("i") + 1).alias("feature"),
                      "shap_importance")
