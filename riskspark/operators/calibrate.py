"""Isotonic calibration of a frozen model on validation rows.

The base model is not refitted: an ``IsotonicRegression`` is fitted on the
validation rows' ``(score, label)`` and maps scores to calibrated
probabilities (clipped to the fitted range, like the reference's library).
"""

from __future__ import annotations

from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_isotonic(scored_val: DataFrame, score: str = "score", label: str = "label") -> IsotonicRegressionModel:
    data = scored_val.select(F.col(score).cast("double").alias("feature"),
                             F.col(label).cast("double").alias("label"))
    return IsotonicRegression(featuresCol="feature", labelCol="label", isotonic=True).fit(data)


def apply_isotonic(iso: IsotonicRegressionModel, scored: DataFrame, score: str = "score",
                   threshold: float = 0.5) -> DataFrame:
    """Calibrated ``score`` and ``predicted_label`` (``score > threshold``)."""
    tmp = scored.withColumn("_feature", F.col(score).cast("double"))
    out = iso.copy().setFeaturesCol("_feature").setPredictionCol("_cal").transform(tmp)
    cal = F.least(F.greatest(F.col("_cal"), F.lit(0.0)), F.lit(1.0))
    return (out.withColumn(score, cal)
            .withColumn("predicted_label", (cal > threshold).cast("int"))
            .drop("_feature", "_cal"))
