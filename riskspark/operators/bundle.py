"""The scoring bundle (M12, M16, M20, S12): one ``PipelineModel`` from raw
transactions to a calibrated score, its label and the reasons for it.

Stages: clip with the fitted bounds → engineered features → the fitted
preparation → classifier → class-1 probability → isotonic calibration (Spark's
own model; left out when there were no validation rows) → label by threshold →
what the explanations need. Clip, features, probability and threshold are small
transformers of their own with Spark ML's parameter reader and writer, so the
whole bundle is saved and loaded as one model and batch scoring, streams and
monitoring cannot apply different parts of it.

A bundle is written once, to a folder named after its run, and never
overwritten: a version of the registry keeps its scores whatever is trained
later.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (GBTClassificationModel, LogisticRegressionModel,
                                       RandomForestClassificationModel)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators.clean import apply_clip, normalize_names
from riskspark.operators.explain import REASON, background_mean, linear_contributions, top_reasons
from riskspark.operators.features import engineer
from riskspark.operators.treeshap import tree_contributions

RAW_SCORE, CALIBRATED, SCORE, LABEL, REASONS = "raw_score", "calibrated", "score", "predicted_label", "top_reasons"
NOT_EXPLAINED = "no explainer for this kind of model"


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer whose state is its parameters."""

    def _given(self, kwargs):
        self._set(**{k: v for k, v in kwargs.items() if v is not None})


class ClipAmount(_Stage):
    """P1 + P8: normalised names, amount clipped to the fitted bounds."""
    column = Param(Params._dummy(), "column", "column to clip", TypeConverters.toString)
    lower = Param(Params._dummy(), "lower", "lower bound", TypeConverters.toFloat)
    upper = Param(Params._dummy(), "upper", "upper bound", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, column=None, lower=None, upper=None):
        super().__init__()
        self._setDefault(column="transaction_amount", lower=0.0, upper=float("inf"))
        self._given(self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        bounds = {"lower": self.getOrDefault(self.lower), "upper": self.getOrDefault(self.upper)}
        return apply_clip(normalize_names(df), bounds, self.getOrDefault(self.column))


class Engineer(_Stage):
    """F1-F5."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return engineer(df)


class ClassOneScore(_Stage):
    """Probability of class 1; a model that saw one class only has 0."""
    inputCol = Param(Params._dummy(), "inputCol", "probability vector", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "score", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._setDefault(inputCol="probability", outputCol=RAW_SCORE)
        self._given(self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        p = vector_to_array(F.col(self.getOrDefault(self.inputCol)))
        return df.withColumn(self.getOrDefault(self.outputCol), F.coalesce(F.try_element_at(p, F.lit(2)), F.lit(0.0)))


class Threshold(_Stage):
    """Final score, held within 0 and 1, and label ``score > threshold`` (C14)."""
    inputCol = Param(Params._dummy(), "inputCol", "score to judge", TypeConverters.toString)
    threshold = Param(Params._dummy(), "threshold", "largest score of label 0", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, threshold=None):
        super().__init__()
        self._setDefault(inputCol=RAW_SCORE, threshold=0.5)
        self._given(self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        s = F.least(F.greatest(F.col(self.getOrDefault(self.inputCol)), F.lit(0.0)), F.lit(1.0))
        return df.withColumns({SCORE: s, LABEL: (s > self.getOrDefault(self.threshold)).cast("int")})


class Explained(_Stage):
    """What explanations need beside the classifier: feature names and the
    training mean of the features. Changes no rows."""
    names = Param(Params._dummy(), "names", "feature names", TypeConverters.toListString)
    background = Param(Params._dummy(), "background", "mean of each feature", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, names=None, background=None):
        super().__init__()
        self._setDefault(names=[], background=[])
        self._given(self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df


def build(fitted: PipelineModel, bounds: dict, names: list[str], background: list[float],
          iso: IsotonicRegressionModel | None = None, threshold: float = 0.5) -> PipelineModel:
    """The bundle of a fitted preparation + classifier pipeline."""
    stages = [ClipAmount(lower=bounds["lower"], upper=bounds["upper"]), Engineer(), *fitted.stages, ClassOneScore()]
    if iso is not None:
        stages.append(iso.copy().setFeaturesCol(RAW_SCORE).setPredictionCol(CALIBRATED))
    stages += [Threshold(inputCol=RAW_SCORE if iso is None else CALIBRATED, threshold=threshold),
               Explained(names=names, background=background)]
    return PipelineModel(stages)


def training_mean(fitted: PipelineModel, train: DataFrame) -> list[float]:
    """Mean feature vector of the training rows (before balancing)."""
    return background_mean(PipelineModel(fitted.stages[:-1]).transform(train))


def save(bundle: PipelineModel, path: str) -> str:
    """Write a bundle; an existing one is never replaced (Spark raises)."""
    bundle.write().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def classifier(bundle: PipelineModel):
    return next((s for s in bundle.stages if hasattr(s, "numClasses")), None)


def score(bundle: PipelineModel, raw: DataFrame, keep: list[str] | None = None, reasons: bool = False) -> DataFrame:
    """M16 (+ M20): ``keep``, score, predicted_label and, with ``reasons``,
    available, reason, top_reasons of each raw transaction, in one pass."""
    out = bundle.transform(raw)
    cols = [*(keep or []), SCORE, LABEL]
    return explained(bundle, out, cols) if reasons else out.select(*cols)


def explained(bundle: PipelineModel, scored: DataFrame, cols: list[str]) -> DataFrame:
    """M20 (C12: for every row): the ten largest contributions, or why there
    are none. An unknown kind of model is reported, never raised."""
    model, info = classifier(bundle), bundle.stages[-1]
    names, mean = info.getOrDefault("names"), info.getOrDefault("background")
    if isinstance(model, LogisticRegressionModel) and model.numClasses == 2:
        x = vector_to_array(F.col("features"))
        found = scored.withColumn("contrib", linear_contributions(x, model.coefficients.toArray().tolist(), mean))
    elif isinstance(model, GBTClassificationModel | RandomForestClassificationModel):
        found = tree_contributions(scored, model, carry=cols)
    else:
        return scored.select(*cols, F.lit(False).alias("available"), F.lit(NOT_EXPLAINED).alias("reason"),
                             F.lit(None).cast(T.ArrayType(REASON)).alias(REASONS))
    return found.select(*cols, F.lit(True).alias("available"), F.lit(None).cast("string").alias("reason"),
                        top_reasons(F.col("contrib"), names).alias(REASONS))


def contributions(bundle: PipelineModel, raw: DataFrame) -> DataFrame | None:
    """Contribution arrays (column ``contrib``) for the global importance
    (M21), or None where there is no explainer."""
    model, info = classifier(bundle), bundle.stages[-1]
    out = bundle.transform(raw)
    if isinstance(model, LogisticRegressionModel) and model.numClasses == 2:
        x = vector_to_array(F.col("features"))
        return out.select(linear_contributions(x, model.coefficients.toArray().tolist(),
                                               info.getOrDefault("background")).alias("contrib"))
    if isinstance(model, GBTClassificationModel | RandomForestClassificationModel):
        return tree_contributions(out, model).select("contrib")
    return None
