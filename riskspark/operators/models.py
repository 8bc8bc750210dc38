"""Classifiers on Spark ML.

``MODEL_REGISTRY`` maps the reference's three model names to Spark ML
estimators with matching defaults where Spark has the same knob:

- RandomForest: 100 trees, √features per split, seed 42 (Spark needs a
  finite depth: 12); a row's node in each tree is kept from level to level
  instead of being found again from the root;
- XGBoost: gradient-boosted trees (``GBTClassifier``), 100 rounds, depth 6,
  step 0.3, seed 42 — a different boosting algorithm, so agreement is at the
  metric level only;
- LogisticRegression: L2 with sklearn's ``C`` as ``regParam = 1/(C·n)``,
  no standardisation, 100 iterations.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark import schemas as S


@dataclass(frozen=True)
class ModelSpec:
    build: Callable[[int], object]          # n training rows -> fresh estimator
    supports_feature_importance: bool
    supports_predict_proba: bool = True


def _rf(n: int, **kw):
    p = dict(numTrees=100, maxDepth=12, featureSubsetStrategy="sqrt", seed=S.SEED,
             cacheNodeIds=True, checkpointInterval=-1, featuresCol="features", labelCol="label")
    p.update(kw)
    return RandomForestClassifier(**p)


def _gbt(n: int, **kw):
    p = dict(maxIter=100, maxDepth=6, stepSize=0.3, seed=S.SEED, featuresCol="features",
             labelCol="label")
    p.update(kw)
    return GBTClassifier(**p)


def _lr(n: int, C: float = 1.0, **kw):
    p = dict(regParam=1.0 / (C * max(n, 1)), elasticNetParam=0.0, standardization=False,
             maxIter=100, featuresCol="features", labelCol="label")
    p.update(kw)
    return LogisticRegression(**p)


#: The models by name, in the order that settles ties.
MODEL_REGISTRY: dict[str, ModelSpec] = {
    "RandomForest": ModelSpec(_rf, True),
    "XGBoost": ModelSpec(_gbt, True),
    "LogisticRegression": ModelSpec(_lr, False),
}


def spec(name: str) -> ModelSpec:
    """The entry of a model; unknown names raise."""
    try:
        return MODEL_REGISTRY[name]
    except KeyError:
        raise ValueError(f"unknown model {name!r}; known: {', '.join(MODEL_REGISTRY)}") from None


def estimator(name: str, n_rows: int = 1, **params):
    """A fresh estimator for ``n_rows`` training rows."""
    return spec(name).build(n_rows, **params)


def register_model(name: str, entry: ModelSpec) -> None:
    """Add a trainer."""
    MODEL_REGISTRY[name] = entry


def with_label(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return df.withColumn("label", F.col(target).cast("double"))


def training_rows(prep: PipelineModel, train: DataFrame, target: str = S.TARGET,
                  balance: bool = False, key: str = "transaction_id") -> DataFrame:
    """The preprocessed rows a classifier is fitted on, oversampled with
    ``balance`` (M6), as the reference does before fitting. The columns between
    the given ones and ``features`` are left out."""
    data = prep.transform(with_label(train, target))
    data = data.select(*[c for c in data.columns if c in (*train.columns, "features", "label")])
    if balance:
        from riskspark.operators.resample import smote
        data = smote(data.select(key, "features", "label"), key, "features", "label")
    return data


def fit(name: str, prep: PipelineModel, train: DataFrame, target: str = S.TARGET,
        n_rows: int | None = None, balance: bool = False, key: str = "transaction_id", **params) -> PipelineModel:
    """M7-M9: preprocessing + classifier as one ``PipelineModel``."""
    # Each trainer reads the rows a few times before it holds them in its own form.
    data = training_rows(prep, train, target, balance, key).persist(StorageLevel.MEMORY_ONLY)
    try:
        n = n_rows if n_rows is not None else data.count()
        clf = estimator(name, n, **params).fit(data)
    finally:
        data.unpersist()
    return PipelineModel(stages=[*prep.stages, clf])


def parameters(model: PipelineModel) -> dict:
    """The parameters the classifier was fitted with, by name."""
    return {p.name: v for p, v in model.stages[-1].extractParamMap().items()}


def score(model: PipelineModel, df: DataFrame, threshold: float = 0.5,
          keep: list[str] | None = None) -> DataFrame:
    """Probability of class 1 and the label ``score > threshold`` (C14)."""
    out = model.transform(df)
    # a model trained on one class only has a one-element probability vector
    p1 = F.coalesce(F.try_element_at(vector_to_array(F.col("probability")), F.lit(2)), F.lit(0.0))
    cols = [F.col(c) for c in (keep or [])]
    return out.select(*cols, p1.alias("score"),
                      (p1 > threshold).cast("int").alias("predicted_label"))


def importance(model: PipelineModel, names: list[str], model_name: str = "") -> DataFrame:
    """Impurity importance per feature, highest first."""
    spark = SparkSession.getActiveSession()
    clf = model.stages[-1]
    imp = clf.featureImportances.toArray().tolist()
    rows = [(model_name, n, float(v)) for n, v in zip(names, imp)]
    df = spark.createDataFrame(rows, "model string, feature string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("feature"))


def top_per_model(df: DataFrame, value: str, k: int = S.TOP_IMPORTANCE,
                  group: str = "model") -> DataFrame:
    """O3: top k rows per group by ``value`` (ties: feature name)."""
    w = Window.partitionBy(group).orderBy(F.col(value).desc(), F.col("feature"))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def best_model(results: DataFrame, metric: str = "roc_auc", order: list[str] | None = None) -> DataFrame:
    """The best row by ``metric``; ties go to the first model in ``order``
    (the factory order)."""
    order = order or S.MODEL_NAMES
    pos = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    pos = F.when(pos == 0, F.lit(len(order) + 1)).otherwise(pos)
    return results.orderBy(F.col(metric).desc_nulls_last(), pos, F.col("model")).limit(1)
