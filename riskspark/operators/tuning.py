"""Hyperparameter search (M14, M15, X5): seeded random draws from the
reference's search spaces, each candidate fitted on the training rows and
scored by exact ROC AUC on the validation rows; the best is kept.

Trials run as concurrent Spark jobs (a thread per in-flight trial); each
fit is itself distributed. Random search replaces the reference's Bayesian
sampler (single-machine).
"""

from __future__ import annotations

import math
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from riskspark import schemas as S
from riskspark.operators import metrics as M
from riskspark.operators.models import estimator, score, training_rows

# Fixed search spaces of the reference (low, high, kind).
SPACES = {
    "XGBoost": {"n_estimators": (100, 500, "int"), "max_depth": (3, 10, "int"),
                "learning_rate": (0.01, 0.3, "float"), "subsample": (0.6, 1.0, "float"),
                "colsample_bytree": (0.6, 1.0, "float")},
    "RandomForest": {"n_estimators": (100, 500, "int"), "max_depth": (3, 20, "int"),
                     "min_samples_split": (2, 10, "int"), "min_samples_leaf": (1, 5, "int")},
    "LogisticRegression": {"C": (0.01, 10.0, "log"), "max_iter": (100, 500, "int")},
}


def draw(model: str, n_trials: int, seed: int = S.SEED) -> list[dict]:
    if not isinstance(n_trials, int) or n_trials < 1:
        raise ValueError("n_trials must be a positive integer")
    rng = np.random.RandomState(seed)
    out = []
    for _ in range(n_trials):
        p = {}
        for name, (lo, hi, kind) in SPACES[model].items():
            if kind == "int":
                p[name] = int(rng.randint(lo, hi + 1))
            elif kind == "log":
                p[name] = float(math.exp(rng.uniform(math.log(lo), math.log(hi))))
            else:
                p[name] = float(rng.uniform(lo, hi))
        out.append(p)
    return out


def to_spark_params(model: str, p: dict) -> dict:
    """Map a draw onto the Spark estimator's parameters."""
    if model == "XGBoost":
        return dict(maxIter=p["n_estimators"], maxDepth=p["max_depth"], stepSize=p["learning_rate"],
                    subsamplingRate=p["subsample"],
                    featureSubsetStrategy=str(round(p["colsample_bytree"], 4)))
    if model == "RandomForest":
        return dict(numTrees=p["n_estimators"], maxDepth=min(p["max_depth"], 30),
                    minInstancesPerNode=max(p["min_samples_leaf"], math.ceil(p["min_samples_split"] / 2)))
    if model == "LogisticRegression":
        return dict(C=p["C"], maxIter=p["max_iter"])
    raise ValueError(f"no search space for model {model!r}")


@dataclass
class TuneResult:
    best_params: dict
    best_score: float
    trials: list[tuple[int, dict, float]]
    best_model: PipelineModel


def tune(model: str, prep: PipelineModel, train: DataFrame, val: DataFrame, n_trials: int = 50,
         target: str = S.TARGET, parallelism: int = 4, seed: int = S.SEED,
         balance: bool = False, key: str = "transaction_id") -> TuneResult:
    """With ``balance`` the candidates see the rows the trained models saw
    (M6). Of the fitted models only the best so far is held."""
    if train is None or val is None:
        raise ValueError("train and val are required")
    draws = draw(model, n_trials, seed)
    # All trials read the same preprocessed rows of both sides.
    rows = training_rows(prep, train, target, balance, key).persist()
    held = prep.transform(val).select(target, "features").persist()
    try:
        return _trials(model, prep, rows, held, draws, target, parallelism)
    finally:
        rows.unpersist()
        held.unpersist()


def _trials(model: str, prep: PipelineModel, rows: DataFrame, held: DataFrame, draws: list[dict],
            target: str, parallelism: int) -> TuneResult:
    n = rows.count()
    lock, best = threading.Lock(), {}

    def rank(i, auc):
        return (-math.inf if math.isnan(auc) else auc, -i)

    def run(i_p):
        i, p = i_p
        clf = estimator(model, n, **to_spark_params(model, p)).fit(rows)
        auc = M.roc_auc(score(clf, held, keep=[target]), target, "score").first()["roc_auc"]
        auc = float("nan") if auc is None else float(auc)
        with lock:
            if not best or rank(i, auc) > rank(*best["at"]):
                best.update(at=(i, auc), params=p, model=PipelineModel(stages=[*prep.stages, clf]))
        return i, p, auc

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as ex:
        trials = list(ex.map(run, enumerate(draws)))
    return TuneResult(best["params"], best["at"][1], trials, best["model"])
