"""The training flow (reference lifecycle 3.1) as Spark jobs.

extract → (snapshot) → validate + clean + features → split → fit the
preparation on training rows → train each model → calibrate on validation
rows → write its scoring bundle → evaluate the bundle on test rows → explain →
register → choose the best, promote → write the drift baseline (after
promotion, C2) → optional search, whose model becomes a version of its own.

Every run has a folder named by its id that nothing overwrites; what serves is
decided by the registry's log alone, so a rejected candidate changes nothing
and a rollback brings the old scores back.

The driver only holds fitted statistics, models and metric rows. The split
frame is checkpointed (shared checkpoint folder) before the fits, so lost
executors recompute from the checkpoint, not from the source.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.operators import bundle as B
from riskspark.operators import metrics as M
from riskspark.operators import prep as P
from riskspark.operators.calibrate import fit_isotonic
from riskspark.operators.clean import clean
from riskspark.operators.explain import global_importance
from riskspark.operators.features import engineer
from riskspark.operators.models import (MODEL_REGISTRY, best_model, fit, importance, parameters, score, spec,
                                        top_per_model)
from riskspark.operators.registry import Registry
from riskspark.operators.tuning import tune
from riskspark.operators.validate import validate_engineered
from riskspark.sources import sinks


@dataclass
class TrainingConfig:
    """V6: checked before any job runs."""
    query: str
    target: str = S.TARGET
    do_tuning: bool = False
    n_trials: int = 50
    models: list[str] = field(default_factory=lambda: list(S.MODEL_NAMES))
    require_improvement: bool = False
    validate: bool = True
    threshold: float = 0.5
    balance: bool = True            # M6 on the preprocessed training rows
    explain: bool = True            # M21: mean contributions, top features logged
    key: str = "transaction_id"

    def __post_init__(self):
        if not isinstance(self.query, str) or not self.query.strip():
            raise ValueError("a training run needs a query")
        if not isinstance(self.n_trials, int) or self.n_trials < 1:
            raise ValueError(f"n_trials must be a whole number above 0, not {self.n_trials!r}")
        if not self.models:
            raise ValueError("a training run needs a model")
        for name in [*self.models]:
            spec(name)


@dataclass
class TrainingResult:
    best: str
    results: DataFrame
    bounds: dict
    feature_names: list[str]
    versions: dict[str, int]
    paths: dict[str, str]
    promoted: bool
    tuned: dict | None = None


METRICS = ("f1", "recall", "precision", "roc_auc")


@dataclass
class _Run:
    """What all models of one training share."""
    spark: SparkSession
    cfg: TrainingConfig
    root: str
    registry: Registry
    bounds: dict
    names: list[str]
    train: DataFrame
    val: DataFrame
    test: DataFrame

    def finish(self, fitted: PipelineModel, name: str, registered: str, kind: str,
               params: dict) -> tuple[int, str, dict]:
        """Calibrate a fitted model, write its bundle,
        evaluate and explain it, and register it. Returns version, path, metrics."""
        cfg = self.cfg
        run_id = uuid.uuid4().hex
        folder = f"{self.root}/runs/{run_id}"
        validation = score(fitted, self.val, keep=[cfg.target])
        iso = None if validation.isEmpty() else fit_isotonic(validation, "score", cfg.target)
        bundle = B.build(fitted, self.bounds, self.names, B.training_mean(fitted, self.train), iso, cfg.threshold)
        path = B.save(bundle, f"{folder}/bundle")
        scored = B.score(bundle, self.test, keep=[cfg.target])
        record = M.evaluation_record(scored, cfg.target, B.SCORE, B.LABEL)      # one row
        record = record.checkpoint(eager=True)
        record.write.mode("overwrite").json(f"{folder}/evaluation")
        ev = record.first()
        metrics = {k: ev[k] if ev else None for k in METRICS}
        if spec(name).supports_feature_importance:
            sinks.export_csv(importance(fitted, self.names, name), f"{folder}/importance")
        logged = dict(metrics)
        if cfg.explain and (contrib := B.contributions(bundle, self.train)) is not None:
            table = global_importance(contrib, self.names, name)
            sinks.export_csv(table.orderBy(F.col("shap_importance").desc(), "feature"), f"{folder}/shap")
            logged |= {f"shap_top_feature_{r['rank']}_{r['feature']}": round(r["shap_importance"], 4)
                       for r in top_per_model(table, "shap_importance").collect()}
        self.registry.log_run({"model": name, **params}, logged, {"kind": kind}, run_id)
        return self.registry.register_version(registered, run_id, path), path, metrics


def run_training(spark: SparkSession, raw: DataFrame, cfg: TrainingConfig, root: str,
                 feature_cols: tuple[list[str], list[str]] | None = None) -> TrainingResult:
    """Train, calibrate, evaluate, select and promote. ``root`` holds the
    registry, the runs' folders and the baseline."""
    root = root.rstrip("/")
    reg = Registry(spark, f"{root}/registry")
    cleaned, bounds, _ = clean(raw, validate=cfg.validate)
    feats = engineer(cleaned)
    if cfg.validate:
        validate_engineered(feats)
    split = P.split(feats).checkpoint(eager=True)
    num, cat = feature_cols or P.feature_columns(split, cfg.target)
    train, val, test = (split.filter(F.col("split") == s) for s in ("train", "val", "test"))
    prep, names = P.fit_preprocessor(train, num, cat)
    run = _Run(spark, cfg, root, reg, bounds, names, train, val, test)
    n_train = train.count()

    rows, versions, paths = [], {}, {}
    for name in cfg.models:
        fitted = fit(name, prep, train, cfg.target, balance=cfg.balance, key=cfg.key)
        version, path, m = run.finish(fitted, name, S.MODEL_PREFIX + name, "train",
                                      {"n_train": n_train, **parameters(fitted)})
        versions[name], paths[name] = version, path
        rows.append((name, *[None if m[k] is None else float(m[k]) for k in METRICS]))
    results = spark.createDataFrame(rows, "model string, f1 double, recall double, precision double, roc_auc double")
    best = best_model(results, "roc_auc", order=list(MODEL_REGISTRY)).first()["model"]
    promoted = reg.promote(S.MODEL_PREFIX + best, versions[best], "roc_auc", cfg.require_improvement)
    if promoted:
        sinks.save_baseline(feats, f"{root}/baseline")        # C2: only after promotion
    tuned = None
    if cfg.do_tuning:
        r = tune(best, prep, train, val, cfg.n_trials, cfg.target, balance=cfg.balance, key=cfg.key)
        registered = f"{S.MODEL_PREFIX}{best}-tuned"
        version, path, m = run.finish(r.best_model, best, registered, "tune",
                                      {**{f"best_{k}": v for k, v in r.best_params.items()},
                                       "tuned_roc_auc": r.best_score, **parameters(r.best_model)})
        tuned = {"params": r.best_params, "roc_auc": r.best_score, "model": registered, "version": version,
                 "path": path, "test_roc_auc": m["roc_auc"]}
    return TrainingResult(best, results, bounds, names, versions, paths, promoted, tuned)
