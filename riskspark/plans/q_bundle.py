"""Scoring bundle and prediction log."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.operators import bundle as B
from riskspark.operators import prep as P
from riskspark.operators.calibrate import apply_isotonic, fit_isotonic
from riskspark.operators.clean import apply_clip, clip_bounds
from riskspark.operators.features import engineer
from riskspark.operators.metrics import roc_auc
from riskspark.operators.models import fit, importance, score, spec
from riskspark.operators.ordered import ordered_scan
from riskspark.operators.registry import Registry
from riskspark.operators.treeshap import tree_contributions
from riskspark.plans import sql as Q
from riskspark.plans.catalog import query
from riskspark.plans.monitoring import score_for_drift
from riskspark.plans.q_models import CAT, NUM, prepared
from riskspark.plans.q_prep import _U
from riskspark.session import checkpoint_dir, shared_path
from riskspark.sources.derived import Workspace
from riskspark.sources.sinks import log_predictions

PATHS = ("bundle", "monitoring", "version 1 after a second run", "rollback")


def _different(a, b, cols):
    """Rows that differ, and rows on either side: a full join by id."""
    j = a.select("transaction_id", *[F.col(c).alias(f"a_{c}") for c in cols]).join(
        b.select("transaction_id", *[F.col(c).alias(f"b_{c}") for c in cols]), "transaction_id", "full")
    same = F.lit(True)
    for c in cols:
        same = same & (F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) < 1e-9)
    return j.agg(F.count(F.lit(1)).alias("n_rows"), F.sum((~F.coalesce(same, F.lit(False))).cast("long")).alias("n_different"))


@query("score_contract", sql=Q.with_(Q.EV, Q.TX) + f"""
SELECT p.path, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different
FROM tx, (VALUES {", ".join(f"('{p}')" for p in PATHS)}) p(path) WHERE {_U} < 0.2 GROUP BY 1""")
def score_contract(spark, sf_dir):
    """Every way a score can be had equals the calibrated evaluation, row by
    row: the saved and reloaded bundle on raw rows, monitoring, version 1 after
    a later run with other settings was promoted, and after its rollback."""
    raw = P.split(Workspace(spark, sf_dir).transactions())
    bounds = clip_bounds(raw)
    f = engineer(apply_clip(raw, bounds)).checkpoint()
    train, val, test = (f.filter(F.col("split") == s) for s in ("train", "val", "test"))
    prep, names = P.fit_preprocessor(train, NUM, CAT)
    fitted = fit("LogisticRegression", prep, train)
    iso = fit_isotonic(score(fitted, val, keep=[S.TARGET]), "score", S.TARGET)
    expected = apply_isotonic(iso, score(fitted, test, keep=["transaction_id"]), threshold=0.2).checkpoint()

    checkpoint_dir(spark)
    root = shared_path(spark, f"score-contract-{uuid.uuid4().hex[:12]}")
    reg, name = Registry(spark, f"{root}/registry"), S.MODEL_PREFIX + "LogisticRegression"
    mean = B.training_mean(fitted, train)

    def run(bundle):
        run_id = reg.log_run(tags={"kind": "train"})
        path = B.save(bundle, f"{root}/runs/{run_id}/bundle")
        version = reg.register_version(name, run_id, path)
        reg.promote(name, version)
        return path

    rows = raw.filter(F.col("split") == "test").drop("split")
    first = run(B.build(fitted, bounds, names, mean, iso, 0.2))
    found = [(expected, B.score(B.load(first), rows, keep=["transaction_id"]), [B.SCORE, B.LABEL])]
    watched, _ = score_for_drift(rows, rows, reg)
    found.append((expected, watched.withColumnRenamed(S.PREDICTION_COLUMN, B.LABEL), [B.LABEL]))
    run(B.build(fitted, {"lower": 0.0, "upper": 1.0}, names, mean, None, 0.9))
    found.append((expected, B.score(B.load(first), rows, keep=["transaction_id"]), [B.SCORE, B.LABEL]))
    reg.rollback()
    found.append((expected, B.score(B.load(reg.production()[2]), rows, keep=["transaction_id"]), [B.SCORE, B.LABEL]))
    out = None
    for path, (a, b, cols) in zip(PATHS, found, strict=True):
        r = _different(a, b, cols).select(F.lit(path).alias("path"), "n_rows", "n_different")
        out = r if out is None else out.unionByName(r)
    return out


@query("log_replay", sql=Q.with_(Q.EV, Q.PRED) + """
SELECT model_version, predicted_label, count(*) AS n, round(sum(confidence_score), 4) AS total
FROM (SELECT '1' AS model_version, predicted_label, confidence_score FROM pred
      UNION ALL SELECT '2', predicted_label, confidence_score FROM pred) GROUP BY ALL""")
def log_replay(spark, sf_dir):
    """Two batches, the first logged three times as a retry would: the
    log holds each once."""
    p = Workspace(spark, sf_dir).predictions()
    checkpoint_dir(spark)
    path = shared_path(spark, f"prediction-log-{uuid.uuid4().hex[:12]}")
    for version in ("1", "1", "2", "1"):
        log_predictions(p, path, "fraud-RuleScore", version)
    return (spark.read.parquet(path).groupBy(F.col("model_version").cast("string").alias("model_version"), "predicted_label")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("confidence_score"), 4).alias("total")))


# ---------------------------------------------------------------------------
# What must hold for trained models, whatever their fit
# ---------------------------------------------------------------------------
_FITS = {"RandomForest": {"numTrees": 20, "maxDepth": 6}, "XGBoost": {"maxIter": 8, "maxDepth": 4}, "LogisticRegression": {}}
_CHECKS = [(m, c) for m in _FITS for c in ("score", "label", "auc", "calibrated")] + [
    (m, c) for m in ("RandomForest", "XGBoost") for c in ("importance", "contributions")]
AUC_FLOOR = 0.7


@query("model_contract", sql=Q.with_(Q.EV, Q.TX) + f"""
SELECT c.model, c.name AS "check", count(*) AS n_rows, CAST(0 AS BIGINT) AS n_bad
FROM tx, (VALUES {", ".join(f"('{m}', '{c}')" for m, c in _CHECKS)}) c(model, name) WHERE {_U} < 0.2 GROUP BY ALL""")
def model_contract(spark, sf_dir):
    """For each trained model, over all test rows: scores lie in [0, 1]; the
    label is the score above 0.5; ROC AUC reaches a floor; calibrated scores
    never fall while raw ones rise; importances are shares of 1; contributions
    and base add up to the model's output."""
    f, prep, names = prepared(spark, sf_dir)
    f = f.checkpoint()
    train, val, test = (f.filter(F.col("split") == s) for s in ("train", "val", "test"))
    n = test.count()
    out = None
    for name, params in _FITS.items():
        m = fit(name, prep, train, **params)
        s = score(m, test, keep=["transaction_id", S.TARGET]).checkpoint()
        iso = fit_isotonic(score(m, val, keep=[S.TARGET]), "score", S.TARGET)
        cal = apply_isotonic(iso, s.withColumn("raw", F.col("score"))).select("transaction_id", "raw", F.col("score").alias("cal"))
        falls = ordered_scan(cal, [], ["raw", "transaction_id"], lags={"last": "cal"})
        auc = roc_auc(s, S.TARGET, "score").select((F.coalesce("roc_auc", F.lit(0.0)) < AUC_FLOOR).cast("long").alias("bad"))
        checks = {"score": _bad(s, ~F.col("score").between(0, 1) | F.col("score").isNull()),
                  "label": _bad(s, F.col("predicted_label") != (F.col("score") > 0.5).cast("int")),
                  "auc": auc, "calibrated": _bad(falls, F.col("cal") < F.col("last") - 1e-12)}
        if spec(name).supports_feature_importance:
            total = importance(m, names, name).agg(F.sum("importance").alias("t"), F.count(F.lit(1)).alias("k"))
            checks["importance"] = total.select(((F.abs(F.col("t") - 1) > 1e-6) | (F.col("k") != len(names))).cast("long").alias("bad"))
            parts = tree_contributions(m.transform(test), m.stages[-1]).join(s, "transaction_id")
            p = F.col("score")
            target = p if name == "RandomForest" else F.log(p / (1 - p))
            whole = F.col("base") + F.aggregate("contrib", F.lit(0.0), lambda a, x: a + x)
            checks["contributions"] = _bad(parts, ~(F.abs(whole - target) < 1e-6))
        for check, bad in checks.items():
            row = bad.select(F.lit(name).alias("model"), F.lit(check).alias("check"), F.lit(n).cast("long").alias("n_rows"), F.col("bad").alias("n_bad"))
            out = row if out is None else out.unionByName(row)
    return out


def _bad(df, condition):
    return df.agg(F.sum(condition.cast("long")).alias("bad"))
