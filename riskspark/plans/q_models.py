"""Model queries (M7-M21, O3-O5). Trained models give rows-only checks; the
explanation and selection queries with fixed weights / rule models have SQL
oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.operators import metrics as M
from riskspark.operators import prep as P
from riskspark.operators.calibrate import apply_isotonic, fit_isotonic
from riskspark.operators.explain import (global_importance, linear_contributions, reasons_long,
                                         top_reasons)
from riskspark.operators.features import engineer
from riskspark.operators.models import best_model, fit, importance, score, top_per_model
from riskspark.operators.tuning import tune
from riskspark.plans import sql as Q
from riskspark.plans.catalog import query
from riskspark.sources.derived import RULE_SCORERS, Workspace, scored_events

NUM = ["transaction_amount", "previous_transactions_count", "log_transaction_amount",
       "transaction_year", "transaction_month", "transaction_day", "transaction_hour",
       "transaction_day_of_week", "amount_by_device"]
CAT = ["transaction_type", "transaction_location", "device_type"]


def prepared(spark, sf_dir):
    """Engineered transactions with a split column, and the preprocessor
    fitted on the training split."""
    f = P.split(engineer(Workspace(spark, sf_dir).transactions()))
    f = f.select("transaction_id", *NUM, *CAT, S.TARGET, "split")
    train = f.filter(F.col("split") == "train")
    prep, names = P.fit_preprocessor(train, NUM, CAT)
    return f, prep, names


def _model_scores(name, spark, sf_dir):
    f, prep, _ = prepared(spark, sf_dir)
    m = fit(name, prep, f.filter(F.col("split") == "train"))
    return score(m, f.filter(F.col("split") == "test"), keep=["transaction_id"])


@query("forest")
def forest(spark, sf_dir):
    """M7: random forest, test-split scores."""
    return _model_scores("RandomForest", spark, sf_dir)


@query("gbt")
def gbt(spark, sf_dir):
    """M8: boosted trees, test-split scores."""
    return _model_scores("XGBoost", spark, sf_dir)


@query("logistic")
def logistic(spark, sf_dir):
    """M9: logistic regression, test-split scores."""
    return _model_scores("LogisticRegression", spark, sf_dir)


@query("calibrated")
def calibrated(spark, sf_dir):
    """Forest calibrated on validation rows, scored on test rows."""
    f, prep, _ = prepared(spark, sf_dir)
    m = fit("RandomForest", prep, f.filter(F.col("split") == "train"))
    val = score(m, f.filter(F.col("split") == "val"), keep=[S.TARGET])
    iso = fit_isotonic(val, "score", S.TARGET)
    test = score(m, f.filter(F.col("split") == "test"), keep=["transaction_id", S.TARGET])
    return apply_isotonic(iso, test)


@query("feature_importance")
def feature_importance(spark, sf_dir):
    """M11 + O2 + O3: top-5 impurity importance of the forest."""
    f, prep, names = prepared(spark, sf_dir)
    m = fit("RandomForest", prep, f.filter(F.col("split") == "train"))
    return top_per_model(importance(m, names, "RandomForest"), "importance")


@query("tune_logistic")
def tune_logistic(spark, sf_dir):
    """8 seeded draws for logistic regression, validation ROC AUC."""
    f, prep, _ = prepared(spark, sf_dir)
    r = tune("LogisticRegression", prep, f.filter(F.col("split") == "train"),
             f.filter(F.col("split") == "val"), n_trials=8)
    rows = [(i, float(p["C"]), int(p["max_iter"]), a, a == r.best_score) for i, p, a in r.trials]
    return spark.createDataFrame(rows, "trial int, C double, max_iter int, roc_auc double, best boolean")


# ---------------------------------------------------------------------------
# Selection over the rule models (O5) — oracle
# ---------------------------------------------------------------------------
_RULES = {k: v for k, v in RULE_SCORERS.items()}


@query("best_model", sql=Q.with_(Q.EV, Q.scored(_RULES),
  """c AS (SELECT model, score AS s, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
                  sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS neg FROM sc GROUP BY model, score)""",
  """auc AS (SELECT a.model, sum(a.pos * b.neg * (CASE WHEN a.s > b.s THEN 1.0 WHEN a.s = b.s THEN 0.5
                  ELSE 0.0 END)) / (max(tp.p) * max(tp.n)) AS roc_auc
             FROM c a JOIN c b ON a.model = b.model
             JOIN (SELECT model, sum(pos) AS p, sum(neg) AS n FROM c GROUP BY model) tp ON tp.model = a.model
             GROUP BY a.model)""") + """
SELECT model, round(roc_auc, 6) AS roc_auc FROM auc ORDER BY roc_auc DESC, model LIMIT 1""")
def q_best_model(spark, sf_dir):
    sc = scored_events(Workspace(spark, sf_dir).events, _RULES)
    res = M.roc_auc(sc, "label", "score", ["model"])
    return best_model(res, "roc_auc", order=list(_RULES)).select("model", F.round("roc_auc", 6).alias("roc_auc"))


# ---------------------------------------------------------------------------
# Linear reasons with fixed weights (M18, M20, O4) and global importance
# ---------------------------------------------------------------------------
LR_FEATURES = ["transaction_amount", "previous_transactions_count", "log_transaction_amount",
               "transaction_year", "transaction_month", "transaction_day", "transaction_hour",
               "transaction_day_of_week", "amount_by_device", "device_type_desktop",
               "device_type_mobile", "device_type_pos_terminal", "device_type_tablet"]
# Fixed example weights and background (a stand-in for fitted coefficients and
# the training mean). Chosen so that every finite-decimal contribution is exact
# to 4 places: rounding then never meets a half-way case, in any engine.
LR_WEIGHTS = [0.01, -0.02, 0.35, 0.0, 0.0, -0.02, 0.03, 0.05, 0.01, -0.4, 0.6, 0.1, -0.2]
LR_BACKGROUND = [150.0, 30.0, 4.5, 2024.0, 1.0, 15.5, 11.5, 3.0, 40.0, 0.2, 0.3, 0.2, 0.3]


def _lr_frame(spark, sf_dir):
    f = engineer(Workspace(spark, sf_dir).transactions())
    dev = [F.when(F.col("device_type") == d, 1.0).otherwise(0.0).alias(f"device_type_{d}")
           for d in ("desktop", "mobile", "pos_terminal", "tablet")]
    f = f.select("transaction_id", *[F.col(c).cast("double").alias(c) for c in LR_FEATURES[:9]], *dev)
    x = F.array(*[F.col(c) for c in LR_FEATURES])
    return f.select("transaction_id", linear_contributions(x, LR_WEIGHTS, LR_BACKGROUND).alias("contrib"))


def _lr_sql_long() -> str:
    dev = ", ".join(f"CAST(CASE WHEN device_type = '{d}' THEN 1 ELSE 0 END AS DOUBLE) AS device_type_{d}"
                    for d in ("desktop", "mobile", "pos_terminal", "tablet"))
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in LR_FEATURES[:9])
    x = f"x AS (SELECT transaction_id, {cols}, {dev} FROM (SELECT *, {Q.FEATURES} FROM tx))"
    parts = [f"SELECT transaction_id, {i} AS i, '{c}' AS feature, "
             f"CAST({w!r} AS DOUBLE) * ({c} - CAST({m!r} AS DOUBLE)) AS v FROM x"
             for i, (c, w, m) in enumerate(zip(LR_FEATURES, LR_WEIGHTS, LR_BACKGROUND))]
    return [x, "l AS (" + " UNION ALL ".join(parts) + ")"]


@query("linear_reasons", sql=Q.with_(Q.EV, Q.TX, *_lr_sql_long()) + """
SELECT transaction_id, rank, feature, CAST(round_even(v, 4) AS DOUBLE) AS impact,
       CASE WHEN v > 0 THEN 'toward_fraud' ELSE 'away_from_fraud' END AS direction
FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY abs(v) DESC, i) AS rank FROM l)
WHERE rank <= 10""")
def linear_reasons(spark, sf_dir):
    c = _lr_frame(spark, sf_dir)
    expl = c.select("transaction_id", top_reasons(F.col("contrib"), LR_FEATURES).alias("top_reasons"))
    return reasons_long(expl)


@query("shap_importance", sql=Q.with_(Q.EV, Q.TX, *_lr_sql_long()) + """
SELECT 'fixed_linear' AS model, feature, round(avg(abs(v)), 4) AS shap_importance
FROM l GROUP BY feature
QUALIFY row_number() OVER (ORDER BY avg(abs(v)) DESC, feature) <= 5""")
def shap_importance(spark, sf_dir):
    c = _lr_frame(spark, sf_dir)
    g = global_importance(c, LR_FEATURES, "fixed_linear")
    top = top_per_model(g, "shap_importance")
    return top.select("model", "feature", F.round("shap_importance", 4).alias("shap_importance"))


# ---------------------------------------------------------------------------
# Tree contributions
# ---------------------------------------------------------------------------
def _tree_contrib(spark, sf_dir):
    from riskspark.operators.treeshap import tree_contributions
    f, prep, names = prepared(spark, sf_dir)
    m = fit("XGBoost", prep, f.filter(F.col("split") == "train"))
    test = m.transform(f.filter(F.col("split") == "test"))
    return tree_contributions(test, m.stages[-1]), names


@query("tree_reasons")
def tree_reasons(spark, sf_dir):
    """M19 + M20: TreeSHAP top-10 reasons per test row of the boosted trees."""
    c, names = _tree_contrib(spark, sf_dir)
    expl = c.select("transaction_id", top_reasons(F.col("contrib"), names).alias("top_reasons"))
    return reasons_long(expl)


@query("tree_importance")
def tree_importance(spark, sf_dir):
    """M21 for trees: mean |TreeSHAP| per feature, top 5."""
    c, names = _tree_contrib(spark, sf_dir)
    return top_per_model(global_importance(c, names, "XGBoost"), "shap_importance")


def _smote_sql() -> str:
    """Rows per class and origin after balancing the training split: every
    original row, plus (majority - minority) synthetic minority rows (none
    when the classes are even or the minority has fewer than two rows)."""
    from riskspark.plans.q_prep import _U
    return Q.with_(Q.EV, Q.TX, f"""c AS (SELECT CAST(is_fraud AS DOUBLE) AS label, count(*) AS n
                                      FROM tx WHERE {_U} >= 0.28 GROUP BY 1)""",
                   "mi AS (SELECT label, n FROM c ORDER BY n, label LIMIT 1)",
                   "ma AS (SELECT label, n FROM c ORDER BY n DESC, label LIMIT 1)") + """
SELECT label, false AS synthetic, n FROM c
UNION ALL
SELECT mi.label, true, ma.n - mi.n FROM mi, ma
WHERE (SELECT count(*) FROM c) >= 2 AND ma.n > mi.n AND mi.n >= 2"""


@query("smote", sql=_smote_sql())
def q_smote(spark, sf_dir):
    """M6: the preprocessed training split balanced with exact-neighbour SMOTE;
    rows per class and origin."""
    from riskspark.operators.models import with_label
    from riskspark.operators.resample import smote
    f, prep, _ = prepared(spark, sf_dir)
    data = prep.transform(with_label(f.filter(F.col("split") == "train")))
    bal = smote(data.select("transaction_id", "features", "label"), "transaction_id", "features", "label")
    return bal.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"))
