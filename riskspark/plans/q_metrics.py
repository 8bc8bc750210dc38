"""Queries for the feedback join and exact metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.operators import metrics as M
from riskspark.operators.join import feedback_join, performance
from riskspark.plans import sql as Q
from riskspark.plans.catalog import query
from riskspark.sources.derived import Workspace, scored_events


def _r(c, n=6):
    return F.round(F.col(c), n).alias(c)


def _scored(spark, sf_dir):
    return scored_events(Workspace(spark, sf_dir).events)


@query("feedback_join", sql=Q.with_(Q.EV, Q.PRED, Q.FB) + """
SELECT p.transaction_id, p.predicted_label, p.confidence_score, f.actual_label, f.source,
       f.confirmed_at
FROM pred p INNER JOIN fb f ON p.transaction_id = f.transaction_id""")
def q_feedback_join(spark, sf_dir):
    ws = Workspace(spark, sf_dir)
    return feedback_join(ws.predictions(), ws.feedback())


@query("feedback_performance", sql=Q.with_(Q.EV, Q.PRED, Q.FB, """j AS (
  SELECT p.predicted_label AS p, f.actual_label AS y FROM pred p JOIN fb f USING (transaction_id))""",
  """c AS (SELECT sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS tp,
                  sum(CASE WHEN y = 0 AND p = 1 THEN 1 ELSE 0 END) AS fp,
                  sum(CASE WHEN y = 1 AND p = 0 THEN 1 ELSE 0 END) AS fn,
                  count(*) AS n FROM j)""") + f"""
SELECT CAST(n AS BIGINT) AS n_matched,
       round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(coalesce(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, {S.DEFAULT_RECALL}), 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1,
       (CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END) < {S.LOW_RECALL_THRESHOLD} AS low_recall_detected,
       true AS available
FROM c""")
def q_feedback_performance(spark, sf_dir):
    ws = Workspace(spark, sf_dir)
    perf = performance(feedback_join(ws.predictions(), ws.feedback(), ordered=False))
    return perf.select("n_matched", _r("precision"), _r("recall"), _r("f1"),
                       "low_recall_detected", "available")


@query("class_report", sql=Q.with_(Q.EV, Q.scored(), """c AS (
  SELECT sum(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS fn,
         sum(CASE WHEN label = 0 AND pred = 0 THEN 1 ELSE 0 END) AS tn FROM sc)""",
  """m AS (SELECT tp, fp, fn, tn, tp + fp + fn + tn AS n, tp + fn AS s1, tn + fp AS s0,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p1,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r1,
         CASE WHEN 2*tp + fp + fn = 0 THEN 0.0 ELSE 2*tp / (2*tp + fp + fn) END AS f1,
         CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0,
         CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0,
         CASE WHEN 2*tn + fn + fp = 0 THEN 0.0 ELSE 2*tn / (2*tn + fn + fp) END AS f0 FROM c)""") + """
SELECT '0' AS label, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1_score,
       CAST(s0 AS BIGINT) AS support FROM m
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), CAST(s1 AS BIGINT) FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, round((tp + tn) / n, 6), CAST(n AS BIGINT) FROM m
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6),
                 round((f0 + f1) / 2, 6), CAST(n AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6), round((r0 * s0 + r1 * s1) / n, 6),
                 round((f0 * s0 + f1 * s1) / n, 6), CAST(n AS BIGINT) FROM m""")
def q_class_report(spark, sf_dir):
    r = M.class_report(_scored(spark, sf_dir), "label", "pred")
    return r.select("label", _r("precision"), _r("recall"), _r("f1_score"),
                    F.col("support").cast("long").alias("support"))


# Oracles for the curve metrics pair distinct scores directly (no running
# window), so they check the running-sum plan independently.
_CNT = """c AS (SELECT score AS s, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
                 sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS neg FROM sc GROUP BY score)"""


@query("roc_auc", sql=Q.with_(Q.EV, Q.scored(), _CNT) + """
SELECT round(sum(a.pos * b.neg * (CASE WHEN a.s > b.s THEN 1.0 WHEN a.s = b.s THEN 0.5 ELSE 0.0 END))
             / ((SELECT sum(pos) FROM c) * (SELECT sum(neg) FROM c)), 6) AS roc_auc
FROM c a, c b""")
def q_roc_auc(spark, sf_dir):
    return M.roc_auc(_scored(spark, sf_dir), "label", "score").select(_r("roc_auc"))


_PTS = """t AS (SELECT a.s AS threshold, sum(b.pos) AS tp, sum(b.neg) AS fp
          FROM c a JOIN c b ON b.s >= a.s GROUP BY a.s)"""


@query("avg_precision", sql=Q.with_(Q.EV, Q.scored(), _CNT, _PTS) + """
SELECT round(sum(c.pos * (t.tp / (t.tp + t.fp))) / (SELECT sum(pos) FROM c), 6) AS average_precision
FROM t JOIN c ON c.s = t.threshold""")
def q_avg_precision(spark, sf_dir):
    return M.average_precision(_scored(spark, sf_dir), "label", "score").select(_r("average_precision"))


@query("pr_curve", sql=Q.with_(Q.EV, Q.scored(), _CNT, _PTS) + """
SELECT threshold, round(tp / (tp + fp), 6) AS precision,
       round(tp / (SELECT sum(pos) FROM c), 6) AS recall FROM t
UNION ALL SELECT NULL, 1.0, 0.0""")
def q_pr_curve(spark, sf_dir):
    c = M.pr_curve(_scored(spark, sf_dir), "label", "score")
    return c.select("threshold", _r("precision"), _r("recall"))


_MODELS = {"rule_a": (40, 37, 23), "rule_b": (30, 41, 29), "rule_c": (45, 31, 19)}


@query("evaluation_by_model", sql=Q.with_(Q.EV, Q.scored(_MODELS),
  """c AS (SELECT model, score AS s, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
                  sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS neg FROM sc GROUP BY model, score)""",
  """auc AS (SELECT a.model, sum(a.pos * b.neg * (CASE WHEN a.s > b.s THEN 1.0 WHEN a.s = b.s THEN 0.5
                  ELSE 0.0 END)) / (max(tp.p) * max(tp.n)) AS roc_auc
             FROM c a JOIN c b ON a.model = b.model
             JOIN (SELECT model, sum(pos) AS p, sum(neg) AS n FROM c GROUP BY model) tp ON tp.model = a.model
             GROUP BY a.model)""",
  """t AS (SELECT a.model, a.s, a.pos, sum(b.pos) AS tp, sum(b.neg) AS fp
           FROM c a JOIN c b ON a.model = b.model AND b.s >= a.s GROUP BY a.model, a.s, a.pos)""",
  """ap AS (SELECT model, sum(pos * tp / (tp + fp)) / sum(pos) AS pr_auc FROM t GROUP BY model)""",
  """pr AS (SELECT model, sum(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) AS tp,
                   sum(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END) AS fp,
                   sum(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS fn FROM sc GROUP BY model)""") + """
SELECT pr.model,
       round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN 2*tp + fp + fn = 0 THEN 0.0 ELSE 2*tp / (2*tp + fp + fn) END, 6) AS f1,
       round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc
FROM pr JOIN auc USING (model) JOIN ap USING (model)""")
def q_evaluation_by_model(spark, sf_dir):
    from riskspark.sources.derived import RULE_SCORERS
    sc = scored_events(Workspace(spark, sf_dir).events, RULE_SCORERS)
    e = M.evaluation(sc, "label", "score", "pred", ["model"])
    return e.select("model", *[_r(c) for c in ("precision", "recall", "f1", "roc_auc", "pr_auc")])


_RECORD = Q.with_(Q.EV, Q.scored(_MODELS),
  """c AS (SELECT model, score AS s, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
                  sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS neg FROM sc GROUP BY model, score)""",
  """tot AS (SELECT model, sum(pos) AS p, sum(neg) AS n FROM c GROUP BY model)""",
  """auc AS (SELECT a.model, sum(a.pos * b.neg * (CASE WHEN a.s > b.s THEN 1.0 WHEN a.s = b.s THEN 0.5
                  ELSE 0.0 END)) AS u FROM c a JOIN c b ON a.model = b.model GROUP BY a.model)""",
  """t AS (SELECT a.model, a.s, a.pos, sum(b.pos) AS tp, sum(b.neg) AS fp
           FROM c a JOIN c b ON a.model = b.model AND b.s >= a.s GROUP BY a.model, a.s, a.pos)""",
  """ap AS (SELECT model, sum(pos * tp / (tp + fp)) / sum(pos) AS pr_auc FROM t GROUP BY model)""",
  """low AS (SELECT model, min(s) AS s FROM c GROUP BY model, floor(s * 100))""",
  """pt AS (SELECT low.model, low.s AS threshold, tp / (tp + fp) AS precision, tp / p AS recall, fp / n AS fpr
            FROM low JOIN t ON t.model = low.model AND t.s = low.s JOIN tot ON tot.model = low.model
            UNION ALL SELECT model, NULL, 1.0, 0.0, 0.0 FROM tot)""",
  """m AS (SELECT model, count(*) AS n, sum(CASE WHEN label = pred THEN 1 ELSE 0 END) / count(*) AS accuracy,
                  sum(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END) AS fn FROM sc GROUP BY model)""") + """
SELECT pt.model, CAST(m.n AS BIGINT) AS n, CAST(m.fn AS BIGINT) AS fn, round(m.accuracy, 6) AS accuracy,
       round(u / (p * tot.n), 6) AS roc_auc, round(pr_auc, 6) AS pr_auc,
       threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(fpr, 6) AS fpr
FROM pt JOIN m USING (model) JOIN tot USING (model) JOIN auc USING (model) JOIN ap USING (model)"""


@query("evaluation_record", sql=_RECORD)
def q_evaluation_record(spark, sf_dir):
    """The nested record of each model, its curve laid out as rows."""
    from riskspark.sources.derived import RULE_SCORERS
    sc = scored_events(Workspace(spark, sf_dir).events, RULE_SCORERS)
    e = M.evaluation_record(sc, "label", "score", "pred", ["model"])
    accuracy = F.filter("report", lambda x: x["label"] == "accuracy")[0]["f1_score"]
    e = e.select("model", "n", F.col("confusion.fn").alias("fn"), accuracy.alias("accuracy"),
                 _r("roc_auc"), _r("pr_auc"), F.inline("curve"))
    return e.select("model", "n", "fn", _r("accuracy"), "roc_auc", "pr_auc", "threshold",
                    _r("precision"), _r("recall"), _r("fpr"))


@query("feedback_join_narrow", sql=Q.with_(Q.EV, Q.PRED, Q.FB) + """
SELECT p.transaction_id, p.predicted_label, f.actual_label, f.confirmed_at
FROM pred p INNER JOIN fb f ON p.transaction_id = f.transaction_id""")
def q_feedback_join_narrow(spark, sf_dir):
    """The on-demand monitor's narrower projection of the same join."""
    ws = Workspace(spark, sf_dir)
    return feedback_join(ws.predictions(), ws.feedback(), narrow=True)
