"""Registry queries on a registry derived from the data: every day each of
the three rule models is "retrained" (one version per day), scored on that
day's transactions, the best one is promoted (R1-R5, W2, J4, J5, O5)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.operators import metrics as M
from riskspark.operators import registry as R
from riskspark.plans import sql as Q
from riskspark.plans.catalog import query
from riskspark.sources.derived import RULE_SCORERS, Workspace, scored_events

ORDER = list(RULE_SCORERS)


def _scored(spark, sf_dir):
    sc = scored_events(Workspace(spark, sf_dir).events, RULE_SCORERS)
    return sc.withColumn("day", F.to_date("scored_at"))


def daily_metrics(spark, sf_dir):
    g = ["model", "day"]
    # one pass over the scored rows feeds both metrics
    red = M.reduce_scored(_scored(spark, sf_dir), "label", "score", "pred", g)
    auc = M.roc_auc(red, "_ey", "_es", g, weight="_ew")
    prf = M.prf(red, "_ey", "_ep", g, weight="_ew").select("model", "day", "recall")
    ver = F.dense_rank().over(Window.partitionBy("model").orderBy("day"))
    return (auc.join(prf, ["model", "day"])
            .withColumn("model_version", ver.cast("int"))
            .withColumn("run_id", F.concat_ws("-", "model", F.col("day").cast("string"))))


def daily_best(spark, sf_dir, m=None):
    m = daily_metrics(spark, sf_dir) if m is None else m
    pos = F.array_position(F.array(*[F.lit(x) for x in ORDER]), F.col("model"))
    w = Window.partitionBy("day").orderBy(F.col("roc_auc").desc_nulls_last(), pos)
    return m.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).drop("_r")


_SC = Q.scored(RULE_SCORERS)
_C = """c AS (SELECT model, CAST(scored_at AS DATE) AS day, score AS s,
          sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS neg
          FROM sc GROUP BY ALL)"""
_AUC = """auc AS (SELECT a.model, a.day, sum(a.pos * b.neg * (CASE WHEN a.s > b.s THEN 1.0 WHEN a.s = b.s
             THEN 0.5 ELSE 0.0 END)) / (max(t.p) * max(t.n)) AS roc_auc
          FROM c a JOIN c b ON a.model = b.model AND a.day = b.day
          JOIN (SELECT model, day, sum(pos) AS p, sum(neg) AS n FROM c GROUP BY ALL) t
            ON t.model = a.model AND t.day = a.day GROUP BY a.model, a.day)"""
_REC = """rec AS (SELECT model, CAST(scored_at AS DATE) AS day,
          CASE WHEN sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) = 0 THEN 0.0 ELSE
          sum(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END) / sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)
          END AS recall FROM sc GROUP BY ALL)"""
_DM = """dm AS (SELECT model, day, roc_auc, recall,
          CAST(dense_rank() OVER (PARTITION BY model ORDER BY day) AS INTEGER) AS model_version
          FROM auc JOIN rec USING (model, day))"""
_ORD = "CASE model " + " ".join(f"WHEN '{m}' THEN {i + 1}" for i, m in enumerate(ORDER)) + " END"
_BEST = f"""best AS (SELECT * FROM dm QUALIFY row_number() OVER (PARTITION BY day
            ORDER BY roc_auc DESC NULLS LAST, {_ORD}) = 1)"""
_BASE = [Q.EV, _SC, _C, _AUC, _REC, _DM]


@query("daily_model_metrics", sql=Q.with_(*_BASE) + """
SELECT model, day, model_version, round(roc_auc, 6) AS roc_auc, round(recall, 6) AS recall FROM dm""")
def daily_model_metrics(spark, sf_dir):
    """One run and one new version per model and day, with metrics."""
    m = daily_metrics(spark, sf_dir)
    return m.select("model", "day", "model_version", F.round("roc_auc", 6).alias("roc_auc"),
                    F.round("recall", 6).alias("recall"))


@query("daily_best", sql=Q.with_(*_BASE, _BEST) + """
SELECT day, model, model_version, round(roc_auc, 6) AS roc_auc FROM best""")
def q_daily_best(spark, sf_dir):
    """O5 per day: best ROC AUC, ties to the first model in order."""
    b = daily_best(spark, sf_dir)
    return b.select("day", "model", "model_version", F.round("roc_auc", 6).alias("roc_auc"))


_EV = """ev2 AS (SELECT model AS model_name, 'production' AS alias, model_version, day AS set_at, 1 AS seq FROM best
  UNION ALL
  SELECT model, 'previous-production', prev, day, 0 FROM (
    SELECT *, lag(model_version) OVER (PARTITION BY model ORDER BY day) AS prev FROM best) WHERE prev IS NOT NULL)"""


@query("latest_alias", sql=Q.with_(*_BASE, _BEST, _EV) + """
SELECT a.model_name, a.alias, a.model_version, l.latest_version
FROM (SELECT model_name, alias, arg_max(model_version, (set_at, seq)) AS model_version
      FROM ev2 GROUP BY ALL) a
JOIN (SELECT model AS model_name, CAST(max(model_version) AS INTEGER) AS latest_version FROM dm GROUP BY 1) l
  USING (model_name)""")
def latest_alias(spark, sf_dir):
    """R3 + J4 + W2: alias holders after the daily promotions, next to each
    model's latest version."""
    m = daily_metrics(spark, sf_dir)
    best = daily_best(spark, sf_dir, m).select(F.col("day").alias("period"),
                                               F.col("model").alias("model_name"), "model_version")
    events = R.promotion_events(best)
    cur = R.current_aliases(events)
    vers = m.select(
        F.col("model").alias("model_name"), "model_version", F.col("day").alias("created_at"))
    latest = R.latest_versions(vers).withColumnRenamed("model_version", "latest_version")
    return cur.join(latest, "model_name").select("model_name", "alias", "model_version", "latest_version")


@query("audit", sql=Q.with_(*_BASE, _BEST, """prod AS (SELECT day + 1 AS day, model, model_version,
   roc_auc FROM best)""") + """
SELECT sc.transaction_id, sc.model AS model_name, p.model_version, round(sc.score, 6) AS score,
       sc.pred AS predicted_label, p.model || '-' || CAST(p.day - 1 AS VARCHAR) AS run_id,
       round(p.roc_auc, 6) AS run_roc_auc
FROM sc JOIN prod p ON p.model = sc.model AND p.day = CAST(sc.scored_at AS DATE)""")
def q_audit(spark, sf_dir):
    """Each transaction scored by the model in production that day
    (the previous day's winner), with its version, run and run metric."""
    best = daily_best(spark, sf_dir)
    prod = best.select(F.date_add("day", 1).alias("day"), F.col("model").alias("model_name"),
                       "model_version", "run_id", "roc_auc")
    sc = _scored(spark, sf_dir).withColumnRenamed("model", "model_name")
    # prod holds one row per day (bounded by the days covered, not by rows);
    # a shuffle join on (model, day) would put a whole day in one task
    preds = sc.join(F.broadcast(prod), ["model_name", "day"], "inner")
    return preds.select("transaction_id", "model_name", "model_version", F.round("score", 6).alias("score"),
                        F.col("pred").alias("predicted_label"), "run_id",
                        F.round("roc_auc", 6).alias("run_roc_auc"))
