"""Exact classification metrics (A4-A8, D11) as aggregates.

Curve metrics reduce scores to distinct values first (map-side combined),
then take running sums with ``ordered_scan`` (no single-partition window).
All functions accept ``groups`` (e.g. model, day) and return one row (or one
curve) per group. Conventions follow the reference's metric library:
precision / recall / F1 are 0 when their denominator is 0; ROC AUC gives ties
half credit and is NULL when a class is missing; average precision is the
step-wise sum of ΔR·P (not the trapezoid).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.operators.ordered import ordered_scan


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def _counted(e: Column, weight: str | None) -> Column:
    """A 0/1 condition as a count; on a reduced table each row stands for
    ``weight`` rows (NULL conditions stay NULL, as on the raw rows)."""
    return e.cast("long") * F.col(weight) if weight else e.cast("long")


def confusion(df: DataFrame, label: str, pred: str, groups: list[str] | None = None,
              count_as: str | None = None, weight: str | None = None) -> DataFrame:
    """TP, FP, FN, TN per group (conditional sums, one pass); ``count_as``
    adds the number of rows to the same aggregate."""
    y, p = F.col(label), F.col(pred)
    n = F.sum(weight) if weight else F.count(F.lit(1))
    extra = [n.alias(count_as)] if count_as else []
    return df.groupBy(*(groups or [])).agg(
        F.sum(_counted((y == 1) & (p == 1), weight)).alias("tp"),
        F.sum(_counted((y == 0) & (p == 1), weight)).alias("fp"),
        F.sum(_counted((y == 1) & (p == 0), weight)).alias("fn"),
        F.sum(_counted((y == 0) & (p == 0), weight)).alias("tn"),
        *extra,
    )


def prf(df: DataFrame, label: str, pred: str, groups: list[str] | None = None,
        count_as: str | None = None, weight: str | None = None) -> DataFrame:
    """A4: precision, recall and F1 of class 1."""
    c = confusion(df, label, pred, groups, count_as, weight)
    prec = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = _safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return c.select(*(groups or []), prec.alias("precision"), rec.alias("recall"),
                    f1.alias("f1"), "tp", "fp", "fn", "tn", *([count_as] if count_as else []))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """A5: rows '0', '1', 'accuracy', 'macro avg', 'weighted avg' with
    precision, recall, f1_score, support (accuracy sits in f1_score)."""
    return confusion(df, label, pred).select(F.inline(_report(*(F.col(x) for x in ("tp", "fp", "fn", "tn")))))


def _report(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    """The five rows of the report as an array of structs."""
    n = tp + fp + fn + tn
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    f1 = _safe_div(2 * tp, 2 * tp + fp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    f0 = _safe_div(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    acc = _safe_div(tp + tn, n)

    def row(name, p, r, f, sup):
        return F.struct(F.lit(name).alias("label"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1_score"),
                        sup.cast("long").alias("support"))

    none = F.lit(None).cast("double")
    return F.array(
        row("0", p0, r0, f0, s0),
        row("1", p1, r1, f1, s1),
        row("accuracy", none, none, acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", _safe_div(p0 * s0 + p1 * s1, n), _safe_div(r0 * s0 + r1 * s1, n),
            _safe_div(f0 * s0 + f1 * s1, n), n),
    )


def score_counts(df: DataFrame, label: str, score: str, groups: list[str] | None = None,
                 weight: str | None = None) -> DataFrame:
    """Positives and negatives per distinct score."""
    y = F.col(label)
    return df.groupBy(*(groups or []), F.col(score).cast("double").alias("_s")).agg(
        F.sum(_counted(y == 1, weight)).alias("_pos"),
        F.sum(_counted(y == 0, weight)).alias("_neg"))


def roc_auc(df: DataFrame, label: str, score: str, groups: list[str] | None = None,
            weight: str | None = None) -> DataFrame:
    """Mann-Whitney AUC, ties count one half. NULL when a class is absent."""
    g = list(groups or [])
    sc = score_counts(df, label, score, g, weight)
    run = ordered_scan(sc, g, ["_s"], sums={"_cneg": "_neg"})
    # negatives strictly below this score = running sum minus this score's own
    part = F.col("_pos") * ((F.col("_cneg") - F.col("_neg")) + 0.5 * F.col("_neg"))
    agg = run.groupBy(*g).agg(F.sum(part).alias("_u"), F.sum("_pos").alias("_p"),
                              F.sum("_neg").alias("_n"))
    auc = F.when((F.col("_p") == 0) | (F.col("_n") == 0), F.lit(None).cast("double")) \
        .otherwise(F.col("_u") / (F.col("_p").cast("double") * F.col("_n").cast("double")))
    return agg.select(*g, auc.alias("roc_auc"))


def _desc_running(df: DataFrame, label: str, score: str, groups: list[str],
                  weight: str | None = None) -> DataFrame:
    sc = score_counts(df, label, score, groups, weight)
    return ordered_scan(sc, groups, [F.col("_s").desc()], sums={"_tp": "_pos", "_fp": "_neg"})


def average_precision(df: DataFrame, label: str, score: str,
                      groups: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """Σ (R_k − R_{k−1})·P_k over thresholds from high to low.

    ΔR at a threshold is its positives / P, so AP = Σ pos·precision / P.
    """
    g = list(groups or [])
    run = _desc_running(df, label, score, g, weight)
    prec = F.col("_tp") / (F.col("_tp") + F.col("_fp"))
    agg = run.groupBy(*g).agg(F.sum(F.col("_pos") * prec).alias("_w"), F.sum("_pos").alias("_p"))
    ap = F.when(F.col("_p") == 0, F.lit(0.0)).otherwise(F.col("_w") / F.col("_p"))
    return agg.select(*g, ap.alias("average_precision"))


def pr_curve(df: DataFrame, label: str, score: str, groups: list[str] | None = None) -> DataFrame:
    """One row per distinct threshold (precision, recall) plus the final
    point (precision 1, recall 0, threshold NULL). With no positives recall
    is 1 everywhere."""
    g = list(groups or [])
    run = _desc_running(df, label, score, g)
    totals = run.groupBy(*g).agg(F.sum("_pos").alias("_p"))
    j = run.join(totals, g, "inner") if g else run.withColumn("_k", F.lit(1)).join(
        F.broadcast(totals.withColumn("_k", F.lit(1))), "_k").drop("_k")
    prec = F.when(F.col("_tp") + F.col("_fp") == 0, F.lit(0.0)) \
        .otherwise(F.col("_tp") / (F.col("_tp") + F.col("_fp")))
    rec = F.when(F.col("_p") == 0, F.lit(1.0)).otherwise(F.col("_tp") / F.col("_p"))
    pts = j.select(*g, F.col("_s").alias("threshold"), prec.alias("precision"), rec.alias("recall"))
    end = totals.select(*g, F.lit(None).cast("double").alias("threshold"),
                        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def reduce_scored(df: DataFrame, label: str, score: str, pred: str,
                  groups: list[str] | None = None) -> DataFrame:
    """Scored rows reduced (map-side combined) to a count ``_ew`` per
    ``(groups, _es score, _ey label, _ep prediction)`` and checkpointed to
    the shared folder, so several metrics read the rows once. Pass
    ``weight="_ew"`` to the metric functions."""
    g = list(groups or [])
    return (df.groupBy(*g, F.col(score).cast("double").alias("_es"), F.col(label).alias("_ey"),
                       F.col(pred).alias("_ep"))
            .agg(F.count(F.lit(1)).alias("_ew"))
            .checkpoint(eager=True))


def evaluation_record(df: DataFrame, label: str, score: str, pred: str,
                      groups: list[str] | None = None, grid: int = 100) -> DataFrame:
    """The whole evaluation of a group (e.g. a model) in one nested row.

    - ``precision, recall, f1, roc_auc, pr_auc, n`` (conventions as above)
    - ``report``: the class report (A5), ``confusion``: tp, fp, fn, tn
    - ``curve``: precision and recall (ROC: fpr; recall is tpr) at the lowest
      score of each ``1/grid`` step that holds a score, falling, then the end
      point (threshold NULL, precision 1, recall 0). Each point is exact for
      its threshold; the array has at most one point a step, whatever the
      number of rows. ``pr_curve`` gives every distinct threshold as rows.

    Rows without a score or label are left out. The rows are read once
    (reduced to counts, map-side combined); one range shuffle orders the
    counts and feeds every curve value; AUC counts the positives above each
    score's negatives, so it needs no second, rising pass."""
    g = list(groups or [])
    known = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    y, no, p, q = F.col(label) == 1, F.col(label) == 0, F.col(pred) == 1, F.col(pred) == 0
    counts = ["_pos", "_neg", "_tp1", "_fp1", "_fn1", "_tn1"]
    reduced = known.groupBy(*g, F.col(score).cast("double").alias("_s")).agg(
        F.sum(y.cast("long")).alias("_pos"), F.sum(no.cast("long")).alias("_neg"),
        F.sum((y & p).cast("long")).alias("_tp1"), F.sum((no & p).cast("long")).alias("_fp1"),
        F.sum((y & q).cast("long")).alias("_fn1"), F.sum((no & q).cast("long")).alias("_tn1"))
    run = ordered_scan(reduced, g, [F.col("_s").desc()], sums={"_tp": "_pos", "_fp": "_neg"})
    above = F.col("_tp") - 0.5 * F.col("_pos")          # positives above, ties one half
    steps = run.groupBy(*g, F.floor(F.col("_s") * grid).alias("_step")).agg(
        F.min("_s").alias("threshold"), F.max("_tp").alias("_tp"), F.max("_fp").alias("_fp"),
        *[F.sum(c).alias(c) for c in counts],
        F.sum(F.col("_neg") * above).alias("_u"),
        F.sum(F.col("_pos") * F.col("_tp") / (F.col("_tp") + F.col("_fp"))).alias("_w"))
    one = steps.groupBy(*g).agg(
        *[F.sum(c).alias(c) for c in (*counts, "_u", "_w")],
        F.sort_array(F.collect_list(F.struct("threshold", "_tp", "_fp")), asc=False).alias("_at"))
    pos, neg, tp, fp, fn, tn = (F.coalesce(F.col(c), F.lit(0)) for c in counts)     # no prediction counts in none

    def rate(part, whole, empty):
        return F.when(whole == 0, F.lit(empty)).otherwise(part / whole)

    points = F.transform("_at", lambda x: F.struct(
        x["threshold"].alias("threshold"), rate(x["_tp"], x["_tp"] + x["_fp"], 0.0).alias("precision"),
        rate(x["_tp"], pos, 1.0).alias("recall"), rate(x["_fp"], neg, 0.0).alias("fpr")))
    end = F.array(F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                           F.lit(0.0).alias("recall"), F.lit(0.0).alias("fpr")))
    return one.filter(F.size("_at") > 0).select(
        *g, _safe_div(tp, tp + fp).alias("precision"), _safe_div(tp, tp + fn).alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.when((pos > 0) & (neg > 0), F.col("_u") / (pos.cast("double") * neg)).alias("roc_auc"),
        rate(F.col("_w"), pos, 0.0).alias("pr_auc"), (pos + neg).alias("n"),
        _report(tp, fp, fn, tn).alias("report"),
        F.struct(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn")).alias("confusion"),
        F.concat(points, end).alias("curve"))


def evaluation(df: DataFrame, label: str, score: str, pred: str,
               groups: list[str] | None = None) -> DataFrame:
    """The five numbers of the evaluation record (M17), one row per group."""
    return evaluation_record(df, label, score, pred, groups).select(
        *(groups or []), "precision", "recall", "f1", "roc_auc", "pr_auc")
