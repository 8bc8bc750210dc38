"""Predictions meet confirmed outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.operators.metrics import prf


def feedback_join(predictions: DataFrame, feedback: DataFrame, ordered: bool = True,
                  narrow: bool = False) -> DataFrame:
    """J1 (J2 with ``narrow``): inner equi-join on transaction_id; repeated
    rows on either side multiply, as in SQL. AQE chooses broadcast or
    sort-merge from the real sizes and splits skewed keys.

    ``ordered`` adds the newest-first order (O1), a range-partitioned sort.
    """
    p = predictions.alias("p")
    f = feedback.alias("f")
    cols = [F.col("p.transaction_id"), F.col("p.predicted_label")]
    if not narrow:
        cols.append(F.col("p.confidence_score"))
    cols += [F.col("f.actual_label")]
    if not narrow:
        cols.append(F.col("f.source"))
    cols.append(F.col("f.confirmed_at"))
    j = p.join(f, F.col("p.transaction_id") == F.col("f.transaction_id"), "inner").select(*cols)
    if not ordered:
        return j
    # Ties on confirmed_at may come in any order (as in SQL); ordering them
    # by the other columns lets the range partitioner split a hot timestamp
    # across tasks instead of sending all its rows to one.
    ties = [F.col(c) for c in ("transaction_id", "actual_label", "predicted_label")]
    return j.orderBy(F.col("confirmed_at").desc(), *ties)


def performance(matched: DataFrame, label: str = "actual_label",
                pred: str = "predicted_label") -> DataFrame:
    """Precision, recall, F1 and the low-recall flag from matched rows.
    One row; ``available`` is false when nothing matched."""
    # counts and the number of matched rows in one aggregate: one pass over the join
    j = prf(matched, label, pred, count_as="n_matched")
    recall = F.coalesce(F.col("recall"), F.lit(S.DEFAULT_RECALL))
    return j.select(
        F.col("n_matched"),
        F.col("precision"), recall.alias("recall"), F.col("f1"),
        (recall < S.LOW_RECALL_THRESHOLD).alias("low_recall_detected"),
        (F.col("n_matched") > 0).alias("available"))
