"""Drift with missing sides and small samples (D1, D2, D3, D5), and checks on
coerced text (F10, V1-V3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.operators import drift as D
from riskspark.operators.validate import failure_cases, raw_rules
from riskspark.plans import inject as I
from riskspark.plans import q_drift as QD
from riskspark.plans import sql as Q
from riskspark.plans.catalog import query
from riskspark.sources.derived import Workspace

# Columns emptied on the current side, on the reference side and on both.
EMPTY_CUR = ["transaction_location", "transaction_hour"]
EMPTY_REF = ["transaction_type", "transaction_day"]
EMPTY_BOTH = ["device_type", "amount_by_device"]
_COLS = [*QD.NUM_COLS, *QD.CAT_COLS]

_GONE = ("f AS (SELECT * REPLACE ("
         + ", ".join([*(f"CASE WHEN _ref = 1 THEN {c} END AS {c}" for c in EMPTY_CUR),
                      *(f"CASE WHEN _ref = 0 THEN {c} END AS {c}" for c in EMPTY_REF),
                      *(f"CASE WHEN _ref = 2 THEN {c} END AS {c}" for c in EMPTY_BOTH)]) + ") FROM f0)")
_BOTH = "HAVING sum(n_ref) > 0 AND sum(n_cur) > 0"
_MISSING = Q.with_(
    Q.EV, Q.TX, Q.PRED, QD._F.replace("f AS (", "f0 AS (", 1), _GONE, QD._NUML, QD._CATL, QD._NCNT, QD._SCNT,
    QD._NTOT.replace("GROUP BY 1", f"GROUP BY 1 {_BOTH}"), QD._STOT.replace("GROUP BY 1", f"GROUP BY 1 {_BOTH}"),
    QD._CDF, QD._WS, QD._STD, QD._CAT, QD._JS, QD._PER,
    """sides AS (SELECT "column", sum(n_ref) AS r, sum(n_cur) AS c FROM
       (SELECT "column", n_ref, n_cur FROM nc UNION ALL SELECT "column", n_ref, n_cur FROM scn) GROUP BY 1)""")


@query("drift_missing", sql=_MISSING + f"""
SELECT l."column", coalesce(per.stattest, CASE WHEN coalesce(r, 0) > 0 THEN 'no_current'
         WHEN coalesce(c, 0) > 0 THEN 'no_reference' ELSE 'no_data' END) AS stattest,
       round(statistic, 6) AS statistic,
       CASE WHEN per.stattest IS NOT NULL THEN statistic >= {S.DRIFT_DISTANCE_THRESHOLD}
            ELSE coalesce(r, 0) + coalesce(c, 0) > 0 END AS drifted
FROM (SELECT unnest({_COLS}) AS "column") l LEFT JOIN per USING ("column") LEFT JOIN sides USING ("column")""")
def drift_missing(spark, sf_dir):
    """D1 on columns without values: every column keeps its row."""
    ref, cur = QD.frames(spark, sf_dir)
    for c in [*EMPTY_CUR, *EMPTY_BOTH]:
        cur = cur.withColumn(c, F.lit(None).cast(cur.schema[c].dataType))
    for c in [*EMPTY_REF, *EMPTY_BOTH]:
        ref = ref.withColumn(c, F.lit(None).cast(ref.schema[c].dataType))
    per = D.column_drift(ref, cur, method="distance")
    return per.select("column", "stattest", F.round("statistic", 6).alias("statistic"), "drifted")


# Days as rows: a sample small enough for the hypothesis tests.
_DAYS = f"""days AS (SELECT CAST(transaction_time AS DATE) AS day, CAST(count(*) AS DOUBLE) AS n,
    round(sum(transaction_amount), 4) AS total, max(transaction_amount) AS largest,
    CAST(sum(is_fraud) AS DOUBLE) AS n_fraud,
    CASE WHEN isodow(min(transaction_time)) > 5 THEN 'yes' ELSE 'no' END AS weekend,
    'quarter ' || CAST(isodow(min(transaction_time)) // 2 AS VARCHAR) AS part
    FROM tx GROUP BY 1)"""
_SMALL = ["n", "total", "largest", "n_fraud"]


def daily(spark, sf_dir):
    tx = Workspace(spark, sf_dir).transactions()
    dow = F.weekday(F.min("transaction_time")) + 1
    return tx.groupBy(F.to_date("transaction_time").alias("day")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.round(F.sum("transaction_amount"), 4).alias("total"),
        F.max("transaction_amount").alias("largest"), F.sum("is_fraud").cast("double").alias("n_fraud"),
        F.when(dow > 5, "yes").otherwise("no").alias("weekend"),
        F.concat(F.lit("quarter "), F.floor(dow / 2).cast("string")).alias("part"))


_AUTO = Q.with_(
    Q.EV, Q.TX, _DAYS,
    "d AS (SELECT *, CASE WHEN day < DATE '2024-01-16' THEN 1 ELSE 0 END AS r FROM days)",
    "l AS (UNPIVOT (SELECT r, " + ", ".join(_SMALL) + " FROM d) ON " + ", ".join(_SMALL)
    + ' INTO NAME "column" VALUE value)',
    """cdf AS (SELECT "column", value, sum(r) OVER w AS fr, sum(1 - r) OVER w AS fc,
       sum(r) OVER (PARTITION BY "column") AS nr, sum(1 - r) OVER (PARTITION BY "column") AS nq
       FROM l WINDOW w AS (PARTITION BY "column" ORDER BY value RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    """ks AS (SELECT "column", max(abs(fr / nr - fc / nq)) AS d, CAST(max(nr) AS BIGINT) AS nr, CAST(max(nq) AS BIGINT) AS nq
       FROM cdf GROUP BY 1)""",
    # Two samples of n values each: reflections of the paths at the lines k apart.
    """pv AS (SELECT "column", d, least(1.0, 2 * coalesce(list_sum([(CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END)
       * exp(2 * lgamma(nr + 1) - lgamma(nr - i * k + 1) - lgamma(nr + i * k + 1))
       for i in range(1, 1 + nr // greatest(k, 1))]), 0.5)) AS p
       FROM (SELECT *, CAST(round(d * nr) AS BIGINT) AS k FROM ks WHERE nr = nq))""",
    """cc AS (SELECT 'weekend' AS "column", weekend AS value, sum(r) AS a, sum(1 - r) AS b FROM d GROUP BY 2
       UNION ALL SELECT 'part', part, sum(r), sum(1 - r) FROM d GROUP BY 2)""",
    """ct AS (SELECT *, sum(a) OVER (PARTITION BY "column") AS ta, sum(b) OVER (PARTITION BY "column") AS tb FROM cc)""",
    """z AS (SELECT "column", (a / ta - b / tb) / sqrt((a + b) / (ta + tb) * (1 - (a + b) / (ta + tb)) * (1 / ta + 1 / tb)) AS z
       FROM ct WHERE "column" = 'weekend' AND value = 'no')""",
    """chi AS (SELECT "column", sum(power(b - a * tb / ta, 2) / (a * tb / ta)) AS chi2 FROM ct
       WHERE "column" = 'part' GROUP BY 1)""")


@query("drift_auto", sql=_AUTO + """
SELECT "column", 'ks' AS stattest, round(d, 6) AS statistic, round(p, 6) AS ks_p, p < 0.05 AS drifted FROM pv
UNION ALL SELECT "column", 'z', round(z, 6), NULL, abs(z) > 1.959963984540054 FROM z
UNION ALL SELECT "column", 'chisquare', round(chi2, 6), NULL, chi2 > 7.814727903251179 FROM chi""")
def drift_auto(spark, sf_dir):
    """D2 picks the tests by itself: days as rows are a small sample, so KS
    (exact p), z for two values and chi-square for more."""
    days = daily(spark, sf_dir).checkpoint()
    at = F.lit("2024-01-16").cast("date")
    per = D.column_drift(days.filter(F.col("day") < at), days.filter(F.col("day") >= at))
    return per.select("column", "stattest", F.round("statistic", 6).alias("statistic"),
                      F.when(F.col("stattest") == "ks", F.round("p_value", 6)).alias("ks_p"), "drifted")


_Z = ["is_fraud", "predicted_fraud"]


@query("drift_z", sql=Q.with_(Q.EV, Q.TX, Q.PRED, QD._F) + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", 'z' AS stattest, round(z, 6) AS statistic, abs(z) > 1.959963984540054 AS drifted
    FROM (SELECT (p1 - p2) / sqrt(pp * (1 - pp) * (1 / n1 + 1 / n2)) AS z FROM (
      SELECT sum(CASE WHEN _ref = 1 AND {c} = 0 THEN 1 ELSE 0 END) / sum(_ref) AS p1,
             sum(CASE WHEN _ref = 0 AND {c} = 0 THEN 1 ELSE 0 END) / sum(1 - _ref) AS p2,
             avg(CASE WHEN {c} = 0 THEN 1.0 ELSE 0.0 END) AS pp, sum(_ref) AS n1, sum(1 - _ref) AS n2 FROM f))"""
    for c in _Z))
def drift_z(spark, sf_dir):
    """Two-proportion z of the label and the prediction over all rows."""
    ref, cur = QD.frames(spark, sf_dir)
    per = D.column_drift(ref, cur, columns=_Z, method="test")
    return per.select("column", "stattest", F.round("statistic", 6).alias("statistic"), "drifted")


# Text columns as a headered file has them, with values no cast accepts.
_TEXT = f"""b AS (SELECT transaction_id, transaction_time, device_type,
  CASE WHEN {Q.idnum()} % 7 = 0 THEN 'abc' WHEN {Q.idnum()} % 11 = 0 THEN '-5' WHEN {Q.idnum()} % 13 = 0 THEN NULL
       WHEN {Q.idnum()} % 17 = 0 THEN ' 12.5 ' ELSE '20' END AS transaction_amount,
  CASE WHEN {Q.idnum()} % 19 = 0 THEN 'fraud' WHEN {Q.idnum()} % 23 = 0 THEN '7' ELSE CAST(is_fraud AS VARCHAR) END AS is_fraud
  FROM tx)"""
_ISIN = f"isin({S.LABEL_VALUES})"


@query("failure_cases_text", sql=Q.with_(Q.EV, Q.TX, _TEXT) + f"""
SELECT transaction_id AS row_key, 'transaction_amount' AS "column", 'coerce_dtype(''double'')' AS "check",
       transaction_amount AS failure_case FROM b
WHERE transaction_amount IS NOT NULL AND TRY_CAST(transaction_amount AS DOUBLE) IS NULL
UNION ALL SELECT transaction_id, 'transaction_amount', 'greater_than(0)', transaction_amount FROM b
WHERE TRY_CAST(transaction_amount AS DOUBLE) <= 0
UNION ALL SELECT transaction_id, 'transaction_amount', 'not_nullable', NULL FROM b WHERE transaction_amount IS NULL
UNION ALL SELECT transaction_id, 'is_fraud', 'coerce_dtype(''int'')', is_fraud FROM b
WHERE TRY_CAST(is_fraud AS INTEGER) IS NULL
UNION ALL SELECT transaction_id, 'is_fraud', '{_ISIN}', is_fraud FROM b WHERE TRY_CAST(is_fraud AS INTEGER) NOT IN (0, 1)""")
def failure_cases_text(spark, sf_dir):
    """amounts and labels that come as text are coerced, then judged."""
    i, tx = I.idnum(), Workspace(spark, sf_dir).transactions()
    amount = (F.when(i % 7 == 0, "abc").when(i % 11 == 0, "-5").when(i % 13 == 0, None)
              .when(i % 17 == 0, " 12.5 ").otherwise("20"))
    label = F.when(i % 19 == 0, "fraud").when(i % 23 == 0, "7").otherwise(F.col("is_fraud").cast("string"))
    return failure_cases(tx.withColumns({"transaction_amount": amount, "is_fraud": label}), raw_rules(), "transaction_id")
