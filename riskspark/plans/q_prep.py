"""Preparation queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.operators import prep as P
from riskspark.plans import inject as I
from riskspark.plans import sql as Q
from riskspark.plans.catalog import query
from riskspark.sources.derived import Workspace

_U = "(CAST(('0x' || substr(md5('42:' || transaction_id), 1, 8)) AS UBIGINT) / 4294967296.0)"


@query("split_counts", sql=Q.with_(Q.EV, Q.TX) + f"""
SELECT CASE WHEN {_U} < 0.2 THEN 'test' WHEN {_U} < 0.28 THEN 'val' ELSE 'train' END AS split,
       count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS n_fraud
FROM tx GROUP BY 1""")
def split_counts(spark, sf_dir):
    s = P.split(Workspace(spark, sf_dir).transactions())
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("is_fraud").cast("long").alias("n_fraud"))


@query("split_exact_counts", sql=Q.with_(Q.EV, Q.TX, f"""r AS (
  SELECT *, row_number() OVER (ORDER BY {_U}, transaction_id) AS rk, count(*) OVER () AS n FROM tx)""",
  """c AS (SELECT CAST(ceil(0.2 * max(n)) AS BIGINT) AS nt, max(n) AS nn FROM r)""") + """
SELECT CASE WHEN rk <= nt THEN 'test' WHEN rk <= nt + CAST(ceil(0.1 * (nn - nt)) AS BIGINT) THEN 'val'
            ELSE 'train' END AS split,
       count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS n_fraud
FROM r, c GROUP BY 1""")
def split_exact_counts(spark, sf_dir):
    s = P.split(Workspace(spark, sf_dir).transactions(), exact=True)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("is_fraud").cast("long").alias("n_fraud"))


@query("class_balance", sql=Q.with_(Q.EV, Q.TX) + f"""
SELECT CASE WHEN {_U} < 0.2 THEN 'test' WHEN {_U} < 0.28 THEN 'val' ELSE 'train' END AS split,
       is_fraud, count(*) AS n FROM tx GROUP BY 1, 2""")
def class_balance(spark, sf_dir):
    """Class counts per split (the balancing input)."""
    s = P.split(Workspace(spark, sf_dir).transactions())
    return s.groupBy("split", "is_fraud").agg(F.count(F.lit(1)).alias("n"))


# NULLs in two numeric columns (amount by id % 9, history by id % 11)
def _num_nulls(tx):
    i = I.idnum()
    return tx.withColumn("transaction_amount", F.when(i % 9 == 0, None).otherwise(F.col("transaction_amount"))) \
             .withColumn("previous_transactions_count",
                         F.when(i % 11 == 0, None).otherwise(F.col("previous_transactions_count")))


_NN = """n AS (SELECT transaction_id,
  CASE WHEN CAST(substr(transaction_id, 5) AS BIGINT) % 9 = 0 THEN NULL ELSE transaction_amount END AS a,
  CASE WHEN CAST(substr(transaction_id, 5) AS BIGINT) % 11 = 0 THEN NULL
       ELSE CAST(previous_transactions_count AS DOUBLE) END AS h FROM tx)"""


@query("impute_scale", sql=Q.with_(Q.EV, Q.TX, _NN, """m AS (SELECT quantile_cont(a, 0.5) AS ma,
  quantile_cont(h, 0.5) AS mh FROM n)""", """i AS (SELECT transaction_id, coalesce(a, ma) AS a,
  coalesce(h, mh) AS h FROM n, m)""", """s AS (SELECT avg(a) AS xa, stddev_pop(a) AS sa, avg(h) AS xh,
  stddev_pop(h) AS sh FROM i)""") + """
SELECT transaction_id, round((a - xa) / (CASE WHEN sa = 0 THEN 1 ELSE sa END), 6) AS transaction_amount_scaled,
       round((h - xh) / (CASE WHEN sh = 0 THEN 1 ELSE sh END), 6) AS previous_transactions_count_scaled
FROM i, s""")
def impute_scale(spark, sf_dir):
    tx = _num_nulls(Workspace(spark, sf_dir).transactions())
    num = ["transaction_amount", "previous_transactions_count"]
    sqlt, _ = P.fit_impute_scale(tx, num, [])
    out = sqlt.transform(tx)
    return out.select("transaction_id",
                      *[F.round(f"{c}__scaled", 6).alias(f"{c}_scaled") for c in num])


@query("mode_impute", sql=Q.with_(Q.EV, Q.TX, f"n AS (SELECT {I.null_rules_sql()} FROM tx)",
  """u AS (UNPIVOT (SELECT transaction_type, transaction_location, device_type FROM n)
           ON transaction_type, transaction_location, device_type INTO NAME "column" VALUE value)""",
  """c AS (SELECT "column", value, count(*) AS n FROM u GROUP BY ALL)""") + """
SELECT "column", value AS mode, n FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value ASC) AS rk FROM c)
WHERE rk = 1""")
def mode_impute(spark, sf_dir):
    n = I.with_nulls(Workspace(spark, sf_dir).transactions())
    return P.modes(n, ["transaction_type", "transaction_location", "device_type"])


_OHE_COLS = {"device_type": sorted(S.DEVICE_TYPES),
             "transaction_type": sorted(["click", "error", "purchase", "signup", "view"])}


@query("one_hot", sql=Q.with_(Q.EV, Q.TX) + "SELECT transaction_id, " + ", ".join(
    f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS {c}_{v}"
    for c, vals in _OHE_COLS.items() for v in vals) + " FROM tx")
def one_hot(spark, sf_dir):
    """M3/M4: indexer + one-hot fitted on the training split, applied to all rows."""
    tx = Workspace(spark, sf_dir).transactions()
    train = P.split(tx).filter(F.col("split") == "train")
    cat = list(_OHE_COLS)
    model, names = P.fit_preprocessor(train, [], cat)
    arr = vector_to_array(F.col("features"))
    out = model.transform(tx).select("transaction_id", arr.alias("_v"))
    return out.select("transaction_id",
                      *[F.col("_v")[i].cast("int").alias(n) for i, n in enumerate(names)])


# ---------------------------------------------------------------------------
# M3 with a dictionary table: every customer is a category
# ---------------------------------------------------------------------------
_MANY = ["customer_id", "transaction_type", "device_type"]


@query("one_hot_ids", sql=Q.with_(Q.EV, Q.TX, f"""tr AS (SELECT * FROM tx WHERE {_U} >= 0.28)""",
  "v AS (" + " UNION ALL ".join(f"SELECT {i} AS place, '{c}' AS col, {c} AS value FROM tr GROUP BY {c}"
                                for i, c in enumerate(_MANY)) + ")",
  "dict AS (SELECT col, value, row_number() OVER (ORDER BY place, value) - 1 AS position FROM v)",
  "l AS (" + " UNION ALL ".join(f"SELECT transaction_id, '{c}' AS col, {c} AS value FROM tx" for c in _MANY) + ")") + """
SELECT l.transaction_id, CAST((SELECT count(*) FROM dict) AS BIGINT) AS size,
       array_to_string(list_sort(list(position) FILTER (position IS NOT NULL)), ',') AS positions
FROM l LEFT JOIN dict USING (col, value) GROUP BY 1""")
def one_hot_ids(spark, sf_dir):
    """M3: dictionary of the training rows, positions of every row."""
    from riskspark.operators import categories as C
    tx = P.split(Workspace(spark, sf_dir).transactions())
    d = C.dictionary(tx.filter(F.col("split") == "train"), _MANY)
    e = C.encode(tx, d, _MANY, "transaction_id")
    return e.select("transaction_id", "size", F.concat_ws(",", F.col("indices").cast("array<string>")).alias("positions"))
