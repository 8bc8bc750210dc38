"""Training preparation.

- ``split``: a seeded hash of the row key decides the split, so the result
  does not depend on partitioning or task retries (``randomSplit`` does).
  ``exact=True`` gives the reference's exact sizes (test = ceil(0.2·n), then
  val = ceil(0.1·rest)): the two border hashes are selected by counting passes.
- ``fit_preprocessor``: exact medians (linear interpolation), population
  mean / std of the imputed values, modes (count desc, value asc), then
  ``StringIndexer(keep) + OneHotEncoder(dropLast)`` — known values get full
  dummies, unseen ones all zeros — and ``VectorAssembler``. The fitted result
  is a ``PipelineModel`` (imputation and scaling are a ``SQLTransformer``
  with the fitted numbers), so it saves and loads with Spark ML.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark import schemas as S
from riskspark.functions.columns import unit_hash
from riskspark.operators.ordered import ordered_scan
from riskspark.operators.selection import counts, quantiles, select

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
ID_COLUMNS = ("transaction_id", "customer_id")


# ---------------------------------------------------------------------------
# M1 / W3
# ---------------------------------------------------------------------------
def split(df: DataFrame, key: str = "transaction_id", test_size: float = S.SPLIT_TEST_SIZE,
          val_size: float = S.SPLIT_VAL_SIZE, seed: int = S.SEED, exact: bool = False) -> DataFrame:
    """Add ``split`` ∈ {train, val, test}: 20 % test, then 10 % of the rest val."""
    u = unit_hash(key, seed=seed)
    if not exact:
        cut_val = test_size + (1 - test_size) * val_size
        return df.withColumn("split", F.when(u < test_size, "test")
                             .when(u < cut_val, "val").otherwise("train"))
    data = df.withColumn("_u", u)
    known = counts(data, "_u")
    if not known:
        return df.withColumn("split", F.lit(None).cast("string"))
    n = known[""]["n"]
    n_test = math.ceil(test_size * n)
    n_val = math.ceil(val_size * (n - n_test))
    found = select(data, "_u", {"": {n_test - 1, n_test + n_val - 1}}, known)
    (last_test, _), (last_val, _) = found["", n_test - 1], found["", n_test + n_val - 1]
    # Only rows that share the hash of a border are ranked, by key.
    border = F.col("_u").isin(last_test, last_val)
    below = F.create_map(*[F.lit(x) for v, b in dict(found.values()).items() for x in (v, b)])
    clear = data.filter(~border).withColumn(
        "split", F.when(F.col("_u") < last_test, "test").when(F.col("_u") < last_val, "val").otherwise("train"))
    tied = ordered_scan(data.filter(border), ["_u"], [key], count_as="_rank")
    rank = F.col("_rank") + below[F.col("_u")]
    tied = tied.withColumn("split", F.when(rank <= n_test, "test").when(rank <= n_test + n_val, "val").otherwise("train"))
    return clear.drop("_u").unionByName(tied.drop("_u", "_rank"))


# ---------------------------------------------------------------------------
# Columns by type
# ---------------------------------------------------------------------------
def feature_columns(df: DataFrame, target: str = S.TARGET, include_ids: bool = False,
                    exclude: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
    num, cat = [], []
    for f in df.schema.fields:
        if f.name == target or f.name in exclude or f.name == "split":
            continue
        if not include_ids and f.name in ID_COLUMNS:
            continue
        if isinstance(f.dataType, NUMERIC):
            num.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            cat.append(f.name)
    return num, cat


# ---------------------------------------------------------------------------
# A11 / A12
# ---------------------------------------------------------------------------
def medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """Exact medians of several columns, all in the same counting passes."""
    if not cols:
        return {}
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]) \
        .unpivot([], cols, "column", "value")
    return {c: None for c in cols} | {c: q[0] for c, q in quantiles(long, "value", [0.5], "column").items()}


def modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """Most frequent value per column: count desc, then value asc. One
    aggregate (combined map-side), no per-column window."""
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, mode string, n long")
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]) \
        .unpivot([], cols, "column", "value").filter(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("value"))).alias("b"))
    return best.select("column", F.col("b.value").alias("mode"), (-F.col("b.neg_n")).alias("n"))


def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(float(v))


def fit_impute_scale(df: DataFrame, num: list[str], cat: list[str]) -> tuple[SQLTransformer, dict]:
    """M2 + mode imputation as one SQL projection with fitted literals."""
    med = medians(df, num)
    imputed = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(med[c])).alias(c) for c in num])
    stats = imputed.agg(*[F.avg(c).alias(f"m_{c}") for c in num],
                        *[F.stddev_pop(c).alias(f"s_{c}") for c in num]).first() if num else None
    mode_rows = {r["column"]: r["mode"] for r in modes(df, cat).collect()}
    exprs, fitted = [], {"median": med, "mean": {}, "std": {}, "mode": mode_rows}
    for c in num:
        mean = stats[f"m_{c}"]
        std = stats[f"s_{c}"]
        scale = std if std not in (None, 0.0) else 1.0
        fitted["mean"][c], fitted["std"][c] = mean, scale
        exprs.append(f"(coalesce(CAST(`{c}` AS DOUBLE), {_sql_lit(med[c])}) - {_sql_lit(mean)}) "
                     f"/ {_sql_lit(scale)} AS `{c}__scaled`")
    for c in cat:
        exprs.append(f"coalesce(CAST(`{c}` AS STRING), {_sql_lit(mode_rows.get(c))}) AS `{c}__filled`")
    stmt = "SELECT *" + "".join(", " + e for e in exprs) + " FROM __THIS__"
    return SQLTransformer(statement=stmt), fitted


def fit_preprocessor(train: DataFrame, num: list[str], cat: list[str],
                     max_categories: int | None = None) -> tuple[PipelineModel, list[str]]:
    """M2-M4 fitted on training rows only. Returns the model and the names of
    the assembled features (numeric names, then ``{column}_{value}``). Every
    category is encoded; the fitted model holds the labels, so columns with
    millions of them are for ``operators/categories.py``. The columns are kept
    while they are fitted: a dozen passes read them."""
    kept = train.select(*num, *cat).persist()
    try:
        return _fit_stages(kept, num, cat, max_categories)
    finally:
        kept.unpersist()


def _fit_stages(train: DataFrame, num: list[str], cat: list[str],
                max_categories: int | None) -> tuple[PipelineModel, list[str]]:
    sqlt, _ = fit_impute_scale(train, num, cat)
    stages = [sqlt]
    if cat:
        stages.append(StringIndexer(inputCols=[f"{c}__filled" for c in cat],
                                    outputCols=[f"{c}__idx" for c in cat],
                                    handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in cat],
                                    outputCols=[f"{c}__ohe" for c in cat], dropLast=True))
    stages.append(VectorAssembler(inputCols=[f"{c}__scaled" for c in num] + [f"{c}__ohe" for c in cat],
                                  outputCol="features", handleInvalid="keep"))
    model = Pipeline(stages=stages).fit(train)
    names = list(num)
    if cat:
        labels = model.stages[1].labelsArray
        for c, labs in zip(cat, labels):
            if max_categories is not None and len(labs) > max_categories:
                raise ValueError(f"column {c} has {len(labs)} categories (> {max_categories})")
            names += [f"{c}_{v}" for v in labs]
    return model, names


def transform(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M5: apply fitted preprocessing to new rows."""
    return model.transform(df)
