"""Drift between a reference and a current frame.

Plan: tag both sides, unpivot the chosen columns into ``(column, value)``,
count per ``(column, value)`` and side (map-side combined), then

- numeric columns: running counts per column in value order
  (``ordered_scan``; a hot column is split across slices) give the
  Kolmogorov-Smirnov D and the Wasserstein-1 distance;
- categorical columns: share vectors give Jensen-Shannon, chi-square and the
  two-proportion z statistic.

Only per-column statistics (one row per column) reach the driver, where
p-values and decisions are taken. Test choice follows the defaults of the
drift library the reference calls: at most 1,000 reference rows → tests at
p < 0.05 (KS for numeric, chi-square or z for categories); more → distances
at ≥ 0.1 (Wasserstein / std for numeric, Jensen-Shannon for categories);
numeric columns with at most 5 reference values count as categories.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark import schemas as S
from riskspark.operators.ordered import ordered_scan

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


# ---------------------------------------------------------------------------
# p-values (driver, scalars)
# ---------------------------------------------------------------------------
KS_EXACT = 10_000        # samples of at most this size have the exact distribution


def ks_exact(d: float, n1: int, n2: int) -> float:
    """P(D >= d) of two samples of one continuous distribution. Each order of
    the pooled values is a lattice path from (0, 0) to (n1, n2), all equally
    likely; D stays below d where no point of the path has
    ``|i / n1 - j / n2| >= d``. ``f[i]`` is the share of the paths to (i, k - i)
    that stay inside. The last step to a point came from the left with chance
    i / k and from below with (k - i) / k, so a diagonal follows from the one
    before and all values are shares."""
    m, n = sorted((n1, n2))
    edge = math.floor(d * m * n + 0.5) - 0.5        # |i n - j m| is a whole number
    i = np.arange(m + 1)
    f = np.zeros(m + 1)
    f[0] = 1.0 if edge > 0 else 0.0
    for k in range(1, m + n + 1):
        j = k - i
        step = f * np.clip(j, 0, None) / k          # from (i, j - 1)
        step[1:] += f[:-1] * i[1:] / k              # from (i - 1, j)
        f = np.where((j >= 0) & (j <= n) & (np.abs(i * n - j * m) <= edge), step, 0.0)
    return float(min(1.0, max(0.0, 1.0 - f[m])))


def ks_pvalue(d: float, n1: int, n2: int) -> float:
    """Two-sided p-value of the two-sample KS statistic: exact up to KS_EXACT
    rows a side, else the Kolmogorov limit."""
    if n1 == 0 or n2 == 0:
        return float("nan")
    if max(n1, n2) <= KS_EXACT:
        return ks_exact(d, n1, n2)
    en = n1 * n2 / (n1 + n2)
    z = math.sqrt(en) * d
    if z < 1e-8:
        return 1.0
    total = 0.0
    for k in range(1, 101):
        term = 2.0 * (-1) ** (k - 1) * math.exp(-2.0 * k * k * z * z)
        total += term
        if abs(term) < 1e-16:
            break
    return min(max(total, 0.0), 1.0)


def _gammq(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x) (series / continued fraction)."""
    if x <= 0:
        return 1.0
    gln = math.lgamma(a)
    if x < a + 1.0:
        ap, s, d = a, 1.0 / a, 1.0 / a
        for _ in range(1000):
            ap += 1.0
            d *= x / ap
            s += d
            if abs(d) < abs(s) * 1e-15:
                break
        return max(0.0, 1.0 - s * math.exp(-x + a * math.log(x) - gln))
    b = x + 1.0 - a
    c = 1.0 / 1e-300
    d = 1.0 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return min(1.0, math.exp(-x + a * math.log(x) - gln) * h)


def chi2_pvalue(stat: float, dof: int) -> float:
    if dof <= 0:
        return 1.0
    if math.isinf(stat):
        return 0.0
    return _gammq(dof / 2.0, stat / 2.0)


def z_pvalue(z: float | None) -> float:
    if z is None or math.isnan(z):
        return 1.0
    return math.erfc(abs(z) / math.sqrt(2.0))


# ---------------------------------------------------------------------------
# Column choice
# ---------------------------------------------------------------------------
def drift_columns(ref: DataFrame, cur: DataFrame, include_ids: bool = False,
                  columns: list[str] | None = None) -> tuple[list[str], list[str]]:
    """Shared numeric and string columns; timestamps are left out, and so are
    identifier columns (``*_id``) unless ``include_ids``."""
    shared = [c for c in ref.columns if c in set(cur.columns)]
    if columns is not None:
        shared = [c for c in shared if c in set(columns)]
    num, cat = [], []
    for c in shared:
        t = ref.schema[c].dataType
        if not include_ids and c.endswith("_id"):
            continue
        if isinstance(t, NUMERIC):
            num.append(c)
        elif isinstance(t, (T.StringType, T.BooleanType)):
            cat.append(c)
    return num, cat


def _tagged(ref: DataFrame, cur: DataFrame, cols: list[str], as_type: str) -> DataFrame:
    r = ref.select(F.lit(1).alias("_ref"), *[F.col(c).cast(as_type).alias(c) for c in cols])
    c = cur.select(F.lit(0).alias("_ref"), *[F.col(c).cast(as_type).alias(c) for c in cols])
    return r.unionByName(c)


def value_counts(ref: DataFrame, cur: DataFrame, cols: list[str], as_type: str) -> DataFrame:
    """``(column, value, n_ref, n_cur)``: one row per distinct value; NULLs are
    not values."""
    if not cols:
        sch = f"column string, value {as_type}, n_ref long, n_cur long"
        return ref.sparkSession.createDataFrame([], sch)
    long = _tagged(ref, cur, cols, as_type).unpivot("_ref", cols, "column", "value")
    return (long.filter(F.col("value").isNotNull())
            .groupBy("column", "value")
            .agg(F.sum("_ref").cast("long").alias("n_ref"),
                 F.sum(1 - F.col("_ref")).cast("long").alias("n_cur")))


def value_counts_both(ref: DataFrame, cur: DataFrame, num: list[str],
                      cat: list[str]) -> tuple[DataFrame, DataFrame]:
    """Numeric and categorical value counts from ONE pass over both frames
    (``stack`` to ``(column, number, text)``, one grouped aggregate), kept
    as a checkpoint and split by kind."""
    cols = num + cat
    tagged = ref.select(F.lit(1).alias("_ref"), *cols).unionByName(
        cur.select(F.lit(0).alias("_ref"), *cols))
    parts = []
    for c in cols:
        q = "`" + c + "`"
        if c in num:
            parts += [f"'{c}'", f"CAST({q} AS DOUBLE)", "CAST(NULL AS STRING)"]
        else:
            parts += [f"'{c}'", "CAST(NULL AS DOUBLE)", f"CAST({q} AS STRING)"]
    long = tagged.select("_ref", F.expr(f"stack({len(cols)}, {', '.join(parts)})")
                         .alias("column", "vnum", "vstr"))
    counts = (long.filter(F.col("vnum").isNotNull() | F.col("vstr").isNotNull())
              .groupBy("column", "vnum", "vstr")
              .agg(F.sum("_ref").cast("long").alias("n_ref"),
                   F.sum(1 - F.col("_ref")).cast("long").alias("n_cur"))
              .checkpoint(eager=True))
    ncounts = counts.filter(F.col("column").isin(num)).select(
        "column", F.col("vnum").alias("value"), "n_ref", "n_cur")
    scounts = counts.filter(F.col("column").isin(cat)).select(
        "column", F.col("vstr").alias("value"), "n_ref", "n_cur")
    return ncounts, scounts


def _with_totals(counts: DataFrame) -> DataFrame:
    tot = counts.groupBy("column").agg(
        F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"),
        F.sum((F.col("n_ref") > 0).cast("long")).alias("nunique_ref"))
    # one row per column: AQE broadcasts it at run time
    return counts.join(tot, "column")


# ---------------------------------------------------------------------------
# Statistics per column (Spark)
# ---------------------------------------------------------------------------
def numeric_stats(ref: DataFrame, cur: DataFrame, cols: list[str],
                  counts: DataFrame | None = None) -> DataFrame:
    """Per numeric column: ks_d, wasserstein (raw), ref_std, tot_ref, tot_cur,
    nunique_ref — all from the reduced ``(column, value, n_ref, n_cur)`` table
    (no second pass over the rows)."""
    counts = counts if counts is not None else value_counts(ref, cur, cols, "double")
    counts = counts.filter(F.col("column").isin(cols))
    run = ordered_scan(counts, ["column"], ["value"],
                       sums={"_cr": "n_ref", "_cc": "n_cur"}, lags={"_pv": "value"})
    j = _with_totals(run)
    # a side without values has no distribution: NULL, not a division by zero
    fr = F.try_divide(F.col("_cr"), F.col("tot_ref"))
    fc = F.try_divide(F.col("_cc"), F.col("tot_cur"))
    # CDF difference just below this value, times the gap to the previous value
    fr_prev = F.try_divide(F.col("_cr") - F.col("n_ref"), F.col("tot_ref"))
    fc_prev = F.try_divide(F.col("_cc") - F.col("n_cur"), F.col("tot_cur"))
    gap = F.when(F.col("_pv").isNull(), F.lit(0.0)).otherwise(F.col("value") - F.col("_pv"))
    stats = j.groupBy("column").agg(
        F.max(F.abs(fr - fc)).alias("ks_d"),
        F.sum(F.abs(fr_prev - fc_prev) * gap).alias("wasserstein"),
        F.first("tot_ref").alias("tot_ref"), F.first("tot_cur").alias("tot_cur"),
        F.first("nunique_ref").alias("nunique_ref"))
    return stats.join(ref_std(counts), "column", "left")


def ref_std(counts: DataFrame) -> DataFrame:
    """Population std of the reference side per column, two passes over the
    counts table (mean, then squared deviations)."""
    m = counts.groupBy("column").agg(
        F.try_divide(F.sum(F.col("n_ref") * F.col("value")), F.sum("n_ref")).alias("_m"))
    dev = counts.join(m, "column").groupBy("column").agg(
        F.try_divide(F.sum(F.col("n_ref") * (F.col("value") - F.col("_m")) ** 2),
                     F.sum("n_ref")).alias("_v"))
    return dev.select("column", F.sqrt("_v").alias("ref_std"))


def nunique_ref(counts: DataFrame) -> DataFrame:
    """Distinct reference values per column."""
    return counts.groupBy("column").agg(F.sum((F.col("n_ref") > 0).cast("long")).alias("nunique_ref"))


def categorical_stats(ref: DataFrame, cur: DataFrame, cols: list[str],
                      as_type: str = "string", counts: DataFrame | None = None) -> DataFrame:
    """Per categorical column: js (natural log), chi2 statistic and dof, the
    two-proportion z (2 values), tot_ref, tot_cur, nunique_ref, n_values."""
    counts = counts if counts is not None else value_counts(ref, cur, cols, as_type)
    counts = _with_totals(counts.filter(F.col("column").isin(cols)))
    p = F.try_divide(F.col("n_ref"), F.col("tot_ref"))
    q = F.try_divide(F.col("n_cur"), F.col("tot_cur"))
    m = (p + q) / 2
    kl = (F.when(p > 0, p * F.log(p / m)).otherwise(0.0)
          + F.when(q > 0, q * F.log(q / m)).otherwise(0.0))
    exp = F.col("n_ref") * F.try_divide(F.col("tot_cur"), F.col("tot_ref"))
    chi = F.when(exp == 0, F.when(F.col("n_cur") > 0, F.lit(float("inf"))).otherwise(0.0)) \
        .otherwise((F.col("n_cur") - exp) ** 2 / exp)
    first_val = F.min("value")
    agg = counts.groupBy("column").agg(
        F.sqrt(F.greatest(F.sum(kl) / 2, F.lit(0.0))).alias("js"),
        F.sum(chi).alias("chi2"),
        (F.count(F.lit(1)) - 1).alias("chi2_dof"),
        F.count(F.lit(1)).alias("n_values"),
        F.first("tot_ref").alias("tot_ref"), F.first("tot_cur").alias("tot_cur"),
        F.first("nunique_ref").alias("nunique_ref"),
        first_val.alias("_key0"))
    # z for two values: shares of the first value (by order) on both sides
    k0 = counts.join(agg.select("column", "_key0"), "column") \
        .filter(F.col("value") == F.col("_key0")) \
        .select("column", F.try_divide("n_ref", "tot_ref").alias("_p1"), F.try_divide("n_cur", "tot_cur").alias("_p2"))
    out = agg.join(k0, "column", "left")
    pooled = (F.col("_p1") * F.col("tot_ref") + F.col("_p2") * F.col("tot_cur")) / \
        (F.col("tot_ref") + F.col("tot_cur"))
    one = F.lit(1.0)
    den = F.sqrt(pooled * (1 - pooled) * (F.try_divide(one, F.col("tot_ref")) + F.try_divide(one, F.col("tot_cur"))))
    z = F.when(den > 0, (F.col("_p1") - F.col("_p2")) / den)
    return out.withColumn("z", z).drop("_key0", "_p1", "_p2")


# ---------------------------------------------------------------------------
# Per-column decision table (driver holds one row per column)
# ---------------------------------------------------------------------------
DRIFT_SCHEMA = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("column_type", T.StringType()),
    T.StructField("stattest", T.StringType()),
    T.StructField("statistic", T.DoubleType()),
    T.StructField("p_value", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("drifted", T.BooleanType()),
])


@dataclass
class DriftReport:
    columns: DataFrame            # DRIFT_SCHEMA rows
    n_columns: int
    n_drifted: int
    share: float
    dataset_drift: bool
    target_drift: bool | None
    prediction_drift: bool | None


NO_DATA, NO_REFERENCE, NO_CURRENT = "no_data", "no_reference", "no_current"


def _choose(kind: str, n_ref: int, nunique: int, method: str) -> str:
    small = n_ref <= S.DRIFT_SMALL_SAMPLE if method == "auto" else method == "test"
    if kind == "num" and nunique > S.DRIFT_CATEGORY_MAX_VALUES:
        return "ks" if small else "wasserstein"
    if small:
        return "chisquare" if nunique > 2 else "z"
    return "jensenshannon"


def column_drift(ref: DataFrame, cur: DataFrame, columns: list[str] | None = None,
                 method: str = "auto", include_ids: bool = False) -> DataFrame:
    """One row per column (``DRIFT_SCHEMA``). ``method``: ``auto`` (by
    reference size), ``test`` or ``distance``. A column without values on a
    side keeps its row, with the state in place of the test: ``no_current``
    and ``no_reference`` count as drifted, ``no_data`` (neither) does not."""
    spark: SparkSession = ref.sparkSession
    num, cat = drift_columns(ref, cur, include_ids, columns)
    rows = []
    nstats, cstats = {}, {}
    if not num and not cat:
        return spark.createDataFrame([], DRIFT_SCHEMA)
    # one pass over the rows: the reduced table serves the numeric tests, the
    # reference std, the few-valued columns and the categorical tests
    ncounts, scounts = value_counts_both(ref, cur, num, cat)
    if num:
        nun = {r["column"]: r["nunique_ref"] for r in nunique_ref(ncounts).collect()}
        few = [c for c in num if nun.get(c, 0) <= S.DRIFT_CATEGORY_MAX_VALUES]
        many = [c for c in num if c not in few]
        if many:
            nstats = {r["column"]: r for r in numeric_stats(ref, cur, many, ncounts).collect()}
        if few:
            cstats.update({r["column"]: r for r in
                           categorical_stats(ref, cur, few, "double", ncounts).collect()})
    else:
        few = []
    if cat:
        cstats.update({r["column"]: r for r in categorical_stats(ref, cur, cat, counts=scounts).collect()})
    for c in num + cat:
        kind = "num" if c in nstats and c not in few else "cat"
        st = nstats.get(c) or cstats.get(c)
        n_ref, n_cur = (int(st["tot_ref"] or 0), int(st["tot_cur"] or 0)) if st else (0, 0)
        if not n_ref or not n_cur:
            # Values came or went altogether: drift. None on either side: nothing to compare.
            state = NO_DATA if not n_ref and not n_cur else NO_REFERENCE if not n_ref else NO_CURRENT
            rows.append((c, "num" if c in num else "cat", state, None, None, None, state != NO_DATA))
            continue
        nun = int(st["nunique_ref"] or 0)
        test = _choose(kind, n_ref, nun, method)
        if test == "ks":
            stat, p = st["ks_d"], ks_pvalue(st["ks_d"], n_ref, n_cur)
        elif test == "wasserstein":
            norm = max(st["ref_std"] or 0.0, S.WASSERSTEIN_STD_FLOOR)
            stat, p = st["wasserstein"] / norm, None
        elif test == "chisquare":
            stat, p = st["chi2"], chi2_pvalue(st["chi2"], int(st["chi2_dof"]))
        elif test == "z":
            stat, p = st["z"], z_pvalue(st["z"])
        else:
            stat, p = st["js"], None
        if p is not None:
            thr, drifted = S.DRIFT_P_THRESHOLD, p < S.DRIFT_P_THRESHOLD
        else:
            thr, drifted = S.DRIFT_DISTANCE_THRESHOLD, stat is not None and stat >= S.DRIFT_DISTANCE_THRESHOLD
        rows.append((c, "num" if kind == "num" else "cat", test,
                     None if stat is None else float(stat), None if p is None else float(p),
                     thr, bool(drifted)))
    return spark.createDataFrame(rows, DRIFT_SCHEMA)


def dataset_summary(per_column: DataFrame) -> DataFrame:
    """Number and share of drifted columns, dataset drift flag."""
    return per_column.agg(
        F.count(F.lit(1)).alias("number_of_columns"),
        F.sum(F.col("drifted").cast("long")).alias("number_of_drifted_columns"),
        F.avg(F.col("drifted").cast("double")).alias("share_of_drifted_columns"),
    ).withColumn("dataset_drift",
                 F.col("share_of_drifted_columns") >= F.lit(S.DATASET_DRIFT_SHARE))


def drift_report(ref: DataFrame, cur: DataFrame, method: str = "auto",
                 include_ids: bool = False, target: str = S.TARGET,
                 prediction: str = S.PREDICTION_COLUMN) -> DriftReport:
    """Per-column table, dataset share, target drift (always when the
    label is on both sides), prediction drift (only when both sides are
    scored)."""
    per = column_drift(ref, cur, method=method, include_ids=include_ids)
    rows = {r["column"]: r for r in per.collect()}
    n = len(rows)
    nd = sum(1 for r in rows.values() if r["drifted"])
    share = nd / n if n else 0.0
    tgt = rows[target]["drifted"] if target in rows else None
    pred = rows[prediction]["drifted"] if prediction in rows else None
    return DriftReport(per, n, nd, share, share >= S.DATASET_DRIFT_SHARE, tgt, pred)


# ---------------------------------------------------------------------------
# Severity and the run record
# ---------------------------------------------------------------------------
def severity_expr(share, prediction_drift, target_drift, recall):
    """D12 as a column expression; NULL flags count as false, NULL recall as
    healthy."""
    serious = ((share >= S.SERIOUS_DRIFT_THRESHOLD)
               | F.coalesce(prediction_drift, F.lit(False))
               | F.coalesce(target_drift, F.lit(False))
               | F.coalesce(recall < S.LOW_RECALL_THRESHOLD, F.lit(False)))
    return (F.when(serious, F.lit("serious"))
            .when(share >= S.NEGLIGIBLE_DRIFT_THRESHOLD, F.lit("negligible"))
            .otherwise(F.lit("none")))


RESULT_SCHEMA = (
    "run_id string, checked_at timestamp, "
    "data_drift struct<drift_score: double, drifted_features: int, dataset_drift_detected: boolean>, "
    "target_drift struct<drift_detected: boolean, available: boolean>, "
    "prediction_drift struct<drift_detected: boolean, available: boolean>, "
    "performance struct<available: boolean, reason: string, precision: double, recall: double, "
    "f1: double, low_recall_detected: boolean>, "
    "drift_severity string, retraining_recommended boolean"
)


def run_record(spark: SparkSession, report: DriftReport, performance: dict | None,
               run_id: str, checked_at=None) -> DataFrame:
    """One nested row per monitoring run."""
    import datetime as _dt
    perf = performance or {"available": False, "reason": "No feedback data yet"}
    recall = perf.get("recall") if perf.get("available") else None
    row = (
        run_id, checked_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None),
        (float(report.share), int(report.n_drifted), bool(report.dataset_drift)),
        (report.target_drift, report.target_drift is not None),
        (report.prediction_drift, report.prediction_drift is not None),
        (bool(perf.get("available")), perf.get("reason"), perf.get("precision"), recall,
         perf.get("f1"), perf.get("low_recall_detected")),
        None, None,
    )
    grade = severity_expr(F.col("data_drift.drift_score"), F.col("prediction_drift.drift_detected"),
                          F.col("target_drift.drift_detected"), F.col("performance.recall"))
    return (spark.createDataFrame([row], RESULT_SCHEMA).withColumn("drift_severity", grade)
            .withColumn("retraining_recommended", F.col("drift_severity") == "serious"))
