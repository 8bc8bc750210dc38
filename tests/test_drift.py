"""Drift statistics and severity (TestDriftDetection)."""
import math
import random

import pytest
from pyspark.sql import functions as F

from riskspark.operators import drift as D

SEVERITY_CASES = [
    (0.60, False, False, 0.85, "serious"),
    (0.10, False, True, 0.85, "serious"),
    (0.10, True, False, 0.85, "serious"),
    (0.10, False, False, 0.60, "serious"),
    (0.30, False, False, 0.85, "negligible"),
    (0.05, False, False, 0.90, "none"),
    (0.50, False, False, 0.85, "serious"),
    (0.15, False, False, 0.85, "negligible"),
    (0.10, False, False, None, "none"),
    (0.10, None, None, None, "none"),
]


@pytest.mark.parametrize("share,pred,tgt,recall,expected", SEVERITY_CASES)
def test_severity_of_the_run_record(spark, share, pred, tgt, recall, expected):
    report = D.DriftReport(None, 10, round(share * 10), share, share >= 0.5, tgt, pred)
    perf = None if recall is None else {"available": True, "recall": recall}
    r = D.run_record(spark, report, perf, "r1").first()
    assert (r["drift_severity"], r["retraining_recommended"]) == (expected, expected == "serious")
    assert r["performance"]["available"] == (recall is not None) and r["target_drift"]["available"] == (tgt is not None)


def test_severity_expression(spark):
    df = spark.createDataFrame(SEVERITY_CASES, "s double, p boolean, t boolean, r double, e string")
    got = df.select(D.severity_expr(F.col("s"), F.col("p"), F.col("t"), F.col("r")).alias("g"), "e").collect()
    assert all(r["g"] == r["e"] for r in got)


def _frames(spark, a, b, name="x"):
    ref = spark.createDataFrame([(float(v),) for v in a], f"{name} double")
    cur = spark.createDataFrame([(float(v),) for v in b], f"{name} double")
    return ref, cur


def test_ks_and_wasserstein_brute_force(spark):
    rnd = random.Random(1)
    a = [round(rnd.gauss(0, 1), 2) for _ in range(400)]
    b = [round(rnd.gauss(0.3, 1.2), 2) for _ in range(300)]
    ref, cur = _frames(spark, a, b)
    st = D.numeric_stats(ref, cur, ["x"]).first()
    pts = sorted(set(a) | set(b))
    fa = lambda t: sum(v <= t for v in a) / len(a)
    fb = lambda t: sum(v <= t for v in b) / len(b)
    ks = max(abs(fa(t) - fb(t)) for t in pts)
    w = sum(abs(fa(pts[i]) - fb(pts[i])) * (pts[i + 1] - pts[i]) for i in range(len(pts) - 1))
    assert math.isclose(st["ks_d"], ks, rel_tol=1e-12)
    assert math.isclose(st["wasserstein"], w, rel_tol=1e-9)
    mean = sum(a) / len(a)
    assert math.isclose(st["ref_std"], math.sqrt(sum((v - mean) ** 2 for v in a) / len(a)), rel_tol=1e-9)


def test_categorical_stats(spark):
    a = ["x"] * 50 + ["y"] * 30 + ["z"] * 20
    b = ["x"] * 20 + ["y"] * 30 + ["z"] * 40 + ["w"] * 10
    ref = spark.createDataFrame([(v,) for v in a], "c string")
    cur = spark.createDataFrame([(v,) for v in b], "c string")
    st = D.categorical_stats(ref, cur, ["c"]).first()
    keys = ["w", "x", "y", "z"]
    p = [a.count(k) / len(a) for k in keys]
    q = [b.count(k) / len(b) for k in keys]
    m = [(x + y) / 2 for x, y in zip(p, q)]
    kl = lambda u: sum(x * math.log(x / z) for x, z in zip(u, m) if x > 0)
    assert math.isclose(st["js"], math.sqrt((kl(p) + kl(q)) / 2), rel_tol=1e-12)
    assert st["chi2"] == float("inf") and st["chi2_dof"] == 3


def test_pvalues():
    assert math.isclose(D.chi2_pvalue(3.841458820694124, 1), 0.05, rel_tol=1e-6)
    assert math.isclose(D.chi2_pvalue(11.070497693516351, 5), 0.05, rel_tol=1e-6)
    assert math.isclose(D.z_pvalue(1.959963984540054), 0.05, rel_tol=1e-9)
    # Kolmogorov limit: P(K > 1.358) ~ 0.05
    assert math.isclose(D.ks_pvalue(1.358 / math.sqrt(10_000), 20_000, 20_000), 0.05, rel_tol=2e-3)


def test_auto_choice_small_and_large(spark):
    rnd = random.Random(3)
    small_a = [rnd.random() for _ in range(200)]
    small_b = [rnd.random() + 0.5 for _ in range(200)]
    ref, cur = _frames(spark, small_a, small_b)
    r = D.column_drift(ref, cur).first()
    assert r["stattest"] == "ks" and r["drifted"]
    big = [rnd.random() for _ in range(1500)]
    ref, cur = _frames(spark, big, big)
    r = D.column_drift(ref, cur).first()
    assert r["stattest"] == "wasserstein" and not r["drifted"] and r["statistic"] == 0.0


def test_few_valued_numeric_is_categorical(spark):
    ref, cur = _frames(spark, [0, 1] * 100, [1] * 150 + [0] * 50, "is_fraud")
    r = D.column_drift(ref, cur).first()
    assert r["column_type"] == "cat" and r["stattest"] == "z" and r["drifted"]


def test_report_target_and_prediction(spark):
    ref = spark.createDataFrame([(i % 2, float(i)) for i in range(100)], "is_fraud int, amount double")
    cur = spark.createDataFrame([(i % 2, float(i)) for i in range(100)], "is_fraud int, amount double")
    rep = D.drift_report(ref, cur)
    assert rep.target_drift is False and rep.prediction_drift is None and rep.share == 0.0


def paths_reaching(d, m, n):
    """Share of all orders of m and n values whose D is at least d."""
    from itertools import combinations
    hit = total = 0
    for at in combinations(range(m + n), m):
        i = j = 0
        most = 0.0
        for k in range(m + n):
            if k in at:
                i += 1
            else:
                j += 1
            most = max(most, abs(i / m - j / n))
        total += 1
        hit += most >= d - 1e-9
    return hit / total


@pytest.mark.parametrize(("m", "n"), [(1, 1), (3, 4), (4, 4), (5, 3), (6, 5), (2, 9)])
def test_exact_ks_against_all_orders(m, n):
    for d in sorted({abs(i / m - j / n) for i in range(m + 1) for j in range(n + 1)}):
        assert math.isclose(D.ks_exact(d, m, n), paths_reaching(d, m, n), rel_tol=1e-9, abs_tol=1e-12)


def test_exact_ks_published_and_limit():
    # Equal sizes, by the reflection formula: P(D >= k/n) = 2 sum (-1)^(i-1) C(2n, n-ik) / C(2n, n)
    for n, k in ((10, 6), (10, 7), (15, 7), (20, 8), (40, 12)):
        p = 2 * sum((-1) ** (i - 1) * math.comb(2 * n, n - i * k) for i in range(1, n // k + 1)) / math.comb(2 * n, n)
        assert math.isclose(D.ks_exact(k / n, n, n), p, rel_tol=1e-9)
    assert round(D.ks_exact(0.6, 10, 10), 5) == 0.05245
    assert abs(D.ks_exact(0.05, 3000, 2500) - D.ks_exact(0.05, 2500, 3000)) < 1e-12
    # near the limit distribution for large samples
    z = 0.03 * math.sqrt(8000 * 8000 / 16000)
    limit = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * z * z) for k in range(1, 50))
    assert math.isclose(D.ks_pvalue(0.03, 8000, 8000), limit, rel_tol=0.05)
    assert D.ks_exact(0.0, 5, 5) == 1.0 and D.ks_exact(1.0, 5, 5) == pytest.approx(2 / math.comb(10, 5))


def test_columns_without_values_keep_their_row(spark):
    schema = "a double, b string, c double, d string, is_fraud int"
    ref = spark.createDataFrame([(float(i), "x", None, None, i % 2) for i in range(50)], schema)
    cur = spark.createDataFrame([(None, None, float(i), None, i % 2) for i in range(50)], schema)
    for method in ("auto", "test", "distance"):
        got = {r["column"]: (r["stattest"], r["drifted"]) for r in D.column_drift(ref, cur, method=method).collect()}
        assert got["a"] == ("no_current", True) and got["b"] == ("no_current", True)
        assert got["c"] == ("no_reference", True) and got["d"] == ("no_data", False)
        assert got["is_fraud"][1] is False and got["is_fraud"][0] not in ("no_data", "no_current")
    rep = D.drift_report(ref, cur)
    assert (rep.n_columns, rep.n_drifted, rep.dataset_drift) == (5, 3, True)
    empty = D.drift_report(ref, cur.limit(0))
    assert empty.target_drift is True and empty.n_drifted == 3
    assert D.drift_report(ref.limit(0), cur.limit(0)).n_drifted == 0
