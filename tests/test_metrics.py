"""Exact metrics against brute force on small frames."""
import itertools
import math
import random

from riskspark.operators import metrics as M


def _df(spark, ys, ss, ps=None):
    ps = ps or [int(s > 0.5) for s in ss]
    return spark.createDataFrame(list(zip(ys, ss, ps)), "y int, s double, p int")


def _auc(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y == 1]
    neg = [s for y, s in zip(ys, ss) if y == 0]
    tot = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def _ap(ys, ss):
    P = sum(ys)
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(ss), reverse=True):
        tp = sum(1 for y, s in zip(ys, ss) if s >= t and y == 1)
        fp = sum(1 for y, s in zip(ys, ss) if s >= t and y == 0)
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


def test_curves_match_brute_force(spark):
    rnd = random.Random(42)
    ys = [rnd.randint(0, 1) for _ in range(300)]
    ss = [round(rnd.random(), 1) for _ in range(300)]      # many ties
    df = _df(spark, ys, ss)
    assert math.isclose(M.roc_auc(df, "y", "s").first()[0], _auc(ys, ss), rel_tol=1e-12)
    assert math.isclose(M.average_precision(df, "y", "s").first()[0], _ap(ys, ss), rel_tol=1e-12)
    curve = M.pr_curve(df, "y", "s").collect()
    assert len(curve) == len(set(ss)) + 1
    end = [r for r in curve if r["threshold"] is None][0]
    assert (end["precision"], end["recall"]) == (1.0, 0.0)


def test_grouped_auc(spark):
    rnd = random.Random(7)
    rows = [(g, rnd.randint(0, 1), rnd.random()) for g in ("a", "b") for _ in range(100)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    got = {r["g"]: r["roc_auc"] for r in M.roc_auc(df, "y", "s", ["g"]).collect()}
    for g in ("a", "b"):
        ys = [y for gg, y, _ in rows if gg == g]
        ss = [s for gg, _, s in rows if gg == g]
        assert math.isclose(got[g], _auc(ys, ss), rel_tol=1e-12)


def test_auc_null_for_one_class(spark):
    assert M.roc_auc(_df(spark, [0, 0, 0], [0.1, 0.2, 0.3]), "y", "s").first()[0] is None


def test_prf_zero_division(spark):
    r = M.prf(_df(spark, [0, 0, 1], [0.1, 0.2, 0.3], [0, 0, 0]), "y", "p").first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)


def test_prf_values(spark):
    r = M.prf(_df(spark, [1, 1, 0, 0, 1], [0.0] * 5, [1, 0, 1, 0, 1]), "y", "p").first()
    assert math.isclose(r["precision"], 2 / 3) and math.isclose(r["recall"], 2 / 3)


def test_class_report(spark):
    rows = {r["label"]: r for r in M.class_report(
        _df(spark, [1, 1, 0, 0, 1], [0.0] * 5, [1, 0, 1, 0, 1]), "y", "p").collect()}
    assert rows["accuracy"]["f1_score"] == 0.6 and rows["accuracy"]["support"] == 5
    assert rows["1"]["support"] == 3 and rows["0"]["support"] == 2
    assert math.isclose(rows["macro avg"]["precision"], (0.5 + 2 / 3) / 2)


def test_evaluation_on_reduced_rows_equals_the_direct_metrics(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        y = rnd.choice([0, 1, 1, None]) if i % 37 else None
        s = round(rnd.random(), 1)                     # many ties
        p = None if i % 53 == 0 else int(s > 0.5)
        rows.append(("a" if i % 3 else "b", y, s, p))
    df = spark.createDataFrame(rows, "g string, y int, s double, p int")
    got = {r["g"]: r for r in M.evaluation(df, "y", "s", "p", ["g"]).collect()}
    a = {r["g"]: r for r in M.prf(df, "y", "p", ["g"]).collect()}
    b = {r["g"]: r["roc_auc"] for r in M.roc_auc(df, "y", "s", ["g"]).collect()}
    c = {r["g"]: r["average_precision"] for r in M.average_precision(df, "y", "s", ["g"]).collect()}
    assert set(got) == {"a", "b"}
    for g, r in got.items():
        for k in ("precision", "recall", "f1"):
            assert r[k] == a[g][k]
        assert math.isclose(r["roc_auc"], b[g], rel_tol=1e-12)
        assert math.isclose(r["pr_auc"], c[g], rel_tol=1e-12)


def test_evaluation_record_brute_force(spark):
    rnd = random.Random(7)
    ys = [rnd.randint(0, 1) for _ in range(400)]
    ss = [round(rnd.random() ** 3, 3) for _ in range(400)]
    ps = [int(s > 0.2) for s in ss]
    rows = [("a", *r) for r in zip(ys, ss, ps)] + [("b", 1, 0.5, 1), ("b", 1, 0.25, 0), ("c", 0, 1.0, 1),
                                                  ("d", None, 0.5, 1), ("a", 1, None, 1)]
    df = spark.createDataFrame(rows, "g string, y int, s double, p int")
    got = {r["g"]: r for r in M.evaluation_record(df, "y", "s", "p", ["g"], grid=20).collect()}
    assert set(got) == {"a", "b", "c"}                     # d has no labelled row
    a = got["a"]
    assert a["n"] == 400 and math.isclose(a["roc_auc"], _auc(ys, ss)) and math.isclose(a["pr_auc"], _ap(ys, ss))
    report = {r["label"]: r for r in a["report"]}
    assert report["1"]["support"] == sum(ys)
    assert math.isclose(report["accuracy"]["f1_score"], sum(y == p for y, p in zip(ys, ps)) / 400)
    lows = sorted({math.floor(s * 20): min(x for x in ss if math.floor(x * 20) == math.floor(s * 20)) for s in ss}.values(),
                  reverse=True)
    assert [c["threshold"] for c in a["curve"]] == [*lows, None]
    for c in a["curve"][:-1]:
        tp = sum(y for y, s in zip(ys, ss) if s >= c["threshold"])
        fp = sum(1 - y for y, s in zip(ys, ss) if s >= c["threshold"])
        assert math.isclose(c["precision"], tp / (tp + fp)) and math.isclose(c["recall"], tp / sum(ys))
        assert math.isclose(c["fpr"], fp / (400 - sum(ys)))
    assert got["b"]["roc_auc"] is None and got["b"]["recall"] == 0.5 and got["b"]["pr_auc"] == 1.0
    assert got["c"]["pr_auc"] == 0.0 and [c["recall"] for c in got["c"]["curve"]] == [1.0, 0.0]
    assert M.evaluation_record(df.limit(0), "y", "s", "p", ["g"]).count() == 0


def test_evaluation_record_orders_once(spark):
    df = _df(spark, [0, 1, 1], [0.1, 0.2, 0.3])
    plan = M.evaluation_record(df, "y", "s", "p")._jdf.queryExecution().toString()
    assert plan.count("rangepartitioning") == 0            # ordered once, into the stored slices
