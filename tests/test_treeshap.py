"""TreeSHAP (M19) against brute-force Shapley values and model outputs."""
import itertools
import math
import random

import numpy as np
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskspark.operators.treeshap import ensemble_shap, predict_raw, tree_contributions, tree_shap, trees_from_model


def _cond(tree, x, s, node=0):
    if tree.left[node] < 0:
        return tree.value[node]
    f = tree.feature[node]
    lc, rc = tree.left[node], tree.right[node]
    if f in s:
        nxt = lc if x[f] <= tree.threshold[node] else rc
        return _cond(tree, x, s, nxt)
    cn = tree.cover[node]
    return (tree.cover[lc] * _cond(tree, x, s, lc) + tree.cover[rc] * _cond(tree, x, s, rc)) / cn


def _brute(tree, x, m):
    phi = np.zeros(m)
    for i in range(m):
        others = [j for j in range(m) if j != i]
        for r in range(len(others) + 1):
            for s in itertools.combinations(others, r):
                w = math.factorial(r) * math.factorial(m - r - 1) / math.factorial(m)
                phi[i] += w * (_cond(tree, x, set(s) | {i}) - _cond(tree, x, set(s)))
    return phi


def _data(spark, n=300):
    rnd = random.Random(5)
    rows = []
    for _ in range(n):
        x = [rnd.random(), rnd.randint(0, 4), rnd.random(), rnd.randint(0, 1)]
        y = 1.0 if (x[0] + 0.3 * x[1] + x[3] > 1.6) ^ (rnd.random() < 0.1) else 0.0
        rows.append((Vectors.dense(x), y))
    return spark.createDataFrame(rows, ["features", "label"])


def test_single_trees_match_brute_force(spark):
    df = _data(spark)
    m = RandomForestClassifier(numTrees=3, maxDepth=4, seed=42).fit(df)
    trees, kind = trees_from_model(spark, m)
    xs = np.array([r["features"].toArray() for r in df.limit(25).collect()])
    for t in trees:
        phi = tree_shap(xs, t)
        for r in range(len(xs)):
            assert np.allclose(phi[r], _brute(t, xs[r], 4), atol=1e-10)


def test_forest_and_boosted_additivity(spark):
    df = _data(spark)
    xs = np.array([r["features"].toArray() for r in df.collect()])
    rf = RandomForestClassifier(numTrees=10, maxDepth=5, seed=42).fit(df)
    trees, kind = trees_from_model(spark, rf)
    phi, base = ensemble_shap(xs, trees, kind)
    p1 = np.array([r["p"] for r in rf.transform(df).select(vector_to_array("probability")[1].alias("p")).collect()])
    assert np.allclose(base + phi.sum(axis=1), p1, atol=1e-9)
    assert np.allclose(predict_raw(xs, trees, kind), p1, atol=1e-9)
    gbt = GBTClassifier(maxIter=10, maxDepth=3, seed=42).fit(df)
    trees, kind = trees_from_model(spark, gbt)
    phi, base = ensemble_shap(xs, trees, kind)
    p = np.array([r["p"] for r in gbt.transform(df).select(vector_to_array("probability")[1].alias("p")).collect()])
    logit = np.log(p / (1 - p))
    assert np.allclose(base + phi.sum(axis=1), logit, atol=1e-7)


def test_distributed_contributions(spark):
    df = _data(spark).withColumn("transaction_id", F.monotonically_increasing_id().cast("string"))
    gbt = GBTClassifier(maxIter=5, maxDepth=3, seed=42).fit(df)
    c = tree_contributions(df, gbt)
    rows = c.collect()
    assert len(rows) == 300 and all(len(r["contrib"]) == 4 for r in rows)


def test_shares_are_worked_out_per_pattern_not_per_row(spark, monkeypatch):
    """10 or 4,000 rows: the shares of a leaf are worked out for at most two
    patterns a feature on its path, or for the rows' own patterns."""
    from riskspark.operators import treeshap
    df = _data(spark)
    m = RandomForestClassifier(numTrees=1, maxDepth=6, seed=42).fit(df)
    trees, _ = trees_from_model(spark, m)
    done, weights = [], treeshap._weights

    def counted(z, o):
        done.append((len(z), len(o), z.shape[1]))
        return weights(z, o)
    monkeypatch.setattr(treeshap, "_weights", counted)
    xs = np.array([r["features"].toArray() for r in df.collect()])
    few, many = tree_shap(xs[:10], trees[0]), tree_shap(np.tile(xs, (14, 1)), trees[0])
    assert done and all(p <= max(1 << d, 2) for _, p, d in done)
    assert np.allclose(many[:10], few, atol=1e-12)
    leaf_patterns = sum(n * p for n, p, _ in done)
    assert leaf_patterns <= 2 * (trees[0].left < 0).sum() * 2 ** 4
    for r in range(10):
        assert np.allclose(few[r], _brute(trees[0], xs[r], 4), atol=1e-10)
