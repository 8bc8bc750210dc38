"""Tree contributions (M19): path-dependent TreeSHAP (Lundberg, Erion, Lee,
"Consistent individualized feature attribution for tree ensembles", 2018;
Lundberg et al., Nature Machine Intelligence 2020, Algorithm 2).

The trees come from the fitted Spark model's saved form (its ``data``
Parquet: node ids, children, splits, node statistics), so their size is the
model's, not the data's; they travel to the executors as a broadcast. Rows
are explained in ``mapInPandas`` batches: each tree is walked once per batch,
a leaf's contributions are worked out per pattern of features that follow its
path, and the rows look them up by their pattern.

- Random forest (classification): contributions to the class-1 probability
  (the mean of the trees' leaf class shares), base = mean expected leaf
  value.
- Boosted trees: contributions to the log-odds ``2·Σ w_t·tree_t(x)`` (Spark's
  probability is ``1/(1+exp(-2·margin))``).

Additivity holds: ``base + Σ contributions = model output`` per row.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.session import shared_path


@dataclass
class Tree:
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    categories: list            # None for continuous splits, else the left set
    value: np.ndarray
    cover: np.ndarray
    weight: float = 1.0

    def expected(self) -> float:
        leaves = self.left < 0
        return float((self.value[leaves] * self.cover[leaves]).sum() / self.cover[0])


def trees_from_model(spark: SparkSession, clf) -> tuple[list[Tree], str]:
    """Read a fitted RF / GBT classification model's trees (model-sized)."""
    if isinstance(clf, RandomForestClassificationModel):
        kind, weights = "rf", [1.0] * clf.getNumTrees
    elif isinstance(clf, GBTClassificationModel):
        kind, weights = "gbt", list(clf.treeWeights)
    else:
        raise ValueError(f"not a tree ensemble: {type(clf).__name__}")
    path = shared_path(spark, "riskspark_models", uuid.uuid4().hex)
    clf.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.impurityStats",
        "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
        "nodeData.split.leftCategoriesOrThreshold", "nodeData.split.numCategories").collect()
    by_tree: dict[int, list] = {}
    for r in rows:
        by_tree.setdefault(r["treeID"], []).append(r)
    trees = []
    for tid in sorted(by_tree):
        nodes = sorted(by_tree[tid], key=lambda r: r["id"])
        n = len(nodes)
        left = np.full(n, -1, dtype=np.int64)
        right = np.full(n, -1, dtype=np.int64)
        feat = np.full(n, -1, dtype=np.int64)
        thr = np.zeros(n)
        cats: list = [None] * n
        val = np.zeros(n)
        cov = np.zeros(n)
        for r in nodes:
            i = r["id"]
            st = list(r["impurityStats"] or [])
            if kind == "rf":
                tot = sum(st)
                cov[i] = tot
                val[i] = (st[1] / tot) if tot > 0 and len(st) > 1 else 0.0
            else:
                cov[i] = st[0] if st else 0.0
                val[i] = r["prediction"]
            if r["leftChild"] is not None and r["leftChild"] >= 0:
                left[i], right[i], feat[i] = r["leftChild"], r["rightChild"], r["featureIndex"]
                sp = list(r["leftCategoriesOrThreshold"] or [])
                if r["numCategories"] is not None and r["numCategories"] >= 0:
                    cats[i] = set(sp)
                else:
                    thr[i] = sp[0]
        trees.append(Tree(left, right, feat, thr, cats, val, cov, weights[tid]))
    return trees, kind


# ---------------------------------------------------------------------------
# The algorithm, vectorised over a batch of rows
# ---------------------------------------------------------------------------
LEAVES = 64                # leaves whose shares are worked out together


def _weights(z: np.ndarray, o: np.ndarray) -> np.ndarray:
    """Shares ``(leaves, patterns, features)`` of a leaf's value. A leaf's
    path has ``d`` distinct features; ``z (leaves, d)`` are the shares of the
    cover that follow it when a feature is unknown, ``o (patterns, d)`` says
    which of the features of a row follow it."""
    d = z.shape[1]
    z = z[:, None, :]
    w = [np.ones((z.shape[0], len(o)))]
    for k in range(d):                              # extend the path by one feature
        n, zk, ok = k + 2, z[:, :, k], o[:, k]
        new = [np.zeros_like(w[0]) for _ in range(n)]
        for i in range(k + 1):
            new[i] += zk * w[i] * ((k + 1 - i) / n)
            new[i + 1] += ok * w[i] * ((i + 1) / n)
        w = new
    out = np.empty((z.shape[0], len(o), d))
    for k in range(d):                              # the weight of the path without one feature
        zk = z[:, :, k]
        rest, with_, without = w[d], 0.0, 0.0
        for i in range(d - 1, -1, -1):
            t = rest * ((d + 1) / (i + 1))
            with_ = with_ + t
            rest = w[i] - t * zk * ((d - i) / (d + 1))
            without = without + w[i] * ((d + 1) / (d - i))
        out[:, :, k] = np.where(o[:, k], with_ * (1 - zk), np.where(zk != 0, -without, 0.0))
    return out


def tree_shap(x: np.ndarray, tree: Tree) -> np.ndarray:
    """Contributions ``(rows, features)`` of one tree for the rows of ``x``.

    A leaf's contributions depend on a row only by which of the features on
    its path follow it: a pattern of one bit a feature. They are worked out
    once a pattern and looked up for the rows; of paths with more patterns
    than rows, for the patterns that occur."""
    b, m = x.shape
    phi = np.zeros((m, b))
    cols = np.ascontiguousarray(x.T)
    held: dict[int, list] = {}                      # features on the path -> leaves

    def add(leaves):
        d = len(leaves[0][0])
        if 1 << d <= max(b, 2):
            seen, codes = np.arange(1 << d), [c for _, _, _, c in leaves]
        else:
            seen, code = np.unique(leaves[0][3], return_inverse=True)
            codes = [code]
        share = _weights(np.array([z for _, z, _, _ in leaves]), (seen[:, None] >> np.arange(d) & 1) > 0)
        for (features, _, value, _), code, part in zip(leaves, codes, share, strict=True):
            table = np.ascontiguousarray(part.T) * value
            for f, t in zip(features, table, strict=True):
                phi[f] += t.take(code)

    def walk(node, features, z, code):
        if tree.left[node] < 0:
            if features and tree.value[node] != 0:
                held.setdefault(len(features), []).append((features, z, tree.value[node], code))
                if len(held[len(features)]) >= LEAVES or 1 << len(features) > max(b, 2):
                    add(held.pop(len(features)))
            return
        f = int(tree.feature[node])
        if tree.categories[node] is None:
            go_left = cols[f] <= tree.threshold[node]
        else:
            go_left = np.isin(cols[f], list(tree.categories[node]))
        cn = tree.cover[node]
        new = f not in features
        at = len(features) if new else features.index(f)
        for child, go in ((tree.left[node], go_left), (tree.right[node], ~go_left)):
            share = tree.cover[child] / cn if cn > 0 else 0.0
            if new:
                walk(child, [*features, f], [*z, share], code | go.astype(np.int64) << at)
            else:
                walk(child, features, [*z[:at], z[at] * share, *z[at + 1:]],
                     np.where(go, code, code & ~(1 << at)))

    walk(0, [], [], np.zeros(b, np.int64))
    for leaves in held.values():
        add(leaves)
    return phi.T


def ensemble_shap(x: np.ndarray, trees: list[Tree], kind: str) -> tuple[np.ndarray, float]:
    """(contributions, base) in the model's output space (see module doc)."""
    phi = np.zeros(x.shape)
    base = 0.0
    for t in trees:
        phi += t.weight * tree_shap(x, t)
        base += t.weight * t.expected()
    if kind == "rf":
        phi /= len(trees)
        base /= len(trees)
    else:
        phi *= 2.0
        base *= 2.0
    return phi, base


def predict_raw(x: np.ndarray, trees: list[Tree], kind: str) -> np.ndarray:
    """Model output the contributions add up to (class-1 probability for a
    forest, log-odds for boosted trees); used by tests."""
    out = np.zeros(x.shape[0])
    for t in trees:
        node = np.zeros(x.shape[0], dtype=np.int64)
        for _ in range(64):
            inner = t.left[node] >= 0
            if not inner.any():
                break
            f = t.feature[node]
            xv = x[np.arange(x.shape[0]), np.maximum(f, 0)]
            go_left = np.array([
                (xv[r] <= t.threshold[nd]) if t.categories[nd] is None else (xv[r] in t.categories[nd])
                for r, nd in enumerate(node)])
            node = np.where(inner, np.where(go_left, t.left[node], t.right[node]), node)
        out += t.weight * t.value[node]
    return out / len(trees) if kind == "rf" else 2.0 * out


def tree_contributions(scored: DataFrame, clf, key: str = "transaction_id",
                       features: str = "features", carry: list[str] | None = None) -> DataFrame:
    """``(key, base, contrib array<double>)`` per row, computed in
    ``mapInPandas`` with the trees broadcast; with ``carry``, these columns
    instead of ``key``."""
    spark = scored.sparkSession
    trees, kind = trees_from_model(spark, clf)
    bc = spark.sparkContext.broadcast((trees, kind))
    kept = [F.col(key).cast("string").alias(key)] if carry is None else [F.col(c) for c in carry]
    x = scored.select(*kept, vector_to_array(F.col(features)).alias("_x"))
    names = x.columns[:-1]

    def fn(batches):
        ts, kd = bc.value
        for pdf in batches:
            if pdf.empty:
                continue
            xs = np.vstack([np.asarray(v, dtype=float) for v in pdf["_x"]])
            phi, base = ensemble_shap(xs, ts, kd)
            yield pdf[names].assign(base=base, contrib=list(phi))

    schema = T.StructType([*[x.schema[c] for c in names], T.StructField("base", T.DoubleType()),
                           T.StructField("contrib", T.ArrayType(T.DoubleType()))])
    return x.mapInPandas(fn, schema)
