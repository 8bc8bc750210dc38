"""SMOTE (M6): exact neighbours across slices, balance, interpolation."""
import random

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskspark.operators import resample
from riskspark.operators.resample import nearest_neighbours, smote


def _points(spark, n=400, dim=3, seed=11):
    rnd = random.Random(seed)
    rows = [(f"p{i:04d}", [round(rnd.gauss(0, 1), 3) for _ in range(dim)]) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id string, x array<double>")


def test_neighbours_exact_across_slices(spark):
    rows, df = _points(spark)
    got = {r["id"]: (r["nn"], r["nd"]) for r in nearest_neighbours(df, "id", "x", 5, cell_rows=40).collect()}
    ids = [r[0] for r in rows]
    xs = np.array([r[1] for r in rows])
    for i, pid in enumerate(ids):
        d = np.sqrt(((xs - xs[i]) ** 2).sum(axis=1))
        order = sorted((d[j], ids[j]) for j in range(len(ids)) if j != i)[:5]
        assert np.allclose(got[pid][1], [o[0] for o in order], atol=1e-9)
        assert got[pid][0] == [o[1] for o in order]


def test_smote_balances_and_interpolates(spark):
    rnd = random.Random(3)
    rows = [(f"t{i}", Vectors.dense([rnd.random(), rnd.random()]), 1 if i < 40 else 0) for i in range(300)]
    df = spark.createDataFrame(rows, ["transaction_id", "features", "is_fraud"])
    out = smote(df, "transaction_id", cell_rows=15)
    counts = {r["is_fraud"]: r["count"] for r in out.groupBy("is_fraud").count().collect()}
    assert counts == {0: 260, 1: 260}
    again = smote(df, "transaction_id", cell_rows=15)
    a = sorted((r[0], tuple(r[1])) for r in out.filter("synthetic").select("transaction_id", vector_to_array("features")).collect())
    b = sorted((r[0], tuple(r[1])) for r in again.filter("synthetic").select("transaction_id", vector_to_array("features")).collect())
    assert a == b                                            # seeded, partition-independent
    mins = np.array([list(r[1]) for r in rows if r[2] == 1])
    lo, hi = mins.min(axis=0), mins.max(axis=0)
    for _, v in a:
        assert np.all(np.array(v) >= lo - 1e-12) and np.all(np.array(v) <= hi + 1e-12)


def test_single_class_unchanged(spark):
    df = spark.createDataFrame([(f"t{i}", Vectors.dense([float(i)]), 0) for i in range(10)],
                               ["transaction_id", "features", "is_fraud"])
    assert smote(df, "transaction_id").count() == 10


def test_neighbours_with_copies_and_few_values(spark):
    """Copies, ties and coordinates of few values: the result is that of all
    pairs, ties by key."""
    rnd = random.Random(4)
    rows = [(f"p{i:04d}", [float(rnd.randint(0, 2)), float(rnd.randint(0, 23)), float(rnd.randint(0, 1))]) for i in range(500)]
    rows += [(f"c{i:04d}", [1.0, 5.0, 0.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, x array<double>")
    got = {r["id"]: (r["nn"], r["nd"]) for r in nearest_neighbours(df, "id", "x", 5, cell_rows=20).collect()}
    assert len(got) == len(rows)
    xs = np.array([r[1] for r in rows])
    for i, (pid, _) in enumerate(rows):
        d = np.sqrt(((xs - xs[i]) ** 2).sum(axis=1))
        order = sorted((d[j], rows[j][0]) for j in range(len(rows)) if j != i)[:5]
        assert got[pid] == ([o[1] for o in order], [o[0] for o in order])


def test_a_point_reaches_few_cells_at_any_size():
    """The highest variance lies in a coordinate of 24 values: cells cut only
    there would send each point to all cells of its value."""
    def asked(n):
        rng = np.random.RandomState(1)
        x = np.column_stack([rng.randint(0, 24, n) / 6.0, rng.rand(n), rng.rand(n)])
        nodes = resample._tree(x, n // 100)
        cell = resample._cells_of(x, nodes)
        boxes = {c: (x[cell == c].min(axis=0), x[cell == c].max(axis=0)) for c in np.unique(cell)}
        assert np.bincount(cell).max() <= 300
        lo, hi = resample._node_boxes(nodes, boxes, 3)
        radius = np.full(n, np.sqrt(24 * 6 / (n * np.pi)))
        return sum(len(rows) for rows, _ in resample._reached(x, radius, nodes, lo, hi)) / n
    assert asked(32_000) < 1.5 * asked(4_000) < 15
