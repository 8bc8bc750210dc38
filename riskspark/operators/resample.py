"""Minority oversampling (M6): SMOTE with exact k nearest neighbours.

Synthetic rows interpolate between a minority row and one of its k nearest
minority neighbours: ``x + gap·(x_nn − x)``; the row, the neighbour and the
gap come from seeded hashes of the synthetic row number, so the result does
not depend on partitioning. The minority class grows to the majority size.

Exact neighbours without a pair explosion or a candidate cap:

1. Rows with equal features are one point, which keeps its first ``k + 1``
   keys: no row can have more of them among its neighbours.
2. A k-d tree cuts the points into cells of about ``cell_rows``. Its cuts come
   from a bounded sample, which decides the balance but not the result; the
   cells' boxes are the exact bounds of their points.
3. Inside each cell, neighbours are found by blocked numpy distances
   (cell-sized, never the whole class).
4. The distance ``r`` within which a point has enough rows in its own cell
   bounds its true neighbours. So the point is sent only to the cells whose
   box comes as near as ``r``, found by descending the tree; those cells
   return their nearest points within ``r``.
5. The k best of all candidates per row (distance, then key) are the exact
   neighbours.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark import schemas as S
from riskspark.functions.columns import unit_hash
from riskspark.operators.ordered import ordered_scan

_CAND = T.StructType([T.StructField("q", T.LongType()), T.StructField("p", T.LongType()),
                      T.StructField("d", T.DoubleType()), T.StructField("cell", T.IntegerType())])
SAMPLE_ROWS, CELL_SAMPLE = 1 << 18, 64       # rows that place the cuts: at most, and per cell


def _topk_rows(q: np.ndarray, p: np.ndarray, k: int, limit: np.ndarray | None = None, block: int = 256):
    """For each row of ``q`` its k nearest rows of ``p`` (ties: the first), not
    beyond ``limit``, as (row of q, row of p, distance). Blocked products, so
    memory is block × |p|, choose the candidates; their distances are exact
    differences."""
    mid = p.mean(axis=0)
    pc = p - mid
    pn = (pc * pc).sum(axis=1)
    out = []
    for s in range(0, len(q), block):
        qb = q[s:s + block] - mid
        qn = (qb * qb).sum(axis=1)
        d2 = qn[:, None] + pn[None, :] - 2.0 * qb @ pc.T
        slack = 1e-13 * (qn + pn.max())
        most = np.partition(d2, k - 1, axis=1)[:, k - 1] + 2 * slack if k < len(p) else np.full(len(qb), math.inf)
        if limit is not None:
            most = np.minimum(most, limit[s:s + block] ** 2 * (1 + 1e-9) + slack)
        row, col = np.nonzero(d2 <= most[:, None])
        row += s
        dist = np.sqrt(((q[row] - p[col]) ** 2).sum(axis=1))
        order = np.lexsort((col, dist, row))
        row, col, dist = row[order], col[order], dist[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        out.append((row[nth < k], col[nth < k], dist[nth < k]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _tree(x: np.ndarray, cells: int) -> list[tuple[int, float, int, int]]:
    """A k-d tree of ``cells`` leaves at most: nodes (coordinate, cut, left,
    right), where ``x <= cut`` goes left; a leaf is (-1, 0, cell, 0)."""
    nodes: list = []
    leaves = 0

    def grow(rows, cells):
        nonlocal leaves
        at = len(nodes)
        nodes.append(None)
        v = x[rows]
        spread = np.where(np.ptp(v, axis=0) > 0, v.var(axis=0), 0.0) if cells > 1 and len(rows) > 1 and v.shape[1] else np.zeros(1)
        f = int(np.argmax(spread))
        if not spread[f] > 0:
            nodes[at] = (-1, 0.0, leaves, 0)
            leaves += 1
            return at
        v = v[:, f]
        cut = np.partition(v, (len(v) - 1) // 2)[(len(v) - 1) // 2]
        if cut == v.max():
            cut = v[v < cut].max()
        go = v <= cut
        left = min(max(round(cells * go.mean()), 1), cells - 1)
        nodes[at] = (f, float(cut), grow(rows[go], left), grow(rows[~go], cells - left))
        return at

    grow(np.arange(len(x)), cells)
    return nodes


def _cells_of(x: np.ndarray, nodes) -> np.ndarray:
    out = np.zeros(len(x), np.int32)
    todo = [(0, np.arange(len(x)))]
    while todo:
        at, rows = todo.pop()
        f, cut, left, right = nodes[at]
        if f < 0:
            out[rows] = left
        elif len(rows):
            go = x[rows, f] <= cut
            todo += [(left, rows[go]), (right, rows[~go])]
    return out


def _node_boxes(nodes, boxes: dict, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of every node from those of its cells (children come later)."""
    lo, hi = np.full((len(nodes), width), math.inf), np.full((len(nodes), width), -math.inf)
    for at in range(len(nodes) - 1, -1, -1):
        f, _, left, right = nodes[at]
        if f >= 0:
            lo[at], hi[at] = np.minimum(lo[left], lo[right]), np.maximum(hi[left], hi[right])
        elif left in boxes:
            lo[at], hi[at] = boxes[left]
    return lo, hi


def _reached(x: np.ndarray, radius: np.ndarray, nodes, lo: np.ndarray, hi: np.ndarray):
    """(rows, cell) of the cells whose box is within ``radius`` of the rows."""
    todo = [(0, np.arange(len(x)))]
    while todo:
        at, rows = todo.pop()
        gap = np.maximum(np.maximum(lo[at] - x[rows], x[rows] - hi[at]), 0.0)
        rows = rows[np.sqrt((gap * gap).sum(axis=1)) <= radius[rows] * (1 + 1e-9)]
        f, _, left, right = nodes[at]
        if f < 0:
            yield rows, left
        elif len(rows):
            todo += [(left, rows), (right, rows)]


def _cand(q, p, d, cell) -> pd.DataFrame:
    return pd.DataFrame({"q": np.asarray(q, np.int64), "p": np.asarray(p, np.int64), "d": np.asarray(d, float),
                         "cell": np.asarray(cell, np.int32)})


def nearest_neighbours(points: DataFrame, key: str, x: str, k: int,
                       cell_rows: int = 10_000) -> DataFrame:
    """Exact k nearest neighbours (excluding the row itself):
    ``(key, nn array<string>, nd array<double>)`` in distance order, ties by
    key; one row a key, of repeated keys the best of their rows. NaN counts as
    0."""
    spark = points.sparkSession
    flat = F.transform(F.col(x), lambda v: F.nanvl(v, F.lit(0.0)) + F.lit(0.0))
    base = points.select(F.col(key).cast("string").alias("_id"), flat.alias("_x")).filter(F.col(x).isNotNull())
    rows = ordered_scan(base, ["_x"], ["_id"], count_as="_nth")
    first = (rows.filter(F.col("_nth") <= k + 1).groupBy("_x").agg(F.array_sort(F.collect_list(F.struct("_id"))).alias("_ids"))
             .withColumn("pid", F.monotonically_increasing_id()).checkpoint(eager=True))
    n = first.count()
    if n == 0:
        return spark.createDataFrame([], f"{key} string, nn array<string>, nd array<double>")
    cells = max(1, math.ceil(n / cell_rows))
    share = min(1.0, min(CELL_SAMPLE * cells, SAMPLE_ROWS) / n)
    some = first.select("_x").filter(F.pmod(F.xxhash64("_x"), F.lit(1 << 20)) < math.ceil(share * (1 << 20))) if cells > 1 else first.select("_x").limit(1)
    sample = np.array([r["_x"] for r in some.collect()], dtype=float)
    nodes = _tree(sample, cells) if len(sample) else [(-1, 0.0, 0, 0)]
    width = len(first.select("_x").first()["_x"])

    def place(batches):
        for b in batches:
            yield b.assign(_cell=_cells_of(np.vstack(b["_x"]), nodes) if len(b) else np.zeros(0, np.int32))

    # a point's number of rows, its first key (ties), its features and its cell
    placed = (first.select("pid", F.size("_ids").alias("m"), F.col("_ids")[0]["_id"].alias("_first"), "_x")
              .mapInPandas(place, "pid long, m int, _first string, _x array<double>, _cell int")
              .repartition(cells, "_cell").checkpoint(eager=True))
    bounds = placed.groupBy("_cell").agg(
        F.array(*[F.min(F.col("_x")[j]) for j in range(width)]).alias("lo"), F.array(*[F.max(F.col("_x")[j]) for j in range(width)]).alias("hi"))
    boxes = {r["_cell"]: (np.array(r["lo"], float), np.array(r["hi"], float)) for r in bounds.collect()}
    tree = spark.sparkContext.broadcast((nodes, *_node_boxes(nodes, boxes, width)))
    most = k + 1                                 # the row itself is its own nearest

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_first", na_position="last", kind="stable")
        xs, pid, m = np.vstack(pdf["_x"]), pdf["pid"].to_numpy(), pdf["m"].to_numpy()
        row, col, dist = _topk_rows(xs, xs, most)
        # the distance at which the rows found so far are enough
        held = np.cumsum(m[col])
        start = np.searchsorted(row, np.arange(len(pdf)))
        held -= np.concatenate([[0], held])[start][row]
        radius = np.full(len(pdf), math.inf)
        np.minimum.at(radius, row[held >= most], dist[held >= most])
        out, cell = [_cand(pid[row], pid[col], dist, np.full(len(row), -1))], int(pdf["_cell"].iloc[0])
        for rows, other in _reached(xs, radius, *tree.value):
            if other != cell and len(rows):
                out.append(_cand(pid[rows], np.full(len(rows), -1), radius[rows], np.full(len(rows), other)))
        return pd.concat(out)

    def remote(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or held.empty:
            return _cand([], [], [], [])
        held = held.sort_values("_first", na_position="last", kind="stable")
        row, col, dist = _topk_rows(np.vstack(asked["_qx"]), np.vstack(held["_x"]), most, asked["d"].to_numpy())
        return _cand(asked["q"].to_numpy()[row], held["pid"].to_numpy()[col], dist, np.full(len(row), -1))

    # one pass per cell; its output is checkpointed (it feeds two branches)
    stage = placed.groupBy("_cell").applyInPandas(local, _CAND).checkpoint(eager=True)
    asked = (stage.filter(F.col("cell") >= 0).select("q", "d", "cell")
             .join(first.select(F.col("pid").alias("q"), F.col("_x").alias("_qx")), "q").repartition(cells, "cell"))
    far = asked.groupBy("cell").cogroup(placed.repartition(cells, "_cell").groupBy("_cell")).applyInPandas(remote, _CAND)
    cands = stage.filter(F.col("cell") < 0).unionByName(far)
    named = cands.join(first.select(F.col("pid").alias("p"), "_ids"), "p").select(
        "q", F.transform("_ids", lambda i: F.struct(F.col("d").alias("d"), i["_id"].alias("nid"))).alias("b"))
    best = named.groupBy("q").agg(F.slice(F.array_sort(F.flatten(F.collect_list("b"))), 1, most).alias("b"))
    best = best.join(first.select(F.col("pid").alias("q"), F.col("_x").alias("_qx")), "q")
    # A row takes its point's list without itself.
    each = rows.join(best, F.col("_x") == F.col("_qx"))
    own = F.array_position(F.transform("b", lambda e: e["nid"].eqNullSafe(F.col("_id")) & (e["d"] == 0)), F.lit(True))
    others = F.filter("b", lambda e, i: i + 1 != own)
    each = each.select(F.col("_id").alias(key), F.slice(others, 1, k).alias("b")).groupBy(key).agg(F.collect_list("b").alias("b"))
    each = each.withColumn("b", F.slice(F.array_sort(F.flatten("b")), 1, k))
    return each.select(key, F.col("b.nid").alias("nn"), F.col("b.d").alias("nd"))


def smote(train: DataFrame, key: str, features: str = "features", label: str = S.TARGET,
          k: int = 5, seed: int = S.SEED, cell_rows: int = 10_000) -> DataFrame:
    """Balanced training rows: the originals plus synthetic minority rows.
    Output columns: ``key, features, label, synthetic``."""
    counts = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}
    base = train.select(F.col(key).cast("string").alias(key), F.col(features).alias(features),
                        F.col(label).alias(label), F.lit(False).alias("synthetic"))
    if len(counts) < 2:
        return base
    minority = min(counts, key=lambda c: (counts[c], c))
    majority = max(counts, key=lambda c: (counts[c], -c))
    n_min, n_new = counts[minority], counts[majority] - counts[minority]
    kk = min(k, n_min - 1)
    if n_new <= 0 or kk < 1:
        return base
    mino = train.filter(F.col(label) == minority).select(
        F.col(key).cast("string").alias("_id"), vector_to_array(F.col(features)).alias("_x")).checkpoint()
    nn = nearest_neighbours(mino, "_id", "_x", kk, cell_rows)
    # only the ids go through the ordered scan; vectors join back by id
    ranks = ordered_scan(mino.select("_id"), [], ["_id"], count_as="_rank")
    ranked = ranks.join(mino, "_id").join(nn, "_id")
    spark = train.sparkSession
    gen = spark.range(n_new).select(
        F.col("id").alias("_s"),
        (F.floor(unit_hash(F.col("id"), F.lit("pick"), seed=seed) * (n_min * kk))).cast("long").alias("_pair"),
        unit_hash(F.col("id"), F.lit("gap"), seed=seed).alias("_gap"))
    gen = gen.select("_s", "_gap", (F.floor(F.col("_pair") / kk) + 1).cast("long").alias("_rank"),
                     (F.col("_pair") % kk).cast("int").alias("_j"))
    g = gen.join(ranked.select("_rank", "_x", "nn"), "_rank")
    g = g.select("_s", "_gap", "_x", F.element_at("nn", F.col("_j") + 1).alias("_nid"))
    g = g.join(mino.select(F.col("_id").alias("_nid"), F.col("_x").alias("_xn")), "_nid")
    new_x = F.zip_with("_x", "_xn", lambda a, b: a + F.col("_gap") * (b - a))
    synth = g.select(F.concat(F.lit("smote_"), F.col("_s").cast("string")).alias(key),
                     array_to_vector(new_x).alias(features),
                     F.lit(minority).cast(train.schema[label].dataType).alias(label),
                     F.lit(True).alias("synthetic"))
    return base.unionByName(synth)
