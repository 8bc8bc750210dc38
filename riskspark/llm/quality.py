"""Quality: a regularised quadratic discriminant over document statistics.

Statistics of the whole text (lengths, shares of character classes, repeated
words, word pairs and lines) are log or arcsine transformed and standardised. Each
class has a mean and a covariance shrunk towards the pooled one and its
diagonal; the score is the logistic of the scaled difference of the two log
densities (Mahalanobis form, Cholesky factors computed once) plus the log prior odds.

Null texts count as empty and get the score of their (zero) statistics.
Without labels of both classes the score is the base rate (0.0 without
labels). Other columns are ignored, repeated rows are scored alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.textkit import (SPACE, held_out, labelled_sample, logistic_fit, sequence_hashes, sigmoid, utf8,
                                   word_hashes)

SAMPLE = {1: 10_000, 0: 10_000}   # bound of the labelled rows read for the fit
SHRINK, DIAGONAL = 0.15, 0.3
THRESHOLD = 0.7
_b = np.arange(256)
CLASSES = [(_b >= 65) & (_b <= 90), (_b >= 97) & (_b <= 122), (_b >= 48) & (_b <= 57), _b >= 128, _b == 124, _b == 33,
           np.isin(_b, list(b"%&*#$")), np.isin(_b, list(b".,;:?")), np.isin(_b, list(b"+-=@<>/\\{}[]()_\"'")), _b == 10]
N = len(CLASSES) + 8


def statistics(data: np.ndarray) -> np.ndarray:
    """Transformed statistics of one text."""
    out = np.zeros(N)
    n = len(data)
    if not n:
        return out
    count = np.bincount(data, minlength=256)
    out[:len(CLASSES)] = [np.arcsin(np.sqrt(count[c].sum() / n)) for c in CLASSES]
    h = word_hashes(data)
    k = len(h)
    out[-8:-5] = np.log1p(n), np.log1p(k), np.log1p((n - count[SPACE].sum()) / max(k, 1))
    if k:
        _, c = np.unique(h, return_counts=True)
        out[-5:-3] = len(c) / k, c.max() / k
    if k > 2:
        out[-3] = len(np.unique(sequence_hashes(h, 3))) / (k - 2)
    lines = bytes(data).split(b"\n")
    out[-2:] = len(set(lines)) / len(lines), np.log1p(n / len(lines))
    return out


def matrix(column) -> np.ndarray:
    data, off = utf8(column)
    return np.array([statistics(data[off[i]:off[i + 1]]) for i in range(len(off) - 1)]).reshape(-1, N)


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    sample, counts = labelled_sample(docs, labels, "quality", SAMPLE)
    total = sum(counts.values())
    model = {"base": counts.get(1, 0) / total if total else 0.0, "classes": None}

    def run(batches):
        for b in batches:
            x = matrix(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), b.column(1).cast(pa.int64())], names=["x", "y"])

    got = sample.select("text", "y").mapInArrow(run, "x array<double>, y long").collect()
    y = np.array([r["y"] for r in got])
    if len(set(y.tolist()) & {0, 1}) < 2:
        return model
    x = np.array([r["x"] for r in got])
    mean, std = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / std
    cov = {c: np.cov(z[y == c].T, bias=True) if (y == c).sum() > 1 else np.eye(N) for c in (0, 1)}
    pooled = sum(cov[c] * (y == c).mean() for c in (0, 1))
    classes = []
    for c in (0, 1):
        s = (1 - SHRINK) * cov[c] + SHRINK * ((1 - DIAGONAL) * pooled + DIAGONAL * np.diag(np.diag(pooled))) + 1e-3 * np.eye(N)
        low = np.linalg.cholesky(s)
        classes.append((z[y == c].mean(0), np.linalg.inv(low), float(np.log(np.diag(low)).sum())))
    model |= {"mean": mean, "std": std, "classes": classes}
    d = log_ratio(x, model)
    w = np.where(y == 1, model["base"] / (y == 1).mean(), (1 - model["base"]) / (y == 0).mean())
    model["scale"] = logistic_fit(np.c_[np.ones(len(d)), np.arcsinh(d)], y.astype(float), w)
    return model


def log_ratio(x: np.ndarray, model: dict) -> np.ndarray:
    """Log density of class 1 less that of class 0."""
    z = (x - model["mean"]) / model["std"]
    dens = [-0.5 * (((z - m) @ inv.T) ** 2).sum(1) - logdet for m, inv, logdet in model["classes"]]
    return dens[1] - dens[0]


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    def run(batches):
        for b in batches:
            if model["classes"] is None:
                s = np.full(b.num_rows, model["base"])
            else:
                s = sigmoid(np.c_[np.ones(b.num_rows), np.arcsinh(log_ratio(matrix(b.column(2)), model))] @ model["scale"])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])
    return (docs.select(F.col("doc_id"), held_out().alias("held_out"), F.col("text"))
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))
