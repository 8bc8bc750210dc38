"""Toxicity: a weighted lexicon matched by Aho-Corasick.

Texts are folded (lower case, homoglyphs, digit substitutions inside words),
words are set off by one space, and one automaton finds the entries: whole
words (`` word ``) and word beginnings (`` pre``). Entries and weights
(smoothed log-odds) are learned from a bounded sample of labelled rows; an
entry needs a G-squared statistic of ``MIN_G2``. Exception phrases (given, or
two-word phrases around a hit found only in harmless sample rows) cancel the hits
inside them. The weights of the hits, alone and divided by the length, give
the score through a ridge logistic fit.

Null and empty texts have no hit and get the base score. Without labels of
both classes the lexicon is empty and all scores are the base rate (0.0
without any label). Repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.textkit import held_out, labelled_sample, logistic_fit, sigmoid

SAMPLE = {1: 6000, 0: 18000}      # bound of the labelled rows read for the fit
MIN_DF, MIN_G2, MIN_WEIGHT, MAX_ENTRIES = 3, 24.0, 1.6, 4000
PREFIXES = (4, 5, 6, 7, 8)
THRESHOLD = 0.3

# Look-alike letters and digit substitutions.
HOMOGLYPHS = str.maketrans(dict(zip("авеёкмнорстухіјѕԁαερτυικνο", "abeekmhopctyxijsdaeptuikvo", strict=True)))
DIGITS = str.maketrans("01345789@$", "oieastbgas")
ODD = re.compile(r"[Ͱ-ϿЀ-ԯ]")
MIXED = re.compile(r"[0-9@$]?[^\W\d_]+(?:[0-9@$]+[^\W\d_]+)+|\b[0-9@$][^\W\d_]{2,}")
GAPS = re.compile(r"[\W_]+")


def fold(text: str | None) -> str:
    """Folded text: words between single spaces, with a space at both ends."""
    t = (text or "").lower()
    if not t.isascii() and ODD.search(t):
        t = t.translate(HOMOGLYPHS)
    t = MIXED.sub(lambda m: m[0].translate(DIGITS), t)
    return " " + GAPS.sub(" ", t).strip() + " "


def automaton(model):
    import ahocorasick
    a = ahocorasick.Automaton()
    for p, w in model["lexicon"].items():
        a.add_word(p, (len(p), w))
    for p in model["exceptions"]:
        a.add_word(p, (len(p), None))
    if len(a):
        a.make_automaton()
    return a


def hits(folded: str, auto) -> list[tuple[int, float, int]]:
    """(start, weight, end): the heaviest entry at each start that is in no exception phrase."""
    if not len(auto):
        return []
    best, cancelled = {}, []
    for end, (n, w) in auto.iter(folded):
        s = end - n + 1
        if w is None:
            cancelled.append((s, end))
        elif s not in best or best[s][0] < w:
            best[s] = (w, end)
    return [(s, w, e) for s, (w, e) in best.items() if not any(a <= s and s + 1 < b for a, b in cancelled)]


def features(folded: str, auto) -> list[float]:
    found = hits(folded, auto)
    n = max(1, folded.count(" ") - 1)
    total = sum(w for _, w, _ in found)
    top = max((w for _, w, _ in found), default=0.0)
    return [1.0, top / 5, math.log1p(total), math.log1p(100 * total / n)]


def _candidates(sample: DataFrame):
    def run(batches):
        count: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen = set()
                for w in set(fold(t).split()):
                    seen.add(f" {w} ")
                    seen.update(f" {w[:k]}" for k in PREFIXES if len(w) >= k)
                count[y].update(seen)
        keys = list(set(count[0]) | set(count[1]))
        for i in range(0, len(keys), 50_000):
            k = keys[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array([count[1][x] for x in k], pa.int64()),
                                              pa.array([count[0][x] for x in k], pa.int64())], names=["e", "p", "q"])
    return (sample.select("text", "y").mapInArrow(run, "e string, p long, q long")
            .groupBy("e").agg(F.sum("p").alias("p"), F.sum("q").alias("q")))


def fit(docs: DataFrame, labels: DataFrame, exceptions=()) -> dict:
    """Learn lexicon, exception phrases and score weights."""
    sample, counts = labelled_sample(docs, labels, "toxic", SAMPLE)
    seen = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = seen.get(1, 0), seen.get(0, 0)
    total = sum(counts.values())
    base = counts.get(1, 0) / total if total else 0.0
    model = {"lexicon": {}, "exceptions": list(exceptions), "beta": None, "base": base}
    if not pos or not neg:
        return model
    share = pos / (pos + neg)
    p, q = F.col("p"), F.col("q")
    n = p + q
    g2 = 2 * (p * F.log(p / (n * share)) + F.when(q > 0, q * F.log(q / (n * (1 - share)))).otherwise(0.0))
    weight = F.log((p + 0.5) / (pos + 1)) - F.log((q + 0.5) / (neg + 1))
    rows = (_candidates(sample).filter(p >= MIN_DF).withColumn("g", g2).withColumn("w", weight)
            .filter((F.col("g") >= MIN_G2) & (F.col("w") >= MIN_WEIGHT))
            .orderBy(F.desc("g"), "e").limit(MAX_ENTRIES).collect())
    count = {r["e"]: r["p"] for r in rows}
    weights = {r["e"]: float(r["w"]) for r in rows}
    chosen: dict[str, float] = {}
    for e in sorted(weights, key=lambda x: (len(x.strip()), x)):
        stem = e.rstrip()
        if any(stem[:k] in chosen for k in range(2, len(stem))):
            continue                                 # a shorter entry already covers it
        longer = [x for x in weights if x != e and x.startswith(stem) and count[x] >= 0.95 * count[e]]
        if not longer:                               # the longest form that finds the same rows
            chosen[e] = weights[e]
    model["lexicon"] = chosen
    auto = automaton(model)

    def around(batches):
        lex = automaton(model)
        for b in batches:
            out = []
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                f = fold(t)
                for s, _, e in hits(f, lex):
                    right = f.find(" ", s + 1)
                    left = f.rfind(" ", 0, s)
                    nxt = f.find(" ", right + 1)
                    if left >= 0:
                        out.append((f[left:right + 1], y))
                    if nxt >= 0:
                        out.append((f[s:nxt + 1], y))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.string()),
                                              pa.array([y for _, y in out], pa.int64())], names=["phrase", "y"])

    phrases = (sample.select("text", "y").mapInArrow(around, "phrase string, y long").groupBy("phrase")
               .agg(F.sum("y").alias("bad"), F.count(F.lit(1)).alias("n"))
               .filter("bad = 0 and n >= 3").orderBy(F.desc("n"), "phrase").limit(1000).collect())
    model["exceptions"] += [r["phrase"] for r in phrases]
    shared = dict(model)

    def measure(batches):
        lex = automaton(shared)
        for b in batches:
            x = np.array([features(fold(t), lex) for t in b.column(0).to_pylist()]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, i]) for i in range(4)] + [b.column(1).cast(pa.int64())],
                                             names=["a", "b", "c", "d", "y"])

    got = sample.select("text", "y").mapInArrow(measure, "a double, b double, c double, d double, y long").toPandas()
    x, y = got[["a", "b", "c", "d"]].to_numpy(), got["y"].to_numpy().astype(float)
    w = np.where(y == 1, base / max(share, 1e-9), (1 - base) / max(1 - share, 1e-9))
    model["beta"] = logistic_fit(x, y, w).tolist()
    return model


def _scores(texts, model, auto) -> np.ndarray:
    if model["beta"] is None:
        return np.full(len(texts), model["base"])
    x = np.array([features(fold(t), auto) for t in texts]).reshape(-1, 4)
    return sigmoid(x @ np.array(model["beta"]))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    def run(batches):
        auto = automaton(model)
        for b in batches:
            s = _scores(b.column(2).to_pylist(), model, auto)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])
    return (docs.select(F.col("doc_id"), held_out().alias("held_out"), F.col("text"))
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))


def drop_toxic(docs: DataFrame, model: dict) -> DataFrame:
    """The rows below the threshold, with all their columns."""
    at = docs.columns.index("text")

    def run(batches):
        auto = automaton(model)
        for b in batches:
            s = _scores(b.column(at).to_pylist(), model, auto)
            yield b.filter(pa.array(s < THRESHOLD))
    return docs.mapInArrow(run, docs.schema)
