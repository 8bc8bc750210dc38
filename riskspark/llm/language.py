"""Language identification with error-correcting output codes.

Each learned language has a codeword of +1/-1 bits; a linear classifier on
hashed byte n-grams (1 to 3, of the lower-cased text) predicts each bit, and
loss-weighted decoding picks the codeword with the least summed logistic loss.
A small gap between the two nearest codewords sets ``ambiguous``. The
classifiers are fitted on a bounded sample of rows with a language (never
those whose crc32(doc_id) mod 4 is 2). Whole texts are read.

``und``: null text, a text without a letter, or nothing learned. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.textkit import LOWER, U64, held_out, reliable, remainder, utf8

SAMPLE_PER_LANG, DIMS, AMBIGUOUS = 800, 1 << 12, 0.15
LETTER = regex.compile(r"\p{L}")
A, B, C = (np.uint32(x) for x in (2654435761, 2246822519, 3266489917))
BLOCK = 1 << 20


def grams(data: np.ndarray) -> np.ndarray:
    """Square-rooted, normalised counts of hashed byte 1-, 2- and 3-grams."""
    acc = np.zeros(DIMS)
    for at in range(0, len(data), BLOCK):
        a = LOWER[data[at:at + BLOCK + 2]].astype(np.uint32)
        own = min(BLOCK, len(data) - at)
        h = a * A
        acc += np.bincount(h[:own] >> np.uint32(20), minlength=DIMS)
        h2 = h[:-1] ^ (a[1:] * B)
        acc += np.bincount(h2[:own] * A >> np.uint32(20), minlength=DIMS)
        h3 = h2[:-1] ^ (a[2:] * C)
        acc += np.bincount(h3[:own] * B >> np.uint32(20), minlength=DIMS)
    v = np.sqrt(acc)
    return v / (np.sqrt((v * v).sum()) or 1.0)


def codewords(k: int) -> np.ndarray:
    """k distinct words of +1/-1: all splits of up to 4 languages, else a
    seeded random code of 10 log2(k) bits with the best least distance of 50."""
    if k <= 4:
        cols = [[1 if i == 0 or (b >> (i - 1)) & 1 else -1 for i in range(k)] for b in range(2 ** (k - 1) - 1)]
        return np.array(cols or [[1] * k]).T
    rng = np.random.Generator(np.random.PCG64(5))
    bits = int(np.ceil(10 * np.log2(k)))
    best, far = None, -1
    for _ in range(50):
        m = rng.choice([-1, 1], (k, bits))
        d = min(int((m[i] != m[j]).sum()) for i in range(k) for j in range(i))
        if d > far:
            best, far = m, d
    return best


def fit(docs: DataFrame) -> dict:
    base = docs.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder() != 2))
    langs = sorted(r["lang"] for r in base.select("lang").distinct().collect())
    if not langs:
        return {"langs": []}
    ids = None
    for g in langs:
        part = base.filter(F.col("lang") == g).select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(23)), "doc_id").limit(SAMPLE_PER_LANG)
        ids = part if ids is None else ids.unionByName(part)

    def run(batches):
        for b in batches:
            data, off = utf8(b.column(1))
            x = [grams(data[off[i]:off[i + 1]]).astype(np.float32) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float32()))], names=["lang", "x"])

    # One row an id and language, so no more rows than ids of the sample for each language.
    rows = (base.join(F.broadcast(reliable(ids.distinct())), "doc_id").groupBy("doc_id", "lang")
            .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("lang", "t.text"))
    got = rows.mapInArrow(run, "lang string, x array<float>").toArrow()
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(-1, DIMS).astype(np.float32)
    pos = {g: i for i, g in enumerate(langs)}
    code = codewords(len(langs))
    y = code[[pos[g] for g in got["lang"].to_pylist()]].astype(np.float32)
    w = np.zeros((DIMS, code.shape[1]), np.float32)
    bias = np.zeros(code.shape[1], np.float32)
    v, step = np.zeros_like(w), 20.0
    for i in range(150):                      # accelerated gradient steps on the ridge logistic loss
        m = w + (i / (i + 3)) * v
        g = -y / (1 + np.exp(np.clip(y * (x @ m + bias), -30, 30))) / len(x)
        new = m - step * (x.T @ g + 1e-6 * m)
        bias = bias - 1.0 * g.sum(0)
        v, w = new - w, new
    return {"langs": langs, "code": code, "w": w.astype(float), "bias": bias.astype(float)}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every row."""
    def run(batches):
        langs = model["langs"]
        for b in batches:
            data, off = utf8(b.column(2))
            names, conf, amb = [], [], []
            if langs:
                f = np.array([grams(data[off[i]:off[i + 1]]) for i in range(b.num_rows)]).reshape(-1, DIMS) @ model["w"] + model["bias"]
                loss = np.logaddexp(0, -f[:, None, :] * model["code"][None]).mean(2)
            for i, t in enumerate(b.column(2).to_pylist()):
                if not langs or t is None or not LETTER.search(t):
                    names.append("und"), conf.append(0.0), amb.append(True)
                    continue
                e = np.exp(-(loss[i] - loss[i].min()) * model["code"].shape[1])
                k = int(loss[i].argmin())
                two = np.sort(loss[i])[:2]
                names.append(langs[k]), conf.append(float(e[k] / e.sum()))
                amb.append(bool(len(two) > 1 and two[1] - two[0] < AMBIGUOUS))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(conf, pa.float64()), pa.array(amb, pa.bool_())],
                                             names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])
    return (docs.select(F.col("doc_id"), held_out().alias("held_out"), F.col("text"))
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"))
