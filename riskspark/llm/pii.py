"""Personal data by weak supervision (DataFrame operations only).

Base spans come from four fixed patterns with their checks. Added candidates
(long hexadecimal secrets, obfuscated e-mail addresses, phone numbers without
a plus) come from wider patterns. Three labelers vote on every candidate of
every kind: a strict form or check, a gazetteer of cue words shortly before it
and the character before it. Expectation-maximisation over the counts of the
vote patterns estimates each labeler's reliability by kind; the posteriors are
the soft labels of a logistic span classifier over ``FEATURES`` (the votes and
what the labelers do not see), its weights shared by the kinds with a part of
each kind's own. It is fitted on the counts of all candidates, at most 128
patterns a kind. Added candidates with a score of one half that overlap no
base span are added; base spans need their check alone.

Null text counts as empty. Spans are code points, end exclusive, ordered by
kind (email, ip, card, phone, secret, masked, number), then start. Other
columns are ignored; repeated rows are each scanned; empty tables are fine.
A text's matches are walked in blocks of ``BLOCK``, so the work grows little
faster than their number.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.textkit import logistic_fit

# The base patterns (a run is tried from its beginning only,
# which finds the same leftmost matches; repeated groups are possessive, others
# recurse once per round and overflow the stack on long runs).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?=[\x20-]?[0-9])[0-9]*+(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ADDED = {
    "secret": r"(?<![0-9A-Za-z])[0-9a-f]{32,64}(?![0-9A-Za-z])",
    "masked": r"[A-Za-z0-9._-]{1,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,64} ?[\[(](?:dot|DOT)[\])] ?[A-Za-z]{2,10}",
    "number": r"(?<![0-9+.-])\([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9])",
}
# Words that announce a kind.
GAZETTEER = {
    "email": ["address", "contact", "email", "mail", "mailto", "write"], "ip": ["address", "addr", "host", "ip", "server"],
    "card": ["amex", "card", "credit", "debit", "mastercard", "payment", "visa"],
    "phone": ["call", "cell", "fax", "mobile", "phone", "tel", "telephone"],
    "secret": ["api", "key", "password", "passwd", "secret", "token"], "masked": ["contact", "email", "mail", "reach", "write"],
    "number": ["call", "cell", "fax", "mobile", "phone", "tel", "telephone"],
}
KINDS = [*BASE, *ADDED]
FEATURES = ("strict", "cue", "clean", "closed", "mixed", "long", "first")      # bits 0 to 6; the first three are the votes
BLOCK = 256


def _pairs(text, pattern):
    """array<struct<gap, hit, v, b, a>>: of each match the lengths of the piece before it and
    of itself, its text, the 32 characters before and the one after it."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    both = F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: F.struct(h.alias("h"), g.alias("g")))
    pairs = F.zip_with(both, F.slice(gaps, F.lit(2), F.size(hits)), lambda x, g: F.struct(
        F.length(x["g"]).alias("gap"), F.length(x["h"]).alias("hit"), x["h"].alias("v"), F.right(x["g"], F.lit(32)).alias("b"), F.left(g, F.lit(1)).alias("a")))
    return F.when(text.rlike(pattern), pairs).otherwise(F.array().cast("array<struct<gap:int,hit:int,v:string,b:string,a:string>>"))


def _blocks(array):
    """The array in runs of ``BLOCK``. ``array`` has to be a column, not an expression, or each block makes it anew."""
    count = F.size(array)
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), F.floor((count - 1) / BLOCK).cast("int")),
                                         lambda i: F.slice(array, i * BLOCK + 1, F.lit(BLOCK))))


def _starts(blocks):
    """Where each block begins in the text."""
    sizes = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda n, x: n + x["gap"] + x["hit"]))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(sizes, zero, lambda acc, n: F.struct(
        (acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])


def _spans(kind, blocks, starts):
    """array<struct<s, e, f>> of the matches, f their features."""
    none = F.array().cast("array<struct<s:int,e:int,f:int>>")

    def step(acc, x):
        s = acc["at"] + x["gap"]
        return F.struct((s + x["hit"]).alias("at"), F.concat(acc["out"], F.array(F.struct(
            s.alias("s"), (s + x["hit"]).alias("e"), features(kind, x).alias("f")))).alias("out"))

    placed = F.zip_with(blocks, starts, lambda b, at: F.aggregate(
        b, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"]))
    return F.coalesce(F.flatten(placed), none)


def _luhn(v):
    digits = F.reverse(F.split(F.regexp_replace(v, "[^0-9]", ""), ""))
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(v):
    return F.length(F.regexp_replace(v, "[^0-9]", ""))


CHECK = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.forall(F.split(v, r"\."), lambda p: p.rlike("^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])$")),
    "card": lambda v: _digits(v).between(16, 19) & _luhn(v),
    "phone": lambda v: _digits(v).between(8, 15),
}


STRICT = {
    **CHECK,
    "secret": lambda v: F.length(v).isin(32, 40, 64) & v.rlike("[0-9]") & v.rlike("[a-f]"),
    "masked": lambda v: v.rlike("(?i)(com|org|net|edu|de|fr|es)$"),
    "number": lambda v: ~v.rlike("^\\(0"),
}


def features(kind, m):
    """The features of a match as bits of one integer."""
    words = F.regexp_extract_all(F.lower(m["b"]), F.lit("[a-z]+"), F.lit(0))
    bits = (STRICT[kind](m["v"]), F.arrays_overlap(words, F.array(*[F.lit(w) for w in GAZETTEER[kind]])),
            (m["b"] == "") | m["b"].rlike(r"[\s\"'=:(<]$"), (m["a"] == "") | m["a"].rlike(r"[\s\"'.,;:)>]"),
            m["v"].rlike("[0-9]") & m["v"].rlike("[A-Za-z]"), m["hit"] >= 20, m["b"] == "")
    total = F.lit(0)
    for j, bit in enumerate(bits):
        total = total + F.coalesce(bit, F.lit(False)).cast("int") * (1 << j)
    return total


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and, per kind, all candidates with their features."""
    d = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    out = d.select("doc_id", *[_pairs(F.col("t"), p).alias(k) for k, p in {**BASE, **ADDED}.items()])
    out = out.select("doc_id", *[_blocks(F.col(k)).alias(k) for k in KINDS])
    out = out.select("*", *[_starts(F.col(k)).alias(f"{k}_at") for k in KINDS])
    return out.select("doc_id", *[_spans(k, F.col(k), F.col(f"{k}_at")).alias(k) for k in KINDS])


def reliabilities(counts: dict[int, int], rounds: int = 40) -> dict[int, float]:
    """Posterior of each vote pattern by expectation-maximisation of a
    two-class model with independent labelers; starts from the vote share."""
    post = {v: (0.05 + 0.9 * bin(v).count("1") / 3) for v in range(8)}
    n = sum(counts.values())
    if not n:
        return post
    for _ in range(rounds):
        one = sum(c * post[v] for v, c in counts.items())
        prior = (one + 1) / (n + 2)
        hit = {}
        for j in range(3):
            bit = [(v, c) for v, c in counts.items() if v >> j & 1]
            hit[j] = ((sum(c * post[v] for v, c in bit) + 4) / (one + 5),
                      (sum(c * (1 - post[v]) for v, c in bit) + 1) / (n - one + 5))
        for v in range(8):
            z = math.log(prior / (1 - prior))
            for j, (a, b) in hit.items():
                z += math.log(a / b) if v >> j & 1 else math.log((1 - a) / (1 - b))
            post[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
    return post


def _design(kind: int, f: int) -> list[float]:
    own = [float(k == kind) for k in range(1, len(KINDS))]
    bits = [float(f >> j & 1) for j in range(len(FEATURES))]
    return [1.0, *own, *bits, *[b * (k == kind) for k in range(len(KINDS)) for b in bits]]


def classifier(counts: dict[tuple[int, int], int]) -> np.ndarray:
    """Score above 0 (a probability of one half) or not, as the log-odds of every (kind, features).

    ``counts`` holds how often each occurs. The labels are the posteriors of
    the kind's vote patterns; a kind without candidates has only the shared weights."""
    posts = {}
    for k in range(len(KINDS)):
        votes: dict[int, int] = {}
        for (kind, f), n in counts.items():
            if kind == k:
                votes[f & 7] = votes.get(f & 7, 0) + n
        posts[k] = reliabilities(votes)
    patterns = [(k, f) for k in range(len(KINDS)) for f in range(1 << len(FEATURES))]
    if not counts:
        return np.array([math.log(posts[k][f & 7] / (1 - posts[k][f & 7])) for k, f in patterns]).reshape(len(KINDS), -1)
    seen = sorted(counts)
    x = np.array([_design(*c) for c in seen])
    p = np.array([posts[k][f & 7] for k, f in seen])
    n = np.array([counts[c] for c in seen], dtype=float)
    beta = logistic_fit(np.concatenate([x, x]), np.repeat([1.0, 0.0], len(seen)), np.concatenate([n * p, n * (1 - p)]))
    return (np.array([_design(*c) for c in patterns]) @ beta).reshape(len(KINDS), -1)


def find(docs: DataFrame, checkpoint) -> DataFrame:
    """doc_id, base spans (array of kind, s, e) and all spans."""
    found = checkpoint(scan(docs))

    def code(i):
        return lambda m: F.lit(i << len(FEATURES)) + m["f"]

    codes = F.concat(*[F.transform(k, code(i)) for i, k in enumerate(KINDS)])
    got = found.select(F.explode(codes).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()   # at most 128 rows a kind
    scores = classifier({divmod(r["c"], 1 << len(FEATURES)): r["n"] for r in got})

    def span(k):
        return lambda m: F.struct(F.lit(k).alias("k"), m["s"].alias("s"), m["e"].alias("e"))

    def accepted(k):
        good = [f for f, z in enumerate(scores[KINDS.index(k)].tolist()) if z >= 0]
        return F.filter(k, lambda m: m["f"].isin(good) if good else F.lit(False))

    out = found.select("doc_id", *[F.filter(k, lambda m: m["f"].bitwiseAND(1) == 1).alias(k) for k in BASE], *[accepted(k).alias(k) for k in ADDED])
    out = out.withColumn("base", F.concat(*[F.transform(k, span(k)) for k in BASE]))
    # Of a block of candidates, only the base spans within its reach are compared with each.
    out = out.select("doc_id", *BASE, "base", *[_blocks(F.col(k)).alias(k) for k in ADDED])
    out = out.select("doc_id", *BASE, "base", *[F.transform(k, lambda c: F.struct(c.alias("c"), F.filter(
        "base", lambda b: (b["s"] < F.element_at(c, -1)["e"]) & (F.element_at(c, 1)["s"] < b["e"])).alias("near"))).alias(k) for k in ADDED])
    free = {k: F.flatten(F.transform(k, lambda x: F.filter(x["c"], lambda m: ~F.exists(
        x["near"], lambda b: (b["s"] < m["e"]) & (m["s"] < b["e"]))))) for k in ADDED}
    none = F.array().cast("array<struct<k:string,s:int,e:int>>")
    return out.select("doc_id", *BASE, "base", F.concat("base", *[F.coalesce(F.transform(c, span(k)), none) for k, c in free.items()]).alias("all"))


def text_of(spans):
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", m["k"], m["s"], m["e"])), ",")
