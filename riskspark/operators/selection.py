"""Exact order statistics by counting passes, without sorting.

A value range that holds a wanted rank is cut into ``STEPS`` equal steps; one
aggregate (combined map-side) counts each step's rows and notes its lowest and
highest value. The step that holds the rank, with those two values as bounds,
is the next range. A range of one value is the answer; one of at most
``FINISH`` rows is finished from its distinct values. The lowest and highest
value of a range never share a step, so every pass narrows it. Later passes
filter by the bounds, which reach a Parquet scan as pushed filters.

Nothing is shuffled but the counts. The driver holds at most ``STEPS`` rows
for each open range (at most two a probability and column). ``group`` must be
a column with few values (the name of a column), not data; groups of unknown
number go through ``quantile.exact_quantiles``.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEPS, FINISH = 1024, 4096


def _finite(c):
    return (c > F.lit(-math.inf)) & (c < F.lit(math.inf))       # NaN is greater than infinity


def counts(df: DataFrame, value: str, group: str | None = None) -> dict:
    """Per group: rows with a value, those of -inf, +inf and NaN, and the finite bounds."""
    v = F.col(value).cast("double")
    g = F.col(group) if group else F.lit("")
    rows = df.filter(v.isNotNull()).groupBy(g.alias("g")).agg(
        F.count(v).alias("n"), F.count_if(v == -math.inf).alias("least"), F.count_if(v == math.inf).alias("most"),
        F.count_if(F.isnan(v)).alias("nan"), F.min(F.when(_finite(v), v)).alias("lo"), F.max(F.when(_finite(v), v)).alias("hi"))
    return {r["g"]: r for r in rows.collect()}


def select(df: DataFrame, value: str, ranks: dict, known: dict, group: str | None = None) -> dict:
    """``{(group, rank): (value, rows below it)}`` for 0-based ``ranks`` per
    group; ``known`` comes from ``counts``. Without ``group`` the group is ''."""
    out, open_ = {}, defaultdict(set)           # (g, lo, hi, rows below, rows within) -> ranks
    for g, wanted in ranks.items():
        r = known[g]
        finite = r["n"] - r["least"] - r["most"] - r["nan"]
        for k in wanted:
            if not 0 <= k < r["n"]:
                raise ValueError(f"rank {k} of {r['n']} rows")
            if k < r["least"]:
                out[g, k] = (-math.inf, 0)
            elif k < r["least"] + finite:
                open_[g, r["lo"], r["hi"], r["least"], finite].add(k)
            elif k < r["n"] - r["nan"]:
                out[g, k] = (math.inf, r["least"] + finite)
            else:
                out[g, k] = (math.nan, r["n"] - r["nan"])
    v = F.col(value).cast("double")
    data = df.select((F.col(group) if group else F.lit("")).alias("g"), v.alias("v"))
    while open_:
        todo = {}
        for at in open_:
            if at[1] == at[2]:
                out.update({(at[0], k): (at[1], at[3]) for k in open_[at]})
            else:
                todo[len(todo)] = at
        if not todo:
            break
        wide = [not math.isfinite(at[2] - at[1]) for at in todo.values()]
        table = df.sparkSession.createDataFrame(
            [(i, g, lo, hi, 0.25 if w else 1.0, n <= FINISH) for (i, (g, lo, hi, _, n)), w in zip(todo.items(), wide)],
            "i int, r string, lo double, hi double, scale double, few boolean")
        within = data.filter((F.col("v") >= min(at[1] for at in todo.values())) & (F.col("v") <= max(at[2] for at in todo.values())))
        # At most two ranges a probability and column.
        met = within.join(F.broadcast(table), (F.col("g") == F.col("r")) & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
        share = (F.col("v") * F.col("scale") - F.col("lo") * F.col("scale")) / (F.col("hi") * F.col("scale") - F.col("lo") * F.col("scale"))
        step = F.least(F.floor(share * STEPS), F.lit(STEPS - 1))
        hist = met.groupBy("i", F.when(~F.col("few"), step).alias("step"), F.when(F.col("few"), F.col("v")).alias("x")).agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        steps = defaultdict(list)
        for r in hist.collect():
            steps[r["i"]].append((r["lo"], r["hi"], r["n"]))
        nxt = defaultdict(set)
        for i, at in todo.items():
            below, wanted = at[3], sorted(open_[at])
            for lo, hi, n in sorted(steps[i]):
                for k in (k for k in wanted if below <= k < below + n):
                    nxt[at[0], lo, hi, below, n].add(k)
                below += n
        open_ = nxt
    return out


def quantiles(df: DataFrame, value: str, probs: list[float], group: str | None = None) -> dict:
    """``{group: [quantile, ...]}`` with linear interpolation; nulls are
    ignored, a group without values is absent."""
    known = counts(df, value, group)
    at = {g: [(r["n"] - 1) * float(p) for p in probs] for g, r in known.items()}
    got = select(df, value, {g: {k for h in hs for k in (math.floor(h), math.ceil(h))} for g, hs in at.items()}, known, group)

    def between(g, h):
        lo, hi = got[g, math.floor(h)][0], got[g, math.ceil(h)][0]
        return lo if lo == hi else lo + (h - math.floor(h)) * (hi - lo)
    return {g: [between(g, h) for h in hs] for g, hs in at.items()}
