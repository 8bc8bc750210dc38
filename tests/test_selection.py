"""Order statistics by counting passes against sorted lists."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import prep as P
from riskspark.operators import selection as S

HARD = {"uniform": lambda r: r.random(3000), "heavy": lambda r: np.exp(r.normal(0, 40, 3000)),
        "ties": lambda r: r.integers(0, 3, 3000).astype(float), "one": lambda r: np.full(50, 2.5),
        "wide": lambda r: np.array([-1.7e308, 1.7e308, 0.0, 5e-324, -5e-324, 1.0]),
        "odd": lambda r: np.array([-math.inf, math.inf, math.inf, math.nan, 1.0, 2.0, 2.0])}


@pytest.mark.parametrize("finish", [0, S.FINISH])
def test_ranks_equal_the_sorted_values(spark, monkeypatch, finish):
    """All groups in the same passes; ``finish`` 0 narrows to single values."""
    monkeypatch.setattr(S, "FINISH", finish)
    monkeypatch.setattr(S, "STEPS", 64)
    rng = np.random.default_rng(3)
    data = {g: np.sort(make(rng)) for g, make in HARD.items() if finish or g != "heavy"}       # NaN sorts last
    df = spark.createDataFrame([(g, float(x)) for g, xs in data.items() for x in xs] + [("none", None)], "g string, v double")
    known = S.counts(df, "v", "g")
    assert "none" not in known
    ranks = {g: {0, len(xs) // 3, len(xs) // 2, len(xs) - 1} for g, xs in data.items()}
    got = S.select(df, "v", ranks, known, "g")
    for g, ks in ranks.items():
        for k in ks:
            value, below = got[g, k]
            want = float(data[g][k])
            assert value == want or math.isnan(value) and math.isnan(want), (g, k)
            assert below == (sum(data[g] < want) if not math.isnan(want) else sum(~np.isnan(data[g])))


def test_quantiles_without_rows_and_rank_out_of_range(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "v double")
    assert S.quantiles(df, "v", [0.0, 0.5, 0.75, 1.0]) == {"": [1.0, 2.0, 3.0, 4.0]}
    assert S.quantiles(df.filter("v > 9"), "v", [0.5]) == {}
    with pytest.raises(ValueError):
        S.select(df, "v", {"": {3}}, S.counts(df, "v"))


@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_exact_split_sizes_with_repeated_keys(spark, n):
    df = spark.range(n).select(F.when(F.col("id") < n // 2, "hot").otherwise(F.col("id").cast("string")).alias("transaction_id"))
    out = P.split(df, exact=True)
    got = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    test = math.ceil(0.2 * n)
    val = math.ceil(0.1 * (n - test))
    assert got == {k: v for k, v in (("test", test), ("val", val), ("train", n - test - val)) if v}
