"""Text of numbers and names."""
import random

from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.functions.columns import norm_name, percent_text, strip_model_prefix


def test_percent_text_is_the_format_of_the_binary_value(spark):
    rnd = random.Random(5)
    xs = [k / n for n in range(1, 60) for k in range(n + 1)] + [rnd.random() for _ in range(2000)] + [
        k / 10000 for k in range(0, 10001, 5)] + [0.0015, 0.0625, 0.999999, 1e-9, 3.14159, -0.25]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in df.select("x", percent_text(F.col("x"), 1).alias("a"), percent_text(F.col("x"), 2).alias("b")).collect():
        assert (r["a"], r["b"]) == (f"{r['x']:.1%}", f"{r['x']:.2%}"), r["x"]


def test_names(spark):
    r = spark.range(1).select(strip_model_prefix(F.lit(S.MODEL_PREFIX + "GBT")), norm_name(F.lit("  Amount "))).first()
    assert tuple(r) == ("GBT", "amount")
