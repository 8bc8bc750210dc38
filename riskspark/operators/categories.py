"""One-hot encoding with any number of categories (M3).

The dictionary is a table: each category of each column with its rank in the
order of the values, counted across slices (``ordered_scan``), so no task and
no driver holds the categories of a column. Rows meet it in a join per
(column, value) and come out as sparse vectors; a category with a third of
all rows is split by Spark's skew join, a small dictionary is broadcast by its
measured size. An unseen or NULL value has no position (all zeros).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.ordered import ordered_scan
from riskspark.session import checkpoint_dir


def dictionary(train: DataFrame, columns: list[str]) -> DataFrame:
    """column, value, position: the categories of each column in order of their
    values, the columns one behind the other in the order given. Kept as a
    checkpoint in the shared folder."""
    checkpoint_dir(train.sparkSession)
    # the column's place goes first, so one running count numbers all columns
    place = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))])
    long = (train.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "value")
            .filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    long = long.withColumn("place", place[F.col("column")])
    ranked = ordered_scan(long, [], ["place", "value"], count_as="rank")
    return ranked.select("column", "value", (F.col("rank") - 1).alias("position"), "n").checkpoint(eager=True)


def size(categories: DataFrame) -> int:
    """Length of the vectors."""
    return categories.count()


def positions(df: DataFrame, categories: DataFrame, columns: list[str], key: str) -> DataFrame:
    """key, positions: the sorted positions of the ones of each row's vector.
    Rows are known by ``key``; rows that share one share a vector."""
    long = (df.select(key, *[F.col(c).cast("string").alias(f"_{c}") for c in columns])
            .select(key, F.expr(f"stack({len(columns)}, {', '.join(f'{c!r}, `_{c}`' for c in columns)})").alias("column", "value")))
    found = long.join(categories.select("column", "value", "position"), ["column", "value"], "left")
    return found.groupBy(key).agg(F.array_sort(F.collect_set("position")).alias("positions"))


def encode(df: DataFrame, categories: DataFrame, columns: list[str], key: str) -> DataFrame:
    """key, size, indices, values: each row's sparse 0/1 vector in the form
    Spark ML stores one, built without Python."""
    n = size(categories)
    p = positions(df, categories, columns, key)
    return p.select(key, F.lit(n).cast("long").alias("size"), F.col("positions").alias("indices"),
                    F.transform("positions", lambda _: F.lit(1.0)).alias("values"))
