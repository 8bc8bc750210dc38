"""Running counts, running sums and previous-row values within ordered keys,
without moving a whole key (or the whole table) into one task.

A plain ``Window.partitionBy(key).orderBy(...)`` sends every row of a key to
one task, and a window without ``partitionBy`` sends the whole table to one
task. Here instead:

1. ``repartitionByRange(P, *keys, *order)``: rows are cut into P ordered
   slices of similar size; a hot key spans several slices. The slice number is
   written with the row (checkpoint in the shared folder), so every later read
   sees the same slices, after a lost executor and without exchange reuse.
2. Windows over (slice, key) give slice-local running values: a group is at
   most a slice.
3. An aggregate over (slice, key) gives each segment's totals and last values.
   Only a key that goes on in the next slice needs them: slices are ordered by
   key, so these are at most one a slice.
4. A window over those rows gives the totals of a key's earlier slices; at
   most P rows, which are broadcast and added to the local values.

The order columns must make rows unique within a key for the result to be
deterministic (add a tie-breaker column).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.session import checkpoint_dir, estimated_bytes

_SLICE, _LC = "_os_slice", "_os_lc"


SLICE_BYTES = 256 << 20
MIN_SLICES = 8


def slice_count(df: DataFrame) -> int:
    """Slices for ``df``: about ``riskspark.slice.bytes`` (256 MB) each by the
    optimizer's size estimate, at most ``spark.sql.shuffle.partitions`` and at
    least 8 (no action is run to decide)."""
    spark = df.sparkSession
    default = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    target = int(spark.conf.get("riskspark.slice.bytes", str(SLICE_BYTES)))
    size = estimated_bytes(df)
    if size is None:                  # no estimate: use the configured count
        return default
    need = -(-size // max(target, 1))
    return max(min(MIN_SLICES, default), min(default, need))


def ordered_scan(df: DataFrame, keys: list[str], order: list[Column | str], *,
                 count_as: str | None = None,
                 sums: dict[str, str] | None = None,
                 lags: dict[str, str] | None = None,
                 num_partitions: int | None = None) -> DataFrame:
    """Running values within ``keys`` in ``order`` (inclusive of the row).

    - ``count_as``: running row number (1-based)
    - ``sums``: ``{out: col}`` running sum of ``col`` (nulls count as 0)
    - ``lags``: ``{out: col}`` value of ``col`` on the previous row of the key;
      needs an order of column names (ascending)
    """
    sums, lags = dict(sums or {}), dict(lags or {})
    if lags and not all(isinstance(o, str) for o in order):
        raise ValueError("previous-row values need an order of column names")
    p = num_partitions or slice_count(df)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    checkpoint_dir(df.sparkSession)
    sliced = (df.repartitionByRange(p, *[F.col(k).asc_nulls_first() for k in keys], *order_cols)
              .withColumn(_SLICE, F.spark_partition_id()).checkpoint(eager=True))

    here = Window.partitionBy(_SLICE, *keys).orderBy(*order_cols)
    upto = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def number(c):
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0))

    data = sliced.withColumns({_LC: F.row_number().over(here).cast("long"),
                               **{"_os_s_" + o: F.sum(number(c)).over(upto) for o, c in sums.items()},
                               **{"_os_l_" + o: F.lag(c).over(here) for o, c in lags.items()}})

    totals = [F.count(F.lit(1)).alias("_os_n"), *[F.sum(number(c)).alias("_os_t_" + o) for o, c in sums.items()],
              *[F.max_by(F.struct(c), F.struct(*order)).getField(c).alias("_os_e_" + o) for o, c in lags.items()]]
    edges = sliced.groupBy(_SLICE, *keys).agg(*totals)
    w = Window.partitionBy(*keys).orderBy(_SLICE) if keys else Window.orderBy(_SLICE)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    offsets = edges.select(
        F.col(_SLICE).alias("_os_slice_"), *[F.col(k).alias("_os_k_" + k) for k in keys],
        F.sum("_os_n").over(before).alias("_os_off"),
        *[F.sum("_os_t_" + o).over(before).alias("_os_off_" + o) for o in sums],
        *[F.lag("_os_e_" + o).over(w).alias("_os_prev_" + o) for o in lags]).filter("_os_off > 0")

    cond = data[_SLICE] == offsets["_os_slice_"]
    for k in keys:
        cond = cond & data[k].eqNullSafe(offsets["_os_k_" + k])
    j = data.join(F.broadcast(offsets), cond, "left")       # at most a row a slice
    cols = [F.col(f"`{c}`") for c in df.columns]
    if count_as:
        cols.append((F.col(_LC) + F.coalesce("_os_off", F.lit(0))).alias(count_as))
    for o in sums:
        cols.append((F.col("_os_s_" + o) + F.coalesce("_os_off_" + o, F.lit(0.0))).alias(o))
    for o in lags:
        # the first row of a segment takes the last value of the key's earlier segment
        first = (F.col(_LC) == 1) & F.col("_os_off").isNotNull()
        cols.append(F.when(first, F.col("_os_prev_" + o)).otherwise(F.col("_os_l_" + o)).alias(o))
    return j.select(*cols)
