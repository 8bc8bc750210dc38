"""Cleaning (A1, A3, P1, P5-P8).

``clean`` follows the reference's order: validate, drop repeated rows, drop
all-null rows, normalise names, drop rows null in columns with more than 10 %
nulls (column by column, each seeing the smaller frame), clip the amount to
its own 1 % / 99 % quantiles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.functions.columns import clip
from riskspark.operators.quantile import exact_quantiles

MAX_NULL_PATTERNS = 100_000


def dedup(df: DataFrame) -> DataFrame:
    """A3: distinct rows over all columns. The aggregate is combined map-side,
    so a row repeated millions of times is collapsed before the shuffle."""
    return df.dropDuplicates()


def drop_all_null(df: DataFrame) -> DataFrame:
    """P5."""
    return df.na.drop(how="all")


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case and strip column names; two names that collide raise."""
    new = [c.lower().strip() for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"column names collide after normalising: {df.columns}")
    return df.toDF(*new)


def null_shares(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A1: share of NULL per column, all columns in one pass (one row)."""
    cols = columns or df.columns
    return df.select(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])


def null_pattern_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per NULL pattern (bit i set = column i is NULL)."""
    mask = reduce(lambda a, b: a + b,
                  [F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
                   for i, c in enumerate(columns)], F.lit(0).cast("long"))
    return df.groupBy(mask.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))


def sparse_null_columns(df: DataFrame, limit: float = S.NULL_SHARE_LIMIT,
                        columns: list[str] | None = None) -> list[str]:
    """P6 decision: the columns whose rows get dropped, in order.

    One aggregate gives the row count per NULL pattern (at most 2^columns
    rows, in practice a handful); the column-by-column sequence is replayed on
    that small table. Only with very many patterns does it fall back to one
    pass per column.
    """
    cols = list(columns or df.columns)
    if len(cols) <= 62:
        pats = null_pattern_counts(df, cols).limit(MAX_NULL_PATTERNS + 1).collect()
        if len(pats) <= MAX_NULL_PATTERNS:
            live = [(r["pattern"], r["n"]) for r in pats]
            dropped = []
            for i, c in enumerate(cols):
                total = sum(n for _, n in live)
                if total == 0:
                    break
                nulls = sum(n for p, n in live if p >> i & 1)
                if nulls / total > limit:
                    dropped.append(c)
                    live = [(p, n) for p, n in live if not p >> i & 1]
            return dropped
    dropped = []
    cur = df
    for c in cols:
        share = cur.select(F.avg(F.col(c).isNull().cast("double"))).first()[0]
        if share is not None and share > limit:
            dropped.append(c)
            cur = cur.filter(F.col(c).isNotNull())
    return dropped


def drop_sparse_nulls(df: DataFrame, limit: float = S.NULL_SHARE_LIMIT) -> tuple[DataFrame, list[str]]:
    """One filter for all the chosen columns."""
    dropped = sparse_null_columns(df, limit)
    return (df.na.drop(how="any", subset=dropped) if dropped else df), dropped


def clip_bounds_df(df: DataFrame, amount_col: str = "transaction_amount",
                   lower_q: float = S.CLIP_LOWER_Q, upper_q: float = S.CLIP_UPPER_Q) -> DataFrame:
    """One row (lower, upper), exact with linear interpolation."""
    return exact_quantiles(df, amount_col, [lower_q, upper_q], names=["lower", "upper"])


def clip_bounds(df: DataFrame, amount_col: str = "transaction_amount") -> dict:
    row = clip_bounds_df(df, amount_col).first()
    return {"lower": row["lower"], "upper": row["upper"]}


def apply_clip(df: DataFrame, bounds: dict | None, amount_col: str = "transaction_amount") -> DataFrame:
    """Clip with saved bounds; missing bounds mean (0, +inf). NULL stays NULL."""
    b = bounds or {"lower": 0.0, "upper": float("inf")}
    return df.withColumn(amount_col, clip(amount_col, b["lower"], b["upper"]))


def clean(df: DataFrame, amount_col: str = "transaction_amount", validate: bool = True,
          null_limit: float = S.NULL_SHARE_LIMIT) -> tuple[DataFrame, dict, list[str]]:
    """Training-time cleaning. Returns (frame, fitted bounds, null-dropped columns).

    Bounds are returned, not saved: only ``fit`` persists them (C6).
    """
    if validate:
        from riskspark.operators.validate import validate_raw
        validate_raw(df)
    out = drop_all_null(dedup(df))
    out = normalize_names(out)
    # The null-pattern pass, the quantile pass and the result all read the
    # deduplicated rows: write them once to the shared checkpoint folder
    # rather than repeat the full-width distinct shuffle three times.
    out = out.checkpoint(eager=True)
    out, dropped = drop_sparse_nulls(out, null_limit)
    bounds = clip_bounds(out, amount_col.lower().strip())
    out = apply_clip(out, bounds, amount_col.lower().strip())
    return out, bounds, dropped


def clean_for_scoring(df: DataFrame, bounds: dict | None,
                      amount_col: str = "transaction_amount") -> DataFrame:
    """Inference-time cleaning: names and the saved clip only."""
    return apply_clip(normalize_names(df), bounds, amount_col)
