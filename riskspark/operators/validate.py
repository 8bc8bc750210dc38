"""Rule-based validation (V1-V4), lazy: every failure is collected in one
pass, then the caller raises.

A rule set is data: ``Rule(column, check, ok, nullable, required)``. Each row
gets an array of the checks it fails; exploding that array gives the
failure-case table ``(row_key, column, check, failure_case)``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.session import checkpoint_dir


@dataclass(frozen=True)
class Rule:
    column: str
    check: str                      # label, e.g. "greater_than(0)"
    ok: Callable[[Column], Column] | None    # of the coerced value: True when it passes
    nullable: bool = False
    required: bool = True
    cast: str | None = None         # coercion target; a failed cast is a failure


class SchemaValidationError(ValueError):
    def __init__(self, message: str, failures: list | None = None):
        super().__init__(message)
        self.failures = failures or []


def _in_range(lo, hi) -> Callable[[Column], Column]:
    return lambda v: (v >= lo) & (v <= hi)


# Fixed rule sets of the reference (raw and engineered frames).
def raw_rules() -> list[Rule]:
    return [
        Rule("transaction_amount", "greater_than(0)", lambda v: v > 0, cast="double"),
        Rule("transaction_time", "dtype('str')", None, cast="string"),
        Rule("device_type", f"isin({S.DEVICE_TYPES})", lambda v: v.isin(S.DEVICE_TYPES),
             cast="string"),
        Rule("is_fraud", "isin([0, 1])", lambda v: v.isin(S.LABEL_VALUES), required=False,
             cast="int"),
    ]


def engineered_rules() -> list[Rule]:
    return [
        Rule("log_transaction_amount", "greater_than_or_equal_to(0)",
             lambda v: v >= 0, cast="double"),
        Rule("transaction_year", "dtype('int64')", None, cast="int"),
        Rule("transaction_month", "in_range(1, 12)", _in_range(1, 12), cast="int"),
        Rule("transaction_day", "in_range(1, 31)", _in_range(1, 31), cast="int"),
        Rule("transaction_hour", "in_range(0, 23)", _in_range(0, 23), cast="int"),
        Rule("transaction_day_of_week", "in_range(0, 6)", _in_range(0, 6),
             cast="int"),
        Rule("amount_by_device", "dtype('float64')", None, cast="double"),
    ]


def missing_columns(df: DataFrame, rules: list[Rule]) -> list[str]:
    """V4: required columns absent from the frame (a driver-side schema check)."""
    have = set(df.columns)
    return [r.column for r in rules if r.required and r.column not in have]


def failure_cases(df: DataFrame, rules: list[Rule], row_key: str | None = None) -> DataFrame:
    """V3: one row per failed (row, check): ``row_key, column, check, failure_case``.

    A value is coerced first (F10) and judged as what it became: text that is
    no number is a failed coercion and nothing else, never an error. Checks on
    absent optional columns are skipped; absent required columns are reported
    by ``missing_columns``.
    """
    have = set(df.columns)
    cases = []
    for r in rules:
        if r.column not in have:
            continue
        raw = F.col(r.column)
        sval = raw.cast("string")
        coerced = raw.try_cast(r.cast) if r.cast else raw
        if r.cast:
            bad_cast = raw.isNotNull() & coerced.isNull()
            cases.append(F.when(bad_cast, F.struct(F.lit(r.column).alias("column"),
                                                   F.lit(f"coerce_dtype('{r.cast}')").alias("check"),
                                                   sval.alias("failure_case"))))
        if not r.nullable:
            cases.append(F.when(raw.isNull(), F.struct(F.lit(r.column).alias("column"),
                                                       F.lit("not_nullable").alias("check"),
                                                       F.lit(None).cast("string").alias("failure_case"))))
        if r.ok is not None:
            cases.append(F.when(coerced.isNotNull() & ~F.coalesce(r.ok(coerced), F.lit(False)),
                                F.struct(F.lit(r.column).alias("column"),
                                         F.lit(r.check).alias("check"),
                                         sval.alias("failure_case"))))
    if not cases:
        return df.sparkSession.createDataFrame([], "row_key string, column string, check string, "
                                                   "failure_case string")
    key = F.col(row_key).cast("string") if row_key else F.monotonically_increasing_id().cast("string")
    arr = F.filter(F.array(*cases), lambda x: x.isNotNull())
    return (df.select(key.alias("row_key"), F.explode(arr).alias("f"))
              .select("row_key", "f.column", "f.check", "f.failure_case"))


def validate(df: DataFrame, rules: list[Rule], row_key: str | None = None,
             max_report: int = 100) -> DataFrame:
    """Raise with every failure kind and its count. ``failure_frame`` of the
    error is the DataFrame of all cases; ``max_report`` of them are shown. The
    cases are found in one pass and kept in the shared checkpoint folder."""
    missing = missing_columns(df, rules)
    if missing:
        raise SchemaValidationError(f"column(s) {missing} not in dataframe", missing)
    checkpoint_dir(df.sparkSession)
    fc = failure_cases(df, rules, row_key).checkpoint(eager=True)
    sample = fc.limit(max_report).collect()
    if sample:
        summary = (fc.groupBy("column", "check").agg(F.count(F.lit(1)).alias("n"))
                   .orderBy("column", "check").collect())
        kinds = ", ".join(f"{r['column']}:{r['check']} x{r['n']}" for r in summary)
        error = SchemaValidationError(f"schema validation failed: {kinds}",
                                      [r.asDict() for r in sample])
        error.failure_frame = fc
        raise error
    return df


def validate_raw(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise SchemaValidationError("empty frame: nothing to validate")
    return validate(df, raw_rules(), "transaction_id" if "transaction_id" in df.columns else None)


def validate_engineered(df: DataFrame) -> DataFrame:
    return validate(df, engineered_rules(),
                    "transaction_id" if "transaction_id" in df.columns else None)
