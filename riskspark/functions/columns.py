"""Column expressions (scalar functions). All JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskspark import schemas as S


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def log_amount(amount="transaction_amount") -> Column:
    """ln(1 + amount)."""
    return F.log1p(_c(amount))


def parse_time(t="transaction_time", strict: bool = True) -> Column:
    """parse an ISO time; a bad value raises (``strict``) or gives NULL."""
    c = _c(t)
    return F.to_timestamp(c) if strict else F.try_to_timestamp(c)


def year(t) -> Column:
    return F.year(_c(t))


def month(t) -> Column:
    return F.month(_c(t))


def day(t) -> Column:
    return F.dayofmonth(_c(t))


def hour(t) -> Column:
    return F.hour(_c(t))


def day_of_week(t) -> Column:
    """Monday = 0 … Sunday = 6 (``weekday``, not ``dayofweek``)."""
    return F.weekday(_c(t))


def amount_if_mobile(amount="transaction_amount", device="device_type") -> Column:
    """amount when the device is mobile, else 0 (NULL device gives NULL)."""
    return _c(amount) * (_c(device) == F.lit(S.MOBILE)).cast("int")


def round_half_even(x, places: int = 4) -> Column:
    """Python's ``round``: ties go to the even digit."""
    return F.bround(_c(x), places)


def direction(v) -> Column:
    """sign label, zero is ``away_from_fraud``."""
    return F.when(_c(v) > 0, F.lit("toward_fraud")).otherwise(F.lit("away_from_fraud"))


def strip_model_prefix(name) -> Column:
    """F8: the reference removes the prefix wherever it occurs."""
    return F.replace(_c(name), F.lit(S.MODEL_PREFIX), F.lit(""))


def norm_name(x) -> Column:
    """F9 on values: lower-case and strip."""
    return F.lower(F.trim(_c(x)))


def percent_text(x, places: int = 1) -> Column:
    """``f"{x:.1%}"``: the exact binary value of ``100 * x`` rounded, ties to even.

    A double's fraction times 2^62 is a whole number wherever a tie can be, so
    the comparison with the half is exact (0.15 lies under its tie)."""
    y = _c(x).cast("double") * 100
    whole = F.floor(F.abs(y))
    unit = 1 << 62
    part = ((F.abs(y) - whole) * float(unit)).cast("bigint").cast("decimal(20,0)") * F.lit(10**places).cast("decimal(4,0)")
    low = F.floor(part / F.lit(unit).cast("decimal(20,0)")).cast("bigint")
    rest = part - low.cast("decimal(5,0)") * F.lit(unit).cast("decimal(20,0)")
    half = F.lit(unit // 2).cast("decimal(20,0)")
    up = (rest > half) | ((rest == half) & (low % 2 == 1))
    total = whole * 10**places + low + up.cast("bigint")
    digits = F.format_string(f"%s%d.%0{places}d%%", F.when(y < 0, "-").otherwise(""),
                             F.floor(total / 10**places), total % 10**places)
    return F.when(y.isNull(), F.format_string(f"%.{places}f%%", y)).otherwise(digits)


def yes_no(flag) -> Column:
    """Yes / No / Not measured from a nullable flag."""
    f = _c(flag)
    return (F.when(f.isNull(), F.lit("Not measured"))
            .when(f, F.lit("Yes")).otherwise(F.lit("No")))


def clip(x, lower, upper) -> Column:
    """Clip keeping NULL as NULL (``greatest(NULL, 1)`` is 1 in Spark)."""
    c = _c(x)
    lo = lower if isinstance(lower, Column) else F.lit(float(lower))
    hi = upper if isinstance(upper, Column) else F.lit(float(upper))
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.least(F.greatest(c, lo), hi))


def unit_hash(*cols, seed: int = S.SEED) -> Column:
    """A number in [0, 1) from the first 32 bits of md5(seed:cols).

    Stable under repartition and reproducible outside Spark (DuckDB has md5
    too), unlike ``rand`` or ``randomSplit``.
    """
    key = F.concat_ws(":", F.lit(str(seed)), *[_c(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
