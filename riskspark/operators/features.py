"""Feature engineering (F1-F5): one projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions import columns as C

ENGINEERED = [
    "log_transaction_amount", "transaction_year", "transaction_month", "transaction_day",
    "transaction_hour", "transaction_day_of_week", "amount_by_device",
]


def engineer(df: DataFrame, amount_col: str = "transaction_amount",
             time_col: str = "transaction_time", device_col: str = "device_type",
             strict_time: bool = True) -> DataFrame:
    """Add the seven engineered columns; the time column becomes a timestamp.

    A time string that does not parse raises (``strict_time``), as the
    reference's ``to_datetime`` does; ``strict_time=False`` gives NULL, for a
    quarantine path.
    """
    ttype = df.schema[time_col].dataType
    if isinstance(ttype, T.StringType):
        t = C.parse_time(time_col, strict=strict_time)
    else:
        t = F.col(time_col)
    out = df.withColumn(time_col, t)
    return out.withColumns({
        "log_transaction_amount": C.log_amount(amount_col),
        "transaction_year": C.year(time_col),
        "transaction_month": C.month(time_col),
        "transaction_day": C.day(time_col),
        "transaction_hour": C.hour(time_col),
        "transaction_day_of_week": C.day_of_week(time_col),
        "amount_by_device": C.amount_if_mobile(amount_col, device_col),
    })
