"""Fixed rules that put NULLs, repeats and bad values into the derived
transactions (the driver tables have none). Every row is kept; the rules only
change values or add copies, and each is written in SQL as well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TX_COLS = ["transaction_id", "customer_id", "transaction_amount", "transaction_type",
           "transaction_time", "transaction_location", "device_type",
           "previous_transactions_count", "is_fraud"]

# column -> id modulus that makes it NULL
NULL_RULES = {
    "transaction_amount": 9,        # ~11 %: over the 10 % limit
    "transaction_location": 4,      # 25 %
    "device_type": 13,              # ~7.7 %
    "transaction_type": 20,         # 5 %
}
REPEAT_EVERY = 7                    # these rows appear twice
ALL_NULL_EVERY = 101                # these ids add one all-NULL row
BAD_AMOUNT_EVERY = 97               # amount negated
BAD_DEVICE_EVERY = 89               # device 'smartwatch'
BAD_LABEL_EVERY = 83                # label 2
NULL_AMOUNT_EVERY = 79              # amount NULL
NULL_TIME_EVERY = 71                # time NULL


def idnum(col: str = "transaction_id") -> Column:
    return F.substring(F.col(col), 5, 30).cast("long")


def with_nulls(tx: DataFrame) -> DataFrame:
    i = idnum()
    cols = []
    for c in TX_COLS:
        if c in NULL_RULES:
            cols.append(F.when(i % NULL_RULES[c] == 0, F.lit(None)).otherwise(F.col(c))
                        .cast(tx.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(c))
    return tx.select(*cols)


def null_rules_sql() -> str:
    parts = []
    for c in TX_COLS:
        if c in NULL_RULES:
            parts.append(f"CASE WHEN CAST(substr(transaction_id, 5) AS BIGINT) % {NULL_RULES[c]} = 0 "
                         f"THEN NULL ELSE {c} END AS {c}")
        else:
            parts.append(c)
    return ", ".join(parts)


def with_repeats(tx: DataFrame) -> DataFrame:
    """Rows with id % 7 = 0 twice, plus one all-NULL row per id % 101 = 0."""
    i = idnum()
    base = tx.select(*TX_COLS)
    reps = base.filter(i % REPEAT_EVERY == 0)
    nulls = base.filter(i % ALL_NULL_EVERY == 0).select(
        *[F.lit(None).cast(base.schema[c].dataType).alias(c) for c in TX_COLS])
    return base.unionByName(reps).unionByName(nulls)


def repeats_sql(src: str = "tx") -> str:
    cols = ", ".join(TX_COLS)
    nulls = ", ".join(f"NULL AS {c}" for c in TX_COLS)
    return (f"SELECT {cols} FROM {src} UNION ALL "
            f"SELECT {cols} FROM {src} WHERE CAST(substr(transaction_id, 5) AS BIGINT) % {REPEAT_EVERY} = 0 "
            f"UNION ALL SELECT {nulls} FROM {src} "
            f"WHERE CAST(substr(transaction_id, 5) AS BIGINT) % {ALL_NULL_EVERY} = 0")


def with_bad_values(tx: DataFrame) -> DataFrame:
    i = idnum()
    return tx.select(
        "transaction_id", "customer_id",
        F.when(i % NULL_AMOUNT_EVERY == 0, F.lit(None).cast("double"))
         .when(i % BAD_AMOUNT_EVERY == 0, -F.col("transaction_amount"))
         .otherwise(F.col("transaction_amount")).alias("transaction_amount"),
        "transaction_type",
        F.when(i % NULL_TIME_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(F.date_format("transaction_time", "yyyy-MM-dd HH:mm:ss")).alias("transaction_time"),
        "transaction_location",
        F.when(i % BAD_DEVICE_EVERY == 0, F.lit("smartwatch")).otherwise(F.col("device_type"))
         .alias("device_type"),
        "previous_transactions_count",
        F.when(i % BAD_LABEL_EVERY == 0, F.lit(2)).otherwise(F.col("is_fraud")).cast("int")
         .alias("is_fraud"),
    )


def bad_values_sql(src: str = "tx") -> str:
    i = "CAST(substr(transaction_id, 5) AS BIGINT)"
    return f"""SELECT transaction_id, customer_id,
  CASE WHEN {i} % {NULL_AMOUNT_EVERY} = 0 THEN NULL
       WHEN {i} % {BAD_AMOUNT_EVERY} = 0 THEN -transaction_amount
       ELSE transaction_amount END AS transaction_amount,
  transaction_type,
  CASE WHEN {i} % {NULL_TIME_EVERY} = 0 THEN NULL
       ELSE strftime(transaction_time, '%Y-%m-%d %H:%M:%S') END AS transaction_time,
  transaction_location,
  CASE WHEN {i} % {BAD_DEVICE_EVERY} = 0 THEN 'smartwatch' ELSE device_type END AS device_type,
  previous_transactions_count,
  CAST(CASE WHEN {i} % {BAD_LABEL_EVERY} = 0 THEN 2 ELSE is_fraud END AS INTEGER) AS is_fraud
FROM {src}"""
