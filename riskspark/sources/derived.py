"""Transaction, prediction and feedback tables derived from the driver's
``events`` table.

The driver data has no transaction table; this is the mapping (one row per
event, ``k`` is the integer in ``props``):

- transaction_id = 'txn_' || event_id, customer_id = 'cust_' || user_id
- amount = value, type = event_type, time = ts
- location = LOCATIONS[k % 7], device = DEVICE_TYPES[k % 4]
- previous_transactions_count = earlier events of the same user
  (ordered by ts, event_id)
- is_fraud = 1 when event_type = 'error' and k < 50

Predictions come from a fixed rule score; feedback arrives for three events
in ten, a few of them twice. Every rule is plain arithmetic so the same table
can be written in SQL for the oracle.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark import schemas as S
from riskspark.operators.ordered import ordered_scan
from riskspark.session import partitions_for_size, shared_path
from riskspark.sources.sinks import path_exists, write_once

# ---------------------------------------------------------------------------
# Fixed rule values of the derived tables
# ---------------------------------------------------------------------------
FRAUD_EVENT = "error"
FRAUD_K_BELOW = 50
RULE_MODEL_NAME = "fraud-RuleScore"
RULE_MODEL_VERSION = "1"
FEEDBACK_EVERY = 10          # event_id % 10 < 3 gets feedback
FEEDBACK_SHARE = 3
REPEAT_FEEDBACK_EVERY = 50   # event_id % 50 = 0 gets a second, later row
REPEAT_FEEDBACK_DAYS = 10
# Three rule scorers used as competing "models" (weights on error flag, k, amount).
RULE_SCORERS = {
    "rule_a": (40, 37, 23),
    "rule_b": (30, 41, 29),
    "rule_c": (45, 31, 19),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def rule_score(weights=RULE_SCORERS["rule_a"], event_type="event_type", k=None,
               value="value") -> Column:
    """Integer rule score / 100: ties on purpose, reproducible in any engine."""
    w_err, k_mod, v_mod = weights
    kk = k if k is not None else _k()
    s = (F.when(F.col(event_type) == FRAUD_EVENT, F.lit(w_err)).otherwise(F.lit(0))
         + kk % k_mod + F.floor(F.col(value)).cast("bigint") % v_mod)
    return s.cast("double") / F.lit(100.0)


def transactions_from_events(events: DataFrame) -> DataFrame:
    """The raw transactions table (not yet cleaned)."""
    k = _k()
    base = events.select(
        F.concat(F.lit("txn_"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.concat(F.lit("cust_"), F.col("user_id").cast("string")).alias("customer_id"),
        F.col("value").alias("transaction_amount"),
        F.col("event_type").alias("transaction_type"),
        F.col("ts").alias("transaction_time"),
        _pick(S.LOCATIONS, k % len(S.LOCATIONS)).alias("transaction_location"),
        _pick(S.DEVICE_TYPES, k % len(S.DEVICE_TYPES)).alias("device_type"),
        F.when((F.col("event_type") == FRAUD_EVENT) & (k < FRAUD_K_BELOW), 1).otherwise(0)
         .cast("int").alias("is_fraud"),
        "user_id", "event_id", "ts",
    )
    # Per-user history without sending a whole user to one task.
    ranked = ordered_scan(base, ["user_id"], ["ts", "event_id"], count_as="_rn")
    return ranked.select(
        "transaction_id", "customer_id", "transaction_amount", "transaction_type",
        "transaction_time", "transaction_location", "device_type",
        (F.col("_rn") - 1).cast("int").alias("previous_transactions_count"),
        "is_fraud",
    )


def predictions_from_events(events: DataFrame, weights=RULE_SCORERS["rule_a"],
                            model_name: str = RULE_MODEL_NAME,
                            model_version: str = RULE_MODEL_VERSION) -> DataFrame:
    score = rule_score(weights)
    return events.select(
        F.concat(F.lit("txn_"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.when(score > 0.5, 1).otherwise(0).cast("int").alias("predicted_label"),
        score.alias("confidence_score"),
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        F.col("ts").alias("predicted_at"),
    )


def feedback_from_events(events: DataFrame) -> DataFrame:
    k = _k()
    label = F.when((F.col("event_type") == FRAUD_EVENT) & (k < FRAUD_K_BELOW), 1).otherwise(0).cast("int")
    tid = F.concat(F.lit("txn_"), F.col("event_id").cast("string"))
    first = events.filter(F.col("event_id") % FEEDBACK_EVERY < FEEDBACK_SHARE).select(
        tid.alias("transaction_id"), label.alias("actual_label"),
        _pick(S.FEEDBACK_SOURCES, k % len(S.FEEDBACK_SOURCES)).alias("source"),
        (F.col("ts") + F.make_dt_interval(days=(k % 7 + 1).cast("int"))).alias("confirmed_at"),
    )
    again = events.filter(F.col("event_id") % REPEAT_FEEDBACK_EVERY == 0).select(
        tid.alias("transaction_id"), label.alias("actual_label"),
        F.lit("manual_review").alias("source"),
        (F.col("ts") + F.make_dt_interval(days=F.lit(REPEAT_FEEDBACK_DAYS))).alias("confirmed_at"),
    )
    return first.unionByName(again)


class Workspace:
    """The tables of one data directory.

    ``transactions`` is built once per data directory and kept as Parquet in
    the shared checkpoint folder (sorted by time, so time filters skip files
    and row groups); later queries read it like the stored table it stands
    for.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @property
    def events(self) -> DataFrame:
        return self.table("events")

    def _fingerprint(self) -> str:
        src = f"{self.sf_dir}/events.parquet"
        try:
            st = os.stat(src)
            tag = f"{os.path.abspath(src)}|{st.st_size}|{int(st.st_mtime)}"
        except OSError:
            tag = src
        return hashlib.md5(tag.encode()).hexdigest()[:16]

    def transactions(self, materialize: bool = True) -> DataFrame:
        if not materialize:
            return transactions_from_events(self.events)
        root = self.spark.conf.get("riskspark.tables.root", None)
        path = (f"{root.rstrip('/')}/{self._fingerprint()}/transactions" if root else
                shared_path(self.spark, "riskspark_tables", self._fingerprint(), "transactions"))
        if path_exists(self.spark, f"{path}/_SUCCESS"):
            return self.spark.read.parquet(path)      # deriving again would shuffle every event
        df = transactions_from_events(self.events)
        # one derived row per event: size the files from the events scan
        # (bytes on disk), not from a fixed count that 100 TB would overfill
        n = partitions_for_size(self.events)
        return write_once(df.repartitionByRange(n, "transaction_time", "transaction_id"),
                          path, sort_within=["transaction_time", "transaction_id"])

    def predictions(self) -> DataFrame:
        return predictions_from_events(self.events)

    def feedback(self) -> DataFrame:
        return feedback_from_events(self.events)


def scored_events(events: DataFrame, scorers: dict | None = None) -> DataFrame:
    """Long table ``(model, transaction_id, label, score, pred)``: every rule
    scorer applied to every event (the label is the transactions' is_fraud)."""
    scorers = scorers or {"rule_a": RULE_SCORERS["rule_a"]}
    k = _k()
    label = F.when((F.col("event_type") == FRAUD_EVENT) & (k < FRAUD_K_BELOW), 1).otherwise(0)
    parts = []
    for name, w in scorers.items():
        s = rule_score(w)
        parts.append(events.select(
            F.lit(name).alias("model"),
            F.concat(F.lit("txn_"), F.col("event_id").cast("string")).alias("transaction_id"),
            F.col("ts").alias("scored_at"),
            label.cast("int").alias("label"), s.alias("score"),
            F.when(s > 0.5, 1).otherwise(0).cast("int").alias("pred")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
