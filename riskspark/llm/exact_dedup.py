"""Exact deduplication by a tree-merge of sorted digest runs (DataFrame only).

Every input partition forms one run: a row per distinct digest with its count
and the identifier that stays. Runs meet in rounds: run ``r`` of a round joins
run ``r div FAN`` of the next, and an aggregation per (run, digest) merges
them, until one run is left. A digest is verified at every level: rows merge
only where SHA-256, length and a second 64-bit hash agree. A group with a
third of all rows is one row per run after the first level, and its
documents are joined back per (run, digest), so no key gathers a group.

Null text counts as empty. Of rows equal in text and id exactly one stays.
Null ids rank below all others. Empty tables give empty results; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskspark.llm.textkit import reliable, unused

FAN = 8
KEY = ["digest", "length", "second"]


def digests(docs: DataFrame) -> DataFrame:
    t = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.col("doc_id").alias("doc_id"), t.alias("t")).select(
        "doc_id", F.unhex(F.sha2(F.col("t"), 256)).alias("digest"), F.octet_length("t").alias("length"),
        F.xxhash64("t").alias("second"), F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row"))
    return reliable(d)


def merge(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(first level: a row per run and digest, last level: a row per digest)."""
    best = F.max(F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "row")).alias("best")
    first = rows.groupBy("run", *KEY).agg(best, F.count(F.lit(1)).alias("n"))
    last = rows.agg(F.max("run").alias("m")).collect()[0]["m"] or 0
    level, width = first, last + 1
    while True:
        level = (level.withColumn("run", F.floor(F.col("run") / FAN))
                 .groupBy("run", *KEY).agg(F.max("best").alias("best"), F.sum("n").alias("n")))
        width = -(-width // FAN)
        if width <= 1:
            return first, level


def mark(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    rows = digests(docs)
    first, groups = merge(rows)
    groups = reliable(groups.filter("n > 1").select(*KEY, F.col("best").alias("keep"), F.col("n").alias("size")))
    per_run = reliable(first.select("run", *KEY).join(groups, KEY))
    out = rows.join(per_run, ["run", *KEY], "left")
    return out.select(
        "doc_id", F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep.row") == F.col("row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns."""
    m = mark(docs).groupBy("doc_id", "text_sha256").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("same"))
    keep = reliable(m.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"),
                             F.col("kept").alias("__kept"), F.col("same").alias("__same")))
    gone = keep.filter("not __kept").drop("__kept", "__same")
    sha = F.sha2(F.coalesce(docs["text"], F.lit("")), 256)
    name = unused(docs, "sha256")
    out = docs.withColumn(name, sha)
    out = out.join(gone, out["doc_id"].eqNullSafe(gone["__id"]) & (out[name] == gone["__sha"]), "left_anti")
    if keep.filter("__same > 1").head(1):     # rows equal in id and text: one of them
        out = out.dropDuplicates(["doc_id", name])
    return out.drop(name)


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""
