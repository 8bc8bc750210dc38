"""The document pipeline: toxicity, exact dedup, n-gram Jaccard join,
benchmark decontamination, byte-level BPE. Each stage reads what its
predecessor kept, written as Parquet in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskspark.llm import bpe_bytes, decontaminate, exact_dedup, ngram_join, toxicity
from riskspark.llm.queries import rank_path
from riskspark.llm.textkit import read_table, written


def toxic(spark, docs, sf_dir) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def copies(spark, docs, sf_dir) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_copies(spark, docs, sf_dir) -> DataFrame:
    return ngram_join.keep_one(docs)


def benchmark(spark, docs, sf_dir) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark, docs, sf_dir) -> DataFrame:
    return bpe_bytes.digest_documents(docs, *rank_path())


STAGES = [("toxicity", toxic), ("exact_dedup", copies), ("ngram_join", near_copies),
          ("decontaminate", benchmark), ("byte_bpe", tokens)]
ORACLE_SQL = None     # toxicity and tokens are beyond SQL; tests/llm holds a brute-force version


def run(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
