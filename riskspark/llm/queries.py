"""The registered queries of the operators, and SQL where it can say them."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.llm import (alignment, bpe_bytes, decontaminate, exact_dedup, language, licenses, ngram_join, pii, quality,
                           spelling, token_files, toxicity, warc)
from riskspark.llm.textkit import read_table, reliable

END_ID = 2


def rank_path():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_language(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op2_ngram_join(spark, sf_dir):
    return ngram_join.join(read_table(spark, sf_dir, "documents"))


def op3_decontaminate(spark, sf_dir):
    return decontaminate.matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.mark(read_table(spark, sf_dir, "documents"))


def op5_token_files(spark, sf_dir):
    import public_tokenizers
    docs = read_table(spark, sf_dir, "documents")
    return token_files.read_documents(token_files.write_documents(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID))


def op6_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op7_pii(spark, sf_dir):
    found = pii.find(read_table(spark, sf_dir, "documents"), reliable)
    base = pii.text_of(F.col("base"))
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in pii.BASE],
                        F.sha2(base, 256).alias("base_sha256"), pii.text_of(F.col("all")).alias("spans"))


def op8_licenses(spark, sf_dir):
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark, sf_dir):
    return bpe_bytes.digest_documents(read_table(spark, sf_dir, "documents"), *rank_path())


def op10_quality(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def op11_spelling(spark, sf_dir):
    return spelling.group(read_table(spark, sf_dir, "documents"))


def op12_warc(spark, sf_dir):
    return warc.read_pages(warc.write_pages(read_table(spark, sf_dir, "pages")))


def op13_alignment(spark, sf_dir):
    import public_tokenizers
    return alignment.align(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_language, op2_ngram_join, op3_decontaminate, op4_exact_dedup, op5_token_files,
                                   op6_toxicity, op7_pii, op8_licenses, op9_byte_bpe, op10_quality, op11_spelling, op12_warc,
                                   op13_alignment)}
ORACLES = {"op4_exact_dedup": exact_dedup.SQL.strip(), "op12_warc": warc.SQL.strip()}
