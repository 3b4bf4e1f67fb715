"""A corpus pipeline over the documents table: rules, line dedup, near-duplicates, benchmark passages, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import byte_bpe, decontamination, line_dedup, near_dedup, quality_rules
from pairloom.llm.common import read, stored

#: SQL can't express the first stage; tests compare every stage with a brute-force version instead
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest fitted on labelled documents."""
    rules = quality_rules.fit(docs, read(spark, sf_dir, "labels"))
    return quality_rules.keep_good(docs, rules)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without lines of recurring templates; n_chars follows the text."""
    out = line_dedup.without_recurring_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text again."""
    out = byte_bpe.encode_and_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                                     keep=["doc_id", "text"])
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                      (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near_duplicates),
          ("decontamination", benchmark_passages), ("byte_bpe", encoding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what each stage before it keeps is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
