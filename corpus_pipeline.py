"""A training-corpus pipeline over ``documents``: five operators in a row.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame.  ``run`` writes
a stage's result as Parquet to the shared folder and reads it back as the next
one's documents, so a lost executor repeats one stage at most; a stage's input
is deleted when its result is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import decontaminate, quality, queries, simhash, suffix_dedup
from tillroll.llm.common import materialize, release, ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go."""
    ship(spark)
    return quality.quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship(spark)
    return simhash.keep_one(docs, width=3, max_bits=3)


def repeated_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Text of 200 bytes and more that occurs again goes from every document."""
    ship(spark)
    return suffix_dedup.remove_repeats(docs, depth=200)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left with its token ids, encoded and decoded again."""
    ship(spark)
    return queries.token_ids(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", repeated_text),
    ("benchmark_decontamination", benchmark),
    ("byte_level_bpe", token_ids),
]

#: SQL expresses none of the stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents of ``sf_dir``."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs, written = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if path:
            release(spark, path)
        path = written
    return docs
