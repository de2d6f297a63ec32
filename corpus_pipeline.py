"""The corpus pipeline: quality rules, near-dedup, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
reread as the next stage's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from provena.llm import decontaminate, near_dup, packing, pii, quality_rules
from provena.llm.common import documents, remove, scratch, shared_dir
from provena.llm.queries import word_tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules (repetition, compression bands) keep."""
    return quality_rules.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return near_dup.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def anonymous(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by [KIND]; n_chars follows."""
    return pii.redact(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: a row for each piece of a document with its ids and place."""
    return packing.pack(packing.tokenize(docs, word_tokenizer()))


STAGES: list[tuple[str, Stage]] = [("quality_rules", good), ("near_dedup", distinct), ("decontamination", clean), ("pii", anonymous), ("packing", packed)]

#: Near-dedup and tokenization have no SQL form; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again; only the last one's table stays there."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        with scratch():
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, f"{folder}/{before}")
        before = name
    return docs
