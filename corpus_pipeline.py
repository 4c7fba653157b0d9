"""A training-data pipeline over ``documents``: five stages, each a table that the next one reads.

Each stage takes ``(spark, docs, sf_dir)`` and works on every row that its predecessor kept. All but
the last return the columns of ``documents``; ``n_chars`` follows the text where a stage cuts it.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadmill.llm import bpe, decontaminate, simwide, suffix, toxicity
from threadmill.llm.storage import bounded_batches, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _bounded(stage: Stage) -> Stage:
    """The stage, with Arrow batches of few bytes."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


@_bounded
def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.keep_civil(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


@_bounded
def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group of near-duplicates (SimHash, five words, 0.8)."""
    return simwide.keep_one(docs.select(*COLUMNS), words=5, similarity=0.8)


@_bounded
def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 200 bytes that also start elsewhere; every row stays."""
    cut = suffix.keep_unique(docs.select(*COLUMNS), length=200)
    return cut.withColumn("n_chars", F.char_length("text").cast("long"))


@_bounded
def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of ten words of a benchmark item."""
    return decontaminate.keep_clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=10)


@_bounded
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``lang``, ``source``, token ``ids``, ``n_tokens`` and whether they decode to the text's bytes."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.encode_checked(docs, path, pattern, keep=("doc_id", "lang", "source"))


STAGES = [("toxicity", civil), ("simhash", distinct), ("suffix_array", unrepeated), ("decontamination", clean), ("byte_bpe", encoded)]

#: SQL expresses neither the classifier nor the tokenizer; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
