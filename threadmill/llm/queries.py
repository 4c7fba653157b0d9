"""The ``opN_<name>`` queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontaminate, suffix, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import simhash

    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, radius=2)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"), least_bytes=0)


def op3_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_log(_table(spark, sf_dir, "conversations"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), threshold=0.3)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from . import tokencount

    return tokencount.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from . import bpe

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), size=10)
    return found.drop("items", "runs", "spans")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.deduplicate(_table(spark, sf_dir, "documents"), length=200).drop("kept")


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import media

    return media.media_columns(_table(spark, sf_dir, "documents")).drop("shard", "offset")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import html

    return html.main_text(_table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_warc": op2_warc,
    "op3_tool_calls": op3_tool_calls,
    "op4_toxicity": op4_toxicity,
    "op5_token_counts": op5_token_counts,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_decontaminate": op7_decontaminate,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_media": op9_media,
    "op10_html_text": op10_html_text,
}

#: DuckDB SQL of the queries that SQL can express on whole tables.
ORACLES: dict[str, str] = {"op2_warc": warc.SQL, "op3_tool_calls": chat.CHAT_LOG_SQL, "op7_decontaminate": decontaminate.SQL, "op8_suffix_dedup": suffix.SQL}
