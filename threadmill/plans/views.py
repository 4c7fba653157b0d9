"""The logical tables of the curation pipeline over the driver's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The same views as DuckDB common table expressions.
MSG = "msg as (select concat(conv_id, '-', turn) as message_id, cast(conv_id as varchar) as thread_id, role as sender, turn as pos, text from conversations)"
ORD = "ord as (select cast(o_orderkey as varchar) as message_id, cast(o_custkey as varchar) as thread_id, o_orderpriority as sender, o_orderdate as ts, strftime(o_orderdate, '%Y-%m') as cohort from orders)"
DOC = "doc as (select cast(doc_id as varchar) as message_id, cast(doc_id as varchar) as thread_id, source as sender, n_chars as length, text from documents)"
EVT = "evt as (select cast(event_id as varchar) as message_id, cast(user_id as varchar) as thread_id, event_type as sender, ts, strftime(ts, '%Y-%m-%d') as shard, event_id as pos, value from events)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def msg(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.select(F.concat_ws("-", "conv_id", "turn").alias("message_id"), F.col("conv_id").cast("string").alias("thread_id"), F.col("role").alias("sender"), F.col("turn").alias("pos"), "text")


def ord(spark: SparkSession, sf_dir: str) -> DataFrame:  # noqa: A001
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("message_id"), F.col("o_custkey").cast("string").alias("thread_id"), F.col("o_orderpriority").alias("sender"), F.col("o_orderdate").alias("ts"), F.date_format("o_orderdate", "yyyy-MM").alias("cohort"))


def doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id").cast("string")
    return d.select(i.alias("message_id"), i.alias("thread_id"), F.col("source").alias("sender"), F.col("n_chars").alias("length"), "text")


def evt(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").cast("string").alias("message_id"), F.col("user_id").cast("string").alias("thread_id"), F.col("event_type").alias("sender"), "ts", F.date_format("ts", "yyyy-MM-dd").alias("shard"), F.col("event_id").alias("pos"), "value")


def bucket_100(expr: str, seed: int | str = 42) -> str:
    """DuckDB expression of ``hash_bucket_100``."""
    digest, value = f"sha256('{seed}:' || {expr})", "0"
    for i in range(8):
        value = f"(({value}) * 96 + ('0x' || substr({digest}, {1 + 8 * i}, 8))::bigint) % 100"
    return f"({value})"


def split_case(bucket: str) -> str:
    return f"case when {bucket} < 80 then 'train' when {bucket} < 90 then 'val' else 'test' end"


def order_key(seed: str, context: str, id_: str) -> str:
    """DuckDB expression of ``functions.hashing.order_key``; ``context`` and ``id_`` are expressions."""
    return f"sha256(concat_ws(':', '{seed}', {context}, {id_}))"
