"""Streams that end where batches do: ingest into a frozen manifest, shard windows, KPIs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import manifest as m
from ..operators import sampling


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    schema = "message_id string, thread_id string, split string, batch long"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    exists = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    return spark.read.schema(schema).parquet(path) if exists else spark.createDataFrame([], schema)


def incremental_ingest(messages: DataFrame, manifest_path: str, checkpoint: str, seed: int = 42, trigger: dict | None = None) -> StreamingQuery:
    """Append splits of unseen ids for each micro-batch of a stream (``message_id``, ``thread_id``).

    A thread keeps its split however late its messages come, so nothing is dropped as late. A batch
    that is tried again finds its own rows written and replaces them: its folder is named by its number.
    """

    def batch(rows: DataFrame, n: int) -> None:
        spark = rows.sparkSession
        old = _manifest(spark, manifest_path).where(F.col("batch") != n).drop("batch")
        new = m.assign_splits(rows, old, seed)
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{manifest_path}/batch={n}")

    return messages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def watch_shards(spark: SparkSession, folder: str, schema: str, rebuild: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Call ``rebuild(all rows of the folder, batch)`` whenever new shard files have come.

    ``trigger={"processingTime": "60 seconds"}`` polls for ever; the default takes what is there and ends.
    """

    def batch(_: DataFrame, n: int) -> None:
        rows = spark.read.schema(schema).json(folder).withColumns({"path": F.col("_metadata.file_path"), "modified": F.col("_metadata.file_modification_time")})
        rebuild(rows, n)

    stream = spark.readStream.schema(schema).json(folder)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def shard_window(rows: DataFrame, n: int, id_: str = "message_id") -> DataFrame:
    """Rows of the newest ``n`` shards (``path``, ``modified``), each id once, the oldest shard's row first."""
    newest = sampling.last_n_shards(rows, n).select("path", F.col("modified").alias("_m"))
    kept = rows.join(F.broadcast(newest), "path", "left_semi")
    return sampling.pool_union_dedup(kept.withColumn("shard", F.struct("modified", "path")).withColumn("pos", F.monotonically_increasing_id()), id_=id_).drop("shard", "pos")


def scheduled_kpis(messages: DataFrame, compute: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``compute`` once over what has come since the last run (a scheduler starts it again)."""
    return messages.writeStream.foreachBatch(compute).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Events by type and time window of a stream or a batch; rows later than the watermark are out of a stream's result."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
