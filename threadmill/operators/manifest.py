"""Frozen split manifests: assignment, thread windows, integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hashing
from .materialize import ranked, shard_number

SCHEMES = {"canonical": hashing.hash_bucket_100, "spec": hashing.hash_bucket_spec}


def assign_splits(messages: DataFrame, existing: DataFrame | None = None, seed: int = 42, scheme: str = "canonical", cuts: tuple[int, int] = hashing.CUTS) -> DataFrame:
    """New manifest rows ``message_id``, ``thread_id``, ``split`` for messages the manifest lacks.

    A thread keeps the split of any row it already has; else its hash decides. Rows of the manifest
    never change: only messages without a row are returned. A null thread stands for itself.
    """
    messages = messages.select("message_id", "thread_id").distinct()
    bucket = SCHEMES[scheme](F.coalesce(F.col("thread_id"), F.col("message_id")), seed)
    if existing is None:
        return messages.select("message_id", "thread_id", hashing.split_of(bucket, cuts).alias("split"))
    new = messages.join(existing.select("message_id"), "message_id", "left_anti")
    old = existing.where("thread_id is not null").groupBy("thread_id").agg(F.min("split").alias("old"))
    return new.join(old, "thread_id", "left").select("message_id", "thread_id", F.coalesce("old", hashing.split_of(bucket, cuts)).alias("split"))


def append_manifest(existing: DataFrame, new: DataFrame) -> DataFrame:
    """The manifest after appending: old rows as they are, new ids only."""
    return existing.unionByName(new.join(existing.select("message_id"), "message_id", "left_anti"))


def _stride(size: int, overlap: int) -> int:
    if size < 1 or not 0 <= overlap < size:
        raise ValueError("window overlap must be smaller than the window size")
    return size - overlap


def thread_windows(messages: DataFrame, size: int, overlap: int) -> DataFrame:
    """Windows of each thread: ``thread_id``, ``window_id``, ``window_idx``, ``window_start``, ``window_end``.

    Ranges follow from the number of messages alone, so nothing is sorted.
    """
    step = _stride(size, overlap)
    n = messages.groupBy("thread_id").agg(F.count("*").alias("n"))
    at = n.select("thread_id", "n", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(step).cast("long"))).alias("window_idx", "window_start"))
    return at.select("thread_id", F.concat(F.col("thread_id"), F.lit("_window_"), F.col("window_idx").cast("string")).alias("window_id"), "window_idx", "window_start", F.least(F.col("window_start") + size, "n").alias("window_end"))


def _numbered(messages: DataFrame, order: str) -> DataFrame:
    """Messages with their 0-based place ``rn`` in the thread; nulls first, ties by id."""
    by = Window.partitionBy("thread_id").orderBy(F.col(order).asc_nulls_first(), "message_id")
    return messages.withColumn("rn", (F.row_number().over(by) - 1).cast("long"))


def window_members(messages: DataFrame, size: int, overlap: int, order: str = "pos") -> DataFrame:
    """Messages of each window: each message is sent to the windows that cover it, without a range join."""
    step = _stride(size, overlap)
    last = F.floor(F.col("rn") / step)
    first = F.greatest(F.ceil((F.col("rn") - (size - 1)) / F.lit(step)), F.lit(0))
    spread = _numbered(messages, order).select("thread_id", "message_id", "rn", F.explode(F.sequence(first, last)).alias("window_idx"))
    return spread.select("thread_id", F.concat(F.col("thread_id"), F.lit("_window_"), F.col("window_idx").cast("string")).alias("window_id"), F.col("window_idx").cast("int").alias("window_idx"), "message_id", "rn")


def message_windows(messages: DataFrame, size: int, overlap: int, order: str = "pos") -> DataFrame:
    """Each message's last covering window, named ``<thread>:w<i>``."""
    index = F.floor(F.col("rn") / _stride(size, overlap)).cast("int")
    return _numbered(messages, order).select("message_id", "thread_id", index.alias("window_idx"), F.concat(F.col("thread_id"), F.lit(":w"), index.cast("string")).alias("window_id"))


def quota_assign(threads: DataFrame, shares: tuple[float, float] = (0.8, 0.1), existing: DataFrame | None = None, seed: int = 42) -> DataFrame:
    """Threads in id order: train if their bucket is below 800 and train has room, else val below 900, else test.

    Quotas count threads, those of ``existing`` (``thread_id``, ``split``) included. Ranks inside the two
    bucket classes come from range-partitioned prefix counts, so no task sorts all threads.
    """
    threads = threads.select("thread_id").distinct()
    held = {"train": 0, "val": 0}
    if existing is not None:
        threads = threads.join(existing.select("thread_id"), "thread_id", "left_anti")
        held |= {r["split"]: r["n"] for r in existing.groupBy("split").agg(F.count_distinct("thread_id").alias("n")).collect()}
    total = threads.count() + (existing.select("thread_id").distinct().count() if existing is not None else 0)
    quota = [max(0, int(total * s) - held[k]) for s, k in zip(shares, ("train", "val"))]
    rows = threads.withColumn("bucket", hashing.hash_bucket_1000(F.col("thread_id"), seed))
    rows = ranked(rows.withColumn("low", F.col("bucket") < 800), ["low"], ["thread_id"], "r1").withColumn("train", F.col("low") & (F.col("r1") <= quota[0]))
    rows = ranked(rows.withColumn("mid", ~F.col("train") & (F.col("bucket") < 900)), ["mid"], ["thread_id"], "r2").withColumn("val", F.col("mid") & (F.col("r2") <= quota[1]))
    return rows.select("thread_id", F.col("bucket").cast("long").alias("bucket"), F.when(F.col("train"), "train").when(F.col("val"), "val").otherwise("test").alias("split"))


def window_coverage_gap(manifest: DataFrame, messages: DataFrame) -> DataFrame:
    """Threads whose frozen windows end before their messages do: ``thread_id``, ``covered``, ``n``, ``gap``."""
    ends = manifest.groupBy("thread_id").agg(F.max("window_end").alias("covered"))
    n = messages.groupBy("thread_id").agg(F.count("*").alias("n"))
    return n.join(ends, "thread_id", "left").select("thread_id", F.coalesce("covered", F.lit(0)).cast("long").alias("covered"), "n").withColumn("gap", F.col("n") - F.col("covered")).where("gap > 0")


def manifest_stats(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("split").agg(F.count("*").alias("n_rows"), F.count_distinct("thread_id").alias("n_threads"))


def thread_stats(messages: DataFrame) -> DataFrame:
    n = messages.groupBy("thread_id").agg(F.count("*").alias("n"))
    return n.agg(F.count("*").alias("threads"), F.max("n").alias("largest"))


def cohort_list(messages: DataFrame) -> DataFrame:
    return messages.groupBy("cohort").agg(F.count("*").alias("n"))


def ordered_cohorts(messages: DataFrame) -> DataFrame:
    """Distinct cohorts, rows without one left out, and their ``position`` in order."""
    return shard_number(messages.where("cohort is not null").select("cohort").distinct(), 1, ["cohort"]).drop("shard")


def thread_split_violations(manifest: DataFrame) -> DataFrame:
    """Threads in more than one split."""
    return manifest.groupBy("thread_id").agg(F.count_distinct("split").alias("n_splits")).where("n_splits > 1")


def split_overlap(manifest: DataFrame) -> DataFrame:
    """Ids that test shares with train or val."""
    test = manifest.where("split = 'test'").select("message_id")
    return test.intersect(manifest.where("split in ('train', 'val')").select("message_id"))


def manifest_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of a manifest that a later one changed or lost."""
    return before.exceptAll(after.select(*before.columns))
