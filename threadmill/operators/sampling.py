"""Samples and schedules. Seeded shuffles are orders by hash (``functions.hashing.order_key``).

Sequential allocations ("take until the sample is full") are prefix sums over groups, so only tables
of one row for each group are ordered. Sums and ranks come from range partitions (``materialize.sum_before``,
``materialize.ranked``), so that neither all groups nor one large group meet in a task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import hashing, text
from .materialize import ranked, shard_number, sum_before


def _clip(wanted: Column, left: Column) -> Column:
    return F.greatest(F.lit(0), F.least(wanted, left)).cast("long")


def _ceil_div(a: Column, b: Column) -> Column:
    return F.floor((a + b - 1) / b).cast("long")


def _ranked(rows: DataFrame, groups: list[str], seed: int | str, context: Column | str, id_: str, name: str, first: str | None = None) -> DataFrame:
    """Rows with their rank in a hash order inside each group, those where ``first`` is false before others."""
    keyed = rows.withColumn("_o", hashing.order_key(seed, context, F.col(id_)))
    return ranked(keyed, groups, [*([first] if first else []), "_o", id_], name).drop("_o")


def parse_ratio(ratio: str) -> tuple[int, int]:
    """Replay and new parts of ``"replay:new"``; anything but two whole numbers, the second above 0, is an error."""
    m = re.fullmatch(r"\s*(\d+)\s*:\s*(\d+)\s*", ratio)
    if not m or not int(m[2]):
        raise ValueError(f"not a replay:new ratio: {ratio!r}")
    return int(m[1]), int(m[2])


def bucket_caps_sample(rows: DataFrame, caps: dict[str, int], most: int, seed: int = 42, id_: str = "message_id") -> DataFrame:
    """Rows of each length bucket up to its cap, then ``most`` of all; ``position`` is the final order.

    Each bucket is ordered and limited on its own: tasks keep their best rows and send no others.
    """
    marked = rows.withColumn("bucket", text.length_bucket(F.col("length")))
    kept = None
    for bucket, cap in caps.items():
        of = marked.where(F.col("bucket") == bucket).withColumn("_o", hashing.order_key(seed, bucket, F.col(id_))).orderBy("_o", id_).limit(cap).drop("_o")
        kept = of if kept is None else kept.unionByName(of)
    final = (marked.limit(0) if kept is None else kept).withColumn("_o", hashing.order_key(seed, "global", F.col(id_)))
    return shard_number(final.orderBy("_o", id_).limit(most), 1, ["_o", id_]).drop("_o", "shard")


def bucket_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(text.length_bucket(F.col("length")).alias("bucket")).agg(F.count("*").alias("n"))


def sender_totals(rows: DataFrame) -> DataFrame:
    n = rows.groupBy("sender").agg(F.count("*").alias("n"))
    return n.join(F.broadcast(rows.agg(F.count("*").alias("total"))))


def replay_allocation(rows: DataFrame, n: int, least: int) -> DataFrame:
    """How many rows each (sender, thread) gives in both phases: ``take1``, ``take2``.

    Phase 1 takes up to ``least`` from each in order; phase 2 shares what is left by sender and
    then by thread, rounding up, until the sample is full.
    """
    groups = rows.groupBy("sender", "thread_id").agg(F.count("*").alias("size"))
    want = F.least(F.lit(least), F.col("size"))
    one = sum_before(groups, want, ["sender", "thread_id"], "_before").withColumn("take1", _clip(want, F.lit(n) - F.col("_before"))).drop("_before")
    by_sender = one.groupBy("sender").agg(F.sum("size").alias("of_sender"))
    totals = one.agg(F.sum("size").alias("total"), F.sum("take1").alias("taken"))
    left = F.lit(n) - F.col("taken")
    shared = one.join(by_sender, "sender").join(F.broadcast(totals))
    quota = _ceil_div(left * F.col("of_sender"), F.col("total"))
    shared = shared.withColumn("want2", F.when(left > 0, F.least(_ceil_div(quota * F.col("size"), F.col("of_sender")), F.col("size"))).otherwise(F.lit(0)))
    two = sum_before(shared, F.col("want2"), ["sender", "thread_id"], "_before").withColumn("take2", _clip(F.col("want2"), left - F.col("_before")))
    return two.select("sender", "thread_id", "size", "take1", "take2")


def replay_sample(rows: DataFrame, n: int, least: int, seed: int = 42, epoch: int = 0, id_: str = "message_id", mode: str = "dedup") -> DataFrame:
    """The sample with its ``phase``. ``mode``: ``dedup`` lets phase 2 take rows that phase 1 left
    (fewer rows where a thread runs out); ``reference`` lets it take any, so a row may come twice."""
    alloc = replay_allocation(rows, n, least)
    both = rows.join(alloc, ["sender", "thread_id"])
    keys = ["sender", "thread_id"]
    first = _ranked(both, keys, f"{seed}:{epoch}", "phase1", id_, "_r1")
    if mode == "reference":
        second = _ranked(both, keys, f"{seed}:{epoch}", "phase2", id_, "_r2").where(F.col("_r2") <= F.col("take2"))
    else:
        second = first.where((F.col("_r1") > F.col("take1")) & (F.col("_r1") <= F.col("take1") + F.col("take2")))
    out = first.where(F.col("_r1") <= F.col("take1")).select(*rows.columns, F.lit(1).alias("phase"))
    return out.unionByName(second.select(*rows.columns, F.lit(2).alias("phase")))


def interleave_schedule(new: DataFrame, replay: DataFrame, batch: int, new_parts: int, replay_parts: int, seed: int = 42, epoch: int = 0) -> DataFrame:
    """New rows (``id``, ``pos`` from 0) and for each chunk of them its share of replay rows, in a hash order.

    Each chunk draws its replay rows in an order of its own; ``replay`` has ``id``. Chunks are dealt
    the first rows of that order, so a chunk needs no more than its share.
    """
    size = batch * new_parts
    chunks = new.groupBy(F.floor(F.col("pos") / size).cast("long").alias("chunk")).agg(F.count("*").alias("n"))
    chunks = chunks.select("chunk", _ceil_div(F.col("n") * batch * replay_parts, F.lit(size)).alias("share"))
    # Replay rows in one order; chunk k takes the next run of it, wrapping round.
    numbered = shard_number(replay.select("id", hashing.order_key(f"{seed}:{epoch}", "replay", F.col("id")).alias("_o")), 1, ["_o", "id"]).select("id", (F.col("position") - 1).alias("at"))
    total = F.broadcast(numbered.agg(F.count("*").alias("total")))
    starts = sum_before(chunks, F.col("share"), ["chunk"], "start").join(total).where("share > 0 and total > 0")
    wanted = starts.select("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("share") - 1)).alias("i"), "start", "total").select("chunk", F.pmod(F.col("start") + F.col("i"), F.col("total")).alias("at"), "i")
    drawn = wanted.join(numbered, "at").select("chunk", "id", F.lit("replay").alias("part"), F.col("i").alias("place"))
    fresh = new.select(F.floor(F.col("pos") / size).cast("long").alias("chunk"), "id", F.lit("new").alias("part"), F.pmod("pos", F.lit(size)).cast("long").alias("place"))
    rows = fresh.unionByName(drawn)
    return rows.withColumn("order_key", hashing.order_key(f"{seed}:{epoch}", "interleave", F.concat_ws("/", "part", "chunk", "place", "id")))


def stratified_downsample(rows: DataFrame, target: int, per_sender: int, per_thread: int, seed: int = 42, id_: str = "message_id", mode: str = "clamped") -> DataFrame:
    """At most ``target`` rows: minima for each sender, then each thread, then shares by sender.

    ``mode``: ``reference`` lets the last stage overshoot by rounding up, ``clamped`` does not.
    """
    rows = rows.withColumns({"sender": F.coalesce("sender", F.lit("unknown")), "thread_id": F.coalesce("thread_id", F.lit("unknown"))})
    n = rows.count()
    if n <= target:
        return rows.withColumn("stage", F.lit(0))
    ranked = _ranked(rows, ["sender"], seed, "sender", id_, "_rs")
    senders = rows.groupBy("sender").agg(F.count("*").alias("size"))
    want = F.least(F.lit(per_sender), F.col("size"))
    senders = sum_before(senders, want, ["sender"], "_before").withColumn("t1", _clip(want, F.lit(target) - F.col("_before")))
    one = ranked.join(senders.select("sender", "t1"), "sender").withColumn("s1", F.col("_rs") <= F.col("t1")).drop("t1", "_rs")
    taken = senders.agg(F.sum("t1")).first()[0]
    two = _ranked(one, ["thread_id"], seed, "thread", id_, "_rt", "s1")
    threads = one.groupBy("thread_id").agg(F.count("*").alias("size"), F.count_if(~F.col("s1")).alias("free"))
    want = F.least(F.lit(per_thread), F.col("free"))
    threads = sum_before(threads, want, ["thread_id"], "_before").withColumn("t2", _clip(want, F.lit(target - taken) - F.col("_before")))
    two = two.join(threads.select("thread_id", "t2"), "thread_id").withColumn("s2", ~F.col("s1") & (F.col("_rt") <= F.col("t2"))).drop("t2", "_rt")
    taken += threads.agg(F.sum("t2")).first()[0]
    left = target - taken
    picked = F.col("s1") | F.col("s2")
    three = _ranked(two.withColumn("_picked", picked), ["sender"], seed, "fill", id_, "_rf", "_picked")
    avail = two.groupBy("sender").agg(F.count_if(~picked).alias("avail"))
    total = F.broadcast(avail.agg(F.sum("avail").alias("total")))
    avail = avail.where("avail > 0").join(total).withColumn("want", F.least(_ceil_div(F.col("avail") * left, F.col("total")), F.col("avail")))
    avail, before = sum_before(avail, F.col("want"), ["sender"], "_before"), F.col("_before")
    take = F.when(before < left, F.col("want")).otherwise(F.lit(0)) if mode == "reference" else _clip(F.col("want"), F.lit(left) - before)
    avail = avail.withColumn("t3", take if left > 0 else F.lit(0))
    three = three.join(avail.select("sender", "t3"), "sender", "left").withColumn("s3", ~picked & (F.col("_rf") <= F.coalesce("t3", F.lit(0))))
    stage = F.when(F.col("s1"), 1).when(F.col("s2"), 2).when(F.col("s3"), 3)
    return three.withColumn("stage", stage).where("stage is not null").select(*rows.columns, "stage")


def round_robin_strata(rows: DataFrame, seed: int = 42, id_: str = "message_id") -> DataFrame:
    """``round`` of each row in its stratum (sender and thread), and ``position`` by round, then stratum."""
    ranked = _ranked(rows.withColumn("stratum", F.concat_ws(":", F.coalesce("sender", F.lit("")), F.coalesce("thread_id", F.lit("")))), ["stratum"], seed, "stratify", id_, "round")
    return shard_number(ranked, 1, ["round", "stratum", id_]).drop("shard")


def batches(rows: DataFrame, size: int, order: list[str]) -> DataFrame:
    """``position`` (from 1) and ``batch`` (from 0) of each row."""
    return shard_number(rows, size, order).withColumn("batch", F.col("shard") - 1).drop("shard")


def batch_shuffle(rows: DataFrame, seed: int = 42, epoch: int = 0, id_: str = "message_id") -> DataFrame:
    """Each batch's rows in a hash order: ``place`` from 1. A batch is small by definition."""
    by = Window.partitionBy("batch").orderBy(hashing.order_key(f"{seed}:{epoch}", F.concat(F.lit("batch:"), F.col("batch").cast("string")), F.col(id_)), id_)
    return rows.withColumn("place", F.row_number().over(by))


def query_sample(rows: DataFrame, n: int, seed: int = 42, id_: str = "message_id") -> DataFrame:
    """``n`` rows, the first in a hash order."""
    return rows.withColumn("_o", hashing.order_key(seed, "queries", F.col(id_))).orderBy("_o", id_).limit(n).drop("_o")


def union_train_ids(new: DataFrame, replay: DataFrame) -> DataFrame:
    """Distinct ids (``id``, ``pos``) of new rows, then replay rows, each at its first place."""
    both = new.select("id", F.struct(F.lit(0).alias("part"), F.col("pos")).alias("_at")).unionByName(replay.select("id", F.struct(F.lit(1).alias("part"), F.col("pos")).alias("_at")))
    return both.groupBy("id").agg(F.min("_at").alias("_at")).select("id", F.col("_at.part").alias("part"), F.col("_at.pos").alias("pos"))


def pool_union_dedup(rows: DataFrame, shard: str = "shard", pos: str = "pos", id_: str = "message_id") -> DataFrame:
    """The first row of each id over shards from old to new; rows without an id count as one."""
    whole = F.struct(F.col(shard), F.col(pos), *[F.col(c) for c in rows.columns if c not in (shard, pos)])
    return rows.groupBy(F.col(id_).alias("_id")).agg(F.min(whole).alias("_row")).select("_row.*").select(*rows.columns)


def last_n_shards(shards: DataFrame, n: int, modified: str = "modified", path: str = "path") -> DataFrame:
    """The newest ``n`` of distinct shards."""
    return shards.select(modified, path).distinct().orderBy(F.col(modified).desc(), F.col(path).desc()).limit(n)


def pool_stats(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("n_rows"), F.count_distinct("sender").alias("senders"), F.count_distinct("thread_id").alias("threads"))
