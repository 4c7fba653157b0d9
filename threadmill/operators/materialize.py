"""Materialising splits: routing, pins, exclusions, tombstones, shards."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def check_pin(pin: str) -> str:
    if not re.fullmatch(r"\d{4}-\d{2}(-\d{2})?", pin):
        raise ValueError(f"not a cohort: {pin}")
    return pin


def pin_filter(rows: DataFrame, pin: str, cohort: str = "cohort") -> DataFrame:
    """Rows up to a cohort; rows without one stay."""
    c = F.coalesce(F.col(cohort), F.lit(""))
    return rows.where((c == "") | (c <= check_pin(pin)))


def pinned_out(rows: DataFrame, pin: str, cohort: str = "cohort") -> DataFrame:
    return rows.where(F.col(cohort) > check_pin(pin))


def nil_cohort_count(rows: DataFrame, cohort: str = "cohort") -> DataFrame:
    return rows.agg(F.count_if(F.coalesce(F.col(cohort), F.lit("")) == "").alias("n_nil"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def exclude_anti(rows: DataFrame, excluded: DataFrame, *ids: str) -> DataFrame:
    """Rows whose first non-null id is not excluded; rows without any id stay."""
    key = F.coalesce(*[F.col(i) for i in ids])
    name = fresh(rows, "_gone")
    gone = excluded.select(F.col("id").alias(name)).where(F.col(name).isNotNull()).distinct()
    return rows.join(gone, key == F.col(name), "left_anti")


def tombstone_anti(rows: DataFrame, tombstones: DataFrame, message: str = "message_id", thread: str = "thread_id", chunk: str | None = None) -> DataFrame:
    """Rows that no tombstone names, on any level (``level``, ``id``); order columns stay as they are."""
    for level, col in (("message", message), ("thread", thread), ("chunk", chunk)):
        if col and col in rows.columns:
            name = fresh(rows, "_gone")
            gone = tombstones.where(F.col("level") == level).select(F.col("id").alias(name)).where(F.col(name).isNotNull()).distinct()
            rows = rows.join(gone, F.col(col) == F.col(name), "left_anti")
    return rows


def split_in(rows: DataFrame, *splits: str) -> DataFrame:
    """Rows of the given splits; ``validation`` means ``val``."""
    return rows.where(F.col("split").isin(["val" if s == "validation" else s for s in splits]))


def train_only(rows: DataFrame) -> DataFrame:
    return split_in(rows, "train")


def window_split_filter(rows: DataFrame, window: str, split: str) -> DataFrame:
    return rows.where((F.col("window_idx").cast("string") == window) & (F.col("split") == split))


def since_filter(rows: DataFrame, since: str, date: str = "ts") -> DataFrame:
    return rows.where(F.col(date) > F.lit(since).cast("timestamp"))


def thread_recency_filter(rows: DataFrame, since: str, date: str = "ts") -> DataFrame:
    """Rows of threads whose last activity is not before ``since``."""
    alive = rows.groupBy("thread_id").agg(F.max(date).alias("_last")).where(F.col("_last") >= F.lit(since).cast("timestamp")).select("thread_id")
    return rows.join(alive, "thread_id", "left_semi")


def last_active(rows: DataFrame, date: str = "ts") -> DataFrame:
    """Every row with its thread's latest time."""
    return rows.join(rows.groupBy("thread_id").agg(F.max(date).alias("last_active")), "thread_id")


def route(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """Records with the ``split`` the manifest gives them, or ``skipped``."""
    known = manifest.select("message_id", "split").dropDuplicates(["message_id"])
    return records.join(known, "message_id", "left").withColumn("split", F.coalesce("split", F.lit("skipped")))


def materialize_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("split").agg(F.count("*").alias("n"))


def train_semi(rows: DataFrame, ids: DataFrame) -> DataFrame:
    return rows.join(ids.select("message_id").distinct(), "message_id", "left_semi")


def past_train_anti(manifest: DataFrame, current: DataFrame) -> DataFrame:
    """Train ids that the current window lacks."""
    return train_only(manifest).select("message_id").join(current.select("message_id"), "message_id", "left_anti")


def length_join(ids: DataFrame, lengths: DataFrame) -> DataFrame:
    """Ids with their length; an id without one is an error."""
    both = ids.join(lengths.select("message_id", "length", F.lit(True).alias("_known")), "message_id", "left")
    missing = F.raise_error(F.concat(F.lit("no length for "), F.col("message_id")))
    return both.withColumn("length", F.when(F.col("_known"), F.col("length")).otherwise(missing.cast("long"))).drop("_known")


def shard_number(rows: DataFrame, size: int, order: list[str]) -> DataFrame:
    """Rows with their 1-based ``position`` in the order and 1-based ``shard`` of ``size`` rows.

    Positions are prefix counts over range partitions: each task sorts its own range only.
    """
    from ..session import written

    part, at, n, first, before = (fresh(rows, c) for c in ("_p", "_m", "_n", "_first", "_before"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id()})
    dealt = written(dealt, "ranges")
    sizes = dealt.groupBy(part).agg(F.count("*").alias(n), F.min(at).alias(first))
    # As many rows as there were tasks.
    sizes = sizes.withColumn(before, F.coalesce(F.sum(n).over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop(n)
    out = dealt.join(F.broadcast(sizes), part).withColumn("position", F.col(at) - F.col(first) + F.col(before) + 1)
    return out.withColumn("shard", F.floor((F.col("position") - 1) / size).cast("long") + 1).drop(part, at, first, before)


def sum_before(rows: DataFrame, size: Column, order: list[str], name: str) -> DataFrame:
    """Rows with the sum of ``size`` (whole numbers) over the rows before them in the order, as ``name``.

    Sums inside range partitions, then of whole partitions: each task sorts its own range only.
    """
    from ..session import written

    part, own, n, ranges = (fresh(rows, c) for c in ("_p", "_size", "_n", "_of_ranges"))
    dealt = written(rows.withColumn(own, size.cast("long")).repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranges")
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # As many rows as there were tasks.
    sums = dealt.groupBy(part).agg(F.sum(own).alias(n))
    before = sums.select(part, F.coalesce(F.sum(n).over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(ranges))
    summed = dealt.withColumn(name, F.coalesce(F.sum(own).over(inside), F.lit(0)))
    return summed.join(F.broadcast(before), part).withColumn(name, F.col(name) + F.col(ranges)).drop(part, own, ranges)


def ranked(rows: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """1-based rank ``name`` in each group, nulls of a group column being one group.

    Rows are numbered over range partitions of group and order, and a group's first number is taken off: a group
    that holds most rows is sorted by many tasks.
    """
    from ..session import written

    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_whole")
    of, by = [f"_g{i}" for i in range(len(groups))], [f"_o{i}" for i in range(len(order))]
    packed = rows.select(whole, *[F.col(c).alias(n) for c, n in zip([*groups, *order], [*of, *by])])
    numbered = written(shard_number(packed, 1, [*of, *by]), "numbered")
    starts = numbered.groupBy(*[F.col(g).alias(f"_of{g}") for g in of]).agg(F.min("position").alias("_start"))
    same = [F.col(g).eqNullSafe(F.col(f"_of{g}")) for g in of]
    return numbered.join(starts, same).select("_whole.*", (F.col("position") - F.col("_start") + 1).cast("int").alias(name))


def split_distribution(rows: DataFrame, pin: str) -> DataFrame:
    """Counts and percentages of the splits among rows up to the pin."""
    kept = pin_filter(rows, pin)
    total = F.count("*")

    def share(n: Column) -> Column:
        return F.when(total == 0, F.lit(0.0)).otherwise(F.round(n * 100.0 / total, 2))

    counts = {s: F.count_if(F.col("split") == s) for s in ("train", "val", "test")}
    return kept.agg(total.alias("total"), *[c.alias(f"n_{s}") for s, c in counts.items()], *[share(c).alias(f"pct_{s}") for s, c in counts.items()])


def exclusion_backlog(rows: DataFrame, excluded: DataFrame, pin: str) -> DataFrame:
    """Rows held back: pinned out, quarantined, both sums and the distinct number, and percentages."""
    gone = excluded.select(F.col("id").alias("_gone")).distinct()
    marked = rows.join(gone, F.col("message_id") == F.col("_gone"), "left").select(F.coalesce(F.col("cohort") > check_pin(pin), F.lit(False)).alias("p"), F.col("_gone").isNotNull().alias("q"))
    total = F.count("*")
    one = marked.agg(total.alias("total"), F.count_if("p").alias("pinned_out"), F.count_if(F.col("p") | F.col("q")).alias("distinct_rows"))
    listed = excluded.agg(F.count("*").alias("quarantined"))
    both = one.join(F.broadcast(listed))
    held = F.col("pinned_out") + F.col("quarantined")
    pct = F.when(F.col("total") == 0, F.lit(0.0)).otherwise(F.round(held * 100.0 / F.col("total"), 2))
    return both.select("total", "pinned_out", "quarantined", "distinct_rows", pct.alias("backlog_pct"))


def corpus_concat(*splits: DataFrame) -> DataFrame:
    out = splits[0]
    for s in splits[1:]:
        out = out.unionByName(s)
    return out


def consolidate_shards(rows: DataFrame, window: int) -> DataFrame:
    """Train rows of windows before ``window``."""
    return train_only(rows).where(F.col("window_idx") < window)
