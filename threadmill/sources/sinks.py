"""Sinks: sharded and single JSON, split materialisation, manifests, reports, tombstones, vaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.materialize import shard_number


def write_sharded_jsonl(rows: DataFrame, path: str, size: int, order: list[str] | None = None) -> None:
    """JSON lines in folders ``part=NNNNN`` of ``size`` rows in order, or files of at most ``size`` rows without one."""
    if not order:
        rows.write.option("maxRecordsPerFile", size).mode("errorifexists").json(path)
        return
    numbered = shard_number(rows, size, order).withColumn("part", F.lpad(F.col("shard").cast("string"), 5, "0")).drop("shard")
    numbered.repartition("part").sortWithinPartitions("part", "position").drop("position").write.partitionBy("part").mode("errorifexists").json(path)


def write_json_single(rows: DataFrame, path: str, most: int = 1_000_000) -> None:
    """One JSON array in one file, for results of at most ``most`` rows (checked)."""
    if rows.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} rows; write shards")
    rows.coalesce(1).agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value")).coalesce(1).write.mode("errorifexists").text(path)


def materialize_write(routed: DataFrame, path: str, shard_rows: int = 1_000_000, dry_run: bool = False) -> DataFrame:
    """Routed records as gzipped JSON by split, in files of at most ``shard_rows``; nothing is overwritten.

    Returns the counts by split; a dry run writes nothing.
    """
    counts = routed.groupBy("split").agg(F.count("*").alias("n"))
    if not dry_run:
        routed.where("split <> 'skipped'").write.partitionBy("split").option("compression", "gzip").option("maxRecordsPerFile", shard_rows).mode("errorifexists").json(path)
    return counts


def append_manifest(new: DataFrame, path: str) -> None:
    """New manifest rows beside the old ones, which are not touched."""
    new.write.mode("append").parquet(path)


def write_ids(ids: DataFrame, path: str, as_json: bool = False, most: int = 1_000_000) -> None:
    """Ids one a line, or as one JSON array of at most ``most`` ids (checked)."""
    if as_json:
        if ids.limit(most + 1).count() > most:
            raise ValueError(f"more than {most} ids; write lines")
        ids.agg(F.to_json(F.array_sort(F.collect_list("id"))).alias("value")).coalesce(1).write.mode("errorifexists").text(path)
    else:
        ids.select("id").write.mode("errorifexists").text(path)


def write_report(summary: DataFrame, path: str, fail_over: float | None = None) -> None:
    """A one-row summary as JSON; over ``fail_over`` percent contamination is an error after writing."""
    summary.select(F.to_json(F.struct(*summary.columns)).alias("value")).coalesce(1).write.mode("errorifexists").text(path)
    if fail_over is not None and (pct := summary.first()["contamination_pct"]) > fail_over:
        raise RuntimeError(f"contamination of {pct} % exceeds {fail_over} %")


def write_tombstones(tombstones: DataFrame, path: str) -> None:
    tombstones.write.mode("append").json(path)


def write_run_manifest(ids: DataFrame, path: str, seed: int, window: int) -> None:
    """An audit row: number of ids, a digest of them, seed and window."""
    digest = F.sum(F.xxhash64("id").cast("decimal(38,0)"))
    ids.agg(F.count("*").alias("n_ids"), digest.alias("ids_digest")).select("*", F.lit(seed).alias("seed"), F.lit(window).alias("window")).write.mode("append").json(path)


def vault_store(vault: DataFrame, path: str, key: str) -> None:
    """The vault with originals encrypted (AES-GCM); ``key`` has 16, 24 or 32 bytes."""
    vault.select("pseudonym", F.base64(F.aes_encrypt("original", F.lit(key))).alias("original")).write.mode("append").parquet(path)


def vault_load(spark, path: str, key: str) -> DataFrame:
    return spark.read.parquet(path).select("pseudonym", F.aes_decrypt(F.unbase64("original"), F.lit(key)).cast("string").alias("original")).distinct()
