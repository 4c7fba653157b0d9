"""Pseudonyms, data-subject requests and tombstones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .materialize import fresh


def vault(values: DataFrame, salt: str, column: str = "email") -> DataFrame:
    """Distinct ``pseudonym``, ``original`` of the non-empty values of a column."""
    v = F.col(column)
    return values.where(F.coalesce(v, F.lit("")) != "").select(text.pseudonymize(v, salt).alias("pseudonym"), v.alias("original")).distinct()


def email_vault(rows: DataFrame, salt: str, column: str = "text") -> DataFrame:
    """The vault of all addresses in a text column."""
    return vault(rows.select(F.explode(text.emails(F.col(column))).alias("email")), salt)


def pseudonymize_text(rows: DataFrame, salt: str, id_: str = "message_id", column: str = "text") -> DataFrame:
    """Rows with every address of the text replaced by its pseudonym.

    Pieces between addresses and the addresses' pseudonyms are zipped together again, so no row
    leaves its place and no vault is needed.
    """
    pieces = F.split(F.col(column), text.EMAIL)
    names = F.transform(text.emails(F.col(column)), lambda e: text.pseudonymize(e, salt))
    joined = F.aggregate(F.arrays_zip(pieces.alias("p"), names.alias("n")), F.lit(""), lambda s, x: F.concat(s, F.coalesce(x["p"], F.lit("")), F.coalesce(x["n"], F.lit(""))))
    return rows.withColumn(column, F.when(F.col(column).isNotNull(), joined))


def unpseudonymize(rows: DataFrame, kept: DataFrame, id_: str = "message_id", column: str = "text") -> DataFrame:
    """Rows with pseudonyms that the vault knows replaced by their originals."""
    names = F.array_distinct(F.regexp_extract_all(F.col(column), F.lit("(user_[0-9a-f]{12})"), F.lit(1)))
    of, known = fresh(rows, "_id"), fresh(rows, "_pairs")
    found = rows.select(F.col(id_).alias(of), F.explode(names).alias("pseudonym")).distinct().join(kept, "pseudonym")
    pairs = found.groupBy(of).agg(F.collect_list(F.struct("pseudonym", "original")).alias(known))
    both = rows.join(pairs, rows[id_] == F.col(of), "left")
    back = F.aggregate(F.coalesce(known, F.array().cast("array<struct<pseudonym: string, original: string>>")), F.col(column), lambda s, p: F.replace(s, p["pseudonym"], p["original"]))
    return both.withColumn(column, back).select(*rows.columns)


def leak_scan(rows: DataFrame, column: str = "text") -> DataFrame:
    """Rows that still hold an address, and how many."""
    n = F.size(text.emails(F.col(column)))
    return rows.withColumn("n_leaks", n).where("n_leaks > 0")


def dsr_locate(rows: DataFrame, subjects: DataFrame, salt: str, column: str = "text") -> DataFrame:
    """Rows that name a subject (``email``), in clear or by pseudonym: ``message_id``, ``thread_id``, ``email``.

    Addresses and pseudonyms are taken out of the texts and joined by value; texts are not compared
    with every subject.
    """
    names = F.array_distinct(F.concat(text.emails(F.col(column)), F.regexp_extract_all(F.coalesce(F.col(column), F.lit("")), F.lit("(user_[0-9a-f]{12})"), F.lit(1))))
    named = rows.select("message_id", "thread_id", F.explode(names).alias("_name"))
    email = F.col("email")
    wanted = subjects.select("email", F.explode(F.array(email, text.pseudonymize(email, salt))).alias("_name"))
    return named.join(wanted, "_name").select("message_id", "thread_id", "email").distinct()


def dsr_export(rows: DataFrame, located: DataFrame, kept: DataFrame) -> DataFrame:
    """All messages of the located threads, with originals."""
    own = rows.join(located.select("thread_id").distinct(), "thread_id", "left_semi")
    return unpseudonymize(own, kept).select(*rows.columns)


def dsr_delete(located: DataFrame, level: str = "thread", reason: str = "dsr", deleted_at: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Tombstones (``level``, ``id``, ``deleted_at``, ``reason``) for what was located; none for nothing."""
    id_ = F.col("thread_id" if level == "thread" else "message_id")
    return located.where(id_.isNotNull()).select(F.lit(level).alias("level"), id_.alias("id"), F.lit(deleted_at).alias("deleted_at"), F.lit(reason).alias("reason")).distinct()


def dsr_subject_scope(located: DataFrame, manifest: DataFrame) -> DataFrame:
    """How many located messages and threads each split holds."""
    both = located.select("message_id", "thread_id").distinct().join(manifest.select("message_id", "split"), "message_id", "left")
    return both.groupBy(F.coalesce("split", F.lit("none")).alias("split")).agg(F.count("*").alias("n_messages"), F.count_distinct("thread_id").alias("n_threads"))


def tombstone_count(tombstones: DataFrame) -> DataFrame:
    return tombstones.agg(F.count("*").alias("n"))


def tombstone_duplicates(tombstones: DataFrame) -> DataFrame:
    return tombstones.groupBy("level", "id").agg(F.count("*").alias("n")).where("n > 1")
