"""Hash functions that splits, pseudonyms and orders rest on, as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Percentages up to which a bucket is train, then val; the rest is test.
CUTS = (80, 90)


def sha256(*parts: Column | str | int) -> Column:
    """Hex SHA-256 of the parts joined by colons (nulls are left out)."""
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.sha2(F.concat_ws(":", *[c.cast("string") for c in cols]), 256)


def hex_mod(digest: Column, modulus: int) -> Column:
    """A 256-bit hex number modulo a small number, eight digits at a time."""
    step = pow(16, 8, modulus)
    value = F.lit(0).cast("long")
    for i in range(8):
        value = (value * step + F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long")) % modulus
    return value


def hash_bucket_100(thread: Column, seed: int | str, separator: str = ":") -> Column:
    """Canonical bucket 0..99: the whole SHA-256 of ``seed:thread`` modulo 100."""
    return hex_mod(F.sha2(F.concat(F.lit(f"{seed}{separator}"), thread.cast("string")), 256), 100)


def hash_bucket_spec(thread: Column, seed: int | str) -> Column:
    """The bucket by ``thread-seed``."""
    return hex_mod(F.sha2(F.concat(thread.cast("string"), F.lit(f"-{seed}")), 256), 100)


def hash_bucket_1000(thread: Column, seed: int | str) -> Column:
    """Bucket 0..999: the first eight digits of the SHA-256 of ``seed:thread``."""
    return F.conv(F.substring(sha256(seed, thread), 1, 8), 16, 10).cast("long") % 1000


def split_of(bucket: Column, cuts: tuple[int, int] = CUTS) -> Column:
    return F.when(bucket < cuts[0], "train").when(bucket < cuts[1], "val").otherwise("test")


def seed_int(seed: int | str, epoch: int | str, context: Column | str, bits: int = 32) -> Column:
    """SHA-256 of ``seed:epoch:context`` modulo 2 ** bits (32 at most)."""
    return F.conv(F.substring(sha256(seed, epoch, context), 57, 8), 16, 10).cast("long") % (1 << bits)


def order_key(seed: int | str, context: Column | str, id_: Column) -> Column:
    """What replaces seeded shuffles: rows in the order of a hash of seed, context and id."""
    return sha256(seed, context, id_)


def token_hash(token: Column) -> Column:
    """Low 64 bits of a token's SHA-256, as a signed long with the same bits."""
    return F.conv(F.substring(F.sha2(token, 256), 49, 16), 16, -10).cast("long")


def simhash64(tokens: DataFrame, key: str = "row_id", token: str = "token") -> DataFrame:
    """``key`` and ``simhash``: the sign of the sum of +1/-1 of each token's hash bits, by occurrence.

    ``tokens`` has a row for each token; rows with a null token only name a key, and a key without
    tokens has fingerprint 0. Tokens that one row was exploded to are added up before the shuffle.
    """
    hashed = tokens.select(key, F.col(token).isNotNull().cast("int").alias("n"), F.coalesce(token_hash(F.col(token)), F.lit(0)).alias("h"))
    sums = hashed.groupBy(key).agg(F.sum("n").alias("n"), *[F.sum(F.getbit("h", F.lit(i)).cast("int")).alias(f"s{i}") for i in range(64)])
    value = F.lit(0).cast("long")
    for i in range(64):
        value = value.bitwiseOR(F.when(F.col(f"s{i}") * 2 > F.col("n"), F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return sums.select(key, value.alias("simhash"))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
