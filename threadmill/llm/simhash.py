"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text's 64-bit fingerprint takes the majority, bit by bit, of its shingles' XXH64 values.
Two fingerprints differ in at most ``2 r`` bits exactly if some 64-bit value lies within
``r`` bits of both. So every distinct fingerprint emits all variants within ``r`` bits (2,081
for r = 2), variants are brought together by value, and owners of one variant are linked.

The shuffle is factored so that it carries 79 rows for a fingerprint instead of 2,081: variants
travel by their 12 leading bits. A fingerprint is sent once to each bucket that some variant of
it falls into, and the variants of that bucket are written out after the shuffle. Buckets with
more fingerprints than ``SPLIT_ABOVE`` are dealt again by the next 12 bits, and so on to the last; one variant
has at most 2,081 owners, since fingerprints are distinct here. Copies meet before (one row for each
fingerprint), and a task that finds k owners of a variant writes k - 1 links, of which a
spanning forest of its bundle of buckets is kept. Links are checked by counting differing bits.

Classes are found by rounds of large-star and small-star steps on written tables; no link or
fingerprint reaches the driver, only the count of changed links does.

Defined results: a null or empty text, or one without words, has fingerprint zero and is linked
like any other; repeated rows and ties share a class; rows with a null id get a fingerprint and
the class of their group, and a class without any id has a null ``component_id``.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, realigned, written

#: Bits that deal variants out to buckets, on each level.
BUCKET_BITS = 12
#: Distinct fingerprints at home in a bucket beyond which the next level deals it again.
SPLIT_ABOVE = 4_000
#: Variants that a task writes out at a time; whole buckets, so one bucket may pass it.
BUNDLE = 1_000_000
#: Rows that a task gathers before it works on whole buckets of them.
GATHER = 50_000
#: Bytes of a text whose words are held at a time.
PIECE = 65_536

_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_pieces(text: str | None, words: int, seed: int = 42) -> Iterator[np.ndarray]:
    """XXH64 values of a text's lower-cased (A-Z) word shingles, repeats included, for about ``PIECE`` bytes at a time."""
    from xxhash import xxh64_intdigest as digest

    data = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
    held: list[bytes] = []
    at, none = 0, True
    while at < len(data):
        end = len(data)
        if end - at > PIECE and (gap := _SPACE.search(data, at + PIECE)):
            end = gap.start()
        held += data[at:end].split()
        at, n = end, len(held)
        if n >= words:
            joined = b" ".join(held)
            ends = list(itertools.accumulate(map(len, held), lambda a, b: a + b + 1))
            starts = [0, *(e + 1 for e in ends[: n - words])]
            yield np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1 :])], np.uint64)
            held, none = held[n - words + 1 :], False
    if held and none:
        yield np.array([digest(b" ".join(held), seed)], np.uint64)


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """Unsigned SimHash of a text's lower-cased (A-Z) word shingles."""
    counts, n = np.zeros(64, np.int64), 0
    for h in shingle_pieces(text, words, seed):
        counts += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        n += len(h)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(df: DataFrame, text: str = "text", key: str = "doc_id", words: int = 4, seed: int = 42) -> DataFrame:
    """``key`` and ``fp`` (the fingerprint's bits as a signed long) of every row."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, words, seed) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64), pa.int64())], [key, "fp"])

    return df.select(key, F.col(text).alias("_text")).mapInArrow(run, f"`{key}` {kind}, fp long")


@lru_cache(maxsize=64)
def masks(bits: int, radius: int, shift: int = 0) -> np.ndarray:
    """All words with at most ``radius`` of ``bits`` bits set, moved up by ``shift``."""
    out = [sum(1 << (shift + i) for i in c) for r in range(radius + 1) for c in itertools.combinations(range(bits), r)]
    return np.array(out, np.uint64)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _classes(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each of ``n`` numbers' class, where ``a`` and ``b`` are linked."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        np.minimum.at(label, before, label.copy())
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            return label


def _links_of(fp: np.ndarray, home: np.ndarray, fixed: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows that share a variant inside their bucket.

    ``fp`` is the fingerprint of each row, ``home`` the variant stem: the fingerprint with its
    ``fixed`` leading bits replaced by the bucket's. What is left of the radius is spent on the
    other bits.
    """
    spent = _popcount(fp ^ home)
    values, owners = [], []
    for r in range(radius + 1):
        at = np.flatnonzero(spent == radius - r)
        if len(at):
            m = masks(64 - fixed, r)
            values.append((home[at, None] ^ m[None, :]).ravel())
            owners.append(np.repeat(at.astype(np.int32), len(m)))
    if not values:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    value, owner = np.concatenate(values), np.concatenate(owners)
    ordered = np.sort(value)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(shared):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.searchsorted(shared, value)
    place[place == len(shared)] = 0
    hit = shared[place] == value
    place, owner = place[hit], owner[hit].astype(np.int64)
    order = np.lexsort((owner, place))
    place, owner = place[order], owner[order]
    first = np.concatenate([[True], place[1:] != place[:-1]])
    star = owner[np.flatnonzero(first)[np.cumsum(first) - 1]]
    pair = np.unique(np.stack([star, owner], 1)[star != owner], axis=0)
    return pair[:, 0], pair[:, 1]


def links(nodes: DataFrame, radius: int = 2, bits: int = BUCKET_BITS, split_above: int = SPLIT_ABOVE) -> DataFrame:
    """Links ``a``, ``b`` (values of ``node``) between fingerprints at most ``2 * radius`` bits apart.

    ``nodes``: distinct ``fp`` with a ``node`` each. The links connect what all pairs would.
    """
    far = 2 * radius
    sent, parts, fixed = nodes.select("fp", "node", F.lit(0).cast("long").alias("m")), [], 0
    while True:
        fixed += bits
        low = 64 - fixed
        more = []
        for r in range(radius + 1 if fixed > bits else 1):
            deal = F.array(*[F.lit(int(np.uint64(m).view(np.int64))) for m in masks(bits, radius - r, low).tolist()])
            more.append(sent.where(F.bit_count("m") == r).select("fp", "node", "m", F.explode(deal).alias("d")).select("fp", "node", F.col("m").bitwiseOR(F.col("d")).alias("m")))
        sent = more[0]
        for x in more[1:]:
            sent = sent.unionByName(x)
        sent = sent.withColumn("bucket", F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.col("m")), low))
        if low < bits:
            break
        # At most one row for every ``split_above`` fingerprints.
        hot = written(nodes.groupBy(F.shiftrightunsigned("fp", low).alias("bucket")).count().where(F.col("count") > split_above).select("bucket"), "hot-buckets")
        if not hot.head(1):
            break
        parts.append(sent.join(hot, "bucket", "left_anti").select("fp", "node", F.lit(fixed).alias("fixed"), "bucket"))
        sent = sent.join(hot, "bucket", "left_semi").select("fp", "node", "m")
    sent = sent.select("fp", "node", F.lit(fixed).alias("fixed"), "bucket")
    for x in parts:
        sent = sent.unionByName(x)

    def bundle(parts):
        fp, node, level, bucket = (np.concatenate(x) for x in zip(*parts))
        fp = fp.view(np.uint64)
        out = [(node[:0], node[:0])]
        for fixed in np.unique(level).tolist():
            at, low = np.flatnonzero(level == fixed), 64 - fixed
            home = (fp[at] & np.uint64((1 << low) - 1)) | (bucket[at].astype(np.uint64) << np.uint64(low))
            weight = np.array([len(masks(low, radius - r)) for r in range(radius + 1)])[_popcount(fp[at] ^ home)]
            for part in _bundles(bucket[at], weight):
                f, v = fp[at[part]], node[at[part]]
                i, j = _links_of(f, home[part], fixed, radius)
                near = _popcount(f[i] ^ f[j]) <= far
                label = _classes(len(f), i[near], j[near])
                child = np.flatnonzero((label != np.arange(len(f))) & (v[label] != v))
                out.append((v[label[child]], v[child]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["a", "b"])

    def run(batches):
        held, size = [], 0
        for t in batches:
            cols = [t.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if held and size >= GATHER:
                last = (held[-1][2][-1], held[-1][3][-1])
                change = np.flatnonzero((cols[2] != last[0]) | (cols[3] != last[1]))
                if len(change):
                    cut = change[0]
                    held.append([c[:cut] for c in cols])
                    yield bundle(held)
                    held, size, cols = [], 0, [c[cut:] for c in cols]
            if len(cols[0]):
                held.append(cols)
                size += len(cols[0])
        if held:
            yield bundle(held)

    dealt = sent.repartition("fixed", "bucket").sortWithinPartitions("fixed", "bucket")
    found = dealt.mapInArrow(run, "a long, b long")
    return found.distinct()


def _bundles(bucket: np.ndarray, weight: np.ndarray):
    """Slices of whole buckets (equal neighbours) with about BUNDLE variants each."""
    ends = np.append(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket))
    total = np.cumsum(weight)[ends - 1]
    at = done = 0
    while at < len(bucket):
        i = min(int(np.searchsorted(total, done + BUNDLE)), len(ends) - 1)
        yield slice(at, int(ends[i]))
        at, done = int(ends[i]), int(total[i])


def components(edges: DataFrame, rounds: int = 60, part_files: int | None = None) -> DataFrame:
    """``node`` and its class's least node as ``component``, for nodes of ``edges`` (a, b: longs).

    Alternates large-star and small-star steps until no link changes. Each round is written to
    the shared folder, so a lost executor repeats one round at most, in ``part_files`` at most if given.
    """
    def few(e: DataFrame) -> DataFrame:
        return e if part_files is None else e.coalesce(part_files)

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e if not large else e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # a: centre. Small star: e has a > b. Large star: both directions.
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("m"))
        joined = both.join(realigned(least, "a"), "a")
        if large:
            return joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        kept = joined.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return kept.unionByName(least.where(F.col("a") != F.col("m")).select("a", F.col("m").alias("b"))).distinct()

    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().transform(few), "links")
    for _ in range(rounds):
        n, children = e.agg(F.count("*"), F.count_distinct("a")).first()
        if n == children and not _chained(e):
            break
        before, e = e, written(few(star(star(e, True), False)), "links")
        discard(before)
    else:
        raise RuntimeError(f"components not found in {rounds} rounds")
    tops = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)


def _chained(e: DataFrame) -> bool:
    """Whether some node is both a parent and a child."""
    return bool(e.select(F.col("b").alias("a")).distinct().join(e.select("a"), "a", "left_semi").head(1))


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", words: int = 4, radius: int = 2) -> DataFrame:
    """One row per row of ``df``: ``key``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the least ``key`` (an integer) reachable by links of at most ``2 * radius`` bits.
    """
    prints = written(fingerprints(df, text, key, words).withColumn(key, F.col(key).cast("long")), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min(key).alias("node"))
    known = nodes.where("node is not null")
    classes = components(links(known, radius))
    of_print = nodes.join(classes, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    out = prints.join(realigned(of_print, "fp"), "fp", "left")
    return out.select(key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
