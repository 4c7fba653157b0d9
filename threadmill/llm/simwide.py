"""SimHash near-duplicates at a given shingle similarity, by ball hashing in several tables.

Texts of Jaccard similarity 0.8 differ in 15 % of SimHash bits, too many for one ball: 64 bits
would have to be searched up to 10 apart. So a wide fingerprint (``WIDE`` bits) is made, and
``TABLES`` parts of it, ``PART`` bits each, are searched for neighbours at most 4 bits apart by
meet-in-the-middle ball hashing: each part emits all variants within 2 bits, variants meet in a
shuffle, and colliding pairs that are close in the other 192 bits are decided by the exact Jaccard
similarity of their shingle sets (64-bit hashes). A pair of similarity 0.8 meets in
one of the tables with a probability of 0.96 (its copies add to that), a random pair of
part values with one of 1e-6.

The shuffle is factored as in ``simhash``: variants travel by their leading bits, and the rest is
written out after it. The number of leading bits follows the number of fingerprints, so that a bucket
stays a few tens of thousands. Equal sets are one node. Each owner of a variant is paired with the one that
shares most variants with others (an original among its edited copies), never all with all. A first pass over one
table joins most of a dense group; the pass over all tables leaves out pairs of one class. Rows carry 192 bits
more, by which most false pairs are known at once.

These passes find most classes cheaply but may miss links, so a last pass leaves nothing to chance
(``remaining``): sets of similarity t share a shingle in their prefixes, the first n - ceil(t n) + 1
shingles in one order of all. All pairs of different classes that meet in such a shingle are decided exactly; those of
one class need not be. Before a pair is made, the tallies of its sets (how many shingles have each value of six hash
bits) tell how many shingles they cannot share; that leaves out no pair. Nor does it that a pair is made at its first
common shingle only, as far as the first ``FIRST`` of both sets tell: sets much alike have one of those in common. Frequent shingles come last in the order, which keeps their meetings few. A shingle that
more than ``CROWD`` sets meet in is dealt out in blocks, so that no task holds all its sets.

One pass over the texts keeps fingerprints, prefixes and a digest of each set. Sets themselves are made again from
the texts of those rows alone that some pair asks for.

Defined results: as in ``simhash``; texts without words share one class; a text of fewer words than
a shingle is one shingle.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .simhash import BUNDLE, GATHER, _bundles, _popcount, components, masks, shingle_pieces
from .storage import discard, hold, realigned, shuffles_deleted, written
from .storage import part_files as _part_files

#: Bits of the fingerprint that pairs are checked on, in words of 64.
WIDE = 512
#: Tables, and bits of the part of the fingerprint that each searches.
TABLES = 8
PART = 36
#: Bits that each side of a pair may differ from a shared variant.
RADIUS = 2
#: Fingerprints at home in a bucket, about.
HOME = 16_000
#: Deviations of the number of differing bits that pairs of the SimHash passes are given before they are checked
#: exactly; the exact search takes the rest.
SLACK = 1.0
#: Sets in the sample of frequent shingles, how many of them hold one that counts as frequent, and the most that are known.
SAMPLE = 20_000
OFTEN = 20
FREQUENT = 50_000
#: Rows whose shingle sets a task works on at a time.
SLICE = 500
#: Sets that meet in one shingle in one task, at most (two blocks of half as many), and hash values by which crowds are sought.
CROWD = 40_000
SPOTS = 1 << 20
#: Rows of a part file of tables of two longs a row, and their part files at least.
LINK_ROWS = 100_000
LINK_FILES = 4
#: Words of a set's tally, sixteen counts of four bits each, and the first of the hash bits that name a count.
TALLY = 4
TALLY_BIT = 20
#: First shingles of a set that travel with each of its prefix, and pairs that a task holds before it hands them on.
FIRST = 4
HELD = 500_000

#: Eight lanes of one byte for the eight bits of a byte, first bit in the first lane.
_LANES = np.array([sum(((b >> (7 - i)) & 1) << (8 * i) for i in range(8)) for b in range(256)], np.uint64)


def _words_of_hash(h: np.ndarray, n: int) -> np.ndarray:
    """``n`` independent 64-bit words for each hash, by a splitting mixer."""
    x = h[:, None] + np.arange(1, n + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, words: int, seed: int = 42) -> np.ndarray:
    """Distinct XXH64 values of a text's lower-cased (A-Z) word shingles."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_pieces(text, words, seed)]))


def wide_fingerprint(text: str | None, words: int = 5) -> np.ndarray:
    """``WIDE`` bits as words of 64: the majority of the distinct shingles' bits."""
    return wide_of(shingle_hashes(text, words))


def _ascending(h: np.ndarray) -> np.ndarray:
    """Hashes in the order of signed longs."""
    return np.sort(h.view(np.int64)).view(np.uint64)


def wide_of(h: np.ndarray) -> np.ndarray:
    """The fingerprint of distinct shingle hashes."""
    if not len(h):
        return np.zeros(WIDE // 64, np.uint64)
    counts = np.zeros(WIDE, np.uint32)
    for at in range(0, len(h), 4_096):
        x = _words_of_hash(h[at : at + 4_096], WIDE // 64)
        lanes = _LANES[x.byteswap().view(np.uint8)]
        sums = np.add.reduceat(lanes, np.arange(0, len(x), 255), axis=0)
        counts += sums.view(np.uint8).reshape(len(sums), WIDE).sum(axis=0, dtype=np.uint32)
    return np.packbits(counts * 2 > len(h)).view(">u8").astype(np.uint64)


def parts_of(wide: np.ndarray) -> np.ndarray:
    """The ``TABLES`` parts of fingerprints (rows of words), each in the low ``PART`` bits."""
    bits = np.unpackbits(wide.astype(">u8").view(np.uint8).reshape(len(wide), -1), axis=1)[:, : TABLES * PART].reshape(-1, TABLES, PART)
    padded = np.zeros((len(wide), TABLES, 64), np.uint8)
    padded[:, :, 64 - PART :] = bits
    return np.packbits(padded, axis=2).view(">u8").astype(np.uint64).reshape(len(wide), TABLES)


def most_bits(similarity: float, bits: int, slack: float = SLACK) -> int:
    """Differing bits of ``bits`` that pairs of this Jaccard similarity have at most, up to ``slack`` deviations."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.floor(bits * p + slack * math.sqrt(bits * p * (1 - p)))


def _pairs(value: np.ndarray, owner: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of owners of equal values: each with the one of them that shares most values with others.

    ``known``: each owner's class so far; pairs inside one are left out.
    """
    ordered = np.sort(value)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(shared):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.searchsorted(shared, value)
    place[place == len(shared)] = 0
    hit = shared[place] == value
    place, owner = place[hit], owner[hit].astype(np.int64)
    busy = np.bincount(owner, np.bincount(place)[place])
    by = np.lexsort((owner, -busy[owner], place))
    place, owner = place[by], owner[by]
    first = np.concatenate([[True], place[1:] != place[:-1]])
    star = owner[np.flatnonzero(first)[np.cumsum(first) - 1]]
    pair = np.sort(np.stack([star, owner], 1)[known[star] != known[owner]], axis=1)
    pair = np.unique(pair, axis=0)
    return pair[:, 0], pair[:, 1]


def _variants(home: np.ndarray, spent: np.ndarray, rows: np.ndarray, low_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Variants in the low bits with what is left of the radius, and the row that owns each."""
    values, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
    for r in range(RADIUS + 1):
        at = np.flatnonzero(spent == RADIUS - r)
        if len(at):
            m = masks(low_bits, r)
            values.append((home[at, None] ^ m[None, :]).ravel())
            owners.append(np.repeat(rows[at].astype(np.int32), len(m)))
    return np.concatenate(values), np.concatenate(owners)


def _dealt(home: np.ndarray, spent: np.ndarray, top: int, variants: int):
    """A bucket in parts of about BUNDLE variants: dealt once more, by its next bits, in memory."""
    s = 0 if variants <= 2 * BUNDLE else min(10, math.ceil(math.log2(variants / BUNDLE)))
    if not s:
        yield home, spent, np.arange(len(home)), top
        return
    stems, costs, rows = [], [], []
    for m in masks(s, RADIUS, top - s):
        cost = int(m).bit_count()
        at = np.flatnonzero(spent + cost <= RADIUS)
        stems.append(home[at] ^ m)
        costs.append((spent[at] + cost).astype(np.uint8))
        rows.append(at.astype(np.int32))
    stem, cost, row = np.concatenate(stems), np.concatenate(costs), np.concatenate(rows)
    part = (stem >> np.uint64(top - s)) & np.uint64((1 << s) - 1)
    by = np.argsort(part, kind="stable")
    for at in np.split(by, np.flatnonzero(np.diff(part[by])) + 1):
        yield stem[at], cost[at], row[at], top - s


def _sliced(batches):
    """Batches of ``SLICE`` rows at most: whole ones of shingle sets take much memory."""
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            yield b.slice(at, SLICE)


def _gathered(batches, *keys: int):
    """Lists of batches' columns: about GATHER rows, cut where the sorted columns at ``keys`` change."""
    held, size = [], 0
    for t in batches:
        cols = [x.to_numpy(zero_copy_only=False) for x in t.columns]
        if held and size >= GATHER:
            other = np.zeros(len(cols[0]), bool)
            for k in keys:
                other |= cols[k] != held[-1][k][-1]
            change = np.flatnonzero(other)
            if len(change):
                cut = change[0]
                held.append([c[:cut] for c in cols])
                yield held
                held, size, cols = [], 0, [c[cut:] for c in cols]
        if len(cols[0]):
            held.append(cols)
            size += len(cols[0])
    if held:
        yield held


def candidates(nodes: DataFrame, count: int, most: int, tables: int = TABLES) -> DataFrame:
    """Distinct pairs ``a`` < ``b`` of nodes of different classes that share a variant in some table: each node with the busiest.

    ``nodes``: ``node`` (long, distinct), ``parts`` (array of ``TABLES`` longs), ``wide`` and ``known`` (the class so
    far, a long); ``count``: their number. Pairs whose last 192 bits differ in more than ``most`` are left out. Only the first ``tables`` parts are searched.
    """
    bits = min(20, max(4, math.ceil(math.log2(max(count, 1) / HOME)))) if count > HOME else 4
    top = PART - bits
    last = [F.col("wide")[WIDE // 64 - i].alias(f"x{i}") for i in (3, 2, 1)]
    part = nodes.select("node", "known", *last, F.posexplode(F.slice("parts", 1, tables)).alias("t", "part"))
    row = F.explode(F.array(*[F.lit(int(m)) for m in masks(bits, RADIUS, top).tolist()]))
    sent = part.select("node", "known", "x3", "x2", "x1", "part", "t", row.alias("m"))
    sent = sent.select("node", "part", F.shiftleft("t", bits).bitwiseOR(F.shiftright(F.col("part").bitwiseXOR(F.col("m")), top).cast("int")).alias("bucket"), "known", "x3", "x2", "x1")

    def bundle(held):
        node, part, bucket, known, *more = (np.concatenate(x) for x in zip(*held))
        part = part.view(np.uint64)
        low = np.uint64((1 << top) - 1)
        stem = (bucket.astype(np.uint64) & np.uint64((1 << bits) - 1)) << np.uint64(top)
        home = (part & low) | stem
        spent = _popcount(part ^ home)
        weight = np.array([len(masks(top, RADIUS - r)) for r in range(RADIUS + 1)])[spent]
        out = [np.zeros((0, 2), np.int64)]
        for at in _bundles(bucket, weight):
            n, u, c = node[at], bucket[at].astype(np.uint64) << np.uint64(PART), known[at]
            tail = np.stack([x[at] for x in more], 1).view(np.uint64)
            for h, s, rows, low_bits in _dealt(home[at], spent[at], top, int(weight[at].sum())):
                values, owners = _variants(h | u[rows], s, rows, low_bits)
                i, j = _pairs(values, owners, c)
                near = _popcount(tail[i] ^ tail[j]).sum(axis=1, dtype=np.int64) <= most
                i, j = i[near], j[near]
                out.append(np.stack([np.minimum(n[i], n[j]), np.maximum(n[i], n[j])], 1))
        pair = np.unique(np.concatenate(out), axis=0)
        pair = pair[pair[:, 0] != pair[:, 1]]
        return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["a", "b"])

    def run(batches):
        for held in _gathered(batches, 2):
            yield bundle(held)

    dealt = sent.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def frequent(source: DataFrame, count: int, words: int) -> np.ndarray:
    """Shingles that many of a sample of the texts hold, ascending. Which they are changes no result."""

    def run(batches):
        for t in _sliced(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *(shingle_hashes(x, words) for x in t.column(0).to_pylist())]).view(np.int64))], ["h"])

    sample = source.where(F.pmod(F.xxhash64("_row"), F.lit(max(1, count // SAMPLE))) == 0).select("_text")
    with shuffles_deleted(source.sparkSession):
        found = sample.mapInArrow(run, "h long").groupBy("h").count().where(F.col("count") >= OFTEN)
        return np.sort(np.array([r.h for r in found.orderBy(F.desc("count"), "h").limit(FREQUENT).collect()], np.int64))


def prefix_of(h: np.ndarray, often: np.ndarray, similarity: float) -> np.ndarray:
    """So many of a set's shingles (signed, ascending), frequent ones last, then by value, that two sets of this
    similarity have their first common shingle in both prefixes."""
    if not len(h):
        return h
    late = np.zeros(len(h), bool)
    if len(often):
        late = often[np.minimum(np.searchsorted(often, h), len(often) - 1)] == h
    return np.concatenate([h[~late], h[late]])[: len(h) - math.ceil(similarity * len(h) - 1e-9) + 1]


def tally_of(h: np.ndarray) -> np.ndarray:
    """How many shingles have each value of a few hash bits, modulo 16, as ``TALLY`` words."""
    counts = np.bincount(((h >> np.uint64(TALLY_BIT)) & np.uint64(16 * TALLY - 1)).astype(np.int64), minlength=16 * TALLY)
    c = (counts % 16).astype(np.uint8)
    return (c[0::2] | c[1::2] << 4).view(np.uint64)


def _unlike(tally: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Shingles that are in one of two sets only: so many at least, by their tallies (rows of counts)."""
    d = (tally[i] - tally[j]) & np.uint8(15)
    return np.minimum(d, 16 - d).sum(axis=1, dtype=np.int64)


def _met(first: np.ndarray, at: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether two rows share one of their ``first`` shingles that comes before their places ``at``."""
    out = np.zeros(len(i), bool)
    for x in range(first.shape[1]):
        for y in range(first.shape[1]):
            out |= (first[i, x] == first[j, y]) & (at[i] > x) & (at[j] > y)
    return out


def _across(h: np.ndarray, at: np.ndarray, n: np.ndarray, known: np.ndarray, side: np.ndarray, tally: np.ndarray, first: np.ndarray, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of equal ``h`` and different classes that may be so similar, about ``HELD`` at a time.

    ``at``: the shingle's place in a row's set of ``n``. A pair is left out if the places from there on are too
    few; at the first common shingle they are not, if it is so similar. It is left out too if its tallies (rows of
    words) differ by more than the shingles that sets so similar need not share, or if its sets meet at an earlier
    shingle, among the ``first`` of both. ``h`` is ascending. ``side``: rows of
    one side (from 1 on) are not compared with one another; 0 is none.
    """
    group = np.cumsum(np.append(0, h[1:] != h[:-1]))
    by = np.lexsort((known, group))
    run = np.cumsum(np.append(0, (np.diff(group[by]) != 0) | (np.diff(known[by]) != 0)))
    size = np.bincount(run)[run]
    # The largest class of each group comes last: its members are not compared with one another.
    by = by[np.lexsort((run, size, group[by]))]
    g, c = group[by], known[by]
    last = np.append(g[1:] != g[:-1], True)
    of_last = c[last][g]
    start = np.flatnonzero(np.append(True, g[1:] != g[:-1]))[g]
    others = np.bincount(g, c != of_last).astype(np.int64)[g]
    index = np.flatnonzero(others > 0)
    low = tally.view(np.uint8).reshape(len(tally), -1)
    counts = np.concatenate([low & 15, low >> 4], axis=1)
    out, size, step = [np.zeros((0, 2), np.int64)], 0, 0
    while True:  # the member at this place of its group with all later ones
        index = index[(index - start[index] > step) & (others[index] > step)]
        if not len(index):
            break
        i, j = by[start[index] + step], by[index]
        need = similarity / (1 + similarity) * (n[i] + n[j]) - 1e-9
        ok = (known[i] != known[j]) & ((side[i] == 0) | (side[i] != side[j])) & (np.minimum(n[i] - at[i], n[j] - at[j]) >= need)
        i, j, need = i[ok], j[ok], need[ok]
        ok = n[i] + n[j] - _unlike(counts, i, j) >= 2 * need
        i, j = i[ok], j[ok]
        ok = ~_met(first, at, i, j)
        out.append(np.stack([i[ok], j[ok]], 1))
        size += len(out[-1])
        step += 1
        if size >= HELD:
            yield tuple(np.concatenate(out).T)
            out, size = [], 0
    if out:
        yield tuple(np.concatenate(out).T)


def _crowds(sent: DataFrame) -> DataFrame | None:
    """``h`` and the number of ``blocks`` of shingles that more than ``CROWD`` sets meet in; None if there are none.

    Hash values are counted first: most shingles share theirs with too few to be counted themselves.
    """
    spot = F.pmod(F.xxhash64("h"), F.lit(SPOTS))
    spots = written(sent.groupBy(spot.alias("_spot")).count().where(F.col("count") > CROWD).select("_spot"), "crowded-spots")
    if not spots.head(1):
        discard(spots)
        return None
    held = sent.withColumn("_spot", spot).join(spots, "_spot", "left_semi")
    crowds = written(held.groupBy("h").count().where(F.col("count") > CROWD).select("h", F.ceil(F.col("count") * 2 / CROWD).alias("blocks")), "crowds")
    return crowds if crowds.head(1) else None


def remaining(prefix: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs ``a`` < ``b`` of nodes of different classes: all that may be this similar.

    ``prefix``: ``node``, size ``n``, ``tally``, ``prefix``; ``known``: ``node``, ``known``.
    """
    tallies = [F.col("tally")[i].alias(f"y{i}") for i in range(TALLY)]
    # Places beyond a prefix are never looked at.
    firsts = [F.coalesce(F.get("prefix", F.lit(i)), F.lit(0)).alias(f"z{i}") for i in range(FIRST)]
    sent = prefix.select("node", "n", *tallies, *firsts, "prefix").join(known, "node")
    sent = sent.select("node", "n", "known", *(f"y{i}" for i in range(TALLY)), *(f"z{i}" for i in range(FIRST)), F.posexplode("prefix").alias("at", "h"))
    crowds = _crowds(sent.select("h"))
    none = F.lit(0).cast("long")
    if crowds is None:
        sent = sent.select("*", none.alias("part"), none.alias("side"))
    else:
        # Each set of a crowd goes to all pairs of blocks that its own block is in.
        mine = F.pmod(F.xxhash64("node"), F.col("blocks"))
        crowded = sent.join(crowds, "h").select(*sent.columns, mine.alias("mine"), "blocks", F.explode(F.sequence(none, F.col("blocks") - 1)).alias("with"))
        first, second = F.least("mine", "with"), F.greatest("mine", "with")
        side = F.when(F.col("mine") == F.col("with"), 0).when(F.col("mine") < F.col("with"), 1).otherwise(2).cast("long")
        crowded = crowded.select(*sent.columns, (first * F.col("blocks") + second).alias("part"), side.alias("side"))
        sent = sent.join(crowds, "h", "left_anti").select(*sent.columns, none.alias("part"), none.alias("side")).unionByName(crowded)

    def run(batches):
        for held in _gathered(batches, TALLY + FIRST + 4, TALLY + FIRST + 5):
            node, n, known, *words, at, h, part, side = (np.concatenate(x) for x in zip(*held))
            tally, first = np.stack(words[:TALLY], 1), np.stack(words[TALLY:], 1)
            group = np.cumsum(np.append(0, (np.diff(h) != 0) | (np.diff(part) != 0)))
            for i, j in _across(group, at.astype(np.int64), n.astype(np.int64), known, side, tally, first, similarity):
                pair = np.unique(np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j])], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["a", "b"])

    return sent.repartition("h", "part").sortWithinPartitions("h", "part").mapInArrow(run, "a long, b long").distinct()


def possible(pairs: DataFrame, prefix: DataFrame, similarity: float) -> DataFrame:
    """Pairs without those whose prefixes (``node``, size ``n``, ``low``: the last 16 bits of each shingle) share too little.

    Up to where the first of two prefixes ends, what is common is in both; of the rest, all may be. Shingles
    that agree in 16 bits count as common, which leaves out no pair.
    """
    one, two = (prefix.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("low").alias(f"l{k}")) for k in "ab")

    def run(batches):
        for t in _sliced(batches):
            n, low, size = [], [], []
            for i in (2, 3):
                n.append(t.column(i).to_numpy(zero_copy_only=False).astype(np.int64))
                held = t.column(i + 2).to_pylist()
                size.append(np.array([len(x) // 2 for x in held], np.int64))
                low.append(np.repeat(np.arange(len(held)) << 16, size[-1]) | np.frombuffer(b"".join(held), np.uint16))
            both = np.bincount(low[0][np.isin(low[0], low[1])] >> 16, minlength=t.num_rows)
            near = both + np.maximum(n[0] - size[0], n[1] - size[1]) >= similarity / (1 + similarity) * (n[0] + n[1]) - 1e-9
            near = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([t.column(0).filter(near), t.column(1).filter(near)], ["a", "b"])

    return pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "la", "lb").mapInArrow(run, "a long, b long")


def _checked(pairs: DataFrame, rows: DataFrame, source: DataFrame, words: int, similarity: float, few: int) -> DataFrame:
    """Pairs whose shingle sets are at least this similar, exactly; a written table.

    Sets are made from the texts of rows that some pair asks for: ``rows`` tells the ids of a node's row in ``source``.
    ``few``: part files of its tables, at most.
    """
    pairs = written(pairs.coalesce(few), "candidates")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("_row")).distinct()
    asked = rows.select("_row", "_key", "_odd").join(realigned(nodes, "_row"), "_row")
    on = (source["_key"].eqNullSafe(asked["_key"])) & (source["_odd"].eqNullSafe(asked["_odd"]))
    texts = source.join(asked, on).select(asked["_row"].alias("node"), source["_text"])

    def sets(batches):
        for t in _sliced(batches):
            made = [shingle_hashes(x, words) for x in t.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, made)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.uint64), *made]).view(np.int64)))
            yield pa.RecordBatch.from_arrays([t.column(0), lists], ["node", "set"])

    sets = written(texts.mapInArrow(sets, "node long, set array<long>").coalesce(few), "sets")
    one, two = (sets.select(F.col("node").alias(k), F.col("set").alias(f"s{k}")) for k in "ab")

    def run(batches):
        for t in _sliced(batches):
            near = np.zeros(t.num_rows, bool)
            of = [(x.offsets.to_numpy(), x.values.to_numpy(zero_copy_only=False)) for x in (t.column(2), t.column(3))]
            for i in range(t.num_rows):
                x, y = (h[at[i] : at[i + 1]] for at, h in of)
                both = len(np.intersect1d(x, y, assume_unique=True))
                near[i] = both >= similarity * (len(x) + len(y) - both) - 1e-9
            near = pa.array(near)
            yield pa.RecordBatch.from_arrays([t.column(0).filter(near), t.column(1).filter(near)], ["a", "b"])

    out = written(pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long").coalesce(few), "similar-pairs")
    discard(pairs, sets)
    return out


def _link_files(rows: int) -> int:
    """Part files of a table of links or classes of at most so many rows."""
    return max(LINK_FILES, math.ceil(rows / LINK_ROWS))


def _tree(classes: DataFrame) -> DataFrame:
    """Classes as pairs."""
    return classes.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))


def _classes(source: DataFrame, words: int, similarity: float) -> DataFrame:
    """``_key``, ``_odd`` and ``class`` (a long) of every row of ``source``: ``_key``, ``_odd`` (longs, together distinct), ``_text``; a written table."""
    texts, source = source, source.select(F.monotonically_increasing_id().alias("_row"), "_key", "_odd", "_text")
    total = source.count()
    few, links = _part_files(total), _link_files(total)
    often = frequent(source, total, words)

    def prints(batches):
        hold("sets")
        for b in _sliced(batches):
            sets = [_ascending(shingle_hashes(t, words)) for t in b.column(3).to_pylist()]
            wide = np.array([wide_of(h) for h in sets], np.uint64).reshape(-1, WIDE // 64)
            n = len(wide)
            parts = parts_of(wide) if n else np.zeros((0, TABLES), np.uint64)
            tally = np.array([tally_of(h) for h in sets], np.uint64).reshape(-1, TALLY)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * x.shape[1], pa.int32()), pa.array(x.reshape(-1).view(np.int64))) for x in (wide, parts, tally)]
            prefix = [prefix_of(h.view(np.int64), often, similarity) for h in sets]
            ends = np.cumsum([0, *map(len, prefix)])
            lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *prefix]))))
            low = pa.array([h.astype(np.uint16).tobytes() for h in prefix], pa.binary())
            digest = pa.array([hashlib.blake2b(h.tobytes(), digest_size=16).digest() for h in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], digest, pa.array(list(map(len, sets)), pa.int32()), *lists, low], ["_row", "_key", "_odd", "digest", "n", "wide", "parts", "tally", "prefix", "low"])

    kinds = "_row long, _key long, _odd long, digest binary, n int, wide array<long>, parts array<long>, tally array<long>, prefix array<long>, low binary"
    rows = written(source.mapInArrow(prints, kinds), "wide-fingerprints")
    # Equal sets are one node, named by a row of it.
    of_digest = written(rows.groupBy("digest").agg(F.min("_row").alias("node")).coalesce(few), "digests")
    named = of_digest.select("node")
    nodes = written(rows.select(F.col("_row").alias("node"), "wide", "parts").join(realigned(named, "node"), "node").coalesce(few), "nodes")
    count = nodes.count()
    most = most_bits(similarity, 192)

    def similar(pairs: DataFrame) -> DataFrame:
        return _checked(pairs, rows, texts, words, similarity, few)

    # One table joins most of a dense group; then all tables, for pairs of different classes alone.
    early = written(components(similar(candidates(nodes.withColumn("known", F.col("node")), count, most, 1)), part_files=links).coalesce(links), "early-classes")
    told = nodes.join(early, "node", "left").select("node", "parts", "wide", F.coalesce("component", "node").alias("known"))
    later = similar(candidates(told, count, most))
    # The search so far may have missed pairs: what is left between classes is searched exactly.
    found = written(components(later.unionByName(_tree(early)), part_files=links).coalesce(links), "found-classes")
    told = named.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("known"))
    prefix = rows.select(F.col("_row").alias("node"), "n", "tally", "prefix")
    short = rows.select(F.col("_row").alias("node"), "n", "low")
    rest = similar(possible(remaining(prefix, told, similarity), short, similarity))
    classes = components(rest.unionByName(_tree(found)), part_files=links)
    of_print = of_digest.join(classes, "node", "left").select("digest", F.coalesce("component", "node").alias("class"))
    out = written(rows.select("_key", "_odd", "digest").join(realigned(of_print, "digest"), "digest").select("_key", "_odd", "class").coalesce(few), "classes")
    discard(rows, of_digest, nodes, early, later, found, rest)
    return out


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """``key`` and ``component_id`` (least ``key`` of the class) of every row."""
    numbered = written(df.select(F.col(key).cast("long").alias("_key"), F.monotonically_increasing_id().alias("_odd"), F.col(text).alias("_text")), "numbered-texts")
    rows = _classes(numbered, words, similarity)
    discard(numbered)
    least = rows.groupBy("class").agg(F.min("_key").alias("component_id"))
    return rows.join(realigned(least, "class"), "class").select(F.col("_key").alias(key), "component_id")


def keep_one(df: DataFrame, text: str = "text", key: str = "doc_id", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of ``df`` for each class: the row with the least ``key``, nulls last, any one of equals.

    Rows whose ``key`` is null or repeated are written and numbered (``_odd``), all others are known by it.
    """
    of_key = F.col(key).cast("long")
    times = df.groupBy(of_key.alias("_key")).count()
    again = written(times.where("count > 1 and _key is not null").select("_key"), "repeated-ids")
    columns = [F.col(f"`{c}`") for c in df.columns]
    whole = df.select(of_key.alias("_key"), F.struct(*columns).alias("_of"))
    repeated = whole.join(again, "_key", "left_semi").unionByName(whole.where("_key is null"))
    odd = written(repeated.withColumn("_odd", F.monotonically_increasing_id()), "odd-rows")
    plain = whole.where("_key is not null").join(again, "_key", "left_anti")
    of_text = F.col("_of").getField(text).alias("_text")
    source = plain.select("_key", F.lit(None).cast("long").alias("_odd"), of_text).unionByName(odd.select("_key", "_odd", of_text))
    first = F.min(F.struct(F.col("_key").isNull().alias("n"), "_key", "_odd"))
    classes = _classes(source, words, similarity)
    few = _part_files(classes.count())
    kept = written(classes.groupBy("class").agg(first.alias("f")).select("f._key", "f._odd").coalesce(few), "kept")
    discard(classes)
    plainly = kept.where("_odd is null").select("_key")
    oddly = kept.where("_odd is not null").select("_odd")
    stay = plain.join(realigned(plainly, "_key"), "_key", "left_semi").select("_of").unionByName(odd.join(oddly, "_odd", "left_semi").select("_of"))
    return stay.select("_of.*")
