"""Contamination between splits: similar shingles or similar SimHash fingerprints.

All pairs of rows of different splits are compared, exactly, where they meet: rows of later splits and rows of earlier
ones are dealt into blocks, and each pair of blocks is one task. There fingerprints are compared word by word, and sets of
shingles by prefixes: of two sets with similarity t, the first n - ceil(t n) + 1 elements in any common order share one.
The order is by frequency, rarest first. Pairs leave that task as results and go through no shuffle.

What travels with a row is its fingerprint and those of its shingles alone that another set has too; shingles of
one set only can be in no intersection. They are found in slices of the hashes, so that little of all shingles
is on disk at once. Rows with equal sets are told by a hash of the set.

The work is quadratic, as the definition is: fingerprints of texts of one language lie so close together that keys of equal
bits (11 blocks, any 3 equal) brought more candidates than there are pairs, and so are the pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..session import discard, written

#: Rows in a block at most; blocks of the earlier and the later splits at least, if there are ``FEW`` rows for each.
BLOCK = 32_768
EARLIER, LATER, FEW = 16, 2, 1_024
#: Shingles that are looked at in one slice, if ``SLICES`` are enough for it.
SLICE = 4_000_000
SLICES = 8
#: Rows of a batch that is handed on, and hashes of tokens that a worker keeps.
ROWS = 50_000
KEPT = 300_000

_kept: dict[str, int] = {}


def _hashes(words: list[str]) -> np.ndarray:
    """Low 64 bits of each token's SHA-256."""
    if len(_kept) > KEPT:
        _kept.clear()
    for w in {w for w in words if w not in _kept}:
        _kept[w] = int.from_bytes(hashlib.sha256(w.encode()).digest()[24:], "big")
    return np.fromiter(map(_kept.__getitem__, words), np.uint64, len(words))


def _shingle_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of ``width`` tokens."""
    n = max(0, len(h) - width + 1)
    g = np.zeros(n, np.uint64)
    for i in range(width):
        g = (g ^ (g >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    return np.unique((g ^ (g >> np.uint64(32))).view(np.int64))


def fingerprints(rows: DataFrame, width: int = 5, quotes: bool = True) -> DataFrame:
    """``row_id``, ``split``, ``thread_id``, ``grams`` (sorted hashes of distinct shingles), ``simhash``.

    ``rows``: ``row_id`` (distinct in a split), ``split``, ``thread_id``, ``text``.
    """
    kinds = dict(rows.dtypes)
    content = text.normalize_content(F.coalesce("text", F.lit("")), quotes)

    def run(batches):
        for b in batches:
            grams, prints = [], []
            for t in b.column("content").to_pylist():
                h = _hashes(t.split(" ") if t else [])
                ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
                prints.append(np.packbits(ones * 2 > len(h), bitorder="little").view(np.int64)[0])
                grams.append(_shingle_hashes(h, width))
            ends = np.cumsum([0, *map(len, grams)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(grams) if grams else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("row_id", "split", "thread_id")), lists, pa.array(prints, pa.int64())], ["row_id", "split", "thread_id", "grams", "simhash"])

    made = rows.select("row_id", "split", "thread_id", content.alias("content"))
    return written(made.mapInArrow(run, f"row_id {kinds['row_id']}, split {kinds['split']}, thread_id {kinds['thread_id']}, grams array<long>, simhash long"), "fingerprints")


def _rank(split: str = "split"):
    return F.when(F.col(split) == "train", 0).when(F.col(split) == "val", 1).otherwise(2)


def _shared(sets: DataFrame, slices: int, at: int) -> DataFrame:
    """``kind``, ``gram``, ``df`` of the shingles of a slice that sets of several kinds have. ``sets``: ``kind``, ``grams``."""

    def cut(batches):
        for b in batches:
            gram = b.column("grams").flatten().to_numpy()
            kind = np.repeat(b.column("kind").to_numpy(), pc.list_value_length(b.column("grams")).to_numpy())
            mine = gram.view(np.uint64) % np.uint64(slices) == at
            kind, gram = kind[mine], gram[mine]
            for i in range(0, len(gram), ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(kind[i : i + ROWS]), pa.array(gram[i : i + ROWS])], ["kind", "gram"])

    def meet(batches):
        held = [(b.column("gram").to_numpy(), b.column("kind").to_numpy()) for b in batches]
        if not held:
            return
        gram, kind = map(np.concatenate, zip(*held))
        order = np.lexsort((kind, gram))
        gram, kind = gram[order], kind[order]
        new = np.r_[True, (np.diff(gram) != 0) | (np.diff(kind) != 0)]
        gram, kind = gram[new], kind[new]
        df = np.diff(np.flatnonzero(np.r_[True, np.diff(gram) != 0, True]))
        df = np.repeat(df, df)
        gram, kind, df = gram[df > 1], kind[df > 1], df[df > 1]
        for i in range(0, len(gram), ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + ROWS]) for x in (kind, gram, df)], ["kind", "gram", "df"])

    return sets.mapInArrow(cut, "kind long, gram long").repartition("gram").mapInArrow(meet, "kind long, gram long, df long")


def _rows(prints: DataFrame, similarity: float) -> DataFrame:
    """A row's fingerprint ``v``, ``kind`` and size ``n`` of its set, its shared shingles ``g``, rarest first, and how many (``prefix``) are in its prefix."""
    kind = F.xxhash64("grams")
    total = prints.agg(F.sum(F.size("grams"))).first()[0] or 0
    slices = max(1, min(SLICES, -(-total // SLICE)))
    held = [written(_shared(prints.select(kind.alias("kind"), "grams"), slices, i), "shared-shingles") for i in range(slices)]
    each = held[0]
    for h in held[1:]:
        each = each.unionByName(h)
    sets = written(each.groupBy("kind").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("x")).select("kind", F.col("x.gram").alias("g")), "shared-sets")
    discard(*held)
    rows = prints.select("row_id", "split", "thread_id", kind.alias("kind"), F.size("grams").alias("n"), F.col("simhash").alias("v"))
    g = F.coalesce("g", F.array().cast("array<long>"))
    # What is left of the prefix after the set's own shingles, which come first.
    left = F.col("n") - F.ceil(F.col("n") * similarity - 1e-9).cast("int") + 1 - (F.col("n") - F.size(g))
    out = written(rows.join(sets, "kind", "left").select(*rows.columns, g.alias("g"), F.when(F.col("n") > 0, F.greatest(left, F.lit(0))).otherwise(F.lit(0)).alias("prefix")), "guarded-rows")
    discard(sets)
    return out


class _Side:
    """The rows of a block: ``rank``, fingerprints, kinds, sizes, prefixes, shingles, and what results name."""

    def __init__(self, batches: list[pa.RecordBatch]):
        t = pa.Table.from_batches(batches).combine_chunks()
        self.names = {c: t.column(c).combine_chunks() for c in ("split", "row_id", "thread_id")}
        self.rank, self.kind, self.n, self.prefix = (t.column(c).to_numpy() for c in ("k", "kind", "n", "prefix"))
        self.v = t.column("v").to_numpy().view(np.uint64)
        g = t.column("g").combine_chunks()
        self.size = pc.list_value_length(g).to_numpy().astype(np.int64)
        self.start, self.g = np.cumsum(self.size) - self.size, g.flatten().to_numpy()


def _lists(key: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each key's rows start, and the rows."""
    order = np.argsort(key, kind="stable")
    return np.searchsorted(key[order], np.arange(n + 1)), row[order]


def _similar(one: _Side, two: _Side, similarity: float, bits: int, counts: tuple[np.ndarray, np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """Pairs (row of ``one``, row of ``two``, similarity, differing bits) of a lower and a higher rank and of no common thread.

    With ``counts`` pairs are only added up there, for each row; then close fingerprints need no similarity.
    """
    both, ids = np.unique(np.concatenate([one.g, two.g]), return_inverse=True)
    g1, g2 = ids[: len(one.g)], ids[len(one.g) :]
    owner = np.repeat(np.arange(len(one.n)), one.size)
    early = np.arange(len(g1)) - one.start[owner] < one.prefix[owner]
    at, meet = _lists(g1[early], owner[early], len(both))
    sets, of = np.unique(np.concatenate([one.kind, two.kind]), return_inverse=True)
    k1, k2 = of[: len(one.kind)], of[len(one.kind) :]
    kind_at, alike = _lists(k1, np.arange(len(k1)), len(sets))
    threads = pc.unique(pa.concat_arrays([one.names["thread_id"], two.names["thread_id"]]))
    h1, h2 = (pc.index_in(x.names["thread_id"], value_set=threads.drop_null()).fill_null(-1).to_numpy() for x in (one, two))
    marks, found, size = np.zeros(len(both), bool), [], 0
    for j in range(len(two.n)):
        apart = np.bitwise_count(one.v ^ two.v[j])
        near = apart <= bits
        mine = g2[two.start[j] : two.start[j] + two.size[j]]
        if two.n[j] and similarity <= 1:
            near[alike[kind_at[k2[j]] : kind_at[k2[j] + 1]]] = True
            for x in mine[: two.prefix[j]]:
                near[meet[at[x] : at[x + 1]]] = True
        near &= one.rank < two.rank[j]
        if h2[j] >= 0:
            near &= h1 != h2[j]
        if counts:
            close = near & (apart <= bits)
            counts[0][close] += 1
            counts[1][j] += close.sum()
            near &= ~close
        i = np.flatnonzero(near)
        if not len(i):
            continue
        marks[mine] = True
        m = one.size[i]
        ends = np.cumsum(m)
        place = np.repeat(one.start[i] - ends + m, m) + np.arange(ends[-1])
        hits = np.r_[0, np.cumsum(marks[g1[place]])]
        marks[mine] = False
        common = np.where(k1[i] == k2[j], two.n[j], hits[ends] - hits[ends - m])
        union = one.n[i] + two.n[j] - common
        share = np.where(union == 0, 0.0, common / np.maximum(union, 1))
        keep = (share >= similarity) | (apart[i] <= bits)
        if counts:
            counts[0][i[keep]] += 1
            counts[1][j] += keep.sum()
            continue
        found.append((i[keep], np.full(keep.sum(), j), share[keep], apart[i][keep].astype(np.int32)))
        size += int(keep.sum())
        if size >= ROWS:
            yield tuple(map(np.concatenate, zip(*found)))
            found, size = [], 0
    if size:
        yield tuple(map(np.concatenate, zip(*found)))


def _compared(rows: DataFrame, similarity: float, bits: int, counted: bool = False) -> DataFrame:
    """``split_a``, ``row_a``, ``thread_a``, the same of ``b``, ``_j`` and ``hamming`` of all pairs that are similar by either measure.

    ``counted``: ``side``, ``split``, ``id`` and ``n``, a row's pairs in a task, instead.
    """
    rows = rows.withColumn("k", _rank())
    kinds = dict(rows.dtypes)
    n = rows.agg(F.count(F.when(F.col("k") < 2, 1)), F.count(F.when(F.col("k") > 0, 1))).first()
    ones, twos = (max(-(-x // BLOCK), min(few, -(-x // FEW)), 1) for x, few in zip(n, (EARLIER, LATER)))
    mine = F.xxhash64("split", "row_id")
    # A key for each pair of blocks that a partition of its own belongs to.
    free: dict[int, int] = {}
    candidates = rows.sparkSession.range(40 * ones * twos + 1_000).select("id", F.pmod(F.hash("id"), F.lit(ones * twos)).alias("part"))
    for part, key in candidates.groupBy("part").agg(F.min("id")).collect():
        free[part] = key
    taken = set(free.values())
    spare = (x for x in range(-1, -ones * twos - 1, -1) if x not in taken)
    keys = F.array(*[F.lit(free[p] if p in free else next(spare)).cast("long") for p in range(ones * twos)])
    first = F.transform(F.sequence(F.lit(0), F.lit(twos - 1)), lambda j: F.pmod(mine, F.lit(ones)) * twos + j)
    second = F.transform(F.sequence(F.lit(0), F.lit(ones - 1)), lambda i: i * twos + F.pmod(mine, F.lit(twos)))
    sent = rows.where("k < 2").select(F.lit(0).alias("side"), F.explode(first).alias("pair"), *rows.columns).unionByName(rows.where("k > 0").select(F.lit(1).alias("side"), F.explode(second).alias("pair"), *rows.columns))
    sent = sent.withColumn("pair", F.get(keys, F.col("pair").cast("int")))

    def run(batches):
        held: dict[int, tuple[list, list]] = {}
        for b in batches:
            pair, side = b.column("pair").to_numpy(), b.column("side").to_numpy()
            for p in np.unique(pair):
                for s in (0, 1):
                    at = np.flatnonzero((pair == p) & (side == s))
                    if len(at):
                        held.setdefault(int(p), ([], []))[s].append(b.take(pa.array(at)))
        while held:
            one, two = held.popitem()[1]
            if not one or not two:
                continue
            one, two = _Side(one), _Side(two)
            if counted:
                counts = np.zeros(len(one.n), np.int64), np.zeros(len(two.n), np.int64)
                for _ in _similar(one, two, similarity, bits, counts):
                    pass
                for side, x, n in (("a", one, counts[0]), ("b", two, counts[1])):
                    has = pa.array(np.flatnonzero(n))
                    yield pa.RecordBatch.from_arrays([pa.array([side] * len(has), pa.string()), x.names["split"].take(has), x.names["row_id"].take(has), pa.array(n).take(has)], ["side", "split", "id", "n"])
                continue
            for i, j, share, apart in _similar(one, two, similarity, bits):
                sides = [x.names[c].take(pa.array(r)) for x, r in ((one, i), (two, j)) for c in ("split", "row_id", "thread_id")]
                yield pa.RecordBatch.from_arrays([*sides, pa.array(share), pa.array(apart)], ["split_a", "row_a", "thread_a", "split_b", "row_b", "thread_b", "_j", "hamming"])

    named = ", ".join(f"split_{s} {kinds['split']}, row_{s} {kinds['row_id']}, thread_{s} {kinds['thread_id']}" for s in "ab")
    kind = f"side string, split {kinds['split']}, id {kinds['row_id']}, n long" if counted else f"{named}, _j double, hamming int"
    return sent.repartition(ones * twos, "pair").mapInArrow(run, kind)


def close_fingerprints(prints: DataFrame, bits: int) -> DataFrame:
    """Pairs (``split_a``, ``row_a``, ``split_b``, ``row_b``) of rows of different splits at most ``bits`` apart."""
    none = F.array().cast("array<long>")
    rows = prints.select("row_id", "split", F.lit(None).cast("string").alias("thread_id"), F.lit(0).cast("long").alias("kind"), F.lit(0).alias("n"), F.col("simhash").alias("v"), none.alias("g"), F.lit(0).alias("prefix"))
    return _compared(rows, 2.0, bits).select("split_a", "row_a", "split_b", "row_b")


def _checked(prints: DataFrame, similarity: float, bits: int) -> DataFrame:
    if not 0 < similarity <= 1 or not 0 <= bits <= 64:
        raise ValueError("similarity must lie in (0, 1] and bits in 0 to 64")
    return _rows(prints, similarity)


def contamination_pairs(prints: DataFrame, similarity: float = 0.7, bits: int = 8) -> DataFrame:
    """Pairs across splits that are similar by either measure and not of one thread.

    ``split_a``, ``split_b``, ``row_a``, ``row_b``, ``jaccard`` (3 digits), ``hamming``, ``thread_a``, ``thread_b``. What it
    needs of ``prints`` is written before it returns.
    """
    hit = _compared(_checked(prints, similarity, bits), similarity, bits)
    return hit.select("split_a", "split_b", "row_a", "row_b", "hamming", "thread_a", "thread_b", F.round("_j", 3).alias("jaccard"))


def contamination_ends(prints: DataFrame, similarity: float = 0.7, bits: int = 8) -> DataFrame:
    """The ``ends`` of the same pairs, added up where they are found without handing on any."""
    found = _compared(_checked(prints, similarity, bits), similarity, bits, counted=True)
    return found.groupBy("side", "split", "id").agg(F.sum("n").alias("n"))


def ends(pairs: DataFrame) -> DataFrame:
    """``side``, ``split``, ``id`` and number ``n`` of pairs of each row that is in one: counted where pairs are found, then added up."""
    both = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"split_{s}").alias("split"), F.col(f"row_{s}").alias("id")) for s in "ab"])
    return pairs.select(F.explode(both).alias("x")).groupBy("x.side", "x.split", "x.id").agg(F.count("*").alias("n"))


def excluded(found: DataFrame, policy: str = "quarantine_test") -> DataFrame:
    """Ids (``id``) that a policy excludes, of the ``ends`` of pairs: the later split's, both, or none (``coassign``)."""
    later = found.where((F.col("side") == "b") & F.col("split").isin("val", "test")).select("id")
    if policy == "quarantine_test":
        return later.distinct()
    if policy == "quarantine_both":
        return later.unionByName(found.where("side = 'a'").select("id")).distinct()
    if policy == "coassign":
        return later.where(F.lit(False))
    raise ValueError(f"unknown policy: {policy}")


def exclusion_policy(pairs: DataFrame, policy: str = "quarantine_test") -> DataFrame:
    return excluded(ends(pairs), policy)


def contamination_summary(pairs: DataFrame, rows: DataFrame, limit: float = 1.0) -> DataFrame:
    """Pairs, their percentage of the rows, the percentage of rows involved, and PASS or FAIL."""
    return summary_of_ends(ends(pairs), rows, limit)


def summary_of_ends(found: DataFrame, rows: DataFrame, limit: float = 1.0) -> DataFrame:
    sides = found.groupBy("split", "id").agg(F.sum(F.when(F.col("side") == "b", F.col("n")).otherwise(F.lit(0))).alias("n"))
    totals = sides.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"), F.count("*").alias("involved"))
    one = rows.agg(F.count("*").alias("total_rows")).join(F.broadcast(totals))

    def pct(n):
        return F.when(F.col("total_rows") == 0, F.lit(0.0)).otherwise(F.round(F.col(n) * 100.0 / F.col("total_rows"), 2))

    out = one.select("total_rows", "n_pairs", pct("n_pairs").alias("contamination_pct"), pct("involved").alias("contaminated_row_pct"))
    return out.withColumn("status", F.when(F.col("contamination_pct") <= limit, "PASS").otherwise("FAIL"))
