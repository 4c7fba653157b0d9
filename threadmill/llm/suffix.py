"""Exact substring deduplication with suffix arrays built by two-stage sorting.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere else. One suffix
array of a large corpus fits no machine, so suffixes that can match are brought together first:

1. Every window of ``length`` bytes has an anchor, its least-hashed run of ``ANCHOR`` bytes (the
   leftmost of equals). Equal windows have equal anchors at equal places, so matches are found
   among windows of one anchor alone. The windows of one anchor, which follow one another, make a
   segment of at most ``2 * length - ANCHOR`` bytes; a window lies in no other segment.
2. Anchors that occur once are dropped (counts with partial sums). A segment that occurs twice
   as a whole is covered as a whole. Where one anchor has several different segments, one copy
   of each goes to a suffix array.
3. An anchor with more than ``MANY`` different segments (a passage that a third of all texts quote)
   would make one array too large. It is made longer: of its windows, those that reach far to the left
   meet under the anchor with more bytes before it, the others under that with more bytes after it. Both
   halves are split again until no anchor has so many; at last an anchor is a whole window.
4. Segments are packed into arrays by anchor. Two-stage sorting: suffixes smaller than their
   successor are sorted directly, the others are induced by scanning buckets of first bytes
   from the left. Neighbours in the array with a common prefix of ``length`` bytes match.

Full rows are sent only for anchors whose bit is set in a bit map of the anchors that repeat, and texts only if
some segment of them is asked for; both filters have a fixed size and let through too much at worst.

Runs are joined for each text, and texts are cut. Segments are told apart by two 64-bit hashes and
their lengths; everything else compares bytes.

Defined results: null and empty texts and texts shorter than ``length`` lose nothing; repeated rows
(same id, same text) count as two texts; ids may be null. Texts are UTF-8 here: a cut may fall
inside a character, which ``keep_unique`` moves to the character's edge (fewer bytes removed).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import discard, part_files, realigned, shuffles_deleted, written

#: Bytes of an anchor.
ANCHOR = 64
#: Different segments of one anchor in a suffix array, at most.
MANY = 500
#: Words of 64 bits of the map of repeated anchors, and hash values by which texts are asked for.
MAP_WORDS = 1 << 20
SPOTS = 1 << 20
#: Bytes of text hashed at a time (what stays in cache), and bytes in one suffix array, about.
CHUNK = 32_000
ARRAY = 400_000

_BASE = 0x9E3779B97F4A7C15
_CODE = np.random.default_rng(8).integers(1, 1 << 63, 256, dtype=np.uint64)


# --- hashing ---------------------------------------------------------------------------------


class _Powers:
    """Powers of the base and of its inverse modulo 2 ** 64."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> None:
        while len(cls.up) < n:
            k = len(cls.up)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                old = getattr(cls, name)
                setattr(cls, name, np.concatenate([old, old * np.uint64(pow(base, k, 1 << 64))]))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def anchors(data: np.ndarray, ends: np.ndarray, length: int, anchor: int = ANCHOR):
    """Anchors of the texts that ``data`` (bytes) holds one after another up to each of ``ends``.

    Returns, for each anchor: text, hash, hash of its segment, place in its text, and the bytes
    of its segment left of and from that place.
    """
    n, span = len(data), length - anchor + 1
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    if n < length:
        return none
    _Powers.upto(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[data] * _Powers.up[:n], out=sums[1:])
    grams = _mix((sums[anchor:] - sums[:-anchor]) * _Powers.down[: n - anchor + 1])
    # The least gram of each window: hash above, offset below, by doubling.
    low = np.uint64(511)
    key, have = grams & ~low, 1
    while have * 2 <= span:
        key = np.minimum(key[:-have], key[have:] + np.uint64(have))
        have *= 2
    if have < span:
        key = np.minimum(key[: len(key) - (span - have)], key[span - have :] + np.uint64(span - have))
    starts = np.concatenate([[0], ends[:-1]])
    sizes = ends - starts
    # Windows inside one text.
    owner = np.repeat(np.arange(len(ends)), sizes)[: len(key)]
    inside = np.arange(len(key)) + length <= ends[owner]
    at = np.flatnonzero(inside)
    if not len(at):
        return none
    place = at + (key[at] & low).astype(np.int64)
    text = owner[at]
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])]))
    left, right = at[new], at[np.append(new[1:], len(at)) - 1] + length
    place, text = place[new], text[new]
    whole = _mix((sums[right] - sums[left]) * _Powers.down[left] + (right - left).astype(np.uint64))
    return text, grams[place].view(np.int64), whole.view(np.int64), place - starts[text], place - left, right - place


# --- suffix arrays ---------------------------------------------------------------------------


def smaller_than_next(codes: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it (the empty suffix is the smallest)."""
    n = len(codes)
    if not n:
        return np.zeros(0, bool)
    differ = np.append(np.flatnonzero(codes[:-1] != codes[1:]), n - 1)
    edge = differ[np.searchsorted(differ, np.arange(n))]
    following = np.append(codes.astype(np.int64), -1)
    return following[edge] < following[edge + 1]


def suffix_array(data: bytes, depth: int) -> np.ndarray:
    """Suffixes of ``data`` in order of their first ``depth`` bytes, at least, by two-stage sorting."""
    codes = np.frombuffer(data, np.uint8)
    n = len(codes)
    up = smaller_than_next(codes)
    text = data.decode("latin-1")  # one character a byte: slices that sort by bytes
    direct = np.flatnonzero(up).tolist()
    direct.sort(key=lambda i: text[i : i + depth])
    direct = np.array(direct, np.int64)
    firsts = codes[direct]
    begin = np.searchsorted(firsts, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def hand_on(done: np.ndarray, c: int) -> np.ndarray:
        """Give predecessors of ``done`` to their buckets; those of bucket ``c`` itself are returned."""
        before = done[done > 0] - 1
        before = before[~up[before]]
        first = codes[before]
        here = before[first == c]
        rest, first = before[first > c], first[first > c]
        if len(rest):
            order = np.argsort(first, kind="stable")
            rest, first = rest[order], first[order]
            cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
            for part, k in zip(np.split(rest, cuts), first[np.concatenate([[0], cuts])]):
                waiting[k].append(part)
        return here

    if n and not up[n - 1]:
        waiting[codes[n - 1]].append(np.array([n - 1], np.int64))
    for c in range(256):
        part = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(part):
            out.append(part)
            part = hand_on(part, c)
        part = direct[begin[c] : begin[c + 1]]
        if len(part):
            out.append(part)
            hand_on(part, c)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_prefixes(data: bytes, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix in ``order`` shares with the one before it, up to ``most`` (the first: 0)."""
    flat = np.frombuffer(data + bytes(most + 16), np.uint8)
    lcp = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for step in range(0, most, 8):
        if not len(live):
            break
        a, b = order[live - 1] + step, order[live] + step
        wide = np.arange(8)
        same = flat[a[:, None] + wide] == flat[b[:, None] + wide]
        whole = same.all(axis=1)
        lcp[live] += np.where(whole, 8, same.argmin(axis=1))
        live = live[whole]
    return np.minimum(lcp, most)


def repeats(segments: list[bytes], length: int, anchor: np.ndarray | None = None, first: np.ndarray | None = None, last: np.ndarray | None = None) -> list[np.ndarray]:
    """Starts of ``length``-byte strings of each segment that also start elsewhere in the list.

    ``anchor``: only segments of one number count together. With ``first`` and ``last`` (least and greatest
    text of each segment's copies), only strings of two different texts count.
    """
    data = b"".join(segments)
    sizes = np.array([len(s) for s in segments], np.int64)
    ends = np.cumsum(sizes)
    order = suffix_array(data, length)
    owner = np.repeat(np.arange(len(segments)), sizes)[order]
    order = order[order + length <= ends[owner]]
    out = [np.zeros(0, np.int64)] * len(segments)
    if len(order) < 2:
        return out
    equal = common_prefixes(data, order, length) >= length
    owner = np.searchsorted(ends, order, "right")
    run = np.cumsum(~equal) - 1
    if anchor is not None:
        _, run = np.unique(np.stack([run, anchor[owner]], 1), axis=0, return_inverse=True)
        run = run.ravel()
    if first is None:
        hit = np.bincount(run)[run] > 1
    else:
        lo, hi = np.full(len(order), np.iinfo(np.int64).max), np.full(len(order), np.iinfo(np.int64).min)
        np.minimum.at(lo, run, first[owner])
        np.maximum.at(hi, run, last[owner])
        hit = (lo != hi)[run]
    order, owner = order[hit], owner[hit]
    by = np.argsort(order)
    order, owner = order[by], owner[by]
    for part in np.split(np.arange(len(order)), np.flatnonzero(owner[1:] != owner[:-1]) + 1):
        if len(part):
            k = owner[part[0]]
            out[k] = order[part] - (ends[k] - sizes[k])
    return out


def runs_of(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal covered runs [start, end) of strings of ``length`` bytes at sorted ``starts``."""
    if not len(starts):
        return []
    gap = np.flatnonzero(starts[1:] > starts[:-1] + length) + 1
    return [(int(p[0]), int(p[-1]) + length) for p in np.split(starts, gap)]


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs joined where they overlap or touch, in order."""
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


# --- tables ----------------------------------------------------------------------------------

_RUN = "array<struct<a: int, b: int>>"


def _identified(df: DataFrame, text: str, key: str, group: str | None) -> DataFrame:
    """``_k``, ``_h`` (together one text), ``_g`` (its group) and ``_text``."""
    g = F.xxhash64(F.col(group)) if group else F.lit(0).cast("long")
    return df.select(*_key_columns(df, text, key), g.alias("_g"), F.col(text).alias("_text"))


def _key_columns(df: DataFrame, text: str, key: str):
    """``_k`` and ``_h``: the id as a long, and a hash of the text (and of whether the id is null)."""
    kind = df.schema[key].dataType.typeName()
    k = F.coalesce(F.col(key).cast("long"), F.lit(-1)) if kind in ("long", "integer", "short", "byte") else F.xxhash64(F.col(key))
    return k.alias("_k"), F.xxhash64(F.col(key).isNull(), F.col(text)).alias("_h")


def _word_of(h: Column) -> Column:
    return F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(MAP_WORDS - 1))


def bit_words(hashes: DataFrame) -> DataFrame:
    """Words ``w`` of a map of ``64 * MAP_WORDS`` bits, ``b``, in which those of the hashes ``h`` are set."""
    return hashes.groupBy(_word_of(F.col("h")).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("b"))


def parted(df: DataFrame, h: Column, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose hash ``h`` has its bit set in a map (``bit_words``), and the others; no row is shuffled for it."""
    told = df.join(F.broadcast(words), _word_of(h) == F.col("w"), "left")
    is_set = F.coalesce(F.getbit("b", h.bitwiseAND(F.lit(63))), F.lit(0)) == 1
    return told.where(is_set).select(df.columns), told.where(~is_set).select(df.columns)


def _bit_map(hashes: DataFrame):
    """A broadcast map of ``64 * MAP_WORDS`` bits in which those of the hashes ``h`` are set."""
    bits = np.zeros(MAP_WORDS, np.uint64)
    with shuffles_deleted(hashes.sparkSession):
        words = bit_words(hashes).toArrow()
    for r in words.to_batches():
        bits[r.column(0).to_numpy()] = r.column(1).to_numpy().view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(bits)


def _in_map(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    h = h.view(np.uint64)
    return (bits[((h >> np.uint64(6)) & np.uint64(MAP_WORDS - 1)).astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) == 1


def _anchor_rows(texts: DataFrame, length: int, known=None, anchor: int = ANCHOR, asked=None) -> DataFrame:
    """A row for each anchor: ``h``, and if ``known`` (a bit map) has it: ``seg``, ``_k``, ``_h``, ``at`` (packed).

    ``asked``: a bit map of ``_spot_of`` rows; only those, with the bytes of their segments (``data``).
    """
    only_hash = known is None
    names = ["h"] if only_hash else ["h", "seg", "_k", "_h", "at"] + ["data"] * (asked is not None)

    def work(rows):
        whole = b"".join(r[3] for r in rows)
        data = np.frombuffer(whole, np.uint8)
        ends = np.cumsum([len(r[3]) for r in rows])
        text, h, seg, place, left, right = anchors(data, ends, length, anchor)
        g = np.array([r[2] for r in rows], np.int64)
        if len(h):
            h = _mix(h.view(np.uint64) ^ g.view(np.uint64)[text]).view(np.int64) if g.any() else h
        if only_hash:
            # Counts of a chunk's own copies are made here already.
            return pa.RecordBatch.from_arrays([pa.array(h)], names)
        k, hh = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
        if len(h):
            keep = _in_map(known.value, h)
            text, h, seg, place, left, right = (x[keep] for x in (text, h, seg, place, left, right))
        at = (place << 24) | (left << 12) | right
        cols = [h, seg, k[text], hh[text], at] if len(h) else [np.zeros(0, np.int64)] * 5
        if asked is None:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names)
        keep = np.flatnonzero(_in_map(asked.value, cols[1] ^ cols[3] ^ (cols[4] >> 24)))
        begin = np.array([r[4] for r in rows], np.int64)[text[keep]] + place[keep]
        data = [whole[a:b] for a, b in zip((begin - left[keep]).tolist(), (begin + right[keep]).tolist())]
        return pa.RecordBatch.from_arrays([*(pa.array(x[keep]) for x in cols), pa.array(data, pa.binary())], names)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, size = [], 0
            for k, h, g, t in zip(*(b.column(i).to_pylist() for i in range(4))):
                t = (t or "").encode("utf-8", "surrogatepass")
                if len(t) >= length:
                    rows.append((k, h, g, t, size))
                    size += len(t)
                    if size >= CHUNK:
                        yield work(rows)
                        rows, size = [], 0
            if rows:
                yield work(rows)

    return texts.mapInArrow(run, ", ".join(f"{c} {'binary' if c == 'data' else 'long'}" for c in names))


def _left(c="at"):
    return F.shiftright(c, 12).bitwiseAND(F.lit(4095))


def _segments(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bytes of one copy of each wanted segment: ``h``, ``seg``, ``lo``, ``hi``, ``n``, ``data``, ``left`` (of the anchor)."""
    spot = F.pmod(F.xxhash64("_k", "_h"), F.lit(SPOTS)).alias("_spot")
    asked = wanted.select(spot).distinct()
    some = texts.select("*", spot).join(F.broadcast(asked), "_spot", "left_semi").drop("_spot")
    lists = wanted.groupBy("_k", "_h").agg(F.collect_list(F.struct("at", "h", "seg", "n", "lo", "hi")).alias("_want"))
    both = some.join(realigned(lists, "_k", "_h"), ["_k", "_h"]).select("_text", "_want")
    names = ["h", "seg", "n", "lo", "hi", "left", "data"]

    def run(batches):
        for b in batches:
            out = []
            for t, want in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                t = t.encode("utf-8", "surrogatepass")
                for w in want:
                    place, left, right = w["at"] >> 24, w["at"] >> 12 & 4095, w["at"] & 4095
                    out.append((w["h"], w["seg"], w["n"], w["lo"], w["hi"], left, t[place - left : place + right]))
            for i in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[i : i + 20_000]), [pa.int64()] * 6 + [pa.binary()])], names)

    # Repeated rows give their segments twice; the readers drop one.
    return both.mapInArrow(run, "h long, seg long, n long, lo long, hi long, left long, data binary")


def _spot_of(h: str, at: str) -> Column:
    """What names a segment's copy in a bit map, with its ``seg``."""
    return F.col("seg").bitwiseXOR(F.col(h)).bitwiseXOR(F.shiftright(at, 24))


def _read_again(texts: DataFrame, wanted: DataFrame, length: int, known, anchor: int) -> DataFrame:
    """As ``_segments``, by another pass over all texts, which shuffles segments instead of texts."""
    asked = _bit_map(wanted.select(_spot_of("_h", "at").alias("h")))
    found = _anchor_rows(texts, length, known, anchor, asked)
    keys = ["h", "seg", "_k", "_h", "at"]
    return found.join(wanted, keys).select("h", "seg", "n", "lo", "hi", _left().alias("left"), "data")


def _sorted_runs(segments: DataFrame, length: int, across: bool) -> DataFrame:
    """``h``, ``seg`` and covered ``runs`` in the segment, from suffix arrays of whole anchors."""
    names = ["h", "seg", "runs"]
    of = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def work(rows):
        lo, hi = (np.array([r[i] for r in rows], np.int64) for i in (2, 3))
        anchor = np.unique(np.array([r[0] for r in rows], np.int64), return_inverse=True)[1]
        found = repeats([r[4] for r in rows], length, anchor, *((lo, hi) if across else ()))
        out = [(r[0], r[1], [{"a": a, "b": b} for a, b in runs_of(s, length)]) for r, s in zip(rows, found) if len(s)]
        cols = list(zip(*out)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], of)], names)

    def run(batches):
        rows, size, last = [], 0, (None, None)
        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(5))):
                if r[:2] == last:
                    continue
                if size >= ARRAY and r[0] != last[0]:
                    yield work(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[4])
                last = r[:2]
        if rows:
            yield work(rows)

    dealt = segments.select("h", "seg", "lo", "hi", "data").repartition("h").sortWithinPartitions("h", "seg")
    return dealt.mapInArrow(run, f"h long, seg long, runs {_RUN}")


def _whole(kinds: DataFrame, size: Column, length: int, across: bool) -> DataFrame:
    """``h``, ``seg`` and ``runs`` of segments that occur more than once as a whole."""
    again = F.col("lo") != F.col("hi") if across else F.col("n") > 1
    run = F.struct(F.lit(0).cast("int").alias("a"), size.cast("int").alias("b"))
    return kinds.where(again & (size >= length)).select("h", "seg", F.array(run).alias("runs"))


def _halves(segments: DataFrame, length: int) -> DataFrame:
    """The windows of each segment under two longer anchors, with the bytes that they cover.

    ``segments``: ``h``, ``data``, ``left`` and ``wide`` (place and bytes of the anchor in ``data``), and the columns of the
    segment that they are part of (``of_h``, ``of_seg``, ``base``), ``n``, ``lo``, ``hi``.
    """
    names = ["h", "seg", "n", "lo", "hi", "left", "wide", "of_h", "of_seg", "base", "data"]

    def run(batches):
        from xxhash import xxh3_64_intdigest

        signed = lambda x: x - (1 << 64) if x >> 63 else x
        for b in batches:
            out = []
            for h, n, lo, hi, left, wide, of_h, of_seg, base, data in zip(*(b.column(i).to_pylist() for i in range(10))):
                free = length - wide  # bytes of a window outside the anchor
                more = free - free // 2
                # Windows that start ``more`` bytes or further before the anchor hold these bytes, the others free // 2 + 1 after it or further.
                for side, begin, end, cut in ((0, 0, min(len(data), left + wide + free - more), left - more), (1, max(0, left - more + 1), len(data), 0)):
                    grown = (cut, wide + more) if side == 0 else (left, wide + free - more + 1)
                    if end - begin < length or grown[0] < begin or grown[0] + grown[1] > end:
                        continue
                    key = data[grown[0] : grown[0] + grown[1]]
                    part = data[begin:end]
                    name = xxh3_64_intdigest(key, (h ^ side) & (1 << 64) - 1)
                    out.append((signed(name), signed(xxh3_64_intdigest(part, name)), n, lo, hi, grown[0] - begin, grown[1], of_h, of_seg, base + begin, part))
            for i in range(0, len(out), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[i : i + 10_000]), [pa.int64()] * 10 + [pa.binary()])], names)

    cols = ["h", "n", "lo", "hi", "left", "wide", "of_h", "of_seg", "base", "data"]
    return segments.select(*cols).mapInArrow(run, ", ".join(f"{c} long" for c in names[:-1]) + ", data binary")


def _in_few(df: DataFrame, few: int | None) -> DataFrame:
    """``df`` in ``few`` partitions at most, if given."""
    return df if few is None else df.coalesce(few)


def _crowded_runs(segments: DataFrame, length: int, across: bool, many: int, anchor: int = ANCHOR, few: int | None = None) -> DataFrame:
    """As ``_sorted_runs``, for anchors with more than ``many`` segments: their anchors grow until none has so many.

    ``few``: part files of its tables, at most.
    """
    parts, left = [], segments.select("*", F.lit(anchor).cast("long").alias("wide"), F.col("h").alias("of_h"), F.col("seg").alias("of_seg"), F.lit(0).cast("long").alias("base"))
    while True:
        left = written(_in_few(_halves(left, length), few), "longer-anchors")
        m = left.groupBy("h").agg(F.count_distinct("seg").alias("m"), F.max("wide").alias("w"))
        # An anchor that is a window has one segment.
        crowded = written(_in_few(m.where((F.col("m") > many) & (F.col("w") < length)).select("h"), few), "crowded-anchors")
        parts.append(left.join(crowded, "h", "left_anti"))
        if not crowded.head(1):
            break
        left = left.join(crowded, "h")
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    kinds = whole.groupBy("h", "seg").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("data").alias("data"))
    kinds = written(_in_few(kinds, few), "longer-segments")
    found = _sorted_runs(kinds, length, across)
    full = _whole(kinds, F.octet_length("data"), length, across)
    runs = written(_in_few(found.join(full.select("h", "seg"), ["h", "seg"], "left_anti").unionByName(full), few), "longer-covered")
    moved = whole.select("h", "seg", "of_h", "of_seg", F.col("base").cast("int").alias("base")).join(realigned(runs, "h", "seg"), ["h", "seg"])
    shifted = F.transform("runs", lambda r: F.struct((r["a"] + F.col("base")).alias("a"), (r["b"] + F.col("base")).alias("b")))
    # At most as many runs as a segment has windows.
    return moved.groupBy(F.col("of_h").alias("h"), F.col("of_seg").alias("seg")).agg(F.flatten(F.collect_list(shifted)).alias("runs"))


def repeated_runs(df: DataFrame, length: int = 200, text: str = "text", key: str = "doc_id", group: str | None = None, across: bool = False, many: int = MANY, *, anchor: int = ANCHOR, rescan: bool = False, few: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(texts, runs)``: identified texts, and for those with repeats ``_k``, ``_h`` and their byte ``runs``.

    ``group``: match only inside one value of this column. ``across``: only strings of two
    different texts (by ``_k``) count. ``anchor``: bytes of an anchor, which change no result; shorter ones lie further
    apart, and more of them repeat by chance. ``rescan``: where most texts hold some segment that an array needs, a third
    pass over them shuffles less than the texts; and only rows are shuffled that bit maps of repeated anchors and of covered segments let through.
    ``few``: part files of the tables written in between, at most; as many as tasks if not given.
    """
    if not anchor < length <= 2_000 or length - anchor + 1 > 511:
        raise ValueError(f"length must lie between {anchor + 1} and {anchor + 510}")
    texts = _identified(df, text, key, group)
    twice = written(_in_few(_anchor_rows(texts, length, anchor=anchor).groupBy("h").count().where("count > 1").select("h"), few), "repeated-anchors")
    known = _bit_map(twice)
    found = _anchor_rows(texts, length, known, anchor)
    # A map with few bits set lets hardly an anchor through that occurs once, and such a one matches nothing.
    sparse = rescan and twice.count() <= MAP_WORDS
    rows = written(_in_few(found if sparse else found.join(twice, "h"), few), "anchors")
    # One row for each different segment, with one of its copies.
    kinds = written(_in_few(rows.groupBy("h", "seg").agg(F.count("*").alias("n"), F.min("_k").alias("lo"), F.max("_k").alias("hi"), F.min(F.struct("_k", "_h", "at")).alias("one")), few), "segments")
    several = kinds.groupBy("h").agg(F.count("*").alias("m"), F.min("lo").alias("l"), F.max("hi").alias("g"))
    several = written(_in_few(several.where("m > 1 and l <> g" if across else "m > 1").select("h", "m"), few), "several")
    wanted = kinds.join(realigned(several, "h"), "h").select("h", "seg", "n", "lo", "hi", "one._k", "one._h", "one.at")
    data = written(_in_few(_read_again(texts, wanted, length, known, anchor) if rescan else _segments(texts, wanted), few), "segment-bytes")
    crowded = written(_in_few(several.where(F.col("m") > many).select("h"), few), "crowded")
    if crowded.head(1):
        found = _sorted_runs(data.join(crowded, "h", "left_anti"), length, across)
        found = found.unionByName(_crowded_runs(data.join(crowded, "h").dropDuplicates(["h", "seg"]), length, across, many, anchor, few))
    else:
        found = _sorted_runs(data, length, across)
    whole = _whole(kinds, _left("one.at") + F.col("one.at").bitwiseAND(F.lit(4095)), length, across)
    covered = written(_in_few(found.join(whole.select("h", "seg"), ["h", "seg"], "left_anti").unionByName(whole), few), "covered")
    held = rows
    if rescan:
        spots = written(_in_few(bit_words(covered.select(F.col("seg").alias("h"))), few), "covered-spots")
        held, _ = parted(rows, F.col("seg"), spots)
    hits = held.join(realigned(covered, "h", "seg"), ["h", "seg"])
    base = (F.shiftright("at", 24) - _left()).cast("int")
    moved = hits.select("_k", "_h", F.transform("runs", lambda r: F.struct((r["a"] + base).alias("a"), (r["b"] + base).alias("b"))).alias("runs"))
    # Anchors of one text: as many as its length allows.
    runs = written(_in_few(moved.groupBy("_k", "_h").agg(F.flatten(F.collect_list("runs")).alias("runs")), few), "runs")
    discard(twice, rows, kinds, several, data, crowded, covered)
    return texts, runs


def _cut(data: bytes, runs) -> tuple[bytes, list[tuple[int, int]]]:
    spans = merged([(r["a"], r["b"]) for r in runs or ()])
    kept, at = [], 0
    for a, b in spans:
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    return b"".join(kept), spans


def deduplicate(df: DataFrame, length: int = 200, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: ``key``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``, ``kept`` (bytes)."""
    _, runs = repeated_runs(df, length, text, key)
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("_id"), *_key_columns(df, text, key), F.col(text).alias("_text"))
    joined = rows.join(realigned(runs, "_k", "_h"), ["_k", "_h"], "left").select("_id", "_text", "runs")
    names = [key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]

    def run(batches):
        for b in batches:
            out = []
            for t, r in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                data = (t or "").encode("utf-8", "surrogatepass")
                kept, spans = _cut(data, r)
                out.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names)

    return joined.mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def keep_unique(df: DataFrame, length: int = 200, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``df`` with repeated strings cut from ``text``, all other columns as they were.

    Cuts shrink to character edges, so that what is left is text.
    """
    with shuffles_deleted(df.sparkSession):
        rows, size = df.agg(F.count("*"), F.sum(F.octet_length(F.col(text)))).first()
    few = part_files(rows, size or 0)
    _, runs = repeated_runs(df, length, text, key, few=few)
    names, at = df.columns, df.columns.index(text)
    held = df.select(*_key_columns(df, text, key), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    joined = held.join(realigned(runs, "_k", "_h"), ["_k", "_h"], "left").select("_row.*", F.col("runs").alias("_runs_of_text"))

    def run(batches):
        for b in batches:
            out = []
            for t, r in zip(b.column(at).to_pylist(), b.column(len(names)).to_pylist()):
                if not r:
                    out.append(t)
                    continue
                data = t.encode("utf-8", "surrogatepass")
                spans = []
                for a, e in merged([(x["a"], x["b"]) for x in r]):
                    while a < e and data[a] & 0xC0 == 0x80:
                        a += 1
                    while a < e < len(data) and data[e] & 0xC0 == 0x80:
                        e -= 1
                    spans.append({"a": a, "b": e})
                out.append(_cut(data, spans)[0].decode("utf-8", "surrogatepass"))
            cols = [b.column(i) for i in range(len(names))]
            cols[at] = pa.array(out, cols[at].type)
            yield pa.RecordBatch.from_arrays(cols, names)

    return _in_few(joined.mapInArrow(run, df.schema), few)


#: DuckDB SQL of the query over ``documents``: every string of 200 bytes is counted.
SQL = """
with d as (select row_number() over () as r, doc_id, encode(coalesce(text, '')) as b from documents),
w as (select r, i, md5_number(hex(b[i:i + 199])) as s from (select r, b, unnest(range(1, octet_length(b) - 198)) as i from d where octet_length(b) >= 200)),
hits as (select r, i from w where s in (select s from w group by 1 having count(*) > 1)),
marked as (select r, i, case when i > lag(i) over (partition by r order by i) + 200 or lag(i) over (partition by r order by i) is null then 1 else 0 end as first from hits),
spans as (select r, min(i) as a, max(i) + 200 as e from (select r, i, sum(first) over (partition by r order by i) as k from marked) group by r, k),
cuts as (select r, list([a, e] order by a) as c, count(*) as n_spans, sum(e - a) as n_removed from spans group by r),
kept as (select doc_id, b, c, n_spans, n_removed from d left join cuts using (r))
select doc_id, octet_length(b) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(case when c is null then b else unhex(array_to_string(list_transform(range(len(c) + 1), lambda k: hex(b[case when k = 0 then 1 else c[k][2] end:case when k = len(c) then octet_length(b) else c[k + 1][1] - 1 end])), '')) end) as kept_sha256
from kept
"""
