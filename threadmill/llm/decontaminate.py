"""Benchmark decontamination with one Aho-Corasick automaton over normalised items.

Normalising lower-cases A-Z and takes the runs of ASCII letters, digits and non-ASCII characters
as words. A window is ``size`` consecutive words of an item (a shorter item is one window). The
windows, each with a space before and after every word, make one automaton; a text's words,
joined the same way, are scanned once, and hits are mapped back to words and to the characters
of the original text.

Windows are cut from the benchmark by tasks and written as a table in the shared folder; each worker reads it and
builds the automaton, nothing passes the driver. A worker holds ``BLOCK_BYTES`` of windows at most: of a benchmark
beyond, windows are dealt into blocks by hash, and texts pass one block's automaton after another, each pass adding
its hits to the row; nothing is dropped in either case.

Defined results: null texts have no words and no hits; null items and items without words have no
windows; equal items all count; repeated rows are scanned each; empty tables give no hits.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import file_system, hold, part_files, written

#: Bytes of distinct windows in one automaton, about (each text byte is in ten windows).
BLOCK_BYTES = 16_000_000

_WORD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Normalised words of a text, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD).split()


_SPAN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def word_spans(text: str | None) -> list[tuple[int, int]]:
    """Characters [start, end) of each word in the original text."""
    return [m.span() for m in _SPAN.finditer(text or "")]


def windows_of(text: str | None, size: int) -> list[tuple[bytes, int]]:
    """Distinct windows of an item, each word between spaces, and their numbers of words."""
    words = words_of(text)
    cut = (words[at : at + size] for at in range(max(1, len(words) - size + 1) if words else 0))
    return list({b" " + b" ".join(w) + b" ": len(w) for w in cut}.items())


class Windows:
    """The automaton of windows: rows of window, number of words, item."""

    def __init__(self, rows):
        import ahocorasick

        found: dict[bytes, tuple[int, set]] = {}
        for window, n, item in rows:
            found.setdefault(window, (n, set()))[1].add(item)
        self.automaton = ahocorasick.Automaton()
        for key, (n, of) in found.items():
            text = key.decode("latin-1")
            self.automaton.add_word(text, (n, tuple(of)))
        self.any = bool(found)
        if self.any:
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[list[int]], set]:
        """Number of words, covered word ranges [start, end), and items with occurring windows."""
        words = words_of(text)
        runs: list[list[int]] = []
        items: set = set()
        if self.any and words:
            joined = b" " + b" ".join(words) + b" "
            done_at, done = 0, 0
            for end, (n, of) in self.automaton.iter(joined.decode("latin-1")):
                done += joined.count(b" ", done_at, end)
                done_at = end
                items.update(of)
                add_run(runs, done - n, done)  # spaces before the closing one: words ended
        return len(words), runs, items


def add_run(runs: list[list[int]], first: int, last: int) -> None:
    """Join [first, last) to the runs so far; ends come in order."""
    while runs and first <= runs[-1][0]:
        last = max(last, runs.pop()[1])
    if runs and first <= runs[-1][1]:
        runs[-1][1] = max(last, runs[-1][1])
    else:
        runs.append([first, last])


_built: dict = {}


def _windows(uri: str, block: int, blocks: int) -> Windows:
    """The automaton of one block of a written table of windows, built once in a worker."""
    if (uri, block) not in _built:
        from pyarrow import dataset

        fs, path = file_system(uri)
        rows = dataset.dataset(path, filesystem=fs, format="parquet").to_batches()
        mine = (r for b in rows for r in zip(*(b.column(c).to_pylist() for c in ("window", "n", "item"))) if zlib.crc32(r[0]) % blocks == block)
        _built.clear()
        _built[uri, block] = Windows(mine)
    return _built[uri, block]


def window_table(benchmark: DataFrame, text: str = "text", item: str = "item_id", size: int = 10, few: int | None = None) -> tuple[str, int]:
    """Folder of the table of distinct windows of all items, and the number of blocks they are dealt into.

    ``few``: part files of the table, at most.
    """

    def cut(batches):
        for b in batches:
            rows = [(w, n, i) for i, t in zip(*(b.column(k).to_pylist() for k in (0, 1))) for w, n in windows_of(t, size)]
            for at in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[at : at + 10_000]), (pa.binary(), pa.int64(), pa.string()))], ["window", "n", "item"])

    items = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).where("i is not null and t is not null")
    windows = items.mapInArrow(cut, "window binary, n long, item string").distinct()
    table = written(windows if few is None else windows.coalesce(few), "benchmark-windows")
    total = table.select("window").distinct().agg(F.sum(F.octet_length("window"))).first()[0] or 0
    return table._written_to, -(-total // BLOCK_BYTES) or 1


def contaminated(df: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item: str = "item_id", size: int = 10) -> DataFrame:
    """One row per row of ``df``: ``key``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``,
    ``contaminated``, ``items`` (sorted), ``runs`` (covered words [first, last)) and ``spans`` (the
    characters [first, last) of the original text that each run covers)."""
    uri, blocks = window_table(benchmark, item_text, item, size)
    kind = df.schema[key].dataType.simpleString()
    ranges, names = "array<struct<first: long, last: long>>", ["_key", "_text", "n_words", "runs", "spans", "items"]
    of = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    listed = lambda x: [{"first": a, "last": b} for a, b in x]

    def scanned(source: DataFrame, block: int) -> DataFrame:
        def run(batches):
            windows = _windows(uri, block, blocks)
            for b in batches:
                n, runs, spans, items = [], [], [], []
                before = zip(b.column(3).to_pylist(), b.column(5).to_pylist()) if block else iter(lambda: (None, None), 0)
                for t, (old, had) in zip(b.column(1).to_pylist(), before):
                    k, hit, found = windows.scan(t)
                    if old:
                        both, hit = sorted([*hit, *([r["first"], r["last"]] for r in old)], key=lambda r: r[1]), []
                        for first, last in both:
                            add_run(hit, first, last)
                        found |= set(had)
                    at = word_spans(t) if hit else []
                    n.append(k)
                    runs.append(listed(hit))
                    spans.append(listed((at[x][0], at[y - 1][1]) for x, y in hit))
                    items.append(sorted(found))
                whole = b.column(1) if block + 1 < blocks else pa.nulls(b.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0), whole, pa.array(n, pa.int64()), pa.array(runs, of), pa.array(spans, of), pa.array(items, pa.list_(pa.string()))], names)

        return source.mapInArrow(run, f"_key {kind}, _text string, n_words long, runs {ranges}, spans {ranges}, items array<string>")

    found = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    for block in range(blocks):
        found = scanned(found, block)
        if block + 1 < blocks:
            found = written(found, "scanned-texts")
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["last"] - r["first"])
    return found.select(
        F.col("_key").alias(key),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        "items",
        "runs",
        "spans",
    )


def item_digest(items: list[str]) -> str:
    """The digest column of a list of items."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def keep_clean(df: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item: str = "item_id", size: int = 10) -> DataFrame:
    """Rows of ``df``, all columns, whose text holds no window of the benchmark."""
    uri, blocks = window_table(benchmark, item_text, item, size, part_files(benchmark.count()))
    out, at = df, df.columns.index(text)
    for block in range(blocks):

        def run(batches, block=block):
            hold("windows", _built.clear)
            windows = _windows(uri, block, blocks)
            for b in batches:
                yield b.filter(pa.array([not windows.scan(t)[1] for t in b.column(at).to_pylist()], pa.bool_()))

        out = out.mapInArrow(run, out.schema)
        if block + 1 < blocks:
            out = written(out, "clean-texts")
    return out


#: DuckDB SQL of the query over ``documents`` and ``benchmark``.
SQL = r"""
with dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
iw as (select cast(item_id as varchar) as item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where text is not null and item_id is not null),
win as (select distinct item, least(len(w), 10) as n, array_to_string(w[i:i + 9], ' ') as g from (select item, w, unnest(range(1, greatest(len(w) - 8, 2))) as i from iw where len(w) > 0)),
dg as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as g from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from dw, (select distinct n from win) where len(w) >= n)),
hit as (select distinct doc_id, item, i, n from dg join win using (n, g)),
cov as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hit) group by 1),
its as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from hit) group by 1)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, n_hit is not null as contaminated
from dw left join cov using (doc_id) left join its using (doc_id)
"""
