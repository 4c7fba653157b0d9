"""Media columns: content-addressed PNG payloads in tar shards, referred to by rows.

``store`` writes each payload as a lossless 8-bit grey PNG (64 samples a line) into tar shards, one
shard at a time in each task, and returns ``(key, digest, shard, offset, length)`` rows: the member
name is the SHA-256 of the stored bytes, a digest is stored once in a task's shards, and over all
tasks every row of one digest is pointed at the same copy. Shards appear under their final name only
when complete; the rows of an attempt that was lost point nowhere, since only the written index
counts. ``headers`` fills width, height and depth from the first 33 bytes of each member by range
reads; ``payloads`` reads members whole and undoes the PNG.

Defined results: a null text is stored as the empty text (one line of zeros); equal texts share a
digest and its place; an empty table writes no shard.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import file_system, new_folder, realigned, task_tag, written

#: Samples in a line; payloads are padded with zeros to a positive multiple of it.
WIDTH = 64
#: Bytes in a shard before a task opens the next.
SHARD_BYTES = 64_000_000
#: Distance between two members up to which one range read takes both.
GAP_BYTES = 65_536

_MAGIC = bytes([137, 80, 78, 71, 13, 10, 26, 10])


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes, level: int = 4) -> bytes:
    """A grey 8-bit PNG of the payload, ``WIDTH`` samples a line, each line unfiltered."""
    lines = len(payload) // WIDTH
    rows = b"".join(b"\0" + payload[i : i + WIDTH] for i in range(0, len(payload), WIDTH))
    return _MAGIC + _chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, lines, 8, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(rows, level)) + _chunk(b"IEND", b"")


def png_header(first: bytes) -> tuple[int, int, int]:
    """Width, height and bits a sample, of a PNG's first 33 bytes."""
    if first[:8] != _MAGIC or first[12:16] != b"IHDR" or zlib.crc32(first[12:29]) != struct.unpack(">I", first[29:33])[0]:
        raise ValueError("not a PNG header")
    return struct.unpack(">IIB", first[16:25])


def from_png(png: bytes) -> bytes:
    """The samples of a PNG that ``to_png`` wrote."""
    width, height, bits = png_header(png)
    at, data = 8, []
    while at < len(png):
        (n,), kind = struct.unpack(">I", png[at : at + 4]), png[at + 4 : at + 8]
        if kind == b"IDAT":
            data.append(png[at + 8 : at + 8 + n])
        at += 12 + n
    rows = zlib.decompress(b"".join(data))
    if bits != 8 or len(rows) != height * (width + 1):
        raise ValueError("not a grey 8-bit PNG")
    return b"".join(rows[i + 1 : i + 1 + width] for i in range(0, len(rows), width + 1))


def padded(data: bytes) -> bytes:
    """``data`` with zeros up to a positive multiple of ``WIDTH``."""
    return data + bytes(-len(data) % WIDTH if data else WIDTH)


class _Shards:
    """Tar shards of one task."""

    def __init__(self, folder: str):
        self.fs, self.folder = file_system(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.out, self.name, self.size = None, "", 0
        self.seen: dict[bytes, tuple[str, int, int]] = {}

    def add(self, digest: bytes, data: bytes) -> tuple[str, int, int]:
        if digest in self.seen:
            return self.seen[digest]
        if self.out is None:
            self.name, self.size = f"shard-{task_tag()}.tar", 0
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}.part")
        info = tarfile.TarInfo(digest.hex() + ".png")
        info.size = len(data)
        self.out.write(info.tobuf(tarfile.USTAR_FORMAT))
        self.out.write(data)
        self.out.write(bytes(-len(data) % 512))
        self.seen[digest] = place = (self.name, self.size + 512, len(data))
        self.size += 512 + len(data) + -len(data) % 512
        if self.size >= SHARD_BYTES:
            self.close()
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.write(bytes(1024))
            self.out.close()
            self.fs.move(f"{self.folder}/{self.name}.part", f"{self.folder}/{self.name}")
            self.out = None


def store(df: DataFrame, folder: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Write the payload of every row to tar shards in ``folder``; the index rows.

    ``key``, ``n_bytes``, ``digest`` (hex SHA-256 of the stored bytes), ``shard``, ``offset``, ``length``.
    """
    kind = df.schema[key].dataType.simpleString()
    names = [key, "n_bytes", "digest", "shard", "offset", "length"]

    def run(batches):
        shards, held = _Shards(folder), []
        for b in batches:
            rows = []
            for t in b.column(1).to_pylist():
                data = (t or "").encode("utf-8", "surrogatepass")
                png = to_png(padded(data))
                digest = hashlib.sha256(png).digest()
                rows.append((len(data), digest.hex(), *shards.add(digest, png)))
            held.append((b.column(0), rows))
        shards.close()  # rows leave the task when all their shards are complete
        for keys, rows in held:
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([keys, pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())], names)

    rows = written(df.select(key, F.col(text).alias("_text")).mapInArrow(run, f"`{key}` {kind}, n_bytes long, digest string, shard string, offset long, length long"), "media-index")
    # Copies of other tasks: every row of a digest refers to one place.
    place = rows.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("p"))
    return rows.select(key, "n_bytes", "digest").join(realigned(place, "digest"), "digest").select(key, "n_bytes", "digest", "p.shard", "p.offset", "p.length")


def _ranges(stream_of, rows, size_of):
    """(row, bytes) of ``rows`` (shard, offset, length, ...) in order; near members share a read."""
    at = 0
    while at < len(rows):
        shard, start = rows[at][0], rows[at][1]
        end, to = start + size_of(rows[at]), at + 1
        while to < len(rows) and rows[to][0] == shard and rows[to][1] - end <= GAP_BYTES and rows[to][1] - start < 8_000_000:
            end, to = max(end, rows[to][1] + size_of(rows[to])), to + 1
        stream = stream_of(shard)
        stream.seek(start)
        data = stream.read(end - start)
        for r in rows[at:to]:
            yield r, data[r[1] - start : r[1] - start + size_of(r)]
        at = to


def _opener(folder: str):
    fs, path = file_system(folder)
    opened: dict = {}

    def stream(shard: str):
        if shard not in opened:
            for old in opened.values():
                old.close()
            opened.clear()
            opened[shard] = fs.open_input_file(f"{path}/{shard}")
        return opened[shard]

    return stream


def read_back(places: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """Metadata columns of distinct places (``digest``, ``shard``, ``offset``, ``length``).

    Header-only range reads give ``width``, ``height``, ``bits``; with ``payload`` the members are
    read whole as well: ``payload_bytes``, ``payload_sha256``, ``tail_crc32``, ``media_sha256``.
    """
    schema = "digest string, media_bytes long, width int, height int, bits int"
    if payload:
        schema += ", payload_bytes long, payload_sha256 string, tail_crc32 long, media_sha256 string"

    def run(batches):
        stream = _opener(folder)
        for b in batches:
            rows = sorted(zip(*(b.column(i).to_pylist() for i in (1, 2, 3, 0))))
            head = {r: png_header(data) for r, data in _ranges(stream, rows, lambda r: 33)}
            out = []
            for r, png in _ranges(stream, rows, lambda r: r[2]) if payload else ((r, b"") for r in rows):
                line = [r[3], r[2], *head[r]]
                if payload:
                    data = from_png(png)
                    line += [len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]), hashlib.sha256(png).hexdigest()]
                out.append(line)
            if out:
                kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string()]
                names = ["digest", "media_bytes", "width", "height", "bits", "payload_bytes", "payload_sha256", "tail_crc32", "media_sha256"]
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names[: len(cols)])

    # Members that lie together are read together: whole runs of a shard go to one task.
    run_of = F.floor(F.col("offset") / 4_000_000)
    placed = places.select("digest", "shard", "offset", "length").repartition("shard", run_of).sortWithinPartitions("shard", "offset")
    return placed.mapInArrow(run, schema)


def media_columns(df: DataFrame, text: str = "text", key: str = "doc_id", folder: str | None = None) -> DataFrame:
    """Store every text as media, read the store back, and describe it.

    ``key``, ``n_bytes``, ``payload_bytes``, ``payload_sha256``, ``tail_crc32``, ``media_bytes``,
    ``media_sha256``, ``feature`` (what the header says), ``shard``, ``offset``.
    """
    folder = folder or new_folder(df.sparkSession, "media")
    index = written(store(df, folder, text, key), "media-places")
    places = index.groupBy("digest").agg(F.first("shard").alias("shard"), F.first("offset").alias("offset"), F.first("length").alias("length"))
    facts = written(read_back(places, folder), "media-facts")
    feature = F.format_string("png %dx%d grey%d", "width", "height", "bits")
    return index.join(facts, "digest").select(key, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"), "shard", "offset")
