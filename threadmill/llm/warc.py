"""WARC archives as seekable Zstandard bundles.

``archive`` writes one WARC 1.1 record for each page. Records are grouped into frames of about
``FRAME_BYTES``, each an independent Zstandard frame; a bundle is a file of such frames that ends with
a seek table in a skippable frame (compressed and plain size of each frame, their number, a flag
byte and a magic number), so that any reader of seekable Zstandard can go to a frame. The
returned index maps every record identifier to bundle, frame and offset inside the plain frame; readers find the frame
by the seek table.

Of records with equal payloads, at least ``least_bytes`` long, one with the smallest id is a
``response``; the others are ``revisit`` records that name it and carry no payload. Equality is
decided by SHA-1 and length over all pages before any archive is written: digests are counted with partial
sums, and only digests that occur twice are joined back. Rows are numbered in a written table, so that
exactly one of several rows of the smallest id is the response. Identifiers of records are made from page and digest, those
of further rows of a page from the task and their place in it, so that no two are equal.

A bundle appears under its final name when complete, and only the written index refers to bundles,
so attempts that were lost or repeated leave no trace in the result.

Defined results: a null html is the empty payload; repeated rows of one id are one record each (revisits of it
where they share its payload); rows with a null id are written with the id ``null`` and never referred
to unless no other copy has an id; an empty table writes no bundle.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, file_system, new_folder, realigned, task_tag, written

#: Plain bytes in a frame, about.
FRAME_BYTES = 262_144
#: Plain bytes in a bundle, about.
BUNDLE_BYTES = 128_000_000

#: Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame for frames of (compressed, plain) sizes."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(stream, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of each frame, from the end of a bundle of ``size`` bytes."""
    stream.seek(size - 9)
    n, flag, magic = struct.unpack("<IBI", stream.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    entry = 12 if flag & 0x80 else 8
    stream.seek(size - 9 - n * entry)
    table, out, at = stream.read(n * entry), [], 0
    for i in range(n):
        packed, plain = struct.unpack_from("<II", table, i * entry)
        out.append((at, packed, plain))
        at += packed
    return out


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _uuid(name: str) -> str:
    h = hashlib.sha1(f"threadmill:{name}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-8{h[17:20]}-{h[20:32]}>"


def record(page, name: str, url: str | None, payload: bytes, digest: str, refers: tuple | None = None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC record of the given identifier; a revisit if ``refers`` (page and identifier of the response) is given."""
    clean = (url or "").replace("\r", "%0D").replace("\n", "%0A").replace(" ", "%20")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}", f"WARC-Target-URI: {clean}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"X-Page-Id: {'null' if page is None else page}"]
    block = http + payload
    if refers:
        block = http
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {refers[1]}", f"X-Refers-To-Page-Id: {'null' if refers[0] is None else refers[0]}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``."""
    cut = data.index(b"\r\n\r\n", at)
    first, *rest = data[at:cut].decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record here")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in rest)
    end = cut + 4 + int(headers["Content-Length"])
    return headers, data[cut + 4 : end], end + 4


class _Bundle:
    """Bundles of one task: frames are compressed as they fill."""

    def __init__(self, folder: str, level: int):
        import zstandard

        self.fs, self.folder = file_system(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.packer = zstandard.ZstdCompressor(level=level)
        self.out = None

    def _open(self) -> None:
        self.name, self.plain = f"bundle-{task_tag()}.warc.zst", 0
        self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}.part")
        self.frames: list[tuple[int, int]] = []
        self.frame, self.size = [], 0

    def add(self, data: bytes) -> list:
        """Append a record; its index entry: bundle, frame, offset in the plain frame, bytes."""
        if self.out is None:
            self._open()
        entry = [self.name, len(self.frames), self.size, len(data)]
        self.frame.append(data)
        self.size += len(data)
        if self.size >= FRAME_BYTES:
            self._flush()
            if self.plain >= BUNDLE_BYTES:
                self.close()
        return entry

    def _flush(self) -> None:
        if self.frame:
            plain = b"".join(self.frame)
            packed = self.packer.compress(plain)
            self.out.write(packed)
            self.frames.append((len(packed), len(plain)))
            self.plain += len(plain)
            self.frame, self.size = [], 0

    def close(self) -> None:
        if self.out is not None:
            self._flush()
            self.out.write(seek_table(self.frames))
            self.out.close()
            self.fs.move(f"{self.folder}/{self.name}.part", f"{self.folder}/{self.name}")
            self.out = None


def _packed_payloads(pages: DataFrame, html: str, key: str, url: str) -> DataFrame:
    """``_row``, ``_id``, ``_url``, SHA-1 ``_digest`` (hex), ``_size`` and the packed payload of every page."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            data = [(t or "").encode("utf-8", "surrogatepass") for t in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([hashlib.sha1(d).hexdigest() for d in data], pa.string()), pa.array(list(map(len, data)), pa.int64()), pa.array([pack(d) for d in data], pa.binary())],
                ["_row", "_id", "_url", "_digest", "_size", "_packed"],
            )

    return pages.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_id"), F.col(url).alias("_url"), F.col(html).alias("_html")).mapInArrow(run, f"_row long, _id {kind}, _url string, _digest string, _size long, _packed binary")


def archive(pages: DataFrame, folder: str, html: str = "html", key: str = "page_id", url: str = "url", least_bytes: int = 0, level: int = 3) -> DataFrame:
    """Write the archives; the index: ``record_id``, ``page_id`` (text), ``bundle``, ``frame``,
    ``record_offset`` (in the plain frame), ``record_bytes``."""
    rows = written(_packed_payloads(pages, html, key, url), "payloads")
    # Digests that occur more than once, with the row and the id of the response.
    least = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"))).alias("_of")
    twice = rows.where(F.col("_size") >= least_bytes).groupBy("_digest", "_size").agg(least, F.count("*").alias("_n")).where("_n > 1").select("_digest", "_size", F.col("_of.id").alias("_first"), F.col("_of.row").alias("_first_row"))
    made = rows.join(realigned(twice, "_digest"), ["_digest", "_size"], "left")
    names = ["record_id", "page_id", "bundle", "frame", "record_offset", "record_bytes"]
    at = ("_row", "_id", "_url", "_digest", "_size", "_packed", "_first", "_first_row")

    def run(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        bundle, tag, done = _Bundle(folder, level), task_tag(), []
        for b in batches:
            for row, page, link, digest, size, packed, first, first_row in zip(*(b.column(i).to_pylist() for i in range(len(at)))):
                name = _uuid(f"{page}:{digest}")
                refers = None
                if first_row is not None and first_row != row:
                    refers = first, _uuid(f"{first}:{digest}")
                if refers or size < least_bytes:
                    name = _uuid(f"{page}:{digest}:{tag}:{len(done)}")
                data = record(page, name, link, unpack(packed), base64.b32encode(bytes.fromhex(digest)).decode(), refers)
                done.append((name, None if page is None else str(page), *bundle.add(data)))
        bundle.close()  # rows leave the task when all their bundles are complete
        for i in range(0, len(done), 10_000):
            kinds = [pa.string(), pa.string(), pa.string(), *[pa.int64()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done[i : i + 10_000]), kinds)], names)

    index = written(made.select(*at).mapInArrow(run, "record_id string, page_id string, bundle string, frame long, record_offset long, record_bytes long"), "warc-index")
    discard(rows)
    return index


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Read the records of an index back: frames are found by the seek table of their bundle, each is fetched once by a range read.

    ``page_id`` (text), ``record_type``, ``payload_bytes``, ``payload_digest``, ``refers_to`` (text), ``record_id``. The
    payload of a response is hashed again and must match its header.
    """
    schema = "page_id string, record_type string, payload_bytes long, payload_digest string, refers_to string, record_id string"

    def run(batches):
        import zstandard

        fs, path = file_system(folder)
        unpack = zstandard.ZstdDecompressor().decompress
        name, stream, frames, where, plain = None, None, [], None, b""
        for b in batches:
            out = []
            for bundle, frame, at, length, wanted in zip(*(b.column(i).to_pylist() for i in range(5))):
                if bundle != name:
                    if stream is not None:
                        stream.close()
                    name, stream, where = bundle, fs.open_input_file(f"{path}/{bundle}"), None
                    frames = read_seek_table(stream, stream.size())
                if frame != where:
                    offset, size, plain_size = frames[frame]
                    stream.seek(offset)
                    plain, where = unpack(stream.read(size)), frame
                    if len(plain) != plain_size:
                        raise ValueError(f"frame {frame} of {bundle} has {len(plain)} bytes, not {plain_size}")
                headers, block, end = parse_record(plain, at)
                if end != at + length or headers["WARC-Record-ID"] != wanted:
                    raise ValueError(f"record {wanted} of {length} bytes is not at {at} in {bundle}")
                cut = block.index(b"\r\n\r\n") + 4
                http = dict(x.split(": ", 1) for x in block[: cut - 4].decode().split("\r\n")[1:])
                digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
                if kind == "response" and (base32_sha1(block[cut:]) != digest or len(block) - cut != int(http["Content-Length"])):
                    raise ValueError(f"payload of {wanted} does not match its digest")
                page, first = (None if x == "null" else x for x in (headers["X-Page-Id"], headers.get("X-Refers-To-Page-Id")))
                out.append((page, kind, int(http["Content-Length"]), digest, first, wanted))
            if out:
                kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "record_id"])

    by = index.select("bundle", "frame", "record_offset", "record_bytes", "record_id")
    run_of = F.floor(F.col("frame") / 16)
    placed = by.repartition("bundle", run_of).sortWithinPartitions("bundle", "frame", "record_offset")
    return placed.mapInArrow(run, schema)


def round_trip(pages: DataFrame, html: str = "html", key: str = "page_id", url: str = "url", least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write every page as a WARC record, read the archives back, one row per page."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    kind = pages.schema[key].dataType
    back = read_records(archive(pages, folder, html, key, url, least_bytes), folder)
    return back.select(F.col("page_id").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


#: DuckDB SQL of ``round_trip`` over the table ``pages``: base32 takes five hexadecimal digits for four of its own.
SQL = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
n as (select *, row_number() over (partition by html order by page_id) as place, min(page_id) over (partition by html) as least from p)
select page_id, octet_length(encode(html)) as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((cast('0x' || substr(h, cast((i // 4) * 5 + 1 as integer), 5) as bigint) >> (15 - 5 * (i % 4))) & 31 as integer) + 1, 1)), '') as payload_digest,
  case when place = 1 then 'response' else 'revisit' end as record_type, case when place > 1 then least end as refers_to
from n
"""
