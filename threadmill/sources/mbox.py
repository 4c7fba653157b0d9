"""Mailboxes as a Spark data source: ``spark.read.format("mbox").load(path)``.

A line that starts with ``From `` opens a message; the line itself, and text before the first one, is
dropped. Files are read in byte ranges: a task takes the messages whose opening line starts in its
range and reads on to the end of the last, so that one file of any size is read by many tasks.
"""

from __future__ import annotations

import email
import email.policy
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

RANGE_BYTES = 64_000_000
_BLOCK = 1 << 20


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


def _open(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        if path.startswith("file:"):
            return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def messages_in(stream, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, raw bytes) of the messages whose opening line starts in [start, end)."""
    stream.seek(max(start - 1, 0))
    held, base = b"", max(start - 1, 0)
    current: list[bytes] | None = None
    at, done = base, False
    # What precedes the first line start belongs to the range before.
    skip = start > 0
    while not done:
        block = stream.read(_BLOCK)
        held += block
        lines = held.split(b"\n")
        held = lines.pop() if block else b""
        for i, line in enumerate(lines):
            whole = line + (b"\n" if block or i + 1 < len(lines) else b"")
            if skip:
                skip = False
            elif line.startswith(b"From "):
                if current is not None:
                    yield opened, b"".join(current)
                if at >= end:
                    current, done = None, True
                    break
                current, opened = [], at
            elif current is not None:
                current.append(whole)
            elif at >= end:
                done = True
                break
            at += len(whole)
        if not block:
            break
    if current is not None:
        yield opened, b"".join(current)


class MboxReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("rangebytes") or options.get("rangeBytes") or RANGE_BYTES)

    def partitions(self):
        from pyarrow import fs

        system, path = _open(self.path)
        info = system.get_file_info(path)
        files = [info] if info.type == fs.FileType.File else sorted((f for f in system.get_file_info(fs.FileSelector(path, recursive=True)) if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))), key=lambda f: f.path)
        return [_Range(f.path, at, min(at + self.size, f.size)) for f in files for at in range(0, f.size, self.size)]

    def read(self, part):
        system, _ = _open(self.path)
        modified = system.get_file_info(part.path).mtime
        with system.open_input_file(part.path) as stream:
            for at, raw in messages_in(stream, part.start, part.end):
                yield part.path, at, modified, raw.decode("utf-8", "replace")


class MboxSource(DataSource):
    @classmethod
    def name(cls):
        return "mbox"

    def schema(self):
        return "path string, offset long, modified timestamp, raw string"

    def reader(self, schema):
        return MboxReader(self.options)


def scan_mbox(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path``, ``offset``, ``modified`` and ``raw`` of every message of a mailbox file or folder."""
    spark.dataSource.register(MboxSource)
    return spark.read.format("mbox").option("rangeBytes", str(range_bytes)).load(path)


def _text(value) -> str | None:
    return None if value is None else str(value)


def parsed(raw: str) -> tuple:
    """message_id, references, in_reply_to, subject, sender, date, body of one message."""
    m = email.message_from_string(raw, policy=email.policy.default)

    def header(name: str) -> str | None:
        try:
            return _text(m[name])
        except Exception:  # a header that its own parser rejects
            return None

    def ids(value: str | None) -> list[str]:
        return [x.strip("<>") for x in (value or "").split() if x.strip("<>")]

    try:
        body = m.get_body(("plain", "html"))
        body = None if body is None else body.get_content()
    except Exception:
        body = None
    if body is None:
        body = raw.split("\n\n", 1)[1] if "\n\n" in raw else ""
    try:
        date = m["Date"].datetime
    except Exception:
        date = None
    first = lambda name: next(iter(ids(header(name))), None)
    return first("Message-ID"), ids(header("References")), first("In-Reply-To"), header("Subject"), header("From"), date, body


def parse_headers(messages: DataFrame, raw: str = "raw") -> DataFrame:
    """``messages`` with header columns and ``body``, read by the standard mail parser in Arrow batches."""
    from datetime import timezone

    names = ["message_id", "references", "in_reply_to", "subject", "sender", "date", "body"]
    fields = "message_id string, references array<string>, in_reply_to string, subject string, sender string, date timestamp, body string"
    at = messages.columns.index(raw)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in messages.schema)

    def run(batches):
        for b in batches:
            rows = [parsed(r or "") for r in b.column(at).to_pylist()]
            cols = [list(c) for c in zip(*rows)] or [[] for _ in names]
            cols[5] = [None if d is None else (d if d.tzinfo else d.replace(tzinfo=timezone.utc)) for d in cols[5]]
            types = [pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string(), pa.timestamp("us", "UTC"), pa.string()]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, t) for c, t in zip(cols, types))], [*b.schema.names, *names])

    return messages.mapInArrow(run, f"{kinds}, {fields}")


def message_rows(messages: DataFrame, cohort: str | None = None) -> DataFrame:
    """``message_id``, ``thread_id``, ``cohort_id``, ``sender``, ``subject``, ``date``, ``email_message`` of a scanned mailbox."""
    from ..functions import text

    m = parse_headers(messages)
    id_ = text.message_id_or_synth(F.col("message_id"), F.col("raw"))
    thread = text.derive_thread_id(F.col("references"), F.col("in_reply_to"), F.col("subject"), id_)
    return m.select(id_.alias("message_id"), thread.alias("thread_id"), text.stamp_cohort(F.col("date"), F.col("modified"), cohort).alias("cohort_id"), "sender", "subject", "date", F.col("raw").alias("email_message"))
