"""Durable intermediate tables and archive folders, shared by all executors.

Everything goes below the folder named by ``spark.checkpoint.dir``. Only where a session with a local
master names none (tests, a notebook) a folder beside the local temp files is used instead; on a cluster that
is an error, since executors would not see one another's files.
"""

from __future__ import annotations

import contextlib
import ctypes
import math
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Setting by which Spark deletes the shuffle files of an execution at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of a part file of tables that hold a row for each text at most, bytes of the texts that it is made from, and
#: part files at least.
PART_ROWS = 20_000
PART_BYTES = 64_000_000
PART_FILES = 12
#: Setting of the bytes of an Arrow batch, and how many if a session names none: 10,000 long texts take much memory, on both sides.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "4m"


def shared_root(spark: SparkSession) -> str:
    """URI of the folder that driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "threadmill-shared")
    return root.rstrip("/")


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder URI below the shared root; nothing is created yet."""
    return f"{shared_root(spark)}/{kind}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def shuffles_deleted(spark: SparkSession):
    """Executions begun in here delete their shuffle files at their end.

    Otherwise these stay until the driver happens to collect its garbage.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def written(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    The result has no lineage: a lost executor costs a re-read, not a recomputation. So nothing needs the
    shuffle files of the write after it.
    """
    spark = df.sparkSession
    path = new_folder(spark, kind)
    with shuffles_deleted(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def part_files(rows: int, size: int = 0) -> int:
    """Part files of a table made from at most so many rows and bytes of text.

    On a local file system each costs three processes, and while one starts, it counts as large as the executor.
    """
    return max(PART_FILES, math.ceil(rows / PART_ROWS), math.ceil(size / PART_BYTES))


def bounded_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of the session have ``BATCH_BYTES`` about, unless it says otherwise itself."""
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, BATCH_BYTES)


_holder: dict[str, Callable[[], None]] = {}


def hold(owner: str, drop: Callable[[], object] = lambda: None) -> None:
    """What one operator keeps in a worker from task to task: when another one begins, ``drop`` is called.

    Workers live as long as their executor, so all that operators ever kept in them would add up.
    """
    if owner not in _holder:
        for x in _holder.values():
            x()
        _holder.clear()
        _holder[owner] = drop
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` returned, once nothing that reads them is left to compute."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._written_to)
        path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def realigned(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with ``keys`` derived anew, so that a join on them plans an exchange of its own.

    A join would otherwise reuse the partitioning of the aggregate that made ``df``, and adaptive
    execution splits a hot key's rows only between two plain exchanges.
    """
    kinds = dict(df.dtypes)
    empty = {"string": "", "binary": bytearray()}
    return df.withColumns({k: F.concat(k, F.lit(empty[kinds[k]])) if kinds[k] in empty else F.col(k).bitwiseXOR(F.lit(0)) for k in keys})


def file_system(uri: str):
    """``(pyarrow filesystem, path)`` of a folder URI; works on the driver and in tasks."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def task_tag() -> str:
    """A name part that no other task attempt uses."""
    from pyspark import TaskContext

    c = TaskContext.get()
    part = f"{c.partitionId():06d}" if c else "000000"
    return f"{part}-{uuid.uuid4().hex[:12]}"
