"""Sessions: settings for this engine, and making the package importable on executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Settings a new session gets; adaptive execution sizes partitions and splits skewed joins.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Setting by which Spark deletes the shuffle files of an execution at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def session(master: str | None = None, **settings: str) -> SparkSession:
    """A session with this engine's settings; ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName("threadmill").config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each session's context.

    A session that left the size of Arrow batches at its default gets that of ``SETTINGS``: batches of 10,000
    long texts take much memory in each worker.
    """
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, SETTINGS[BATCH])
    context = spark.sparkContext
    if getattr(context, "_threadmill_shipped", False):
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="threadmill-")).resolve() / "threadmill.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    context.addPyFile(str(target))
    context._threadmill_shipped = True


def scratch(spark: SparkSession, kind: str) -> str:
    """A fresh folder below the folder that driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + os.path.join(tempfile.gettempdir(), "threadmill-shared")
    return f"{root.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: no lineage, no recomputation.

    So nothing needs the shuffle files of the write after it, and they are deleted with it.
    """
    spark = df.sparkSession
    path, before = scratch(spark, kind), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` returned, once nothing that reads them is left to compute."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._written_to)
        path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
