"""JSON, id list, manifest and rule sources."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import written


def scan_json_dir(spark: SparkSession, path: str, schema: StructType | str | None = None, pattern: str = "*.json") -> DataFrame:
    """All files of a name pattern below a folder; each holds an object or an array of them."""
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return (reader.schema(schema) if schema else reader).json(path)


def scan_jsonl_permissive(spark: SparkSession, path: str, schema: StructType | str, corrupt: bool = False) -> DataFrame:
    """JSON lines; blank lines are skipped, malformed ones too (or kept in ``_corrupt_record``)."""
    full = StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))
    full = StructType([*full.fields]).add("_corrupt_record", "string")
    lines = spark.read.text(path).where(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    rows = lines.select(F.from_json("value", full, options).alias("_j")).select("_j.*")
    bad = F.col("_corrupt_record").isNotNull()
    return rows.where(bad) if corrupt else rows.where(~bad).drop("_corrupt_record")


def scan_jsonl_file_atomic(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines of the files in which every line is well formed, with ``file_path`` and ``modified``."""
    full = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = full.fieldNames()
    full = StructType([*full.fields]).add("_corrupt_record", "string")
    rows = spark.read.schema(full).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    rows = rows.select(*names, "_corrupt_record", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_modification_time").alias("modified"))
    rows = written(rows, "parsed")  # a file is parsed once, and every column of it
    bad = rows.where("_corrupt_record is not null").select("file_path").distinct()
    return rows.join(bad, "file_path", "left_anti").select(*names, "file_path", "modified")


def scan_jsonl_gz(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """``*.json``, ``*.jsonl`` and ``*.jsonl.gz`` files of a folder, a record a line."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.{json,jsonl,json.gz,jsonl.gz}").json(path)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scan_id_list(spark: SparkSession, path: str) -> DataFrame:
    """``id``, ``pos`` of a JSON array of ids or a list of lines; a missing file is an empty list."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "id string, pos long")
    whole = spark.read.text(path, wholetext=True).select(F.trim(F.regexp_replace("value", r"^[ \t\r\n]+|[ \t\r\n]+$", "")).alias("v"))
    ids = F.when(F.col("v").startswith("["), F.from_json("v", "array<string>")).otherwise(F.split("v", r"\r?\n"))
    return whole.select(F.posexplode(ids).alias("pos", "id")).select(F.trim("id").alias("id"), F.col("pos").cast("long").alias("pos")).where("id is not null and id <> ''")


def scan_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``id``, ``split``, ``thread_id``, ``window_idx`` of a manifest map, with or without an envelope."""
    entry = "map<string, struct<split: string, thread_id: string, window_idx: int>>"
    whole = spark.read.text(path, wholetext=True)
    inner = F.coalesce(F.get_json_object("value", "$.assignments"), F.col("value"))
    rows = whole.select(F.explode(F.from_json(inner, entry)).alias("id", "e"))
    return rows.where("e.split is not null").select("id", F.when(F.col("e.split") == "validation", "val").otherwise(F.col("e.split")).alias("split"), "e.thread_id", "e.window_idx")


def scan_tombstones(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ``id`` of a tombstone file of chunk, message or thread ids; a missing file is empty."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "level string, id string")
    rows = scan_jsonl_permissive(spark, path, "chunk_id string, message_id string, thread_id string")
    pairs = F.array(*[F.struct(F.lit(k).alias("level"), F.col(f"{k}_id").alias("id")) for k in ("chunk", "message", "thread")])
    return rows.select(F.explode(pairs).alias("p")).select("p.*").where("id is not null").distinct()


def scan_trainer_state(spark: SparkSession, path: str) -> DataFrame:
    """``step``, ``eval_loss`` of a training log, with the recorded ``best_model_checkpoint``."""
    schema = "best_model_checkpoint string, best_metric double, log_history array<struct<step: long, eval_loss: double>>"
    return spark.read.schema(schema).option("multiLine", True).json(path).select("best_model_checkpoint", F.explode("log_history").alias("h")).select("best_model_checkpoint", "h.step", "h.eval_loss")


def scan_eval_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """``subject``, ``body`` and the evaluated ``text``."""
    from ..functions import text

    rows = scan_jsonl_permissive(spark, path, "subject string, body string")
    return rows.withColumn("text", text.eval_text(F.col("subject"), F.col("body")))


def array_to_rows(rows: DataFrame, column: str, schema: str) -> DataFrame:
    """Elements of JSON arrays as rows."""
    return rows.select(F.explode(F.from_json(column, f"array<{schema}>")).alias("_e")).select("_e.*")


def parse_rules(source: str) -> list[dict]:
    """Alert rules of a file of nested ``key: value`` lines (the subset of YAML that rules use) or of JSON."""
    if source.lstrip().startswith("{"):
        kpis = json.loads(source)["kpis"]
        return [{"kpi": k, **v} for k, v in kpis.items()]
    rules, inside, skip = [], False, None
    for line in source.splitlines():
        bare = line.split(" #")[0].rstrip()
        depth = len(bare) - len(bare.lstrip())
        if not bare.strip() or bare.lstrip().startswith("#"):
            continue
        if skip is not None and depth > skip:
            continue
        skip = None
        key, _, value = bare.strip().partition(":")
        value = value.strip().strip("'\"")
        if depth == 0:
            inside = key == "kpis"
        elif inside and depth == 2:
            rules.append({"kpi": key})
        elif inside and rules:
            if value in ("|", ">"):
                skip = depth
            else:
                rules[-1][key] = float(value) if key == "threshold" else value
    return rules


def scan_rules(spark: SparkSession, path: str) -> DataFrame:
    """``kpi``, ``metric_path``, ``comparison`` (gt if absent), ``threshold``, ``severity`` of a rule file."""
    source = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    rows = [(r["kpi"], r.get("metric_path"), r.get("comparison", "gt"), r.get("threshold"), r.get("severity")) for r in parse_rules(source)]
    return spark.createDataFrame(rows, "kpi string, metric_path string, comparison string, threshold double, severity string")
