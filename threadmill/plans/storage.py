"""Queries and oracles: sources and sinks (by round trip through files) and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import manifest as m
from ..operators import materialize as z
from ..operators import privacy as p
from ..operators import sampling
from ..session import scratch, written
from ..sources import files, mbox, sinks
from ..streaming import incremental
from . import views as v

KEY = "0123456789abcdef"
MESSAGE = "message_id string, thread_id string, sender string, pos long, text string"
#: Rows of a file that is read as a whole, and steps in a training log.
FILE_ROWS = 10_000
LOG_STEPS = 50_000


def _rows(s, d):
    return v.msg(s, d)


def _text_file(s, lines: list[str]) -> str:
    """A folder with one text file of the given lines."""
    path = scratch(s, "text")
    s.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    return path


def _file(rows, key: str, times: int = 1):
    """A number for each row's file: rows of one key share it, and a file has about ``times`` FILE_ROWS."""
    return F.pmod(F.xxhash64(key), F.lit(max(1, -(-rows.count() // (times * FILE_ROWS)))))


def scan_json_dir(s, d):
    path = scratch(s, "json")
    rows = _rows(s, d)
    arrays = rows.groupBy(_file(rows, "thread_id").alias("file")).agg(F.to_json(F.collect_list(F.struct("message_id", "pos"))).alias("value"))
    arrays.repartition("file").write.option("maxRecordsPerFile", 1).partitionBy("file").text(f"{path}/a")
    return files.scan_json_dir(s, path, "message_id string, pos long", "*.txt")


def scan_jsonl_permissive(s, d):
    path = scratch(s, "jsonl")
    good = F.to_json(F.struct("message_id", "text"))
    line = F.when(F.col("pos") == 1, F.lit("{not json")).when(F.col("pos") == 2, F.lit("")).otherwise(good)
    _rows(s, d).select(line.alias("value")).write.text(path)
    return files.scan_jsonl_permissive(s, path, "message_id string, text string")


def scan_jsonl_file_atomic(s, d):
    path = scratch(s, "jsonl")
    bad = F.col("thread_id").endswith("7") & (F.col("pos") == 0)
    line = F.when(bad, F.lit("{not json")).otherwise(F.to_json(F.struct("message_id", "pos")))
    rows = _rows(s, d)
    # Threads share a file with those of the same last digit, so that a bad line costs no other thread.
    file = F.concat_ws("-", F.right("thread_id", F.lit(1)), _file(rows, "thread_id", 10))
    rows.select(file.alias("file"), line.alias("value")).repartition("file").write.partitionBy("file").text(path)
    return files.scan_jsonl_file_atomic(s, f"{path}/*", "message_id string, pos long").select("message_id", "pos")


def scan_jsonl_gz(s, d):
    path = scratch(s, "gz")
    _rows(s, d).write.option("compression", "gzip").json(path)
    return files.scan_jsonl_gz(s, path, MESSAGE)


def scan_id_list(s, d):
    path = scratch(s, "ids")
    ids = _rows(s, d).where("sender = 'system'").select(F.col("message_id").alias("id"))
    sinks.write_ids(ids, path, as_json=True)
    return files.scan_id_list(s, path)


def scan_manifest(s, d):
    path = scratch(s, "manifest")
    rows = m.assign_splits(_rows(s, d))
    entry = F.map_from_entries(F.collect_list(F.struct("message_id", F.struct("split", "thread_id"))))
    maps = rows.groupBy(_file(rows, "thread_id").alias("file")).agg(F.to_json(F.struct(F.lit(42).alias("seed"), entry.alias("assignments"))).alias("value"))
    maps.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return files.scan_manifest(s, path).select("id", "split", "thread_id")


def scan_tombstones(s, d):
    path = scratch(s, "tombstones")
    rows = _rows(s, d).where("pos = 0").select(F.to_json(F.struct(F.col("message_id"), F.lit("dsr").alias("reason"))).alias("value"))
    rows.unionByName(rows).unionByName(s.createDataFrame([("{bad",), ("",), ('{"chunk_id": "c1"}',)], "value string")).write.text(path)
    return files.scan_tombstones(s, path)


def scan_rules(s, d):
    lines = ["defaults:", "  pin: '2025-01'", "kpis:", "  backlog:  # held back", "    metric_path: 'backlog.pct'", "    threshold: 15.0", "    comparison: 'gt'", "    severity: 'warning'", "    recommended_action: |", "      severity: none", "  low:", "    metric_path: split.train", "    threshold: 75", "    comparison: lt", "    severity: critical", "notifications:", "  email:", "    to: x"]
    return files.scan_rules(s, _text_file(s, lines))


def scan_trainer_state(s, d):
    path = scratch(s, "state")
    log = F.sort_array(F.collect_list(F.struct(F.col("event_id").alias("step"), F.col("value").alias("eval_loss"))))
    # A state for each stretch of steps: one JSON document is written, and read, by one task.
    states = v.table(s, d, "events").groupBy(F.floor(F.col("event_id") / LOG_STEPS).alias("run")).agg(F.to_json(F.struct(F.lit("checkpoint-7").alias("best_model_checkpoint"), log.alias("log_history"))).alias("value"))
    states.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return files.scan_trainer_state(s, path)


def scan_eval_jsonl(s, d):
    path = scratch(s, "eval")
    _rows(s, d).select(F.col("sender").alias("subject"), F.col("text").alias("body")).write.json(path)
    return files.scan_eval_jsonl(s, path).select("text")


def doc_array_to_jsonl(s, d):
    arrays = _rows(s, d).groupBy("thread_id").agg(F.to_json(F.collect_list(F.struct("message_id", "pos"))).alias("j"))
    return files.array_to_rows(arrays, "j", "struct<message_id: string, pos: long>")


def _mailbox(s, d):
    """The turns as a mailbox in several files: headers, folded subject, a reply chain, bodies escaped."""
    path = scratch(s, "mbox")
    before = F.when(F.col("pos") > 0, F.concat(F.lit("References: <"), F.col("thread_id"), F.lit("-0@x>\n"))).otherwise(F.lit(""))
    head = F.concat(F.lit("From a@b.c Mon Jan  1 00:00:00 2024\nMessage-ID: <"), F.col("message_id"), F.lit("@x>\n"), before, F.lit("Date: Tue, 05 Mar 2024 10:00:00 +0000\nSubject: Re: Topic\n of "), F.col("thread_id"), F.lit("\n\n"), F.regexp_replace("text", "(?m)^From ", ">From "))
    _rows(s, d).select(head.alias("value")).repartition(3).write.text(path)
    return path


def scan_mbox(s, d):
    return mbox.scan_mbox(s, _mailbox(s, d), 20_000).select(F.length("raw").cast("long").alias("n"), F.regexp_extract("raw", "<([^@]+)@x>", 1).alias("message_id"))


def parse_headers(s, d):
    rows = mbox.message_rows(mbox.scan_mbox(s, _mailbox(s, d)))
    return rows.select("message_id", "thread_id", "cohort_id", "subject")


def write_sharded_jsonl(s, d):
    path = scratch(s, "shards")
    sinks.write_sharded_jsonl(_rows(s, d).select("message_id", "pos"), path, 100, ["message_id"])
    return s.read.schema("message_id string, pos long, part string").json(path)


def write_json_single(s, d):
    path = scratch(s, "single")
    sinks.write_json_single(_rows(s, d).select("message_id", "pos"), path)
    return s.read.schema("message_id string, pos long").option("multiLine", True).json(path)


def materialize_write(s, d):
    path = scratch(s, "splits")
    rows = _rows(s, d)
    sinks.materialize_write(z.route(rows, m.assign_splits(rows)).select("message_id", "split"), path, 100)
    return s.read.schema("message_id string, split string").json(path)


def write_ids(s, d):
    path = scratch(s, "ids")
    sinks.write_ids(_rows(s, d).select(F.col("message_id").alias("id")), path)
    return s.read.text(path).select(F.col("value").alias("id"))


def write_report(s, d):
    path = scratch(s, "report")
    sinks.write_report(_rows(s, d).agg(F.count("*").alias("total_rows"), F.lit(0.5).alias("contamination_pct")), path, 1.0)
    return s.read.schema("total_rows long, contamination_pct double").json(path)


def write_tombstone(s, d):
    path = scratch(s, "tombstones")
    found = _rows(s, d).where("thread_id like '%3'").select("message_id", "thread_id")
    for level in ("thread", "message"):
        sinks.write_tombstones(p.dsr_delete(found, level), path)
    return s.read.schema("level string, id string, deleted_at string, reason string").json(path)


def write_run_manifest(s, d):
    path = scratch(s, "runs")
    sinks.write_run_manifest(_rows(s, d).select(F.col("message_id").alias("id")), path, 42, 3)
    return s.read.schema("n_ids long, seed int, window int").json(path)


def vault_store(s, d):
    path = scratch(s, "vault")
    sinks.vault_store(p.vault(v.doc(s, d), "pepper", "sender"), path, KEY)
    return sinks.vault_load(s, path, KEY)


def write_append_manifest(s, d):
    path = scratch(s, "manifest")
    rows = _rows(s, d)
    first = m.assign_splits(rows.where("pos < 2"))
    sinks.append_manifest(first, path)
    held = s.read.schema(first.schema).parquet(path)
    sinks.append_manifest(written(m.assign_splits(rows, held), "new"), path)
    return s.read.schema(first.schema).parquet(path)


def write_atomic(s, d):
    """The committer makes a folder's rows visible together; overwriting replaces them together."""
    path = scratch(s, "atomic")
    for pos in (0, 1):
        _rows(s, d).where(F.col("pos") == pos).select("message_id").write.mode("overwrite").json(path)
    return s.read.schema("message_id string").json(path)


def incremental_ingest(s, d):
    source, target, mark = scratch(s, "stream"), scratch(s, "manifest"), scratch(s, "checkpoint")
    rows = _rows(s, d)
    for part in (rows.where("pos < 2"), rows.where("pos >= 2")):
        part.select("message_id", "thread_id").write.mode("append").parquet(source)
        incremental.incremental_ingest(s.readStream.schema("message_id string, thread_id string").parquet(source), target, mark).awaitTermination()
    return incremental._manifest(s, target).drop("batch")


def late_cohort(s, d):
    """Messages that come late, from an old cohort: assigned as if they had come in time."""
    o = v.ord(s, d)
    first = written(m.assign_splits(o.where("cohort >= '1998-01'")), "manifest")
    new = m.assign_splits(o, first)
    return new.select("message_id", "split")


def watch_shards(s, d):
    source, mark, target = scratch(s, "shards"), scratch(s, "checkpoint"), scratch(s, "pool")
    schema = "message_id string, shard string, pos long"
    e = v.evt(s, d).select(F.col("thread_id").alias("message_id"), "shard", "pos")

    def rebuild(rows, n):
        newest = sampling.last_n_shards(rows.select(F.col("shard").alias("modified"), F.col("shard").alias("path")), 5).select("path")
        kept = rows.join(F.broadcast(newest), F.col("shard") == newest["path"], "left_semi")
        sampling.pool_union_dedup(kept.select("message_id", "shard", "pos")).write.mode("overwrite").parquet(target)

    e.repartition(1).write.mode("append").json(source)
    incremental.watch_shards(s, source, schema, rebuild, mark).awaitTermination()
    return s.read.schema(schema).parquet(target)


def scheduled_kpis(s, d):
    source, mark, target = scratch(s, "stream"), scratch(s, "checkpoint"), scratch(s, "kpis")
    _rows(s, d).select("message_id", "thread_id").write.parquet(source)
    stream = s.readStream.schema("message_id string, thread_id string").parquet(source)
    incremental.scheduled_kpis(stream, lambda rows, n: m.manifest_stats(m.assign_splits(rows)).write.mode("overwrite").parquet(target), mark).awaitTermination()
    return s.read.schema("split string, n_rows long, n_threads long").parquet(target)


def windowed_counts(s, d):
    return incremental.windowed_counts(v.table(s, d, "events"))


QUERIES = {k: f for k, f in list(globals().items()) if callable(f) and getattr(f, "__module__", "") == __name__ and not k.startswith("_")}

_SP = v.split_case(v.bucket_100("thread_id"))
ORACLES = {
    "scan_json_dir": f"with {v.MSG} select message_id, pos from msg",
    "scan_jsonl_permissive": f"with {v.MSG} select message_id, text from msg where pos not in (1, 2)",
    "scan_jsonl_file_atomic": f"with {v.MSG} select message_id, pos from msg where thread_id not like '%7'",
    "scan_jsonl_gz": f"with {v.MSG} select * from msg",
    "scan_id_list": f"with {v.MSG} select message_id as id, row_number() over (order by message_id) - 1 as pos from msg where sender = 'system'",
    "scan_manifest": f"with {v.MSG} select message_id as id, {_SP} as split, thread_id from msg",
    "scan_tombstones": f"with {v.MSG} select 'message' as level, message_id as id from msg where pos = 0 union all select 'chunk', 'c1'",
    "scan_rules": "select 'backlog' as kpi, 'backlog.pct' as metric_path, 'gt' as comparison, 15.0::double as threshold, 'warning' as severity union all select 'low', 'split.train', 'lt', 75, 'critical'",
    "scan_trainer_state": "select 'checkpoint-7' as best_model_checkpoint, event_id as step, value as eval_loss from events",
    "scan_eval_jsonl": f"with {v.MSG} select 'Subject: ' || sender || chr(10) || chr(10) || text as text from msg",
    "doc_array_to_jsonl": f"with {v.MSG} select message_id, pos from msg",
    "parse_headers": f"with {v.MSG} select message_id || '@x' as message_id, case when pos > 0 then thread_id || '-0@x' else 'subject-' || substr(sha256('topic of ' || thread_id), 1, 16) end as thread_id, '2024-03' as cohort_id, 'Re: Topic of ' || thread_id as subject from msg",
    "scan_mbox": f"with {v.MSG} select length('Message-ID: <' || message_id || '@x>' || chr(10) || case when pos > 0 then 'References: <' || thread_id || '-0@x>' || chr(10) else '' end || 'Date: Tue, 05 Mar 2024 10:00:00 +0000' || chr(10) || 'Subject: Re: Topic' || chr(10) || ' of ' || thread_id || chr(10) || chr(10) || regexp_replace(text, '(?m)^From ', '>From ', 'g') || chr(10)) as n, message_id from msg",
    "write_sharded_jsonl": f"with {v.MSG} select message_id, pos, printf('%05d', (row_number() over (order by message_id) - 1) // 100 + 1) as part from msg",
    "write_json_single": f"with {v.MSG} select message_id, pos from msg",
    "materialize_write": f"with {v.MSG} select message_id, {_SP} as split from msg",
    "write_ids": f"with {v.MSG} select message_id as id from msg",
    "write_report": "select count(*) as total_rows, 0.5::double as contamination_pct from conversations",
    "write_tombstone": f"with {v.MSG} select distinct 'thread' as level, thread_id as id, '1970-01-01T00:00:00Z' as deleted_at, 'dsr' as reason from msg where thread_id like '%3' union all select 'message', message_id, '1970-01-01T00:00:00Z', 'dsr' from msg where thread_id like '%3'",
    "write_run_manifest": "select count(*) as n_ids, 42 as seed, 3 as window from conversations",
    "vault_store": f"with {v.DOC} select distinct 'user_' || substr(sha256(concat_ws(':', sha256('pepper'), 'email', sender)), 1, 12) as pseudonym, sender as original from doc",
    "write_append_manifest": f"with {v.MSG} select message_id, thread_id, {_SP} as split from msg",
    "write_atomic": f"with {v.MSG} select message_id from msg where pos = 1",
    "incremental_ingest": f"with {v.MSG} select message_id, thread_id, {_SP} as split from msg",
    "late_cohort": f"with {v.ORD} select message_id, {_SP} as split from ord where cohort < '1998-01'",
    "watch_shards": f"with {v.EVT}, n as (select distinct shard from evt order by 1 desc limit 5) select thread_id as message_id, shard, pos from evt where shard in (select shard from n) qualify row_number() over (partition by thread_id order by shard, pos) = 1",
    "scheduled_kpis": f"with {v.MSG} select {_SP} as split, count(*) as n_rows, count(distinct thread_id) as n_threads from msg group by 1",
    "windowed_counts": "select date_trunc('day', ts) as start, event_type, count(*) as n from events group by 1, 2",
}
