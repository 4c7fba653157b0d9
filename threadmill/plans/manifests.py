"""Queries and oracles: hashing, manifests, materialisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing
from ..operators import manifest as m
from ..operators import materialize as z
from ..session import written
from . import views as v

B = v.bucket_100("thread_id")
SPLIT = v.split_case(B)
MAN = f"man as (select message_id, thread_id, {SPLIT} as split from msg)"
OMAN = f"oman as (select message_id, thread_id, cohort, ts, {SPLIT} as split from ord)"
PIN = "1999-12"
EXC = "exc as (select cast(doc_id as varchar) as id from labels where toxic = 1)"
TOMB = "tomb as (select distinct cast(doc_id as varchar) as id from labels where quality = 0)"


def _orders_manifest(s, d):
    o = v.ord(s, d)
    return m.assign_splits(o).join(o.select("message_id", "cohort", "ts"), "message_id")


def _excluded(s, d):
    return v.table(s, d, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("id"))


def _tombstones(s, d):
    return v.table(s, d, "labels").where("quality = 0").select(F.lit("message").alias("level"), F.col("doc_id").cast("string").alias("id")).distinct()


def _grown(s, d):
    """A manifest made when only the first turns were there, then the rest comes with another seed."""
    rows = v.msg(s, d)
    old = written(m.assign_splits(rows.where("pos < 2")), "manifest")
    return old, m.assign_splits(rows, old, seed=7)


def hash_bucket_100(s, d):
    return v.msg(s, d).select("thread_id").distinct().select("thread_id", hashing.hash_bucket_100(F.col("thread_id"), 42).alias("bucket"))


def hash_bucket_spec(s, d):
    return v.msg(s, d).select("thread_id").distinct().select("thread_id", hashing.hash_bucket_spec(F.col("thread_id"), 42).alias("bucket"))


def hash_bucket_1000(s, d):
    return v.ord(s, d).select("thread_id").distinct().select("thread_id", hashing.hash_bucket_1000(F.col("thread_id"), 42).alias("bucket"))


def seed_int(s, d):
    return v.msg(s, d).select("message_id", hashing.seed_int(42, 3, F.col("message_id")).alias("seed32"), hashing.seed_int(42, 3, F.col("message_id"), 31).alias("seed31"))


def assign_splits(s, d):
    return m.assign_splits(v.msg(s, d))


def assign_splits_growth(s, d):
    return _grown(s, d)[1]


def append_manifest(s, d):
    return m.append_manifest(*_grown(s, d))


def thread_windows(s, d):
    return m.thread_windows(v.msg(s, d), 4, 1)


def thread_windows_orders(s, d):
    return m.thread_windows(v.ord(s, d), 5, 2)


def window_members(s, d):
    return m.window_members(v.msg(s, d), 4, 1)


def message_windows(s, d):
    return m.message_windows(v.msg(s, d), 4, 1)


def quota_assign(s, d):
    return m.quota_assign(v.ord(s, d), (0.7, 0.1))


def window_coverage_gap(s, d):
    rows = v.msg(s, d)
    return m.window_coverage_gap(m.thread_windows(rows.where("pos < 3"), 4, 1), rows)


def manifest_stats(s, d):
    return m.manifest_stats(m.assign_splits(v.ord(s, d)))


def thread_stats(s, d):
    return m.thread_stats(v.msg(s, d))


def cohort_list(s, d):
    return m.cohort_list(v.ord(s, d))


def ordered_cohorts(s, d):
    return m.ordered_cohorts(v.ord(s, d))


def thread_split_violations(s, d):
    rows = v.msg(s, d).select("message_id", "thread_id", hashing.split_of(hashing.hash_bucket_100(F.col("message_id"), 42)).alias("split"))
    return m.thread_split_violations(rows)


def split_overlap(s, d):
    rows = m.assign_splits(v.msg(s, d))
    return m.split_overlap(rows.unionByName(rows.where("thread_id < '2'").withColumn("split", F.lit("test"))))


def manifest_diff(s, d):
    before = m.assign_splits(v.msg(s, d))
    return m.manifest_diff(before, m.assign_splits(v.msg(s, d), seed=7))


def pin_filter(s, d):
    return z.pin_filter(v.ord(s, d), PIN).select("message_id", "cohort")


def pinned_out(s, d):
    return z.pinned_out(v.ord(s, d), PIN).select("message_id", "cohort")


def nil_cohort_count(s, d):
    return z.nil_cohort_count(v.ord(s, d).withColumn("cohort", F.when(F.col("sender") != "1-URGENT", F.col("cohort"))))


def exclude_anti(s, d):
    return z.exclude_anti(v.doc(s, d), _excluded(s, d), "message_id").select("message_id", "sender", "length")


def tombstone_anti(s, d):
    return z.tombstone_anti(v.doc(s, d), _tombstones(s, d)).select("message_id", "length")


def split_in(s, d):
    return z.split_in(m.assign_splits(v.msg(s, d)), "validation", "test")


def train_only(s, d):
    return z.train_only(m.assign_splits(v.msg(s, d)))


def window_split_filter(s, d):
    rows = m.message_windows(v.msg(s, d), 4, 1).join(m.assign_splits(v.msg(s, d)).drop("thread_id"), "message_id")
    return z.window_split_filter(rows, "1", "train").select("message_id", "window_idx", "split")


def since_filter(s, d):
    return z.since_filter(v.ord(s, d), "2000-01-01").select("message_id", "ts")


def thread_recency_filter(s, d):
    return z.thread_recency_filter(v.ord(s, d), "2001-06-01").select("message_id", "thread_id")


def doc_last_active(s, d):
    return z.last_active(v.ord(s, d)).select("message_id", "last_active")


def route_join(s, d):
    rows = v.msg(s, d)
    return z.route(rows, m.assign_splits(rows.where("sender <> 'system'"))).select("message_id", "split")


def materialize_counts(s, d):
    return z.materialize_counts(route_join(s, d))


def train_semi(s, d):
    rows = m.assign_splits(v.msg(s, d))
    return z.train_semi(v.msg(s, d), z.train_only(rows)).select("message_id", "sender")


def past_train_anti(s, d):
    rows = m.assign_splits(v.msg(s, d))
    return z.past_train_anti(rows, v.msg(s, d).where("pos >= 4"))


def length_join(s, d):
    return z.length_join(v.doc(s, d).select("message_id"), v.doc(s, d)).select("message_id", "length")


def shard_number(s, d):
    return z.shard_number(v.ord(s, d), 1000, ["ts", "message_id"]).select("message_id", "position", "shard")


def split_distribution(s, d):
    return z.split_distribution(_orders_manifest(s, d), PIN)


def exclusion_backlog(s, d):
    listed = v.ord(s, d).where("message_id like '%7'").select(F.col("message_id").alias("id"))
    return z.exclusion_backlog(v.ord(s, d), listed, PIN)


def corpus_concat(s, d):
    rows = m.assign_splits(v.msg(s, d))
    return z.corpus_concat(*[z.split_in(rows, x) for x in ("train", "val", "test")])


def doc_consolidate_shards(s, d):
    rows = m.message_windows(v.msg(s, d), 4, 1).join(m.assign_splits(v.msg(s, d)).drop("thread_id"), "message_id")
    return z.consolidate_shards(rows, 2).select("message_id", "window_idx")


def frozen_manifest(s, d):
    """Flagship: split every thread, cut windows, and count both by split."""
    rows = v.msg(s, d)
    windows = m.thread_windows(rows, 4, 1)
    splits = m.assign_splits(rows).select("thread_id", "split").distinct()
    return windows.join(splits, "thread_id").groupBy("split").agg(F.count("*").alias("n_windows"), F.count_distinct("thread_id").alias("n_threads"), F.sum(F.col("window_end") - F.col("window_start")).alias("n_slots"))


QUERIES = {k: f for k, f in list(globals().items()) if callable(f) and getattr(f, "__module__", "") == __name__ and not k.startswith("_")}

_RN = "rn as (select message_id, thread_id, sender, row_number() over (partition by thread_id order by pos nulls first, message_id) - 1 as rn from msg)"
_MW = "mw as (select message_id, thread_id, cast(rn // 3 as integer) as window_idx, thread_id || ':w' || (rn // 3) as window_id from rn)"


def _windows(source: str, size: int, overlap: int) -> str:
    step = size - overlap
    return f"select thread_id, thread_id || '_window_' || i as window_id, cast(i as integer) as window_idx, cast(i * {step} as bigint) as window_start, least(i * {step} + {size}, n) as window_end from (select thread_id, n, unnest(range((n - 1) // {step} + 1)) as i from (select thread_id, count(*) as n from {source} group by 1))"


_GROWN = f"grown as (select message_id, thread_id, case when thread_id in (select thread_id from msg where pos < 2) then {SPLIT} else {v.split_case(v.bucket_100('thread_id', 7))} end as split from msg where pos >= 2)"
_ROUTED = f"routed as (select message_id, case when sender <> 'system' then {SPLIT} else 'skipped' end as split from msg)"

ORACLES = {
    "hash_bucket_100": f"with {v.MSG} select distinct thread_id, {B} as bucket from msg",
    "hash_bucket_spec": f"with {v.MSG} select distinct thread_id, {B.replace(chr(39) + '42:' + chr(39) + ' || thread_id', 'thread_id || ' + chr(39) + '-42' + chr(39))} as bucket from msg",
    "hash_bucket_1000": f"with {v.ORD} select distinct thread_id, ('0x' || substr(sha256('42:' || thread_id), 1, 8))::bigint % 1000 as bucket from ord",
    "seed_int": f"with {v.MSG} select message_id, ('0x' || substr(sha256('42:3:' || message_id), 57, 8))::bigint as seed32, ('0x' || substr(sha256('42:3:' || message_id), 57, 8))::bigint % 2147483648 as seed31 from msg",
    "assign_splits": f"with {v.MSG}, {MAN} select * from man",
    "assign_splits_growth": f"with {v.MSG}, {_GROWN} select * from grown",
    "append_manifest": f"with {v.MSG}, {MAN}, {_GROWN} select * from grown union all select * from man where message_id in (select message_id from msg where pos < 2)",
    "thread_windows": f"with {v.MSG} {_windows('msg', 4, 1)}",
    "thread_windows_orders": f"with {v.ORD} {_windows('ord', 5, 2)}",
    "window_members": f"with {v.MSG}, {_RN}, w as ({_windows('msg', 4, 1)}) select w.thread_id, w.window_id, w.window_idx, rn.message_id, rn.rn from w join rn on rn.thread_id = w.thread_id and rn.rn >= w.window_start and rn.rn < w.window_end",
    "message_windows": f"with {v.MSG}, {_RN}, {_MW} select * from mw",
    "quota_assign": f"""with {v.ORD}, t as (select distinct thread_id, ('0x' || substr(sha256('42:' || thread_id), 1, 8))::bigint % 1000 as bucket from ord),
        q as (select cast(floor(count(*) * 0.7) as bigint) as qt, cast(floor(count(*) * 0.1) as bigint) as qv from t),
        a as (select *, bucket < 800 and row_number() over (partition by bucket < 800 order by thread_id) <= qt as train from t, q),
        b as (select *, not train and bucket < 900 and row_number() over (partition by not train and bucket < 900 order by thread_id) <= qv as val from a)
        select thread_id, bucket, case when train then 'train' when val then 'val' else 'test' end as split from b""",
    "window_coverage_gap": f"with {v.MSG}, c as (select thread_id, count(*) filter (pos < 3) as covered, count(*) as n from msg group by 1) select thread_id, covered, n, n - covered as gap from c where n > covered",
    "manifest_stats": f"with {v.ORD}, {OMAN} select split, count(*) as n_rows, count(distinct thread_id) as n_threads from oman group by 1",
    "thread_stats": f"with {v.MSG} select count(*) as threads, max(n) as largest from (select count(*) as n from msg group by thread_id)",
    "cohort_list": f"with {v.ORD} select cohort, count(*) as n from ord group by 1",
    "ordered_cohorts": f"with {v.ORD} select cohort, row_number() over (order by cohort) as position from (select distinct cohort from ord)",
    "thread_split_violations": f"with {v.MSG} select thread_id, count(distinct {v.split_case(v.bucket_100('message_id'))}) as n_splits from msg group by 1 having count(distinct {v.split_case(v.bucket_100('message_id'))}) > 1",
    "split_overlap": f"with {v.MSG}, {MAN} select distinct message_id from man where thread_id < '2' and split <> 'test'",
    "manifest_diff": f"with {v.MSG}, {MAN} select * from man except all select message_id, thread_id, {v.split_case(v.bucket_100('thread_id', 7))} from msg",
    "pin_filter": f"with {v.ORD} select message_id, cohort from ord where cohort <= '{PIN}'",
    "pinned_out": f"with {v.ORD} select message_id, cohort from ord where cohort > '{PIN}'",
    "nil_cohort_count": f"with {v.ORD} select count(*) as n_nil from ord where sender = '1-URGENT'",
    "exclude_anti": f"with {v.DOC}, {EXC} select message_id, sender, length from doc where message_id not in (select id from exc)",
    "tombstone_anti": f"with {v.DOC}, {TOMB} select message_id, length from doc where message_id not in (select id from tomb)",
    "split_in": f"with {v.MSG}, {MAN} select * from man where split in ('val', 'test')",
    "train_only": f"with {v.MSG}, {MAN} select * from man where split = 'train'",
    "window_split_filter": f"with {v.MSG}, {MAN}, {_RN}, {_MW} select message_id, window_idx, split from mw join man using (message_id) where window_idx = 1 and split = 'train'",
    "since_filter": f"with {v.ORD} select message_id, ts from ord where ts > timestamp '2000-01-01'",
    "thread_recency_filter": f"with {v.ORD} select message_id, thread_id from ord where thread_id in (select thread_id from ord group by 1 having max(ts) >= timestamp '2001-06-01')",
    "doc_last_active": f"with {v.ORD} select message_id, max(ts) over (partition by thread_id) as last_active from ord",
    "route_join": f"with {v.MSG}, {_ROUTED} select * from routed",
    "materialize_counts": f"with {v.MSG}, {_ROUTED} select split, count(*) as n from routed group by 1",
    "train_semi": f"with {v.MSG}, {MAN} select message_id, sender from msg where message_id in (select message_id from man where split = 'train')",
    "past_train_anti": f"with {v.MSG}, {MAN} select message_id from man where split = 'train' and message_id not in (select message_id from msg where pos >= 4)",
    "length_join": f"with {v.DOC} select message_id, length from doc",
    "shard_number": f"with {v.ORD}, n as (select message_id, row_number() over (order by ts, message_id) as position from ord) select message_id, position, (position - 1) // 1000 + 1 as shard from n",
    "split_distribution": f"with {v.ORD}, {OMAN}, k as (select split from oman where cohort <= '{PIN}') select count(*) as total, " + ", ".join(f"count(*) filter (split = '{x}') as n_{x}, round(count(*) filter (split = '{x}') * 100.0 / count(*), 2) as pct_{x}" for x in ("train", "val", "test")) + " from k",
    "exclusion_backlog": f"""with {v.ORD}, k as (select cohort > '{PIN}' as p, message_id like '%7' as q from ord)
        select count(*) as total, count(*) filter (p) as pinned_out, count(*) filter (q) as quarantined, count(*) filter (p or q) as distinct_rows, round((count(*) filter (p) + count(*) filter (q)) * 100.0 / count(*), 2) as backlog_pct from k""",
    "corpus_concat": f"with {v.MSG}, {MAN} select * from man",
    "doc_consolidate_shards": f"with {v.MSG}, {MAN}, {_RN}, {_MW} select message_id, window_idx from mw join man using (message_id) where window_idx < 2 and split = 'train'",
    "frozen_manifest": f"with {v.MSG}, {MAN}, w as ({_windows('msg', 4, 1)}) select split, count(*) as n_windows, count(distinct thread_id) as n_threads, cast(sum(window_end - window_start) as bigint) as n_slots from w join (select distinct thread_id, split from man) using (thread_id) group by 1",
}
