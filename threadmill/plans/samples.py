"""Queries and oracles: sampling, schedules, retrieval, governance."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import governance as k

from ..operators import retrieval as r
from ..operators import sampling as x
from ..session import written
from . import views as v

CAPS = {"short": 40, "medium": 100, "long": 60}


def bucket_caps_sample(s, d):
    return x.bucket_caps_sample(v.doc(s, d), CAPS, 150).select("message_id", "bucket", "position")


def bucket_counts(s, d):
    return x.bucket_counts(v.doc(s, d))


def sender_totals(s, d):
    return x.sender_totals(v.doc(s, d))


def replay_min_phase(s, d):
    return x.replay_allocation(v.msg(s, d), 150, 1).select("sender", "thread_id", "take1")


def replay_fill_phase(s, d):
    return x.replay_allocation(v.msg(s, d), 150, 1).select("sender", "thread_id", "take2")


def replay_sample(s, d):
    return x.replay_sample(v.msg(s, d), 150, 1).select("message_id", "phase")


def replay_sample_reference(s, d):
    return x.replay_sample(v.msg(s, d), 150, 1, mode="reference").select("message_id", "phase")


def interleave_schedule(s, d):
    docs = v.table(s, d, "documents")
    new = docs.where("doc_id % 2 = 1").select(F.col("doc_id").cast("string").alias("id"), F.floor(F.col("doc_id") / 2).cast("long").alias("pos"))
    old = docs.where("doc_id % 2 = 0").select(F.col("doc_id").cast("string").alias("id"))
    return x.interleave_schedule(new, old, 8, 4, 1)


def stratified_downsample(s, d):
    return x.stratified_downsample(v.evt(s, d), 2000, 100, 5).select("message_id", "stage")


def stratified_downsample_reference(s, d):
    return x.stratified_downsample(v.evt(s, d), 2003, 100, 5, mode="reference").select("message_id", "stage")


def round_robin_strata(s, d):
    return x.round_robin_strata(v.msg(s, d)).select("message_id", "round", "position")


def batches(s, d):
    return x.batches(v.doc(s, d), 32, ["message_id"]).select("message_id", "position", "batch")


def batch_shuffle(s, d):
    return x.batch_shuffle(batches(s, d)).select("message_id", "batch", "place")


def query_sample(s, d):
    return x.query_sample(v.doc(s, d), 50).select("message_id")


def union_train_ids(s, d):
    o = v.ord(s, d)
    new = o.where("cohort = '1999-12'").select(F.col("thread_id").alias("id"), F.col("message_id").cast("long").alias("pos"))
    old = o.where("cohort < '1999-12'").select(F.col("thread_id").alias("id"), F.col("message_id").cast("long").alias("pos"))
    return x.union_train_ids(new, old)


def pool_union_dedup(s, d):
    e = v.evt(s, d).select(F.col("thread_id").alias("message_id"), "shard", "pos", "sender", "value")
    return x.pool_union_dedup(e)


def last_n_shards(s, d):
    e = v.evt(s, d)
    return x.last_n_shards(e.select(F.col("shard").alias("modified"), F.concat(F.lit("part-"), "shard").alias("path")), 7)


def pool_stats(s, d):
    return x.pool_stats(v.evt(s, d))


def _turns(s, d):
    """All turns as documents, those of conversations whose id is divisible by 100 as queries, and dates."""
    c = v.msg(s, d)
    asked = c.where(F.col("thread_id").cast("long") % 100 == 0)
    return c.select(F.col("message_id").alias("doc_id"), "text"), asked.select(F.col("message_id").alias("query_id"), text.construct_query(F.lit(""), F.col("text"), 1).alias("query")), c.select(F.col("message_id").alias("doc_id"), F.lpad(F.col("pos").cast("string"), 4, "0").alias("date"))


def _gold(s, d):
    """Pairs of the threads that queries come from; a thread's other messages are in no other thread."""
    return r.gold_within_threads(v.msg(s, d).where(F.col("thread_id").cast("long") % 100 == 0))


def _found(s, d):
    docs, queries, dates = _turns(s, d)
    return written(r.retrieve(docs, queries, dates, 5), "retrieved")


def bm25_stats(s, d):
    return r.bm25_stats(_turns(s, d)[0]).withColumn("avgdl", F.round("avgdl", 6))


def bm25_document_frequency(s, d):
    return r.document_frequency(r.postings(_turns(s, d)[0]))


def bm25_match(s, d):
    docs, queries, _ = _turns(s, d)
    return r.bm25_match(docs, queries)


def bm25_topk(s, d):
    docs, queries, _ = _turns(s, d)
    return r.bm25_topk(docs, queries, 5)


def no_self_no_future(s, d):
    docs, queries, dates = _turns(s, d)
    return r.retrieve(docs, queries, dates, 5, "reference")


def bm25_retrieve(s, d):
    return _found(s, d)


def _with_refs(s, d):
    c = v.msg(s, d)
    before = F.concat_ws("-", "thread_id", F.col("pos") - 1)
    return c.select("message_id", F.when(F.col("pos") > 0, F.array(before, F.concat(F.lit("root-"), F.col("thread_id")))).otherwise(F.array().cast("array<string>")).alias("refs"))


def thread_graph(s, d):
    return r.thread_graph(_with_refs(s, d))


def gold_set(s, d):
    return r.gold_set(r.thread_graph(_with_refs(s, d))).select("src", F.array_join("gold", ",").alias("gold"))


def nonempty_gold(s, d):
    c = v.msg(s, d)
    return r.nonempty_gold(c.select(F.col("message_id").alias("query_id")), r.gold_within_threads(c)).select("query_id")


def thread_heuristic(s, d):
    c = v.msg(s, d)
    return r.thread_heuristic(_found(s, d), _gold(s, d), c).select("query_id", "doc_id", "heuristic_hit")


def rag_metrics(s, d):
    return r.rag_metrics(_found(s, d), _gold(s, d))


def retrieval_rank_metrics(s, d):
    return r.retrieval_rank_metrics(_found(s, d), _gold(s, d), 5)


def vector_topk(s, d):
    e = v.table(s, d, "embeddings")
    return r.vector_topk(e, e.where("vec_id % 100 = 0"), 5)


def doc_scatter_gather_topk(s, d):
    e = v.table(s, d, "embeddings")
    return r.vector_topk(e.repartition(7, "vec_id"), e.where("vec_id % 100 = 0"), 3)


def doc_hybrid_rerank(s, d):
    """The first words of documents whose id is divisible by 100 against all texts, and their vectors against all vectors."""
    docs, e = v.table(s, d, "documents").select("doc_id", "text"), v.table(s, d, "embeddings")
    first = F.array_join(F.slice(F.split("text", " "), 1, 8), " ")
    lexical = r.bm25_topk(docs, docs.where("doc_id % 100 = 0").select(F.col("doc_id").alias("query_id"), first.alias("query")), 20)
    return r.hybrid_rerank(lexical, r.vector_topk(e, e.where("vec_id % 100 = 0"), 20))


def fts_retrieve(s, d):
    """Retrieval by whole texts, themselves and later ones left out; words are not stemmed."""
    docs, queries, dates = _turns(s, d)
    whole = docs.join(queries.select(F.col("query_id").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("query_id"), F.col("text").alias("query"))
    return r.retrieve(docs, whole, dates, 5)


def parse_ratio(s, d):
    rows = v.table(s, d, "nation").agg(F.count("*").alias("n"))
    replay, new = x.parse_ratio(" 1:4 ")
    return rows.select((F.col("n") * 0 + replay).alias("replay"), (F.col("n") * 0 + new).alias("new"))


def doc_recall_date_cut(s, d):
    o = v.ord(s, d).withColumn("date", F.date_format("ts", "yyyy-MM-dd"))
    return r.recall_date_cut(o, "1", "1997-01-01").select("message_id", "date")


def _rules(s):
    return s.createDataFrame([("train_low", "pct_train", "lt", 75.0, "warning"), ("train_high", "pct_train", "gt", 70.0, "warning"), ("val_low", "pct_val", "lte", 50.0, "critical"), ("none", "absent", "gt", 0.0, "critical"), ("odd", "pct_test", "odd", 0.0, "warning"), ("default", "total", None, 10.0, "warning")], "kpi string, metric_path string, comparison string, threshold double, severity string")


def kpi_alerts(s, d):
    from . import manifests

    return k.kpi_alerts(k.unpivot_metrics(manifests.split_distribution(s, d)), _rules(s))


def missing_metrics(s, d):
    from . import manifests

    return k.missing_metrics(k.unpivot_metrics(manifests.split_distribution(s, d)), _rules(s))


def notify_payload(s, d):
    return k.alert_payloads(kpi_alerts(s, d)).select("kpi", "payload")


def running_loss(s, d):
    return k.running_loss(v.table(s, d, "events").select(F.col("event_id").alias("step"), F.col("value").alias("loss")))


def perplexity(s, d):
    return k.perplexity(v.table(s, d, "events").select((F.col("value") / 100).alias("loss"), (F.col("event_id") % 7 + 1).alias("tokens")))


def _log(s, d):
    e = v.table(s, d, "events")
    return e.select(F.col("event_id").alias("step"), F.col("value").alias("eval_loss"))


def best_checkpoint(s, d):
    return k.best_checkpoint(_log(s, d))


def needs_retrain(s, d):
    return k.needs_retrain(_log(s, d), 5.0)


def retrain_schedule(s, d):
    return k.retrain_schedule(s, 4, 0.0002, 0.5, 0.5, 0.15, 3, 1)


def _checkpoints(s, d):
    p = v.table(s, d, "part")
    return p.select(F.col("p_partkey").alias("checkpoint"), (F.col("p_size") * 1.0).alias("ppl"), F.col("p_retailprice").alias("rag"))


def score_checkpoint(s, d):
    return k.score_checkpoints(_checkpoints(s, d)).select("checkpoint", "score")


def doc_pareto_checkpoints(s, d):
    return k.pareto_checkpoints(_checkpoints(s, d))


def doc_weighted_score(s, d):
    return k.weighted_score(_checkpoints(s, d), {"ppl": -0.25, "rag": 0.5}).select("checkpoint", "weighted")


def doc_ppl_threshold(s, d):
    return k.perplexity_threshold(_checkpoints(s, d)).select("checkpoint", "ppl")


def improvement_pct(s, d):
    c = _checkpoints(s, d)
    return c.select("checkpoint", F.round(text.improvement_pct(F.col("rag"), F.col("ppl")), 6).alias("pct"))


def doc_guardrail_fpr(s, d):
    rows = v.table(s, d, "labels").join(v.table(s, d, "documents").select("doc_id", "n_chars"), "doc_id").withColumn("flag", F.col("n_chars") > 2048)
    return k.guardrail_fpr(rows, "flag", "toxic")


QUERIES = {n: f for n, f in list(globals().items()) if callable(f) and getattr(f, "__module__", "") == __name__ and not n.startswith("_")}

_K = v.order_key
_ALLOC = """gs as (select sender, thread_id, count(*) as size from msg group by 1, 2),
    a1 as (select *, greatest(0, least(least(1, size), 150 - coalesce(sum(least(1, size)) over (order by sender, thread_id rows between unbounded preceding and 1 preceding), 0)))::bigint as take1 from gs),
    tt as (select sum(size) as total, 150 - sum(take1) as lft from a1),
    a2 as (select a1.*, lft, sum(size) over (partition by sender) as ofs, total from a1, tt),
    a3 as (select *, case when lft > 0 then least(((lft * ofs + total - 1) // total * size + ofs - 1) // ofs, size) else 0 end as want from a2),
    al as (select *, greatest(0, least(want, lft - coalesce(sum(want) over (order by sender, thread_id rows between unbounded preceding and 1 preceding), 0)))::bigint as take2 from a3)"""
_R1 = f"rk as (select msg.*, take1, take2, row_number() over (partition by sender, thread_id order by {_K('42:0', chr(39) + 'phase1' + chr(39), 'message_id')}, message_id) as r1, row_number() over (partition by sender, thread_id order by {_K('42:0', chr(39) + 'phase2' + chr(39), 'message_id')}, message_id) as r2 from msg join al using (sender, thread_id))"


def _down(target: int, mode: str) -> str:
    third = f"case when coalesce(sum(want) over (order by sender rows between unbounded preceding and 1 preceding), 0) < lft then want else 0 end" if mode == "reference" else "greatest(0, least(want, lft - coalesce(sum(want) over (order by sender rows between unbounded preceding and 1 preceding), 0)))"
    return f"""with {v.EVT},
    g1 as (select sender, least(100, count(*)) as w from evt group by 1),
    t1 as (select sender, greatest(0, least(w, {target} - coalesce(sum(w) over (order by sender rows between unbounded preceding and 1 preceding), 0))) as t1 from g1),
    o1 as (select e.*, row_number() over (partition by e.sender order by {_K('42', "'sender'", 'message_id')}, message_id) <= t1.t1 as s1 from evt e join t1 using (sender)),
    g2 as (select thread_id, least(5, count(*) filter (not s1)) as w from o1 group by 1),
    t2 as (select thread_id, greatest(0, least(w, {target} - (select sum(t1) from t1) - coalesce(sum(w) over (order by thread_id rows between unbounded preceding and 1 preceding), 0))) as t2 from g2),
    o2 as (select o1.*, not s1 and row_number() over (partition by o1.thread_id order by s1, {_K('42', "'thread'", 'message_id')}, message_id) <= t2.t2 as s2 from o1 join t2 using (thread_id)),
    lf as (select {target} - (select sum(t1) from t1) - (select sum(t2) from t2) as lft, (select count(*) filter (not s1 and not s2) from o2) as total),
    g3 as (select sender, count(*) filter (not s1 and not s2) as av from o2 group by 1),
    w3 as (select sender, least((av * lft + total - 1) // total, av) as want, lft from g3, lf where av > 0),
    t3 as (select sender, {third} as t3 from w3),
    o3 as (select o2.*, not s1 and not s2 and row_number() over (partition by o2.sender order by s1 or s2, {_K('42', "'fill'", 'message_id')}, message_id) <= coalesce(t3.t3, 0) as s3 from o2 left join t3 using (sender))
    select message_id, case when (select count(*) from evt) <= {target} then 0 when s1 then 1 when s2 then 2 else 3 end as stage from o3 where s1 or s2 or s3 or (select count(*) from evt) <= {target}"""


_BT = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{M}}\p{{N}}_]+'), lambda x: regexp_matches(x, '^[a-z0-9]+$'))"
_LINE = r"regexp_replace(coalesce(list_filter(string_split(text, chr(10)), lambda x: not regexp_matches(x, '^[ \t\r\n\f\x0B]*[>|]') and not regexp_matches(x, '^On .* wrote:'))[1], ''), '^[ \t\r\n\f\x0B]+|[ \t\r\n\f\x0B]+$', '', 'g')"
_BM = f"""{v.MSG}, tk as (select message_id as doc_id, {_BT.format('text')} as w from msg), st as (select count(*) as n_docs, avg(len(w)) as avgdl from tk),
    po as (select doc_id, len(w) as dl, unnest(w) as term from tk), tf as (select doc_id, dl, term, count(*) as tf from po group by all), df as (select term, count(*) as df from tf group by 1),
    qt as (select message_id as query_id, unnest({_BT.format(_LINE)}) as term from msg where cast(thread_id as bigint) % 100 = 0), qf as (select query_id, term, count(*) as qf from qt group by all),
    ma as (select query_id, doc_id, round(cast(sum(cast(round(ln((n_docs - df + 0.5) / (df + 0.5) + 1) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl)) * qf * 1e12) as hugeint)) as double) / 1e12, 6) as score from qf join tf using (term) join df using (term), st group by 1, 2)"""
#: The same over documents, asked for by their first words.
_BMD = (_BM.split(", tk as", 1)[1]).replace("message_id as doc_id", "doc_id").replace("from msg), st", "from documents), st").replace("message_id as query_id", "doc_id as query_id").replace(_BT.format(_LINE), _BT.format("array_to_string(string_split(text, ' ')[1:8], ' ')")).replace("from msg where cast(thread_id as bigint) % 100 = 0", "from documents where doc_id % 100 = 0")
_BMD = "tk as" + _BMD
_FOUND = f"{_BM}, fd as (select query_id, doc_id, score from ma join msg q on q.message_id = query_id join msg dd on dd.message_id = doc_id where query_id <> doc_id and dd.pos <= q.pos), found as (select *, cast(row_number() over (partition by query_id order by score desc, doc_id) as integer) as rank from fd qualify rank <= 5)"
_GOLD = "gold as (select a.message_id as query_id, b.message_id as doc_id from msg a join msg b using (thread_id) where a.message_id <> b.message_id and cast(a.thread_id as bigint) % 100 = 0)"
_PQ = "pq as (select query_id, count(*) as g, count(f.doc_id) as h, min(f.rank) as best from gold left join found f using (query_id, doc_id) group by 1)"
_EDGE = f"""{v.MSG}, rf as (select message_id as src, unnest([thread_id || '-' || (pos - 1), 'root-' || thread_id]) as ref from msg where pos > 0), dr as (select src, ref as dst from rf where ref in (select message_id from msg)),
    edge as (select * from dr union select dst, src from dr union select a.src, b.src from rf a join rf b using (ref) where a.src <> b.src)"""
_TOPV = "(select q.vec_id as query_id, e.vec_id as doc_id, round(sqrt(list_sum(list_transform(list_zip(q.embedding, e.embedding), lambda p: (p[1]::double - p[2]::double) * (p[1]::double - p[2]::double)))), 6) as distance from embeddings q, embeddings e where {0})"

ORACLES = {
    "bucket_caps_sample": f"""with {v.DOC}, b as (select *, case when length <= 512 then 'short' when length <= 2048 then 'medium' else 'long' end as bucket from doc),
        c as (select * from b qualify row_number() over (partition by bucket order by {_K('42', 'bucket', 'message_id')}, message_id) <= case bucket when 'short' then 40 when 'medium' then 100 else 60 end)
        select message_id, bucket, row_number() over (order by {_K('42', "'global'", 'message_id')}, message_id) as position from c qualify position <= 150""",
    "bucket_counts": f"with {v.DOC} select case when length <= 512 then 'short' when length <= 2048 then 'medium' else 'long' end as bucket, count(*) as n from doc group by 1",
    "sender_totals": f"with {v.DOC} select sender, count(*) as n, (select count(*) from doc) as total from doc group by 1",
    "replay_min_phase": f"with {v.MSG}, {_ALLOC} select sender, thread_id, take1 from al",
    "replay_fill_phase": f"with {v.MSG}, {_ALLOC} select sender, thread_id, take2 from al",
    "replay_sample": f"with {v.MSG}, {_ALLOC}, {_R1} select message_id, case when r1 <= take1 then 1 else 2 end as phase from rk where r1 <= take1 + take2",
    "replay_sample_reference": f"with {v.MSG}, {_ALLOC}, {_R1} select message_id, 1 as phase from rk where r1 <= take1 union all select message_id, 2 from rk where r2 <= take2",
    "interleave_schedule": f"""with n as (select cast(doc_id as varchar) as id, doc_id // 2 as pos from documents where doc_id % 2 = 1), o as (select cast(doc_id as varchar) as id from documents where doc_id % 2 = 0),
        c as (select pos // 32 as chunk, (count(*) * 8 + 31) // 32 as share from n group by 1), st as (select chunk, share, coalesce(sum(share) over (order by chunk rows between unbounded preceding and 1 preceding), 0) as start from c),
        nu as (select id, row_number() over (order by {_K('42:0', "'replay'", 'id')}, id) - 1 as spot from o), w as (select chunk, i, (start + i) % (select count(*) from o) as spot from (select chunk, start, unnest(range(cast(share as bigint))) as i from st)),
        al as (select pos // 32 as chunk, id, 'new' as part, pos % 32 as place from n union all select chunk, id, 'replay', i from w join nu using (spot))
        select chunk, id, part, place, {_K('42:0', "'interleave'", "concat_ws('/', part, chunk, place, id)")} as order_key from al""",
    "stratified_downsample": _down(2000, "clamped"),
    "stratified_downsample_reference": _down(2003, "reference"),
    "round_robin_strata": f"with {v.MSG}, q as (select message_id, sender || ':' || thread_id as stratum from msg), r as (select *, cast(row_number() over (partition by stratum order by {_K('42', chr(39) + 'stratify' + chr(39), 'message_id')}, message_id) as integer) as round from q) select message_id, round, row_number() over (order by round, stratum, message_id) as position from r",
    "batches": f"with {v.DOC}, n as (select message_id, row_number() over (order by message_id) as position from doc) select message_id, position, (position - 1) // 32 as batch from n",
    "batch_shuffle": f"with {v.DOC}, n as (select message_id, (row_number() over (order by message_id) - 1) // 32 as batch from doc) select message_id, batch, cast(row_number() over (partition by batch order by {_K('42:0', chr(39) + 'batch:' + chr(39) + ' || batch', 'message_id')}, message_id) as integer) as place from n",
    "query_sample": f"with {v.DOC} select message_id from doc order by {_K('42', chr(39) + 'queries' + chr(39), 'message_id')}, message_id limit 50",
    "union_train_ids": f"with {v.ORD}, u as (select thread_id as id, 0 as part, cast(message_id as bigint) as pos from ord where cohort = '1999-12' union all select thread_id, 1, cast(message_id as bigint) from ord where cohort < '1999-12') select id, part, pos from u qualify row_number() over (partition by id order by part, pos) = 1",
    "pool_union_dedup": f"with {v.EVT} select thread_id as message_id, shard, pos, sender, value from evt qualify row_number() over (partition by thread_id order by shard, pos) = 1",
    "last_n_shards": f"with {v.EVT} select distinct shard as modified, 'part-' || shard as path from evt order by 1 desc limit 7",
    "pool_stats": f"with {v.EVT} select count(*) as n_rows, count(distinct sender) as senders, count(distinct thread_id) as threads from evt",
    "bm25_stats": f"with {_BM} select n_docs, round(avgdl, 6) as avgdl from st",
    "bm25_document_frequency": f"with {_BM} select term, df from df",
    "bm25_match": f"with {_BM} select query_id, doc_id, score from ma",
    "bm25_topk": f"with {_BM} select query_id, doc_id, score, cast(row_number() over (partition by query_id order by score desc, doc_id) as integer) as rank from ma qualify rank <= 5",
    "no_self_no_future": f"with {_BM}, tp as (select query_id, doc_id, score, cast(row_number() over (partition by query_id order by score desc, doc_id) as integer) as rank from ma qualify rank <= 5) select tp.* from tp join msg q on q.message_id = query_id join msg d on d.message_id = doc_id where query_id <> doc_id and d.pos <= q.pos",
    "bm25_retrieve": f"with {_FOUND} select * from found",
    "thread_graph": f"with {_EDGE} select * from edge",
    "gold_set": f"with {_EDGE} select src, string_agg(dst, ',' order by dst) as gold from edge group by 1",
    "nonempty_gold": f"with {v.MSG} select message_id as query_id from msg where thread_id in (select thread_id from msg group by 1 having count(*) > 1)",
    "thread_heuristic": f"with {_FOUND} select query_id, doc_id, q.thread_id = d.thread_id as heuristic_hit from found join msg q on q.message_id = query_id join msg d on d.message_id = doc_id",
    "rag_metrics": f"with {_FOUND}, {_GOLD}, {_PQ}, a as (select count(*) as n, avg((h > 0)::integer) as p, avg(h / g) as r, stddev_pop(h / g) as sd, sum(h) / sum(g) as mi from pq) select n as sample_size, round(p, 6) as hit_at_k, round(1.96 * sqrt(p * (1 - p) / n), 6) as hit_ci, round(r, 6) as recall_macro, round(mi, 6) as recall_micro, round(1.96 * sd, 6) as recall_ci_ref, round(1.96 * sd / sqrt(n), 6) as recall_ci from a",
    "retrieval_rank_metrics": f"with {_FOUND}, {_GOLD}, {_PQ}, dc as (select query_id, sum(1 / log2(rank + 1)) as dcg from found join gold using (query_id, doc_id) group by 1) select round(avg(coalesce(1 / best, 0)), 6) as mrr, round(avg(h / 5), 6) as precision_at_k, round(avg(coalesce(dcg, 0) / list_sum(list_transform(range(1, least(g, 5) + 1), lambda i: 1 / log2(i + 1)))), 6) as ndcg_at_k from pq left join dc using (query_id)",
    "vector_topk": f"with p as {_TOPV.format('q.vec_id % 100 = 0')} select *, cast(row_number() over (partition by query_id order by distance, doc_id) as integer) as rank from p qualify rank <= 5",
    "doc_scatter_gather_topk": f"with p as {_TOPV.format('q.vec_id % 100 = 0')} select *, cast(row_number() over (partition by query_id order by distance, doc_id) as integer) as rank from p qualify rank <= 3",
    "doc_hybrid_rerank": f"with {_BMD}, l as (select query_id, doc_id, row_number() over (partition by query_id order by score desc, doc_id) as rank from ma qualify rank <= 20), p as {_TOPV.format('q.vec_id % 100 = 0')}, s as (select query_id, doc_id, row_number() over (partition by query_id order by distance, doc_id) as rank from p qualify rank <= 20), f as (select query_id, doc_id, round(sum(1.0::double / (rank + 60)), 9) as score from (select * from l union all select * from s) group by 1, 2) select query_id, doc_id, score, cast(row_number() over (partition by query_id order by score desc, doc_id) as integer) as rank from f qualify rank <= 5",
    "fts_retrieve": f"with {_FOUND.replace(_LINE, 'text')} select * from found",
    "parse_ratio": "select cast(1 as bigint) as replay, cast(4 as bigint) as new",
    "doc_recall_date_cut": f"with {v.ORD}, o as (select message_id, strftime(ts, '%Y-%m-%d') as date from ord) select * from o where message_id <> '1' and date <= '1997-01-01'",
    "running_loss": "select event_id as step, cast(sum(cast(value as decimal(30,9))) over (order by event_id) as double) / count(*) over (order by event_id) as mean_loss, event_id % 100 = 0 as logged from events",
    "perplexity": "select round(exp(sum(value / 100 * (event_id % 7 + 1)) / sum(event_id % 7 + 1)), 6) as perplexity from events",
    "best_checkpoint": "select event_id as step, value as eval_loss from events order by value, event_id limit 1",
    "needs_retrain": "with l as (select value, row_number() over (order by event_id desc) as r from events) select max(value) filter (r = 2) - max(value) filter (r = 1) < 5.0 as needs_retrain from l",
    "retrain_schedule": "select attempt, round(0.0002::double * pow(0.5, attempt), 12) as learning_rate, round(least(0.5::double + attempt * 0.15::double, 0.9), 6) as replay_ratio, 3 + attempt as epochs from (select unnest(range(1, 5)) as attempt)",
    "score_checkpoint": "select p_partkey as checkpoint, round(p_retailprice / p_size, 9) as score from part",
    "doc_pareto_checkpoints": "select p_partkey as checkpoint, p_size * 1.0::double as ppl, p_retailprice as rag from part a where not exists (select 1 from part b where b.p_size <= a.p_size and b.p_retailprice >= a.p_retailprice and (b.p_size < a.p_size or b.p_retailprice > a.p_retailprice))",
    "doc_weighted_score": "select p_partkey as checkpoint, round(0.0 + p_size * -0.25::double + p_retailprice * 0.5::double, 9) as weighted from part",
    "doc_ppl_threshold": "select p_partkey as checkpoint, p_size * 1.0::double as ppl from part where p_size <= 15",
    "improvement_pct": "select p_partkey as checkpoint, round((p_retailprice - p_size) / p_retailprice * 100, 6) as pct from part",
    "doc_guardrail_fpr": "select count(*) filter (toxic = 0) as n_good, count(*) filter (toxic = 0 and n_chars > 2048) as n_flagged, round(count(*) filter (toxic = 0 and n_chars > 2048) / count(*) filter (toxic = 0), 6) as fpr from labels join documents using (doc_id)",
}


def _with_alert_oracles() -> None:
    from . import manifests

    dist = manifests.ORACLES["split_distribution"]
    rules = "(values ('train_low', 'pct_train', 'lt', 75.0::double, 'warning'), ('train_high', 'pct_train', 'gt', 70.0, 'warning'), ('val_low', 'pct_val', 'lte', 50.0, 'critical'), ('none', 'absent', 'gt', 0.0, 'critical'), ('odd', 'pct_test', 'odd', 0.0, 'warning'), ('default', 'total', null, 10.0, 'warning')) r(kpi, metric_path, comparison, threshold, severity)"
    names = ["total"] + [f"{a}_{b}" for a in ("n", "pct") for b in ("train", "val", "test")]
    metrics = " union all ".join(f"select '{n}' as metric_path, cast({n} as double) as value from dist" for n in names)
    base = f"with dist as ({dist}), mt as ({metrics}), al as (select kpi, metric_path, value, threshold, severity from {rules} join mt using (metric_path) where case coalesce(comparison, 'gt') when 'gt' then value > threshold when 'lt' then value < threshold when 'gte' then value >= threshold when 'lte' then value <= threshold else false end)"
    ORACLES["kpi_alerts"] = f"{base} select * from al"
    ORACLES["missing_metrics"] = f"{base} select kpi, metric_path from {rules} where metric_path not in (select metric_path from mt)"
    ORACLES["notify_payload"] = f"""{base} select kpi, '{{"kpi":"' || kpi || '","severity":"' || severity || '","value":' || cast(value as varchar) || ',"threshold":' || cast(threshold as varchar) || '}}' as payload from al"""


_with_alert_oracles()
