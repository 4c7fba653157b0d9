"""Queries and oracles: text functions, guard, privacy."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing, text
from ..operators import guard as g
from ..operators import manifest as m
from ..operators import privacy as p
from ..session import discard, written
from . import views as v

SALT = "pepper"



def _quoted(s, d):
    t = F.concat(F.lit("> quoted "), F.col("message_id"), F.lit("\n  On Monday, A <a@b.c> wrote:\n"), F.col("text"))
    return v.msg(s, d).withColumn("text", t)


def _subjects(s, d):
    return v.msg(s, d).select("message_id", F.concat(F.lit("Re: "), F.element_at(F.array(F.lit("Re: "), F.lit("FW: "), F.lit("aw:\t"), F.lit("")), (F.col("pos") % 4 + 1).cast("int")), F.substring("text", 1, 20), F.lit("  ")).alias("subject"))


def message_id_or_synth(s, d):
    return v.msg(s, d).select("message_id", text.message_id_or_synth(F.when(F.col("pos") % 3 == 0, F.col("message_id")).when(F.col("pos") % 3 == 1, F.lit("")), F.col("text")).alias("id"))


def normalize_subject(s, d):
    return _subjects(s, d).select("message_id", text.normalize_subject(F.col("subject")).alias("subject"))


def derive_thread_id(s, d):
    r = v.msg(s, d).join(_subjects(s, d), "message_id")
    refs = F.when(F.col("pos") % 4 == 1, F.array(F.concat(F.col("thread_id"), F.lit("-0")))).otherwise(F.array().cast("array<string>"))
    reply = F.when(F.col("pos") % 4 == 2, F.concat(F.col("thread_id"), F.lit("-1")))
    subject = F.when(F.col("pos") % 4 == 3, F.col("subject"))
    return r.select("message_id", text.derive_thread_id(refs, reply, subject, F.col("message_id")).alias("thread"))


def stamp_cohort(s, d):
    o = v.ord(s, d)
    return o.select("message_id", text.stamp_cohort(F.when(F.col("sender") != "1-URGENT", F.col("ts")), F.lit("2020-05-01").cast("timestamp")).alias("cohort"))


def length_bucket(s, d):
    return v.doc(s, d).select("message_id", text.length_bucket(F.col("length")).alias("bucket"))


def row_id_fallback(s, d):
    r = v.msg(s, d)
    return r.select("message_id", text.row_id_fallback(F.when(F.col("pos") == 0, F.col("message_id")), F.when(F.col("pos") == 1, F.col("thread_id")), F.lit("train"), F.col("pos")).alias("row_id"))


def text_coalesce(s, d):
    r = v.msg(s, d)
    return r.select("message_id", text.text_coalesce(F.when(F.col("pos") == 0, F.col("text")), F.when(F.col("pos") == 1, F.col("sender"))).alias("content"))


def eval_text(s, d):
    return v.msg(s, d).select("message_id", text.eval_text(F.col("sender"), F.col("text")).alias("text"))


def doc_build_prompt(s, d):
    r = v.msg(s, d)
    return r.select("message_id", text.build_prompt(F.array("sender", "message_id"), F.col("text")).alias("prompt"))


def strip_quotes(s, d):
    return _quoted(s, d).select("message_id", text.strip_quotes(F.col("text")).alias("text"))


def doc_dequote(s, d):
    return _quoted(s, d).select("message_id", text.dequote(F.col("text")).alias("text"))


def normalize_content(s, d):
    return _quoted(s, d).select("message_id", text.normalize_content(F.col("text")).alias("content"))


def shingles(s, d):
    words = written(v.msg(s, d).select("message_id", text.tokens(text.normalize_content(F.col("text"))).alias("words")), "tokens")
    return words.select("message_id", F.explode(text.shingles(F.col("words"))).alias("gram"))


def simhash64(s, d):
    words = v.doc(s, d).select("message_id", F.explode_outer(text.tokens(text.normalize_content(F.col("text")))).alias("token"))
    return hashing.simhash64(words, "message_id").select("message_id", F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("simhash"))


def hamming(s, d):
    a = v.msg(s, d).select("message_id", hashing.token_hash(F.col("message_id")).alias("a"), hashing.token_hash(F.col("thread_id")).alias("b"))
    return a.select("message_id", hashing.hamming(F.col("a"), F.col("b")).alias("bits"))


def jaccard(s, d):
    r = v.msg(s, d).select("message_id", "thread_id", "pos", text.tokens(text.normalize_content(F.col("text"))).alias("w"))
    n = r.select("thread_id", (F.col("pos") - 1).alias("pos"), F.col("w").alias("w2"))
    return r.join(n, ["thread_id", "pos"]).select("message_id", F.round(text.jaccard(F.col("w"), F.col("w2")), 6).alias("jaccard"))


def bm25_tokens(s, d):
    return v.msg(s, d).select("message_id", F.posexplode(text.bm25_tokens(F.col("text"))).alias("pos", "term"))


def parse_references(s, d):
    r = v.msg(s, d).select("message_id", F.concat(F.lit("<"), F.col("thread_id"), F.lit("-0> <x@y> junk <"), F.col("message_id"), F.lit(">")).alias("h"))
    return r.select("message_id", F.posexplode(text.parse_references(F.col("h"))).alias("pos", "ref"))


def construct_query(s, d):
    return _quoted(s, d).select("message_id", text.construct_query(F.col("sender"), F.col("text"), 1).alias("query"))


def pseudonymize(s, d):
    return v.doc(s, d).select("message_id", text.pseudonymize(F.col("sender"), SALT).alias("pseudonym"))


def _mailed(s, d):
    who = F.concat(F.lit("write to u"), F.col("thread_id"), F.lit("@mail.example.com or "), F.col("sender"), F.lit("@x.org, thanks"))
    return v.msg(s, d).withColumn("text", who)


def pseudonymize_text(s, d):
    return p.pseudonymize_text(_mailed(s, d), SALT).select("message_id", "text")


def unpseudonymize(s, d):
    rows = _mailed(s, d)
    return p.unpseudonymize(p.pseudonymize_text(rows, SALT), p.email_vault(rows, SALT)).select("message_id", "text")


def pii_vault(s, d):
    return p.email_vault(v.doc(s, d), SALT)


def doc_redact_pii(s, d):
    return v.doc(s, d).select("message_id", F.md5(text.redact_pii(F.col("text"))).alias("digest"))


def doc_leak_scan(s, d):
    return p.leak_scan(v.doc(s, d)).select("message_id", F.col("n_leaks").cast("long").alias("n_leaks"))


def doc_chunk_text(s, d):
    r = v.doc(s, d).select("message_id", F.posexplode(text.chunks(F.col("text"), 400, 50)).alias("i", "chunk"))
    return r.select(F.concat_ws("_", "message_id", "i").alias("chunk_id"), F.md5("chunk").alias("digest"), F.length("chunk").cast("long").alias("n"))


def compare_threshold(s, d):
    o = v.table(s, d, "orders").select("o_orderkey", "o_totalprice", F.element_at(F.array(F.lit("gt"), F.lit("lt"), F.lit("gte"), F.lit("lte"), F.lit("odd")), (F.col("o_orderkey") % 5 + 1).cast("int")).alias("c"))
    return o.select("o_orderkey", text.compare_threshold(F.col("o_totalprice"), F.col("c"), F.lit(150000.0)).alias("hit"))


def _guarded(s, d):
    docs = v.doc(s, d)
    split = hashing.split_of(hashing.hash_bucket_100(F.col("message_id"), 42))
    return docs.select(F.col("message_id").alias("row_id"), split.alias("split"), F.col("thread_id"), "text")


def _contaminated(s, d, find):
    prints = g.fingerprints(_guarded(s, d))
    found = find(prints)
    discard(prints)
    return found


def contamination_pairs(s, d):
    return _contaminated(s, d, g.contamination_pairs)


def exclusion_policy(s, d):
    found = written(_contaminated(s, d, g.contamination_ends), "ends")
    out = [g.excluded(found, k).select(F.lit(k).alias("policy"), "id") for k in ("quarantine_test", "quarantine_both", "coassign")]
    return out[0].unionByName(out[1]).unionByName(out[2])


def contamination_summary(s, d):
    return g.summary_of_ends(_contaminated(s, d, g.contamination_ends), _guarded(s, d))


def _located(s, d):
    rows = p.pseudonymize_text(_mailed(s, d).where("pos > 0"), SALT).unionByName(_mailed(s, d).where("pos = 0"))
    subjects = v.msg(s, d).where("thread_id like '%3'").select(F.concat(F.lit("u"), F.col("thread_id"), F.lit("@mail.example.com")).alias("email")).distinct()
    return rows, p.dsr_locate(rows, subjects, SALT)


def dsr_locate(s, d):
    return _located(s, d)[1]


def dsr_export(s, d):
    rows, found = _located(s, d)
    return p.dsr_export(rows, found, p.email_vault(_mailed(s, d), SALT)).select("message_id", "text")


def dsr_delete(s, d):
    return p.dsr_delete(_located(s, d)[1])


def dsr_subject_scope(s, d):
    return p.dsr_subject_scope(_located(s, d)[1], m.assign_splits(v.msg(s, d)))


def tombstone_count(s, d):
    return p.tombstone_count(v.table(s, d, "labels").where("quality = 0"))


def doc_tombstone_duplicates(s, d):
    t = v.msg(s, d).select(F.lit("thread").alias("level"), F.col("thread_id").alias("id"))
    return p.tombstone_duplicates(t)


QUERIES = {k: f for k, f in list(globals().items()) if callable(f) and getattr(f, "__module__", "") == __name__ and not k.startswith("_")}

_S = r"[ \t\r\n\f\x0B]"
_QTD = "qtd as (select message_id, sender, pos, '> quoted ' || message_id || chr(10) || '  On Monday, A <a@b.c> wrote:' || chr(10) || text as text from msg)"
_SUB = "sub as (select message_id, 'Re: ' || ['Re: ', 'FW: ', 'aw:' || chr(9), ''][cast(pos % 4 + 1 as integer)] || substr(text, 1, 20) || '  ' as subject from msg)"


def _strip(e: str) -> str:
    return f"array_to_string(list_filter(string_split({e}, chr(10)), lambda x: not regexp_matches(x, '^{_S}*>') and not regexp_matches(x, '(?i)^{_S}*On .+<[^>]+> wrote:')), chr(10))"


def _norm(e: str, quotes: bool = True) -> str:
    return f"trim(regexp_replace(lower({_strip(e) if quotes else e}), '{_S}+', ' ', 'g'))"


def _norm_subject(e: str) -> str:
    return f"lower(regexp_replace(regexp_replace(coalesce({e}, ''), '(?im)^(re|fwd?|aw):{_S}*', '', 'g'), '^{_S}+|{_S}+$', '', 'g'))"


def _tokens(e: str) -> str:
    return f"list_filter(string_split({_norm(e)}, ' '), lambda x: x <> '')"


def _h64(e: str) -> str:
    return f"('0x' || substr(sha256({e}), 49, 16))::ubigint"


def _pseudo(e: str) -> str:
    return f"'user_' || substr(sha256(concat_ws(':', sha256('{SALT}'), 'email', {e})), 1, 12)"


def _sim(source: str, text_col: str) -> str:
    return f"""(select id, sum(case when s > 0 then (1::hugeint << b) else 0 end)::ubigint as simhash from (
        select id, b, sum(n * (2 * ((h >> b) & 1)::bigint - 1)) as s from (
          select id, {_h64('token')} as h, count(*) as n from (select message_id as id, unnest({_tokens(text_col)}) as token from {source}) group by 1, 2, token), (select unnest(range(64))::ubigint as b)
        group by 1, 2) group by 1)"""


_BM25T = r"list_filter(regexp_split_to_array(lower({0}), '[^\p{{L}}\p{{M}}\p{{N}}_]+'), lambda x: regexp_matches(x, '^[a-z0-9]+$'))"
_GUARD = f"""gd as (select message_id as row_id, {v.split_case(v.bucket_100('message_id'))} as split, text from doc),
    tk as (select row_id, split, {_tokens('text')} as w from gd),
    gr as (select row_id, split, case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) else [] end as grams from tk),
    sm as {_sim('doc', 'text')},
    fp as (select gr.*, coalesce(sm.simhash, 0::ubigint) as h, case split when 'train' then 0 when 'val' then 1 else 2 end as k from gr left join sm on sm.id = gr.row_id),
    ex as (select row_id, unnest(grams) as gram from gr),
    cm as (select a.row_id as row_a, b.row_id as row_b, count(*) as c from ex a join ex b using (gram) where a.row_id <> b.row_id group by 1, 2),
    pr as (select a.split as split_a, b.split as split_b, a.row_id as row_a, b.row_id as row_b, a.row_id as thread_a, b.row_id as thread_b, bit_count(xor(a.h, b.h))::integer as hamming,
        coalesce(c, 0) as c, len(a.grams) + len(b.grams) - coalesce(c, 0) as u
      from fp a join fp b on a.k < b.k left join cm on cm.row_a = a.row_id and cm.row_b = b.row_id),
    pairs as (select split_a, split_b, row_a, row_b, hamming, round(case when u = 0 then 0.0 else c / u end, 3) as jaccard, thread_a, thread_b from pr where hamming <= 8 or (u > 0 and c / u >= 0.7))"""
_MAILED = "mailed as (select message_id, thread_id, pos, 'u' || thread_id || '@mail.example.com' as who, sender || '@x.org' as other from msg)"
_MTEXT = "'write to ' || who || ' or ' || other || ', thanks'"
_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def _redacted(e: str) -> str:
    for pattern, label in text.REDACTIONS:
        e = f"regexp_replace({e}, '{pattern}', '{label}', 'g')"
    return e


ORACLES = {
    "message_id_or_synth": f"with {v.MSG} select message_id, case when pos % 3 = 0 then message_id else 'synthetic-' || substr(sha256(text), 1, 16) || '@generated' end as id from msg",
    "normalize_subject": f"with {v.MSG}, {_SUB} select message_id, {_norm_subject('subject')} as subject from sub",
    "derive_thread_id": f"with {v.MSG}, {_SUB} select message_id, case pos % 4 when 1 then thread_id || '-0' when 2 then thread_id || '-1' when 3 then case when {_norm_subject('subject')} <> '' then 'subject-' || substr(sha256({_norm_subject('subject')}), 1, 16) else message_id end else message_id end as thread from msg join sub using (message_id)",
    "stamp_cohort": f"with {v.ORD} select message_id, case when sender = '1-URGENT' then '2020-05' else cohort end as cohort from ord",
    "length_bucket": f"with {v.DOC} select message_id, case when length <= 512 then 'short' when length <= 2048 then 'medium' else 'long' end as bucket from doc",
    "row_id_fallback": f"with {v.MSG} select message_id, case pos when 0 then message_id when 1 then thread_id else 'train_' || pos end as row_id from msg",
    "text_coalesce": f"with {v.MSG} select message_id, case pos when 0 then text when 1 then sender else '' end as content from msg",
    "eval_text": f"with {v.MSG} select message_id, 'Subject: ' || sender || chr(10) || chr(10) || text as text from msg",
    "doc_build_prompt": f"with {v.MSG} select message_id, '[1] ' || sender || chr(10) || chr(10) || '[2] ' || message_id || chr(10) || chr(10) || 'Question: ' || text as prompt from msg",
    "strip_quotes": f"with {v.MSG}, {_QTD} select message_id, {_strip('text')} as text from qtd",
    "doc_dequote": f"with {v.MSG}, {_QTD} select message_id, regexp_replace(array_to_string(list_filter(string_split(text, chr(10)), lambda x: not regexp_matches(x, '^{_S}*>') and not regexp_matches(x, '(?i)^On .+ wrote:') and not regexp_matches(x, '(?i)^From:.+Sent:')), chr(10)), '^{_S}+|{_S}+$', '', 'g') as text from qtd",
    "normalize_content": f"with {v.MSG}, {_QTD} select message_id, {_norm('text')} as content from qtd",
    "shingles": f"with {v.MSG}, t as (select message_id, {_tokens('text')} as w from msg) select message_id, unnest(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) as gram from t where len(w) >= 5",
    "simhash64": f"with {v.DOC}, sm as {_sim('doc', 'text')} select message_id, lpad(printf('%x', coalesce(simhash, 0)), 16, '0') as simhash from doc left join sm on sm.id = message_id",
    "hamming": f"with {v.MSG} select message_id, bit_count(xor({_h64('message_id')}, {_h64('thread_id')}))::integer as bits from msg",
    "jaccard": f"with {v.MSG}, t as (select message_id, thread_id, pos, list_distinct({_tokens('text')}) as w from msg), j as (select a.message_id, len(list_intersect(a.w, b.w)) as c, len(a.w) as n, len(b.w) as k from t a join t b on a.thread_id = b.thread_id and b.pos = a.pos + 1) select message_id, round(case when n + k - c = 0 then 0 else c / (n + k - c) end, 6) as jaccard from j",
    "bm25_tokens": f"with {v.MSG}, t as (select message_id, {_BM25T.format('text')} as w from msg) select message_id, cast(i as integer) as pos, w[i + 1] as term from (select message_id, w, unnest(range(len(w))) as i from t)",
    "parse_references": f"with {v.MSG} select message_id, 0 as pos, thread_id || '-0' as ref from msg union all select message_id, 1, 'x@y' from msg union all select message_id, 2, message_id from msg",
    "construct_query": f"with {v.MSG} select message_id, regexp_replace(sender || ' ' || coalesce(list_filter(list_prepend('  On Monday, A <a@b.c> wrote:', string_split(text, chr(10))), lambda x: not regexp_matches(x, '^{_S}*[>|]') and not regexp_matches(x, '^On .* wrote:'))[1], ''), '^{_S}+|{_S}+$', '', 'g') as query from msg",
    "pseudonymize": f"with {v.DOC} select message_id, {_pseudo('sender')} as pseudonym from doc",
    "pseudonymize_text": f"with {v.MSG}, {_MAILED} select message_id, 'write to ' || {_pseudo('who')} || ' or ' || {_pseudo('other')} || ', thanks' as text from mailed",
    "unpseudonymize": f"with {v.MSG}, {_MAILED} select message_id, {_MTEXT} as text from mailed",
    "pii_vault": f"with {v.DOC}, e as (select distinct unnest(regexp_extract_all(text, '{_EMAIL}')) as original from doc) select {_pseudo('original')} as pseudonym, original from e",
    "doc_redact_pii": f"with {v.DOC} select message_id, md5({_redacted('text')}) as digest from doc",
    "doc_leak_scan": f"with {v.DOC}, n as (select message_id, len(regexp_extract_all(text, '{_EMAIL}')) as n_leaks from doc) select * from n where n_leaks > 0",
    "doc_chunk_text": f"""with {v.DOC}, t as (select message_id, list_filter(string_split(trim(regexp_replace(text, '{_S}+', ' ', 'g')), ' '), lambda x: x <> '') as w from doc),
        c as (select message_id, i, array_to_string(w[i * 350 + 1:i * 350 + 400], ' ') as chunk from (select message_id, w, unnest(range(greatest(cast(ceil((len(w) - 50) / 350.0) as bigint), 1))) as i from t where len(w) > 0))
        select message_id || '_' || i as chunk_id, md5(chunk) as digest, length(chunk) as n from c""",
    "compare_threshold": "select o_orderkey, case o_orderkey % 5 when 0 then o_totalprice > 150000 when 1 then o_totalprice < 150000 when 2 then o_totalprice >= 150000 when 3 then o_totalprice <= 150000 else false end as hit from orders",
    "contamination_pairs": f"with {v.DOC}, {_GUARD} select * from pairs",
    "exclusion_policy": f"with {v.DOC}, {_GUARD} select distinct 'quarantine_test' as policy, row_b as id from pairs union all (select 'quarantine_both', row_b from pairs union select 'quarantine_both', row_a from pairs)",
    "contamination_summary": f"with {v.DOC}, {_GUARD}, n as (select count(*) as t from doc), c as (select count(*) as p from pairs), i as (select count(*) as r from (select row_a from pairs union select row_b from pairs)) select t as total_rows, p as n_pairs, round(p * 100.0 / t, 2) as contamination_pct, round(r * 100.0 / t, 2) as contaminated_row_pct, case when round(p * 100.0 / t, 2) <= 1.0 then 'PASS' else 'FAIL' end as status from n, c, i",
    "dsr_locate": f"with {v.MSG}, {_MAILED} select message_id, thread_id, who as email from mailed where thread_id like '%3'",
    "dsr_export": f"with {v.MSG}, {_MAILED} select message_id, {_MTEXT} as text from mailed where thread_id like '%3'",
    "dsr_delete": f"with {v.MSG} select distinct 'thread' as level, thread_id as id, '1970-01-01T00:00:00Z' as deleted_at, 'dsr' as reason from msg where thread_id like '%3'",
    "dsr_subject_scope": f"with {v.MSG} select {v.split_case(v.bucket_100('thread_id'))} as split, count(*) as n_messages, count(distinct thread_id) as n_threads from msg where thread_id like '%3' group by 1",
    "tombstone_count": "select count(*) as n from labels where quality = 0",
    "doc_tombstone_duplicates": f"with {v.MSG} select 'thread' as level, thread_id as id, count(*) as n from msg group by 2 having count(*) > 1",
}
