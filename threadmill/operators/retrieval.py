"""Retrieval evaluation: BM25, thread graphs, gold sets, metrics, vector search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from . import search


def postings(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``term``, ``tf``, ``dl`` (tokens of the document). ``docs``: ``doc_id``, ``text``."""
    tokens = docs.select("doc_id", text.bm25_tokens(F.col("text")).alias("t"))
    return tokens.select("doc_id", F.size("t").alias("dl"), F.explode("t").alias("term")).groupBy("doc_id", "dl", "term").agg(F.count("*").alias("tf"))


def bm25_stats(docs: DataFrame) -> DataFrame:
    """One row: documents and mean length."""
    return docs.select(F.size(text.bm25_tokens(F.col("text"))).alias("dl")).agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"))


def document_frequency(posted: DataFrame) -> DataFrame:
    return posted.groupBy("term").agg(F.count("*").alias("df"))


def bm25_match(docs: DataFrame, queries: DataFrame, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """``query_id``, ``doc_id``, ``score`` (6 digits) of every document that shares a term with a query.

    A query's repeated tokens count as often as they occur. ``queries``: ``query_id``, ``query``. Documents are
    cut into tokens once and scored where they are, against all queries.
    """
    return search.bm25(docs, queries, k1=k1, b=b)


def top_k(scored: DataFrame, k: int, group: str = "query_id", score: str = "score", tie: str = "doc_id", descending: bool = True) -> DataFrame:
    """The best ``k`` of each group with their ``rank``; ties by id."""
    by = Window.partitionBy(group).orderBy(F.col(score).desc() if descending else F.col(score).asc_nulls_last(), tie)
    return scored.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def bm25_topk(docs: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """Each task's best rows of a query, and the best of these."""
    return top_k(search.bm25(docs, queries, k), k)


def no_self_no_future(found: DataFrame, dates: DataFrame) -> DataFrame:
    """Retrieved rows without the query itself and without documents dated after it.

    ``dates``: ``doc_id``, ``date`` (compared as text); a null date on either side is no objection.
    """
    q = dates.select(F.col("doc_id").alias("query_id"), F.col("date").cast("string").alias("query_date"))
    d = dates.select("doc_id", F.col("date").cast("string").alias("doc_date"))
    both = found.join(q, "query_id", "left").join(d, "doc_id", "left")
    late = F.coalesce(F.col("doc_date") > F.col("query_date"), F.lit(False))
    return both.where((F.col("query_id") != F.col("doc_id")) & ~late).select(*found.columns)


def retrieve(docs: DataFrame, queries: DataFrame, dates: DataFrame, k: int = 5, mode: str = "filter_first") -> DataFrame:
    """Top documents of each query; ``reference`` cuts to ``k`` before self and future are removed."""
    if mode == "reference":
        return no_self_no_future(bm25_topk(docs, queries, k), dates)
    return top_k(search.bm25(docs, queries, k, dates), k)


def thread_graph(messages: DataFrame) -> DataFrame:
    """Distinct edges ``src``, ``dst``: a message and those it refers to, that refer to it, or that share a reference.

    ``messages``: ``message_id``, ``refs`` (array of ids). A reference to an unknown message links its
    referrers only.
    """
    ids = messages.select(text.strip_brackets(F.col("message_id")).alias("src"), "refs").distinct()
    refs = ids.select("src", F.explode("refs").alias("ref")).distinct()
    known = ids.select(F.col("src").alias("ref")).distinct()
    direct = refs.join(known, "ref", "left_semi").select("src", F.col("ref").alias("dst"))
    shared = refs.join(refs.select(F.col("src").alias("dst"), "ref"), "ref").select("src", "dst")
    both = direct.unionByName(direct.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).unionByName(shared)
    return both.where("src <> dst").distinct()


def gold_set(edges: DataFrame) -> DataFrame:
    """Each message's related ids, sorted."""
    return edges.groupBy("src").agg(F.array_sort(F.collect_set("dst")).alias("gold"))


def gold_within_threads(messages: DataFrame) -> DataFrame:
    """Pairs ``query_id``, ``doc_id`` of different messages of one thread."""
    a = messages.select(F.col("message_id").alias("query_id"), "thread_id")
    b = messages.select(F.col("message_id").alias("doc_id"), "thread_id")
    return a.join(b, "thread_id").where("query_id <> doc_id").select("query_id", "doc_id")


def nonempty_gold(queries: DataFrame, gold: DataFrame) -> DataFrame:
    return queries.join(gold.select("query_id").distinct(), "query_id", "left_semi")


def thread_heuristic(found: DataFrame, gold: DataFrame, messages: DataFrame) -> DataFrame:
    """``heuristic_hit``: retrieved rows that are gold or of the query's thread. Metrics do not use it."""
    thread = messages.select("message_id", "thread_id")
    marked = found.join(gold.select("query_id", "doc_id", F.lit(True).alias("_gold")), ["query_id", "doc_id"], "left")
    marked = marked.join(thread.select(F.col("message_id").alias("query_id"), F.col("thread_id").alias("_q")), "query_id", "left").join(thread.select(F.col("message_id").alias("doc_id"), F.col("thread_id").alias("_d")), "doc_id", "left")
    hit = F.coalesce("_gold", F.lit(False)) | F.coalesce(F.col("_q") == F.col("_d"), F.lit(False))
    return marked.select(*found.columns, hit.alias("heuristic_hit"))


def per_query(found: DataFrame, gold: DataFrame) -> DataFrame:
    """``query_id``, gold size ``g``, hits ``h`` and the best hit's rank, for queries with gold."""
    size = gold.groupBy("query_id").agg(F.count("*").alias("g"))
    hits = found.join(gold, ["query_id", "doc_id"]).groupBy("query_id").agg(F.count("*").alias("h"), F.min("rank").alias("best"))
    return size.join(hits, "query_id", "left").select("query_id", "g", F.coalesce("h", F.lit(0)).alias("h"), "best")


def rag_metrics(found: DataFrame, gold: DataFrame) -> DataFrame:
    """Hit rate, recall by query and overall, and their 95 % margins (``recall_ci_ref`` takes the deviation itself)."""
    q = per_query(found, gold).withColumn("hit", (F.col("h") > 0).cast("int")).withColumn("recall", F.col("h") / F.col("g"))
    one = q.agg(F.count("*").alias("n"), F.avg("hit").alias("p"), F.avg("recall").alias("r"), F.stddev_pop("recall").alias("sd"), (F.sum("h") / F.sum("g")).alias("micro"))
    r6 = lambda c: F.round(c, 6)
    return one.select(
        F.col("n").alias("sample_size"), r6("p").alias("hit_at_k"), r6(1.96 * F.sqrt(F.col("p") * (1 - F.col("p")) / F.col("n"))).alias("hit_ci"), r6("r").alias("recall_macro"),
        r6("micro").alias("recall_micro"), r6(1.96 * F.col("sd")).alias("recall_ci_ref"), r6(1.96 * F.col("sd") / F.sqrt("n")).alias("recall_ci"),
    )


def retrieval_rank_metrics(found: DataFrame, gold: DataFrame, k: int = 5) -> DataFrame:
    """Mean reciprocal rank, precision at ``k`` and normalised gain at ``k``."""
    q = per_query(found, gold)
    gains = found.join(gold, ["query_id", "doc_id"]).groupBy("query_id").agg(F.sum(1 / F.log2(F.col("rank") + 1)).alias("dcg"))
    ideal = F.aggregate(F.sequence(F.lit(1).cast("long"), F.least(F.col("g"), F.lit(k).cast("long"))), F.lit(0.0), lambda s, i: s + 1 / F.log2(i + 1))
    all_ = q.join(gains, "query_id", "left")
    return all_.agg(F.round(F.avg(F.coalesce(1 / F.col("best"), F.lit(0.0))), 6).alias("mrr"), F.round(F.avg(F.col("h") / k), 6).alias("precision_at_k"), F.round(F.avg(F.coalesce("dcg", F.lit(0.0)) / ideal), 6).alias("ndcg_at_k"))


def vector_topk(vectors: DataFrame, queries: DataFrame, k: int = 5, id_: str = "vec_id", vector: str = "embedding", most_queries: int = 10_000) -> DataFrame:
    """Nearest vectors of a stated query set, itself included; ``distance`` to 6 digits.

    Queries go to the vectors in blocks of about ``most_queries`` rows, and each task keeps its best before the
    shuffle: a scatter and gather of top lists.
    """
    return top_k(search.nearest(vectors, queries, k, id_, vector, most_queries), k, score="distance", descending=False)


def hybrid_rerank(lexical: DataFrame, dense: DataFrame, k: int = 5, depth: int = 20, c: int = 60) -> DataFrame:
    """Union of both lists' first ``depth``, by the sum of reciprocal ranks."""
    both = lexical.where(F.col("rank") <= depth).select("query_id", "doc_id", "rank").unionByName(dense.where(F.col("rank") <= depth).select("query_id", "doc_id", "rank"))
    fused = both.groupBy("query_id", "doc_id").agg(F.round(F.sum(1.0 / (F.col("rank") + c)), 9).alias("score"))
    return top_k(fused, k)


def recall_date_cut(docs: DataFrame, message: str, date: str) -> DataFrame:
    return docs.where((F.col("message_id") != message) & (F.col("date") <= date))
