"""Searches by blocks of queries: the whole result, whatever the block, and no pair in a shuffle."""

import math
import random

import pytest
from pyspark.sql import functions as F

from threadmill.operators import retrieval, search


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def brute(docs, queries, dates=None):
    """Scores by the definition; texts of one id and one length are one text."""
    n, avg = len(docs), sum(len(t.split()) for _, t in docs) / len(docs)
    units = {}
    for i, t in docs:
        units.setdefault((i, len(t.split())), []).extend(t.split())
    df = {w: sum(w in u for u in units.values()) for u in units.values() for w in u}
    asked = {}
    for i, t in queries:
        asked.setdefault(i, []).extend(t.split())
    found = {}
    for q, words in asked.items():
        for (d, dl), u in units.items():
            for w in set(words) & set(u):
                x = math.log((n - df[w] + 0.5) / (df[w] + 0.5) + 1) * u.count(w) * 2.5 / (u.count(w) + 1.5 * (0.25 + 0.75 * dl / avg))
                found[q, d] = found.get((q, d), 0) + math.floor(x * words.count(w) * 1e12 + 0.5)
    if dates is not None:
        found = {(q, d): s for (q, d), s in found.items() if q != d and not (dates[q] and dates[d] and dates[d] > dates[q])}
    return {p: (s + 500_000) // 1_000_000 / 1e6 for p, s in found.items()}


def best(scores, k):
    out = set()
    for q in {q for q, _ in scores}:
        mine = sorted((-s, d) for (x, d), s in scores.items() if x == q)[:k]
        out |= {(q, d, -s, i + 1) for i, (s, d) in enumerate(mine)}
    return out


@pytest.mark.parametrize("queries, cells", [(4_096, 1 << 20), (3, 40)])
def test_bm25_equals_brute_force(spark, monkeypatch, queries, cells):
    monkeypatch.setattr(search, "QUERIES", queries)
    monkeypatch.setattr(search, "CELLS", cells)
    rng = random.Random(1)
    word = lambda: f"w{min(rng.randrange(30), rng.randrange(30))}"
    rows = [(f"d{i % 55}" if i < 60 else f"c{i}", " ".join(word() for _ in range(rng.randrange(12))) if i < 60 else "w1 w2 w3", rng.choice([None, "1", "2", "3"])) for i in range(75)]
    dates = {i: d for i, _, d in rows}
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id string, text string").repartition(3)
    asked = [(i, t + " w1 w1") for i, t, _ in rows if i[1:] in "0123456789"]
    questions = spark.createDataFrame(asked, "query_id string, query string")
    when = spark.createDataFrame(list(dates.items()), "doc_id string, date string")
    want = brute([(i, t) for i, t, _ in rows], asked)
    assert {(r.query_id, r.doc_id): r.score for r in retrieval.bm25_match(docs, questions).collect()} == want
    assert {tuple(r[c] for c in ("query_id", "doc_id", "score", "rank")) for r in retrieval.bm25_topk(docs, questions, 4).collect()} == best(want, 4)
    want = brute([(i, t) for i, t, _ in rows], asked, dates)
    assert {tuple(r[c] for c in ("query_id", "doc_id", "score", "rank")) for r in retrieval.retrieve(docs, questions, when, 4).collect()} == best(want, 4)


def test_no_pair_of_a_lexical_search_is_shuffled(spark):
    docs = spark.createDataFrame([(f"d{i}", "cat dog") for i in range(9)], "doc_id string, text string")
    asked = docs.select(F.col("doc_id").alias("query_id"), F.col("text").alias("query"))
    assert "Exchange" not in plan(retrieval.bm25_match(docs, asked))
    # Nine equal documents for nine queries; what is shuffled is the tasks' top lists.
    assert search.bm25(docs.coalesce(1), asked, 2).count() == 18


def test_nobody_is_asked(spark):
    docs = spark.createDataFrame([("a", "cat"), ("b", None)], "doc_id string, text string")
    none = spark.createDataFrame([("q", " "), ("p", None)], "query_id string, query string")
    assert retrieval.bm25_topk(docs, none, 2).collect() == [] and retrieval.bm25_match(docs.limit(0), none).collect() == []
    v = spark.createDataFrame([(1, [0.5])], "vec_id long, embedding array<float>")
    assert retrieval.vector_topk(v, v.where("vec_id = 2"), 2).collect() == []


@pytest.mark.parametrize("most", [10_000, 4])
def test_nearest_vectors_equal_brute_force_in_blocks(spark, monkeypatch, most):
    monkeypatch.setattr(search, "CELLS", 50)
    rng = random.Random(2)
    rows = [(i, [rng.choice([0.0, 0.25, rng.random()]) for _ in range(5)]) for i in range(80)]
    rows += [(100 + i, rows[3][1]) for i in range(9)] + [(200, None), (201, [0.5, None, 0.5]), (202, []), (203, [1.0] * 7), (204, [float("nan")] * 5), (205, [float("inf")] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")

    def apart(a, b):
        terms = [(x - y) ** 2 for x, y in zip(a or [], b or []) if x is not None and y is not None]
        return (1, 0.0) if not terms else (0, round(math.sqrt(sum(terms)), 6))

    asked = [r for r in rows if r[0] < 10]
    want = set()
    for q, a in asked:
        near = sorted((*apart(a, b), d) for d, b in rows if d < 204)[:6]
        want |= {(q, d, s, i + 1) for i, (_, s, d) in enumerate(near)}
    got = retrieval.vector_topk(df.repartition(3), df.where("vec_id < 10"), 6, most_queries=most).collect()
    assert {(r.query_id, r.doc_id, r.distance, r["rank"]) for r in got} == want and len(got) == len(want)
    last = [r.doc_id for r in retrieval.vector_topk(df, df.where("vec_id = 0"), 200).orderBy("rank").collect()][-4:]
    assert last == [205, 204, 200, 202]
