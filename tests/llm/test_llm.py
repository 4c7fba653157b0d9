"""The ten operators against brute force, with nulls, empty and long texts, ties, copies and clashing names."""

import base64
import hashlib
import itertools
import json
import random
import re
import zlib

import pytest

llm = pytest.importorskip("threadmill.llm")

from pyspark.sql import functions as F  # noqa: E402

from threadmill.llm import bpe, chat, decontaminate, html, media, simhash, simwide, suffix, tokencount, toxicity, warc  # noqa: E402

P = pytest.importorskip("public_tokenizers")
BPE = P.path("byte_bpe_multi_50k.tiktoken")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def texts():
    """Ids and texts: null, empty, white space, one word, copies, repeated rows, long, many scripts, a null id."""
    random.seed(1)
    words = [f"{a}{b}{c}" for a in "ktn" for b in "aeiou" for c in "rlsm"]
    body = lambda n: " ".join(random.choice(words) for _ in range(n))
    one, long = body(120), body(9_000)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "word"), (4, "Word"), (5, one), (6, one), (6, one), (7, one.replace("k", "K", 3)), (8, long), (9, long + " tail"), (10, "日本語 テスト 😀😀 \x00 é" * 9), (11, "a" * 700), (12, "ab" * 300), (None, body(60)), (13, body(50) + " " + one[100:500] + " " + body(40)), (14, "don't I'll  12345\r\n\n x")]
    return rows + [(20 + i, body(random.choice([4, 5, 30, 200]))) for i in range(25)]


@pytest.fixture(scope="module")
def docs(spark):
    """The texts with columns whose names the operators use inside."""
    df = spark.createDataFrame(texts(), "doc_id long, text string").repartition(3)
    return df.withColumns({c: F.lit(1) for c in ("_text", "fp", "h", "at", "runs", "score", "n_tokens", "component_id", "_key", "shard", "_row", "digest")})


@pytest.fixture(scope="module")
def none(docs):
    return docs.where(F.lit(False))


def by_id(df, *cols):
    """Rows as a sorted list of tuples of the id and the columns."""
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def fingerprint(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not w:
        return 0
    import xxhash

    grams = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or [" ".join(w)]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def classes(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(ids, 2):
        if linked(a, b) and find(a) != find(b):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: find(i) for i in ids}


def test_op1_equals_all_pairs(docs, none):
    prints = {i: fingerprint(t, 4) for i, t in texts()}
    want = classes([i for i in prints if i is not None], lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    want[None] = None
    got = simhash.near_duplicates(docs)
    assert by_id(got, "doc_id", "fingerprint", "component_id") == sorted(((i, f"{prints[i]:016x}", want[i]) for i, _ in texts()), key=str)
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("split_above", [4000, 5])
def test_op1_links_of_crowded_buckets(spark, split_above):
    random.seed(4)
    fp = {}
    for centre in [random.getrandbits(64) for _ in range(30)] + [0xABC << 52]:
        for _ in range(20):
            x = centre
            for _ in range(random.randint(0, 5)):
                x ^= 1 << random.randrange(64)
            fp.setdefault(x, len(fp))
    ids = {n: x for x, n in fp.items()}
    want = classes(sorted(ids), lambda a, b: (ids[a] ^ ids[b]).bit_count() <= 4)
    nodes = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x, n) for x, n in fp.items()], "fp long, node long")
    got = {r.node: r.component for r in simhash.components(simhash.links(nodes, 2, split_above=split_above)).collect()}
    assert {n: got.get(n, n) for n in ids} == want


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200)] + [(300, 301), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(201)} | {300: 300, 301: 300}
    assert simhash.components(edges.where("a < 0")).count() == 0


def test_wide_classes_hold_what_is_similar(spark, docs, none):
    random.seed(6)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(40):
        base = [random.choice(words) for _ in range(150)]
        for k in (0, 1, 2):
            copy = list(base)
            for _ in range(k):
                copy[random.randrange(150)] = "edit"
            rows.append((n, " ".join(copy)))
            n += 1
    got = {r.doc_id: r.component_id for r in simwide.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == i - i % 3 for i in got)
    assert simwide.near_duplicates(none).count() == 0
    kept = simwide.keep_one(docs)
    assert kept.columns == docs.columns and {6, 7, 4} & {r.doc_id for r in kept.collect()} == set()
    assert {5, 8, 13} <= {r.doc_id for r in kept.collect()}


def jaccard(a, b):
    x, y = (set(zip(*(t.lower().split()[i:] for i in range(5)))) for t in (a, b))
    return len(x & y) / len(x | y)


def edited(random, words, base, n):
    """``base`` with ``n`` words changed, five places or more apart."""
    copy = list(base)
    for at in random.sample(range(2, len(base) - 2, 5), n):
        copy[at] = random.choice(words) + "x"
    return copy


def test_wide_pairs_are_decided_by_exact_similarity(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(2_000)]
    rows = []
    for i in range(300):
        base = [rng.choice(words) for _ in range(200)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(edited(rng, words, base, 3 + i % 4)))]
    near = {i: jaccard(rows[2 * i][1], rows[2 * i + 1][1]) for i in range(300)}
    assert min(near.values()) < 0.75 and max(near.values()) > 0.85 and 50 < sum(0.75 <= x < 0.8 for x in near.values())
    got = {r.doc_id: r.component_id for r in simwide.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i in near if near[i] < 0.8 and got[2 * i + 1] != 2 * i + 1] == []


def test_wide_links_inside_a_crowd_of_alike_texts(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(2_000)]
    base = [rng.choice(words) for _ in range(300)]
    rows = [" ".join(edited(rng, words, base, 4)) for _ in range(12)]  # one class
    for _ in range(40):  # less alike than 0.8 to one another, each with a copy of about 0.8
        own = edited(rng, words, base, 7)
        rows += [" ".join(own), " ".join(edited(rng, words, own, 6))]
    want = classes(range(len(rows)), lambda a, b: jaccard(rows[a], rows[b]) >= 0.8)
    assert len(set(want.values())) > 10
    got = {r.doc_id: r.component_id for r in simwide.near_duplicates(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert got == want


def test_wide_search_between_classes_leaves_out_no_pair(spark, monkeypatch):
    import numpy as np

    rng = random.Random(10)
    sets = [sorted(rng.sample(range(60), rng.randint(0, 40))) for _ in range(60)]
    for s in list(sets):
        sets += [sorted({*s[rng.randint(0, 3) :], *rng.sample(range(60), rng.randint(0, 3))}) for _ in range(3)]
    sets = [list(x) for x in dict.fromkeys(map(tuple, sets))]
    known = {i: i - i % 3 for i in range(len(sets))}
    told = spark.createDataFrame(list(known.items()), "node long, known long")
    want = {(a, b) for a, b in itertools.combinations(known, 2) if known[a] != known[b] and sets[a] and len({*sets[a]} & {*sets[b]}) / len({*sets[a], *sets[b]}) >= 0.8}
    assert len(want) > 50
    for often, crowd in (([], 40_000), ([3, 7, 50], 20), (list(range(60)), 6)):
        monkeypatch.setattr(simwide, "CROWD", crowd)
        prefix = [simwide.prefix_of(np.array(s, np.int64), np.array(often, np.int64), 0.8) for s in sets]
        monkeypatch.setattr(simwide, "TALLY_BIT", 0)
        tally = [simwide.tally_of(np.array(s, np.uint64)).view(np.int64).tolist() for s in sets]
        rows = spark.createDataFrame([(i, len(s), t, p.tolist(), bytearray(p.astype(np.uint16).tobytes())) for i, (s, t, p) in enumerate(zip(sets, tally, prefix))], "node long, n int, tally array<long>, prefix array<long>, low binary").repartition(3)
        got = {tuple(r) for r in simwide.possible(simwide.remaining(rows, told, 0.8), rows, 0.8).collect()}
        assert want <= got


def test_wide_search_hands_on_a_pair_once_however_many_shingles_it_shares(monkeypatch):
    import numpy as np

    rng = random.Random(13)
    monkeypatch.setattr(simwide, "HELD", 50)
    base = sorted(rng.sample(range(1, 100_000), 300))
    sets = [np.array(sorted({*rng.sample(base, 280), *rng.sample(range(100_000, 200_000), 10)}), np.int64) for _ in range(40)]
    prefix = [simwide.prefix_of(s, np.zeros(0, np.int64), 0.8) for s in sets]
    rows = sorted((int(h), at, i) for i, p in enumerate(prefix) for at, h in enumerate(p))
    n = np.array([len(s) for s in sets])
    tally = np.stack([simwide.tally_of(s.view(np.uint64)) for s in sets])
    first = np.stack([p[: simwide.FIRST] for p in prefix])
    made = []
    for _, group in itertools.groupby(rows, lambda r: r[0]):  # each shingle in a task of its own
        _, at, i = (np.array(x) for x in zip(*group))
        none = np.zeros(len(i), np.int64)
        for a, b in simwide._across(none, at, n[i], i, none, tally[i], first[i], 0.8):
            made += [tuple(sorted(x)) for x in zip(i[a].tolist(), i[b].tolist())]
    want = {(a, b) for a, b in itertools.combinations(range(40), 2) if len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))}
    shared = sum(len(np.intersect1d(prefix[a], prefix[b])) for a, b in {*made})
    assert len(want) > 10 and want <= {*made} and shared > 20 * len({*made})
    assert len(made) <= 1.1 * len({*made})


def test_wide_tallies_never_count_more_than_sets_differ_in():
    import numpy as np

    rng = np.random.default_rng(12)
    for size in (0, 1, 15, 16, 17, 200, 3_000, 50_000):
        x = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        for gone, more in ((0, 0), (size // 20, 1), (size, size), (size // 2, 3 * size)):
            y = np.unique(np.concatenate([x[gone:], rng.integers(0, 1 << 63, more, dtype=np.uint64)]))
            low = np.stack([simwide.tally_of(x), simwide.tally_of(y)]).view(np.uint8)
            counts = np.concatenate([low & 15, low >> 4], axis=1)
            found = simwide._unlike(counts, np.array([0, 0]), np.array([0, 1]))
            assert found[0] == 0 and found[1] <= len(np.setxor1d(x, y))
            assert size != 200 or not gone or found[1] > 0


def test_wide_pairs_at_the_similarity_are_all_found(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(2_000)]
    rows = []
    for i in range(400):
        base = [rng.choice(words) for _ in range(229)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(edited(rng, words, base, 4 + i % 2)))]
    near = {i: jaccard(rows[2 * i][1], rows[2 * i + 1][1]) for i in range(400)}
    assert sum(0.8 <= x < 0.85 for x in near.values()) > 300
    got = {r.doc_id: r.component_id for r in simwide.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [i for i in near if (got[2 * i + 1] == 2 * i) != (near[i] >= 0.8)] == []


def test_keep_one_keeps_one_row_of_a_class_whatever_its_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(1, a, "p"), (None, a, "q"), (None, b, "r"), (None, b, "s"), (5, c, "t"), (5, c, "u"), (7, c, "v"), (8, d, "w"), (8, a, "x"), (9, d, "y"), (None, None, "z")]
    kept = simwide.keep_one(spark.createDataFrame(rows, "doc_id long, text string, `n.m` string").repartition(3))
    assert kept.columns == ["doc_id", "text", "n.m"]
    assert sorted(((r[0], r[1]) for r in kept.collect()), key=str) == sorted([(1, a), (None, b), (5, c), (8, d), (None, None)], key=str)


def test_wide_variants_are_the_same_when_dealt_again():
    import numpy as np

    rng = np.random.default_rng(0)
    home, spent = rng.integers(0, 1 << 32, 200, dtype=np.uint64), rng.integers(0, 3, 200).astype(np.uint8)
    whole = sorted(zip(*(x.tolist() for x in simwide._variants(home, spent, np.arange(200), 32))))
    parts = []
    old, simwide.BUNDLE = simwide.BUNDLE, 1_000
    try:
        for h, s, r, low in simwide._dealt(home, spent, 32, len(whole)):
            parts += list(zip(*(x.tolist() for x in simwide._variants(h, s, r, low))))
    finally:
        simwide.BUNDLE = old
    assert sorted(parts) == whole


@pytest.mark.parametrize("least", [0, 100])
def test_op2_round_trip(spark, tmp_path, least):
    page = "<html>" + "é" * 300
    rows = [(3, "http://a/ b\r\n", page), (1, "http://b", page), (9, None, page), (2, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (None, "u", page), (7, "u", "<p>" * 90_000), (1, "http://c", page), (1, "http://b", page), (1, "http://b", "short"), (8, "u", "<i>"), (8, "u", "<i>"), (None, None, "<b>"), (None, None, "<b>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("_id", "_digest", "bundle")})
    first = {}
    for r in sorted((r for r in rows if r[0] is not None)):
        first.setdefault(r[2] or "", r[0])
    want = []
    told = set()
    for i, _, t in rows:
        b, f = (t or "").encode(), first.get(t or "")
        again = len(b) >= least and (f != i or (t or "") in told)
        told |= {t or ""} if f == i else set()
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", f if again else None))
    got = warc.round_trip(df, least_bytes=least, folder=str(tmp_path / "w"))
    index = warc.archive(df, str(tmp_path / "x"), least_bytes=least)
    assert index.select("record_id").distinct().count() == index.count() == len(rows)
    back = warc.read_records(index, str(tmp_path / "x"))
    assert {r.record_id for r in back.collect()} == {r.record_id for r in index.collect()}
    assert by_id(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=str)
    assert warc.round_trip(df.where(F.lit(False)), folder=str(tmp_path / "none")).count() == 0


def test_op2_bundles_can_be_read_by_their_seek_table(spark, tmp_path):
    import zstandard

    df = spark.createDataFrame([(i, "u", f"<p>{i}</p>" * 9_000) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    index = warc.archive(df, str(tmp_path / "w"))
    (bundle,) = {r.bundle for r in index.collect()}
    data = (tmp_path / "w" / bundle).read_bytes()
    with open(tmp_path / "w" / bundle, "rb") as f:
        frames = warc.read_seek_table(f, len(data))
    assert len(frames) > 5 and sum(f[1] for f in frames) < len(data)
    for r in index.collect():
        at, packed, plain = frames[r.frame]
        whole = zstandard.ZstdDecompressor().decompress(data[at : at + packed])
        assert len(whole) == plain
        headers, block, end = warc.parse_record(whole, r.record_offset)
        assert headers["WARC-Record-ID"] == r.record_id and end == r.record_offset + r.record_bytes


def test_op3_links_orders_and_checks(spark):
    calls = spark.createDataFrame(
        [("c", "a", 1, "f", '{"y": 1.50, "x": "t"}', []), ("c", "b", 2, "f", '{"x": 3, "z": null}', ["a", "a", "gone", "b"]), ("c", "d", 3, "f", "[1]", ["a", "b"]), ("c", "e", 4, "g", "{}", None), ("c", None, 5, "f", '{"x": "é\\n", "y": true}', ["a"]), ("c", "p", 6, "f", None, ["q"]), ("c", "q", 7, "f", "{", ["p"]), ("c", "a", 8, "f", '{"x": ""}', [])],
        "conv_id string, call_id string, turn long, name string, arguments string, after array<string>",
    )
    results = spark.createDataFrame([("c", "a", 2, "late"), ("c", "a", 1, "early"), ("c", "lost", 9, None), ("c", None, 1, "x")], "conv_id string, call_id string, turn long, content string")
    schemas = spark.createDataFrame([("f", [("x", "string", True), ("y", "number", False)])], "name string, fields array<struct<field: string, type: string, required: boolean>>")
    got = {(r.call_id, r.turn): r for r in chat.linked(calls, results, schemas).collect()}
    assert len(got) == 9
    assert got["a", 1].message == '{"arguments":{"x":"t","y":1.5},"call_id":"a","name":"f","result":"early"}' and got["a", 1].valid
    assert got["b", 2].errors == "x: not string; z: unknown" and got["b", 2].level == 1 and got["b", 2].status == "open"
    assert got["d", 3].level == 2 and got["d", 3].errors == "arguments: no object" and json.loads(got["d", 3].message)["arguments"] is None
    assert got["e", 4].errors == "schema: unknown" and got["e", 4].level == 0
    assert got[None, 5].status == "unnamed" and got[None, 5].errors == "y: not number"
    assert got["p", 6].status == got["q", 7].status == "cycle" and got["p", 6].level is None
    assert got["lost", 9].status == "orphan" and got["a", 8].status == "linked"
    assert chat.linked(calls.where("false"), results.where("false"), schemas.where("false")).count() == 0


def test_op3_levels_of_long_chains_and_wide_graphs(spark):
    kinds = "conv_id long, call_id string, after array<string>"
    found = lambda rows: {json.loads(r._call).get("c"): r.level for r in chat.levels(spark.createDataFrame([(1, *x) for x in rows], kinds)).collect()}
    assert found([(f"n{i}", [f"n{i - 1}"] if i else []) for i in range(70)]) == {f"n{i}": i for i in range(1, 70)}
    assert found([("a", []), ("b", ["a"]), ("c", ["a", "b"]), ("d", ["c", "x"]), ("x", ["y"]), ("y", ["x"])]) == {"b": 1, "c": 2, "d": None, "x": None, "y": None}


def test_op3_levels_of_deep_graphs_with_two_parents(spark, monkeypatch):
    """Deeper than the tables that are put together at a time; two conversations use the same identifiers."""
    monkeypatch.setattr(chat, "FOLD", 4)
    depth = 2 * chat.FOLD + 3
    rows = [(v, f"n{i}", [f"n{j}" for j in (i - 1, i - 2) if j >= 0]) for v, n in ((1, depth), (2, 5)) for i in range(n)]
    got = {tuple(json.loads(r._call).values()): r.level for r in chat.levels(spark.createDataFrame(rows, "conv_id long, call_id string, after array<string>")).collect()}
    assert got == {(v, f"n{i}"): i for v, n in ((1, depth), (2, 5)) for i in range(1, n)}


def test_op3_identifiers_count_inside_their_conversation(spark):
    long = "x" * 200_000
    calls = spark.createDataFrame([("A", "call_1", 1, "f", "{}", []), ("B", "call_1", 1, "f", '{"x": "%s"}' % long, ["call_1"]), ("B", "call_2", 3, "f", "{}", ["call_1"]), (None, "call_1", 1, "f", "", None), ("A", "call_2", 5, None, None, ["call_9"])], "conv_id string, call_id string, turn long, name string, arguments string, after array<string>")
    results = spark.createDataFrame([("A", "call_1", 2, "of A"), ("B", "call_1", 2, long), (None, "call_1", 3, "of none"), ("C", "call_1", 2, None)], "conv_id string, call_id string, turn long, content string")
    schemas = spark.createDataFrame([("f", [("x", "string", False)])], "name string, fields array<struct<field: string, type: string, required: boolean>>")
    extra = ["_id", "_r", "_call", "level", "status", "_parent", "_fields"]
    calls, results = (df.withColumns({c: F.lit(1) for c in extra}) for df in (calls, results))
    got = {(r.conv_id, r.call_id): r for r in chat.linked(calls, results, schemas.withColumn("conv_id", F.lit(1))).collect()}
    assert len(got) == 6
    assert {k: json.loads(r.message)["result"] for k, r in got.items()} == {("A", "call_1"): "of A", ("B", "call_1"): long, ("B", "call_2"): None, (None, "call_1"): "of none", ("A", "call_2"): None, ("C", "call_1"): None}
    assert {k: r.status for k, r in got.items()} == {("A", "call_1"): "linked", ("B", "call_1"): "linked", ("B", "call_2"): "open", (None, "call_1"): "linked", ("A", "call_2"): "open", ("C", "call_1"): "orphan"}
    assert got["B", "call_2"].level == 1 and got["B", "call_1"].level == got["A", "call_2"].level == 0


@pytest.mark.parametrize("name", ["op2_warc", "op3_tool_calls", "op7_decontaminate", "op8_suffix_dedup"])
def test_queries_equal_sql(spark, sf, duck, name):
    from threadmill.llm import queries

    df = queries.QUERIES[name](spark, sf)
    want = duck.execute(f"select {', '.join(df.columns)} from ({queries.ORACLES[name]})").fetchall()
    assert by_id(df, *df.columns) == sorted(want, key=str)
    assert set(queries.ORACLES) == {"op2_warc", "op3_tool_calls", "op7_decontaminate", "op8_suffix_dedup"}


def toxic_texts(n, seed):
    random.seed(seed)
    plain = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("an", "el", "is", "or", "um")]
    rows = []
    for i in range(n):
        words = [random.choice(plain) for _ in range(random.randint(5, 80))] + [random.choice(["women", "muslims", "people"])]
        bad = i % 5 == 0
        if bad:
            words += random.choices(["grobnik", "zorkface", "zorkhead"], k=3)
        random.shuffle(words)
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_op4_finds_held_out_insults_and_spares_groups(spark, docs, none):
    rows = toxic_texts(900, 3)
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (1, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(df, labels).collect()}
    for i, _, bad in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= 0.3)
    held = [(got[i].predicted, bad) for i, _, bad in rows if got[i].held_out]
    assert sum(p == b for p, b in held) / len(held) > 0.98
    weights = toxicity.train(df, labels)
    score = toxicity.Scorer(weights)
    assert max(abs(score("ban " + w) - score("ban people")) for w in toxicity.IDENTITY_TERMS) < 0.02
    assert toxicity.toxicity(docs, labels).count() == docs.count() and toxicity.toxicity(none, labels).count() == 0
    assert toxicity.toxicity(docs, labels.where("toxic = 0")).where("predicted = 1").count() == 0
    kept = toxicity.keep_civil(df, labels)
    assert kept.columns == df.columns and kept.count() == sum(1 for r in got.values() if not r.predicted)


def test_op4_counterfactual_penalty_shrinks_identity_weights():
    rows = [("muslims are zork", 1)] * 1 + [(f"{w} muslims zork{i}", 1) for i, w in enumerate(["ban", "del", "fis"] * 15)] + [(f"word{i} plain text here{i}", 0) for i in range(120)]
    free = toxicity.fit([r[0] for r in rows], [r[1] for r in rows], penalty=0.0)
    tied = toxicity.fit([r[0] for r in rows], [r[1] for r in rows], penalty=5.0)
    move = lambda w: toxicity.Scorer(w)("muslims") - toxicity.Scorer(w)("people")
    assert abs(move(tied)) < abs(move(free))


def test_op5_equals_a_plain_viterbi(docs, none):
    counter = tokencount.load(P.path("piece_bpe_32k.model"))

    def tokens(w):
        best = [(0, 0)]
        for e in range(1, len(w) + 1):
            n = len(w[e - 1].encode())
            found = [(best[e - 1][0] + n * counter.byte_score, best[e - 1][1] - n)]
            found += [(best[s][0] + counter.pieces[w[s:e]], best[s][1] - 1) for s in range(e) if w[s:e] in counter.pieces]
            best.append(max(found))
        return -best[-1][1]

    want = []
    for i, t in texts():
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        want.append((i, len(w), sum(tokens("▁" + x) for x in w)))
    assert by_id(tokencount.token_counts(docs, P.path("piece_bpe_32k.model")), "doc_id", "n_pretokens", "n_tokens") == sorted(want, key=str)
    assert tokencount.token_counts(none, P.path("piece_bpe_32k.model")).count() == 0


def test_op6_equals_tiktoken(docs, none):
    import tiktoken

    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(BPE), special_tokens={})
    want = []
    for i, t in texts():
        ids = ref.encode_ordinary(t or "")
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        want.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert by_id(bpe.round_trip(docs, BPE, P.PATTERN), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)
    assert bpe.round_trip(none, BPE, P.PATTERN).count() == 0
    checked = bpe.encode_checked(docs, BPE, P.PATTERN)
    assert checked.where("not decodes").count() == 0 and checked.where("size(ids) <> n_tokens").count() == 0


def test_op6_offsets_and_split_characters(spark):
    b = bpe.load(BPE, P.PATTERN)
    text = "日本語 é 😀 don't"
    ids, spans = b.encode_with_offsets(text)
    assert b.decode_text(ids) == text and len(ids) == len(spans)
    assert spans[0][0] == 0 and spans[-1][1] == len(text) and all(a < e for a, e in spans)
    assert any(len(b.bytes_of[i].decode("utf-8", "ignore").encode()) != len(b.bytes_of[i]) for i in ids)
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    frame = bpe.encode_frame(df, BPE, P.PATTERN, offsets=True)
    back = {r.doc_id: r.text for r in bpe.decode_frame(frame, BPE, P.PATTERN).collect()}
    assert back == {1: text, 2: ""} and frame.columns == ["doc_id", "ids", "starts", "ends"]


@pytest.mark.parametrize("block", [16_000_000, 500])
def test_op7_equals_window_search(spark, docs, none, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    source = dict((i, t) for i, t in texts() if t)
    words = source[5].split()
    items = [(1, " ".join(words[20:35])), (2, source[5][:200].upper()), (3, "word"), (4, None), (5, "!!"), (6, " ".join(words[25:36])), (10, "日本語 テスト"), (11, "a " * 12)]
    bench = spark.createDataFrame(items + items[:1], "item_id long, text string").withColumn("doc_id", F.lit(1))
    windows = {}
    for i, t in items:
        w = WORD.findall(lower(t))
        for a in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[a : a + 10]), set()).add(str(i))
    want = []
    for i, t in texts():
        w = WORD.findall(lower(t))
        hit, found = set(), set()
        for a in range(len(w)):
            for n in range(1, 11):
                if (x := windows.get(tuple(w[a : a + n]))) and a + n <= len(w):
                    hit |= set(range(a, a + n))
                    found |= x
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    got = decontaminate.contaminated(docs, bench)
    assert by_id(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(want, key=str)
    shown = {i: t for i, t in texts()}
    for r in got.select("doc_id", "runs", "spans").collect():
        words = WORD.findall(lower(shown[r.doc_id]))
        assert [WORD.findall(lower(shown[r.doc_id][x["first"] : x["last"]])) for x in r.spans] == [words[x["first"] : x["last"]] for x in r.runs]
    assert any(w[5] for w in want) and decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.where("false")).where("contaminated").count() == 0
    kept = decontaminate.keep_clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not w[5] for w in want)


def test_op7_word_offsets():
    t = "Ab, cd-é"
    assert [t[a:b] for a, b in decontaminate.word_spans(t)] == ["Ab", "cd", "é"]
    assert decontaminate.words_of(t) == [b"ab", b"cd", "é".encode()]


def removed(rows, length):
    from collections import Counter

    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (i, _), d in zip(rows, data):
        mark = bytearray(len(d))
        for a in range(len(d) - length + 1):
            if seen[d[a : a + length]] > 1:
                mark[a : a + length] = b"\1" * length
        kept = bytes(x for x, m in zip(d, mark) if not m)
        spans = sum(mark[k] and not (k and mark[k - 1]) for k in range(len(d)))
        out.append((i, len(d), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("many", [500, 1])
def test_op8_equals_window_counts(docs, none, monkeypatch, many):
    monkeypatch.setattr(suffix.repeated_runs, "__defaults__", (200, "text", "doc_id", None, False, many))
    got = suffix.deduplicate(docs, 200)
    assert by_id(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == removed(texts(), 200)
    assert suffix.deduplicate(none).count() == 0
    kept = suffix.keep_unique(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_op8_two_stage_sorting():
    random.seed(9)
    for n in [0, 1, 2, 5, 40, 200]:
        for alphabet in (b"a", b"ab", b"abc\x00\xff"):
            d = bytes(random.choice(alphabet) for _ in range(n))
            order = suffix.suffix_array(d, n + 1)
            assert order.tolist() == sorted(range(n), key=lambda i: d[i:])
            direct = suffix.smaller_than_next(__import__("numpy").frombuffer(d, "u1"))
            assert direct.tolist() == [d[i:] < d[i + 1 :] for i in range(n)]


def test_op9_stores_and_reads_back(docs, none, tmp_path):
    want = []
    for i, t in texts():
        b = (t or "").encode()
        p = b + bytes(-len(b) % 64 if b else 64)
        png = media.to_png(p)
        want.append((i, len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(png), hashlib.sha256(png).hexdigest(), f"png 64x{len(p) // 64} grey8"))
        assert media.from_png(png) == p
    cols = ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
    got = media.media_columns(docs, folder=str(tmp_path / "m"))
    assert by_id(got, *cols) == sorted(want, key=str)
    assert media.media_columns(none, folder=str(tmp_path / "none")).count() == 0
    import tarfile

    names = [m.name for p in (tmp_path / "m").glob("*.tar") for m in tarfile.open(p)]
    assert {n.removesuffix(".png") for n in names} == {w[6] for w in want}


def test_op10_main_text(spark):
    notice = "All rights reserved. This site uses cookies to improve your experience; go on and you accept our terms and the privacy policy."
    page = lambda i: f"<html><body><div>{notice}</div><div><p>Own &amp; text {i}\n of  page</p><!-- x --><ul class='site-nav'><li>Home</ul></div></body></html>"
    full = "<html><head><title>t</title></head><body><nav>menu</nav><div class=\"ad\">buy</div><article><h1>Head</h1><p><b>One<br>two<p>Three &lt;x&gt;<script>var a='</p>';</script> end<aside>side</aside><section class='comments'><p>me too</section></article><footer>&copy; foot</footer>"
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(4)] + [(7, "http://h.example/again", page(1)), (8, None, None), (9, "u", ""), (10, "http://z/", f"<p>{notice}</p>"), (11, "http://h.example/x", full), (None, "u", "<article>x"), (12, "u", "plain < text")]
    got = {r.page_id: r for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("open", F.lit(1))).collect()}
    assert len(got) == len(rows)
    for i in range(4):
        assert got[i].text == f"Own & text {i} of page" and got[i].n_chars == len(got[i].text)
    assert got[7].text == got[1].text and got[8].text == got[9].text == "" and got[10].text == notice
    assert got[11].text == "Head\nOne two\nThree <x> end" and got[None].text == "x" and got[12].text == "plain < text"
    assert html.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_op10_host_array_judges_blocks_of_articles_too(spark):
    rng = random.Random(14)
    part = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n)).strip("  ").replace("  ", "x").replace("  ", "y")
    line, quote, own = part(150), part(160), [part(200) for _ in range(4)]
    page = lambda i, *more: f"<nav>{quote}</nav><article><p>{own[i]}</p>{''.join(f'<p>{x}</p>' for x in more)}</article>"
    rows = [(0, "http://h/0", page(0, line)), (1, "http://h/1", page(1, line)), (2, "http://h/2", page(2)), (3, "http://h/copy", page(2)), (4, "http://other/", page(3, line)), (5, "http://h/5", f"<div>{quote}</div><p>{own[3]}</p><p>{line}</p>")]
    got = {r.page_id: r for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in (0, 1):
        assert got[i].text == f"{own[i]}\n{line}" and got[i].n_shared == len(line)
    assert got[2].text == got[3].text == own[2] and got[2].n_shared == got[3].n_shared == 0
    assert got[4].text == f"{own[3]}\n{line}" and got[4].n_shared == 0
    # What an article quotes is no boilerplate of a page without one; what stands in another page's menu is.
    assert got[5].text == f"{own[3]}\n{line}" and got[5].n_shared == 0


def test_op10_marks_are_hints():
    text = lambda page: "\n".join(html.blocks_of(page)[0])
    assert text('<main class="main with-sidebar"><p>a</main>') == "a"
    assert text('<article class="post category-legal"><p>a</article>') == "a"
    assert text('<div class="content has-sidebar"><article>a<figure class="side-by-side"><figcaption>b</figcaption></figure></article></div>') == "a\nb"
    assert text('<article><div class="article-header"><h1>h</h1></div><p>a<div class="article-footer">f</div></article>') == "h\na"
    assert text('<article><p>a</p><article><p>me too</p></article><p>b</article><article class="comment">c</article>') == "a\nb"
    assert text('<div class="sidebar"><article>teaser</article></div><article>a<div class="cookie-notice">n</div><nav>m</nav></article>') == "a"
    assert html.blocks_of("<main></main><p>a</p>")[1:] == (["a"], [], False)
    assert html.blocks_of("<head><title>t</title><body><p>a</p>")[1] == html.blocks_of("<head><meta charset=x></head><p>a</p>")[1] == ["a"]
    assert html.blocks_of('<p it\'s>a</p><a href="x>b</a> c')[1] == ["a", "b c"] and html.blocks_of("a < b <3 <p")[1] == ["a < b <3"]
    assert html.blocks_of("<p>x<script>var a = '</p>'; // </scripts></SCRIPT >y<style>")[1] == ["xy"]


@pytest.mark.parametrize("page", ['<p class="x>t' * 100_001, "<p a=' b=\" c>t" * 50_000, "<div>" * 50_000 + "</section>" * 50_000, "<" * 300_000, "<script </script " * 30_000, "<!-- " * 60_000, "<a href=" + " " * 300_000, "<p>" + "word " * 400_000])
def test_op10_hostile_pages_take_little_time(page):
    import time

    began = time.process_time()
    html.blocks_of(page)
    assert time.process_time() - began < 4


def test_op10_host_array_finds_what_two_pages_share(spark):
    rng = random.Random(12)
    part = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    menus = [part(140) for _ in range(3)]
    rows = [(i, f"h{i % 3}", part(60) + rng.choice(menus)[rng.randint(0, 60) :] + part(80) + rng.choice(menus) + part(30)) for i in range(24)]
    rows += [(30, "h0", menus[0] + part(50) + menus[0]), (31, "alone", part(100) * 3), (32, "h1", "")]
    runs = {r._k: [(x["a"], x["b"]) for x in r.runs] for r in html.host_boilerplate(spark.createDataFrame(rows, "stream long, host string, text string"), 96).collect()}
    owners = {}
    for i, host, text in rows:
        for at in range(len(text) - 95):
            owners.setdefault((host, text[at : at + 96]), set()).add(i)
    for i, host, text in rows:
        want = [any(len(owners[host, text[a : a + 96]]) > 1 for a in range(max(0, at - 95), min(at, len(text) - 96) + 1)) for at in range(len(text))]
        got = [any(a <= at < b for a, b in runs.get(i, [])) for at in range(len(text))]
        assert got == want
    assert runs and 31 not in runs


def test_op10_shuffles_few_texts(spark):
    rng = random.Random(15)
    part = lambda n: "".join(rng.choices("abcdefgh ijklmnop", k=n)).replace("  ", "xy").strip() + "z"
    line, own = part(150), [part(20_000) for _ in range(200)]
    rows = [(i, "http://h/", f"<nav>Home</nav><article><p>{t}</p>{f'<p>{line}</p>' * (i < 3)}</article>") for i, t in enumerate(own)]
    written = lambda: spark._jsc.sc().statusStore().executorList(True).head().totalShuffleWrite()
    pages, before = spark.createDataFrame(rows, "page_id long, url string, html string"), written()
    got = {r.page_id: r for r in html.main_text(pages).collect()}
    assert all(got[i].text == t + f"\n{line}" * (i < 3) and got[i].n_shared == len(line) * (i < 3) for i, t in enumerate(own))
    assert written() - before < 0.8 * sum(map(len, own))


@pytest.mark.parametrize("anchor, rescan", [(64, True), (32, False), (32, True)])
def test_op10_arrays_do_not_depend_on_anchors(spark, anchor, rescan):
    rng = random.Random(16)
    part = lambda n: "".join(rng.choices("abcdé", k=n))
    menus = [part(140) for _ in range(3)]
    rows = [(i, f"h{i % 2}", part(60) + rng.choice(menus)[rng.randint(0, 60) :] + part(80) + rng.choice(menus) + part(30)) for i in range(30)] + [(40, "h0", None), (41, "h1", "")]
    df = spark.createDataFrame(rows, "doc_id long, host string, text string")
    runs = lambda **more: {r._k: suffix.merged([tuple(x) for x in r.runs]) for r in suffix.repeated_runs(df, 96, group="host", across=True, **more)[1].collect()}
    assert runs(anchor=anchor, rescan=rescan) == runs() != {}


def test_pipeline_written_tables_leave_no_shuffle_files(spark):
    import time

    from threadmill.llm import storage

    files = lambda: {f for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    before = files()
    out = storage.written(spark.range(5_000).groupBy((F.col("id") % 70).alias("g")).count().repartition("count", "g"), "test")
    end = time.time() + 10
    while (left := files() - before) and time.time() < end:
        time.sleep(0.2)
    assert not left and out.count() == 70 and spark.conf.get(storage.CLEANUP, "false") == "false"


def test_pipeline_pairs_are_written_in_few_part_files(spark, monkeypatch):
    few, rng, plain, sizes = 3, random.Random(17), simwide.written, []
    body = [" ".join(rng.choices([f"w{i}" for i in range(400)], k=60)) for _ in range(60)]
    df = spark.createDataFrame([(i, t + " tail" * (i > 59)) for i, t in enumerate(body + body)], "doc_id long, text string")

    def noted(table, kind):
        out = plain(table, kind)
        sizes.append((kind, len(out.inputFiles())))
        return out

    monkeypatch.setattr(simwide, "written", noted)
    monkeypatch.setattr(simwide, "_part_files", lambda rows: few)
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        assert simwide.keep_one(df).count() == 60
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert {"candidates", "sets", "similar-pairs"} <= {k for k, _ in sizes}
    assert all(n <= few for k, n in sizes if k in ("candidates", "sets", "similar-pairs"))


def test_pipeline_stages_write_few_part_files(spark, monkeypatch):
    most, rng, plain, sizes = 24, random.Random(19), simwide.written, []
    words = [f"w{i}" for i in range(400)]
    quote = " ".join(rng.choices(words, k=90))
    rows = [(i, " ".join(rng.choices(words, k=40)) + " " + quote[i % 7 : 240 + i % 11] + " " + " ".join(rng.choices(words, k=40))) for i in range(120)]
    rows += [(120 + i, t + " tail" * (i > 20)) for i, t in rows[:40]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(i, rows[i][1]) for i in range(9)], "item_id long, text string")

    def noted(table, kind):
        out = plain(table, kind)
        sizes.append((kind, len(out.inputFiles())))
        return out

    for module in (simhash, simwide, suffix, decontaminate):
        monkeypatch.setattr(module, "written", noted)
    monkeypatch.setattr(suffix.repeated_runs, "__defaults__", (200, "text", "doc_id", None, False, 1))
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", str(most + 6))
        distinct = noted(simwide.keep_one(df), "kept-rows")
        cut = noted(suffix.keep_unique(df), "cut-rows")
        clean = noted(decontaminate.keep_clean(df, bench), "clean-rows")
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    kinds = {k for k, _ in sizes}
    assert {"links", "found-classes", "kept", "repeated-anchors", "segments", "covered", "longer-anchors", "longer-covered", "runs", "benchmark-windows"} <= kinds
    assert [x for x in sizes if x[1] > most] == [] and max(n for k, n in sizes if k == "links") <= 4
    assert sorted(r.doc_id for r in distinct.collect()) == list(range(120))
    data = {i: hashlib.sha256(r.text.encode()).hexdigest() for r in cut.collect() for i in [r.doc_id]}
    assert [(i, data[i]) for i in sorted(data)] == sorted((x[0], x[4]) for x in removed(rows, 200))
    held_out = {tuple(w[a : a + 10]) for w in (WORD.findall(rows[i][1]) for i in range(9)) for a in range(len(w) - 9)}
    want = [i for i, t in rows if not any(tuple(w[a : a + 10]) in held_out for w in [WORD.findall(t)] for a in range(len(w) - 9))]
    assert sorted(r.doc_id for r in clean.collect()) == want


def test_pipeline_workers_hold_one_operator_and_few_bytes(spark, sf):
    import corpus_pipeline
    from pyspark.sql.types import LongType, StructField, StructType

    def seen(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    setting, plan = "spark.sql.execution.arrow.maxBytesPerBatch", spark.range(0, 4_000, 1, 1).select(F.repeat(F.lit("long text "), 500).alias("t"))
    spark.conf.unset(setting)
    for _, stage in corpus_pipeline.STAGES[:2]:
        assert len(stage(spark, docs, sf).columns) == 5
        rows = [r.n for r in plan.mapInArrow(seen, StructType([StructField("n", LongType())])).collect()]
        assert sum(rows) == 4_000 and max(rows) * 5_000 < 8_000_000
        spark.conf.unset(setting)
    from threadmill.llm import storage

    gone = []
    for owner in "aabba":
        storage.hold(owner, lambda x=owner: gone.append(x))
    assert gone == ["a", "b"]


def test_pipeline_stages_take_effect(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    sizes = [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.written(stage(spark, docs, sf), "test")
        assert i == 4 or docs.columns == names
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] >= sizes[4] == sizes[5] > sizes[0] // 2
    assert docs.where("not decodes").count() == 0
    assert corpus_pipeline.run(spark, sf).count() == sizes[-1]


def test_every_operator_has_a_query():
    from threadmill.llm import queries

    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


def test_caches_hold_no_long_runs():
    import tiktoken

    long = "字" * 400 + " " + "a1b2" * 300 + " plain words " + "字" * 400
    b = bpe.ByteBPE(BPE, P.PATTERN)
    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(BPE), special_tokens={})
    packed = b"".join(i.to_bytes(4, "little") for i in ref.encode_ordinary(long))
    assert b.encode(long) == packed and b.encode(long) == packed
    assert max(map(len, b.cache)) <= bpe.CACHE_LENGTH
    counter = tokencount.load(P.path("piece_bpe_32k.model"))
    first = counter.text(long)
    assert counter.text(long) == first and first[1] == sum(counter.walk(["▁" + w])["▁" + w] for w in long.split(" ") if w)
    assert max(map(len, counter.counts)) <= tokencount.CACHE_LENGTH
    score = toxicity.Scorer({"": 0.0, "pla-": 1.0})
    assert score(long) == score(long) > 0.5 and max(map(len, score.known)) <= toxicity.CACHE_LENGTH


def test_op4_learns_one_text_of_a_repeated_id(spark):
    rows = toxic_texts(300, 5)
    df = spark.createDataFrame([(i, r[1]) for i, r in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, r[2]) for i, r in enumerate(rows)], "doc_id long, toxic int")
    repeated = df.union(df.where("doc_id < 9")).union(df.where("doc_id < 9"))
    assert toxicity.train(repeated, labels) == toxicity.train(df, labels)
    assert 0 < len(toxicity.train(repeated, labels, rows=100))
