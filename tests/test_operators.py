"""Operators against plain Python, properties and edge cases."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from threadmill.functions import hashing, text
from threadmill.operators import guard, manifest, materialize, privacy, retrieval, sampling
from threadmill.sources import files, mbox
from threadmill.streaming import incremental


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_buckets_equal_whole_numbers(spark):
    ids = [f"t{i}" for i in range(200)] + ["", "é", "a b"]
    got = rows(spark, [(i,) for i in ids], "t string").select("t", hashing.hash_bucket_100(F.col("t"), 7), hashing.hash_bucket_spec(F.col("t"), 7), hashing.hash_bucket_1000(F.col("t"), 7)).collect()
    for t, a, b, c in got:
        h = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert a == int(h(f"7:{t}"), 16) % 100
        assert b == int(h(f"{t}-7"), 16) % 100
        assert c == int(h(f"7:{t}")[:8], 16) % 1000


def test_simhash_of_nothing_is_zero_and_repeats_count(spark):
    got = dict(hashing.simhash64(rows(spark, [("a", None), ("b", "x"), ("b", "x"), ("b", "y")], "row_id string, token string")).collect())
    h = {w: int(hashlib.sha256(w.encode()).hexdigest()[-16:], 16) for w in "xy"}
    want = sum(1 << i for i in range(64) if 2 * (2 * (h["x"] >> i & 1) - 1) + 2 * (h["y"] >> i & 1) - 1 > 0)
    assert got["a"] == 0 and got["b"] % (1 << 64) == want


def test_subjects_quotes_and_tokens(spark):
    r = rows(spark, [("Re: Re: X ", "> q\n On x <a@b> wrote:\nMy  Text", "Über foo_bar x1, naïve ok"), (None, None, None)], "s string, t string, b string")
    a, b = r.select(text.normalize_subject(F.col("s")), text.normalize_content(F.col("t")), text.bm25_tokens(F.col("b"))).collect()
    assert a[0] == "re: x" and a[1] == "my text" and a[2] == ["x1", "ok"]
    assert b[0] == "" and b[1] is None and b[2] == []


def test_shingles_of_short_texts(spark):
    w = rows(spark, [("",), ("a b c d",), ("a b c d e",), ("a a a a a a",)], "t string").select("t", text.tokens(F.col("t")).alias("w"))
    got = {r.t: r.g for r in w.select("t", text.shingles(F.col("w")).alias("g")).collect()}
    assert got == {"": [], "a b c d": [], "a b c d e": ["a b c d e"], "a a a a a a": ["a a a a a"]}


@pytest.mark.parametrize("n,size,overlap", [(1, 4, 1), (190, 100, 10), (4, 4, 0), (5, 4, 3), (0, 4, 1)])
def test_windows_follow_the_loop(spark, n, size, overlap):
    r = rows(spark, [(f"m{i}", "t", i) for i in range(n)], "message_id string, thread_id string, pos long")
    want, at = [], 0
    while at < n:
        want.append((at, min(at + size, n)))
        at += size - overlap
    got = sorted((w.window_start, w.window_end) for w in manifest.thread_windows(r, size, overlap).collect())
    assert got == want
    members = manifest.window_members(r, size, overlap).collect()
    assert sorted((m.window_idx, m.rn) for m in members) == sorted((i, k) for i, (a, b) in enumerate(want) for k in range(a, b))
    last = {m.message_id: m.window_idx for m in manifest.message_windows(r, size, overlap).collect()}
    assert last == {f"m{k}": max(i for i, (a, b) in enumerate(want) if a <= k) for k in range(n)}


def test_overlap_must_be_smaller(spark):
    with pytest.raises(ValueError):
        manifest.thread_windows(rows(spark, [], "message_id string, thread_id string"), 4, 4)


def test_manifest_is_append_only_and_threads_stay_together(spark):
    r = rows(spark, [(f"{t}-{i}", None if t == 9 else str(t), i) for t in range(30) for i in range(4)], "message_id string, thread_id string, pos long")
    old = manifest.assign_splits(r.where("pos < 2")).cache()
    new = manifest.assign_splits(r, old, seed=1)
    both = manifest.append_manifest(old, new).cache()
    assert both.count() == 120 and manifest.manifest_diff(old, both).count() == 0
    assert manifest.thread_split_violations(both.where("thread_id is not null")).count() == 0
    assert manifest.assign_splits(r, both).count() == 0
    share = {x.split: x.n_rows for x in manifest.manifest_stats(manifest.assign_splits(rows(spark, [(str(i), str(i)) for i in range(4000)], "message_id string, thread_id string"))).collect()}
    assert abs(share["train"] / 40 - 80) < 5 and abs(share["val"] / 40 - 10) < 5


def test_quota_follows_the_loop(spark):
    threads = [f"thread{i:03d}" for i in range(120)]
    train, val, want = int(120 * 0.5), int(120 * 0.1), {}
    for t in sorted(threads):
        b = int(hashlib.sha256(f"42:{t}".encode()).hexdigest()[:8], 16) % 1000
        if b < 800 and train:
            want[t], train = "train", train - 1
        elif b < 900 and val:
            want[t], val = "val", val - 1
        else:
            want[t] = "test"
    got = manifest.quota_assign(rows(spark, [(t,) for t in threads], "thread_id string"), (0.5, 0.1))
    assert {r.thread_id: r.split for r in got.collect()} == want


def test_pins_exclusions_and_tombstones_keep_rows_without_values(spark):
    r = rows(spark, [("a", "t", "2020-01"), ("b", None, None), (None, "t", ""), ("d", "u", "2021-01")], "message_id string, thread_id string, cohort string")
    assert {x.message_id for x in materialize.pin_filter(r, "2020-12").collect()} == {"a", "b", None}
    with pytest.raises(ValueError):
        materialize.pin_filter(r, "2020-1")
    gone = rows(spark, [("a",), (None,)], "id string")
    assert {x.message_id for x in materialize.exclude_anti(r, gone, "message_id").collect()} == {"b", None, "d"}
    tombs = rows(spark, [("thread", "t"), ("message", "d")], "level string, id string")
    assert [x.message_id for x in materialize.tombstone_anti(r, tombs).collect()] == ["b"]


def test_missing_length_is_an_error(spark):
    with pytest.raises(Exception, match="no length for b"):
        materialize.length_join(rows(spark, [("a",), ("b",)], "message_id string"), rows(spark, [("a", 3)], "message_id string, length long")).collect()


@pytest.mark.parametrize("block", [4_096, 7])
def test_guard_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(guard, "BLOCK", block)
    random.seed(5)
    words = [f"w{i}" for i in range(12)]
    data = []
    for i in range(60):
        t = " ".join(random.choice(words) for _ in range(random.choice([0, 2, 6, 8, 30])))
        data.append((f"r{i}", random.choice(["train", "val", "test"]), random.choice([None, "t1", "t2"]), t if i % 3 else data[i - 1][3] + " w1" if data else t))
    data += [("e1", "train", None, ""), ("e2", "test", None, None)]
    r = rows(spark, data, "row_id string, split string, thread_id string, text string")
    prints = guard.fingerprints(r)
    p = {x.row_id: x for x in prints.collect()}
    order = {"train": 0, "val": 1, "test": 2}
    want = set()
    for a in p.values():
        for b in p.values():
            if order[a.split] < order[b.split] and not (a.thread_id is not None and a.thread_id == b.thread_id):
                s, t = set(a.grams), set(b.grams)
                j = len(s & t) / len(s | t) if s | t else 0.0
                if j >= 0.7 or ((a.simhash ^ b.simhash) & (2**64 - 1)).bit_count() <= 8:
                    want.add((a.row_id, b.row_id))
    got = guard.contamination_pairs(prints).collect()
    assert {(x.row_a, x.row_b) for x in got} == want and len(got) == len(want)
    assert ("e1", "e2") in want
    with pytest.raises(ValueError):
        guard.contamination_pairs(prints, bits=65)


def test_replay_counts_follow_the_loop(spark):
    random.seed(2)
    sizes = {(f"s{i}", f"t{i}{j}"): random.randint(1, 9) for i in range(4) for j in range(3)}
    r = rows(spark, [(f"{s}{t}{k}", s, t) for (s, t), n in sizes.items() for k in range(n)], "message_id string, sender string, thread_id string")
    for n, least in ((0, 1), (5, 2), (30, 1), (500, 3)):
        done, one, two = 0, {}, {}
        for key in sorted(sizes):
            one[key] = min(least, sizes[key], n - done)
            done += one[key]
        left, total = n - done, sum(sizes.values())
        filled = 0
        for key in sorted(sizes):
            of = sum(v for k, v in sizes.items() if k[0] == key[0])
            quota = -(-left * of // total)
            two[key] = max(0, min(-(-quota * sizes[key] // of), sizes[key], left - filled)) if left > 0 else 0
            filled += two[key]
        got = {(x.sender, x.thread_id): (x.take1, x.take2) for x in sampling.replay_allocation(r, n, least).collect()}
        assert got == {k: (one[k], two[k]) for k in sizes}
        assert sampling.replay_sample(r, n, least).count() <= n
        assert sampling.replay_sample(r, n, least, mode="reference").count() == sum(one.values()) + sum(two.values())


def test_downsample_respects_its_target(spark):
    random.seed(3)
    r = rows(spark, [(f"m{i}", random.choice(["a", "b", None]), random.choice("xyz")) for i in range(300)], "message_id string, sender string, thread_id string")
    got = sampling.stratified_downsample(r, 50, 5, 2).collect()
    assert len(got) == 50 and len({x.message_id for x in got}) == 50
    assert len(sampling.stratified_downsample(r, 50, 5, 2, mode="reference").collect()) >= 50
    assert sampling.stratified_downsample(r, 400, 5, 2).count() == 300


def test_pool_keeps_the_first_and_one_without_id(spark):
    r = rows(spark, [("a", "s2", 1), ("a", "s1", 2), (None, "s1", 1), (None, "s2", 1)], "message_id string, shard string, pos long")
    assert sorted(map(tuple, sampling.pool_union_dedup(r).collect()), key=str) == sorted([("a", "s1", 2), (None, "s1", 1)], key=str)


def test_bm25_counts_repeated_query_tokens(spark):
    docs = rows(spark, [("d1", "cat cat dog"), ("d2", "dog"), ("d3", None)], "doc_id string, text string")
    got = {x.doc_id: x.score for x in retrieval.bm25_match(docs, rows(spark, [("q", "cat cat dog")], "query_id string, query string")).collect()}
    avg, n = 4 / 3, 3
    idf = lambda df: math.log((n - df + 0.5) / (df + 0.5) + 1)
    part = lambda tf, dl, df: idf(df) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avg))
    assert got == {"d1": round(2 * part(2, 3, 1) + part(1, 3, 2), 6), "d2": round(part(1, 1, 2), 6)}


def test_pseudonyms_go_and_come_back(spark):
    r = rows(spark, [("1", "a@b.co and a@b.co, c@d.org"), ("2", "none"), ("3", None)], "message_id string, text string")
    hidden = privacy.pseudonymize_text(r, "salt").cache()
    assert privacy.leak_scan(hidden).count() == 0
    back = privacy.unpseudonymize(hidden, privacy.email_vault(r, "salt"))
    assert {x.message_id: x.text for x in back.collect()} == {x.message_id: x.text for x in r.collect()}
    assert privacy.dsr_delete(rows(spark, [], "message_id string, thread_id string, email string")).count() == 0


MAIL = b"""ignored before the first separator
From a@b Mon
Message-ID: <1@x>
Subject: =?utf-8?q?Caf=C3=A9?=
 folded
Date: Tue, 05 Mar 2024 10:00:00 +0000

Body one
From c@d Tue
Subject: Re: hello
References: <1@x> <0@x>

Body two
From e@f Wed
no headers at all
"""


@pytest.mark.parametrize("size", [1, 7, 40, 10**6])
def test_mailbox_ranges_give_each_message_once(spark, tmp_path, size):
    (tmp_path / "m.mbox").write_bytes(MAIL)
    got = sorted(mbox.scan_mbox(spark, str(tmp_path / "m.mbox"), size).collect(), key=lambda r: r.offset)
    parts = MAIL.decode().split("From ")[1:]
    assert [r.raw for r in got] == [p.split("\n", 1)[1] for p in parts]


def test_mail_headers(spark, tmp_path):
    (tmp_path / "m.mbox").write_bytes(MAIL)
    a, b, c = sorted(mbox.message_rows(mbox.scan_mbox(spark, str(tmp_path))).collect(), key=lambda r: r.email_message)[0:3]
    by = {r.subject: r for r in (a, b, c)}
    assert by["Café folded"].message_id == "1@x" and by["Café folded"].cohort_id == "2024-03"
    assert by["Re: hello"].thread_id == "1@x" and by["Re: hello"].message_id.startswith("synthetic-")
    assert by[None].thread_id == by[None].message_id


def test_files_with_faults(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n\n{bad\n{"x": 2}\n')
    (tmp_path / "b.jsonl").write_text('{"x": 3}\n')
    assert sorted(r.x for r in files.scan_jsonl_permissive(spark, str(tmp_path), "x long").collect()) == [1, 2, 3]
    assert files.scan_jsonl_permissive(spark, str(tmp_path), "x long", corrupt=True).count() == 1
    assert [r.x for r in files.scan_jsonl_file_atomic(spark, str(tmp_path), "x long").collect()] == [3]
    assert files.scan_id_list(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "ids.txt").write_text("a\nb\n\n")
    assert [r.id for r in files.scan_id_list(spark, str(tmp_path / "ids.txt")).orderBy("pos").collect()] == ["a", "b"]


def test_stream_equals_batch_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    r = rows(spark, [(f"m{i}", f"t{i % 7}") for i in range(40)], "message_id string, thread_id string")
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    r.limit(15).write.parquet(src)
    read = lambda: spark.readStream.schema(r.schema).parquet(src)
    incremental.incremental_ingest(read(), out, mark).awaitTermination()
    r.write.mode("append").parquet(src)
    incremental.incremental_ingest(read(), out, mark).awaitTermination()
    incremental.incremental_ingest(read(), out, mark).awaitTermination()
    got = incremental._manifest(spark, out).drop("batch")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, manifest.assign_splits(r).select(*got.columns).collect()))


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_ranks_and_sums_over_one_hot_group(spark):
    """One sender holds nearly all rows, ids share a prefix, column names clash, groups may be null."""
    from threadmill.operators import materialize, sampling

    rows = [("hot" if i % 50 else None, f"subject-{i:05d}", i) for i in range(700)]
    df = spark.createDataFrame(rows, "sender string, message_id string, size long").withColumns({"position": F.lit(1), "shard": F.lit("x"), "_p": F.lit(2)}).repartition(5)
    got = materialize.ranked(df, ["sender"], ["message_id"], "r")
    assert got.columns == [*df.columns, "r"]
    want = {}
    for sender, message, _ in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        want[message] = 1 + sum(1 for x in want if (rows[int(x[-5:])][0] == sender))
    assert {r.message_id: r.r for r in got.collect()} == want
    sums = {r.message_id: r.before for r in materialize.sum_before(df, F.col("size"), ["message_id"], "before").collect()}
    assert sums == {m: sum(range(n)) for _, m, n in rows}
    caps = sampling.bucket_caps_sample(df.withColumn("length", F.lit(10)), {"short": 30, "long": 5}, 20)
    assert sorted(r.position for r in caps.collect()) == list(range(1, 21))


def test_anti_joins_with_clashing_names(spark):
    from threadmill.operators import materialize

    rows = spark.createDataFrame([("a", "t", 1), ("b", None, 2), (None, "u", 3)], "message_id string, thread_id string, _gone int").withColumns({"__gone": F.lit(0), "_id": F.lit(0)})
    gone = spark.createDataFrame([("a", "message"), (None, "message"), ("u", "thread")], "id string, level string")
    assert [r.message_id for r in materialize.exclude_anti(rows, gone, "message_id").orderBy("_gone").collect()] == ["b", None]
    assert [r.message_id for r in materialize.tombstone_anti(rows, gone).collect()] == ["b"]


def test_ratios(spark):
    from threadmill.operators import sampling

    assert sampling.parse_ratio("1:4") == (1, 4) and sampling.parse_ratio(" 0:3 ") == (0, 3)
    for bad in ("", "1", "1:0", "a:b", "1:2:3", "-1:2"):
        with pytest.raises(ValueError):
            sampling.parse_ratio(bad)


def test_guard_finds_all_close_fingerprints(spark, monkeypatch):
    import random

    from threadmill.operators import guard

    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(6)]
    rows = []
    for i in range(150):
        x = rng.choice(centres)
        for _ in range(rng.randint(0, 7)):
            x ^= 1 << rng.randrange(64)
        rows.append((f"r{i}", ("train", "val", "test")[i % 3], x - (1 << 64) if x >> 63 else x))
    rows += [("copy", "test", rows[0][2]), ("same", "train", rows[0][2])]
    rank = {"train": 0, "val": 1, "test": 2}
    want = {(a[0], b[0]) for a in rows for b in rows if rank[a[1]] < rank[b[1]] and (((a[2] ^ b[2]) & (1 << 64) - 1).bit_count() <= 8)}
    prints = spark.createDataFrame(rows, "row_id string, split string, simhash long")
    for block in (4_096, 20):
        monkeypatch.setattr(guard, "BLOCK", block)
        got = [(r.row_a, r.row_b) for r in guard.close_fingerprints(prints, 8).collect()]
        assert len(got) == len(set(got)) and set(got) == want
