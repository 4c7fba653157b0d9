"""The guard's pairs: exact in any slicing and blocks, and in no shuffle."""

import random

import pytest

from threadmill.operators import guard

ORDER = {"train": 0, "val": 1, "test": 2}


def texts(spark, n=90):
    rng, data = random.Random(7), []
    for i in range(n):
        t = [f"w{rng.randrange(40)}" for _ in range(rng.choice([0, 3, 9, 40]))]
        if data and i % 3 == 0:
            t = rng.choice(data)[3].split()
            t = t[:-1] if i % 2 else t
        if data and i % 7 == 0:
            t = t + "an often repeated closing line of a mail".split()
        data.append((f"r{i}", rng.choice(list(ORDER)), rng.choice([None, "t1", "t2", "t3"]), " ".join(t)))
    # Equal sets of shingles, other numbers of tokens: x x x x x x and one x more.
    data += [("x6", "train", None, "x " * 6), ("x60", "test", None, "x " * 60 + "y"), ("x61", "val", None, "x " * 61 + "y")]
    return spark.createDataFrame(data, "row_id string, split string, thread_id string, text string")


def brute(prints):
    out = {}
    for a in prints:
        for b in prints:
            if ORDER[a.split] < ORDER[b.split] and not (a.thread_id is not None and a.thread_id == b.thread_id):
                s, t = set(a.grams), set(b.grams)
                j, h = len(s & t) / len(s | t) if s | t else 0.0, ((a.simhash ^ b.simhash) & (2**64 - 1)).bit_count()
                if j >= 0.7 or h <= 8:
                    out[a.row_id, b.row_id] = (h, round(j + 1e-12, 3))
    return out


@pytest.mark.parametrize("block, slice_", [(32_768, 4_000_000), (9, 50)])
def test_pairs_equal_brute_force_in_any_slices(spark, monkeypatch, block, slice_):
    monkeypatch.setattr(guard, "BLOCK", block)
    monkeypatch.setattr(guard, "SLICE", slice_)
    prints = guard.fingerprints(texts(spark))
    want = brute(prints.collect())
    got = guard.contamination_pairs(prints).collect()
    assert {(r.row_a, r.row_b): (r.hamming, r.jaccard) for r in got} == want and len(got) == len(want)
    assert any(j >= 0.7 and h > 8 for h, j in want.values()) and ("x60", "x61") not in want and ("x61", "x60") in want
    one = guard.contamination_summary(guard.contamination_pairs(prints), prints).first()
    assert (one.total_rows, one.n_pairs) == (93, len(want))
    assert guard.summary_of_ends(guard.contamination_ends(prints), prints).first() == one
    counted, listed = (sorted(map(tuple, x.collect())) for x in (guard.contamination_ends(prints), guard.ends(guard.contamination_pairs(prints))))
    assert counted == listed
    assert one.contaminated_row_pct == round(len({r for p in want for r in p}) * 100 / 93, 2)


def test_pairs_go_through_no_shuffle(spark):
    pairs = guard.contamination_pairs(guard.fingerprints(texts(spark, 20)))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Exchange") and "Join" not in plan


def test_no_rows_no_pairs(spark):
    none = texts(spark, 1).where("row_id = 'none'")
    assert guard.contamination_pairs(guard.fingerprints(none)).collect() == []
    assert guard.contamination_summary(guard.contamination_pairs(guard.fingerprints(none)), none).first().status == "PASS"
