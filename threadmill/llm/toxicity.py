"""Toxicity scores from a counterfactually regularised classifier.

A logistic model over the presence of words and word beginnings (3 to 6 letters, which catch inflected
and compounded insults in any language). Training swaps identity terms in labelled sentences and
adds the squared change of the score's logit to the loss, so that naming a group cannot move a
score: each term's weight is drawn to that of every other term and of neutral words.

The model is fitted in one task on a bounded sample of labelled rows (``SAMPLE_ROWS``, by hash of the
id), near copies of which count once; the weights (``FEATURES`` at most) are broadcast; every whole
text is scored in one pass without a shuffle.

Defined results: null and empty texts get the score of a text without any known feature; rows
with a null id are scored and not held out; labels that are null are left out and of several labels
of one id the highest counts, of several texts of one id the least is learned from; without labels of both classes every score is the labels' mean (0 if none).
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import hold

#: Labelled rows that the model is fitted on, at most.
SAMPLE_ROWS = 6_000
#: Features that the model keeps, at most.
FEATURES = 5_000
#: Distinct sample texts of class 1 that a feature occurs in, at least.
LEAST_TEXTS = 5
#: Words whose features a worker remembers, at most.
CACHE_WORDS = 200_000
#: Characters of a word that is remembered, at most.
CACHE_LENGTH = 64

#: Identity terms that are swapped for one another, and neutral words that they are swapped for (fixed values).
IDENTITY_TERMS = (
    "women men woman man girls boys muslims muslim christians christian jews jewish hindus hindu buddhists atheists gay lesbian bisexual "
    "transgender queer straight black white asian african arab latino hispanic indian chinese mexican immigrants immigrant refugees "
    "foreigners disabled deaf blind elderly old young poor frauen männer juden muslime christen ausländer flüchtlinge schwule lesben "
    "femmes hommes juifs musulmans chrétiens immigrés étrangers noirs blancs mujeres hombres judíos musulmanes cristianos inmigrantes negros blancos"
).split()
NEUTRAL_TERMS = "people persons leute personen gens personnes gente personas".split()

_WORDS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return [word, *(word[:n] + "-" for n in range(3, 7) if len(word) > n or n == len(word))]


def _text_features(text: str | None) -> set[str]:
    out: set[str] = set()
    for w in set(words_of(text)):
        out.update(features_of(w))
    return out


def _sketch(words: set[str]) -> tuple[int, ...]:
    """Three least word hashes: near copies share them."""
    return tuple(sorted(zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words)[:3])


def counterfactuals(texts: list[str], index: dict[str, int], seed: int = 4) -> list[tuple[list[int], list[int]]]:
    """Features gained and lost when identity terms of a sentence are swapped for other terms."""
    rng = np.random.default_rng(seed)
    terms, others = set(IDENTITY_TERMS), IDENTITY_TERMS + NEUTRAL_TERMS
    pairs = []
    for t in texts:
        for sentence in _SENTENCE.split(t or ""):
            for w in terms.intersection(words_of(sentence)):
                new = others[int(rng.integers(len(others)))]
                gained = [index[f] for f in features_of(new) if f in index]
                lost = [index[f] for f in features_of(w) if f in index]
                if gained != lost:
                    pairs.append((gained, lost))
    # Terms stand for themselves once as well, so that each is tied to a neutral word.
    for i, w in enumerate(IDENTITY_TERMS):
        new = NEUTRAL_TERMS[i % len(NEUTRAL_TERMS)]
        pairs.append(([index[f] for f in features_of(new) if f in index], [index[f] for f in features_of(w) if f in index]))
    return [p for p in pairs if p[0] or p[1]]


def fit(texts: list[str | None], labels: list[int], penalty: float = 1.0, decay: float = 3e-5, steps: int = 500) -> dict[str, float]:
    """Weights by feature; the intercept has the empty name."""
    kept: dict[tuple, tuple[str | None, int]] = {}
    for t, y in zip(texts, labels):
        kept.setdefault((_sketch(set(words_of(t))), y), (t, y))
    rows = list(kept.values())
    y = np.array([r[1] for r in rows], float)
    ones = int(y.sum())
    if not ones or ones == len(y):
        mean = float(np.mean(labels)) if len(labels) else 0.0
        return {"": math.log((mean + 1e-4) / (1 - mean + 1e-4))}
    positive: dict[str, int] = {}
    for t, label in rows:
        if label:
            for f in _text_features(t):
                positive[f] = positive.get(f, 0) + 1
    least = min(LEAST_TEXTS, max(2, ones // 10))
    seen = {f: 0 for f, n in positive.items() if n >= least}
    for t, label in rows:
        if not label:
            for f in _text_features(t):
                if f in seen:
                    seen[f] += 1
    zeros = len(y) - ones

    def gain(f: str) -> float:
        a, b = positive[f], seen[f]
        p, q, r = a / ones, b / zeros, (a + b) / len(y)
        if p <= 3 * (b + 0.5) / zeros:
            return 0.0
        g = a * math.log(p / r) + (b * math.log(q / r) if b else 0)
        g += (ones - a) * math.log((1 - p + 1e-12) / (1 - r)) + (zeros - b) * math.log((1 - q) / (1 - r))
        return g

    gains = {f: g for f in seen if (g := gain(f)) > 8.0}
    chosen = sorted(gains, key=lambda f: (-gains[f], f))[:FEATURES]
    named = [f for w in (*IDENTITY_TERMS, *NEUTRAL_TERMS) for f in features_of(w)[:1] if f not in gains]
    index = {f: i for i, f in enumerate([*chosen, *named])}
    doc, col = [], []
    for i, (t, _) in enumerate(rows):
        hits = [index[f] for f in _text_features(t) if f in index]
        doc += [i] * len(hits)
        col += hits
    doc, col = np.array(doc, np.int64), np.array(col, np.int64)
    pairs = counterfactuals([r[0] for r in rows], index)
    pd = np.array([i for i, (a, b) in enumerate(pairs) for _ in (*a, *b)], np.int64)
    pc = np.array([c for a, b in pairs for c in (*a, *b)], np.int64)
    ps = np.array([s for a, b in pairs for s in ([1.0] * len(a) + [-1.0] * len(b))])
    n, m = len(rows), len(index)
    w, bias = np.zeros(m), math.log(ones / zeros)
    mom, var = np.zeros(m + 1), np.zeros(m + 1)
    for step in range(1, steps + 1):
        z = bias + np.bincount(doc, w[col], n)
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        grad = np.bincount(col, err[doc], m) + decay * w
        if len(pairs):
            change = np.bincount(pd, ps * w[pc], len(pairs))
            grad += penalty * 2 / len(pairs) * np.bincount(pc, ps * change[pd], m)
        g = np.append(grad, err.sum())
        mom, var = 0.9 * mom + 0.1 * g, 0.99 * var + 0.01 * g * g
        move = 0.1 * (mom / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.99**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    out = {f: float(w[i]) for f, i in index.items() if w[i] > 1e-3 or w[i] < -1e-3}
    out[""] = float(bias)
    return out


class Scorer:
    """Scores texts by a model's weights."""

    def __init__(self, weights: dict[str, float]):
        self.bias = weights.get("", 0.0)
        self.weights = {f: w for f, w in weights.items() if f}
        self.known: dict[str, tuple[str, ...]] = {}

    def __call__(self, text: str | None) -> float:
        found: set[str] = set()
        known = self.known
        for w in set(words_of(text)):
            f = known.get(w)
            if f is None:
                f = tuple(x for x in features_of(w) if x in self.weights)
                if len(w) <= CACHE_LENGTH:
                    if len(known) >= CACHE_WORDS:
                        known.clear()
                    known[w] = f
            if f:
                found.update(f)
        z = self.bias + sum(self.weights[f] for f in sorted(found))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


_scorers: dict[str, Scorer] = {}


def held_out(key: str = "doc_id", folds: int = 4, fold: int = 2):
    """Column: whether a row's id falls into the fold that is not learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def train(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", rows: int = SAMPLE_ROWS) -> dict[str, float]:
    """Weights fitted on at most ``rows`` labelled rows outside the held-out fold."""
    marked = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key)).groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("_y"))
    n = marked.count()
    share = F.pmod(F.xxhash64("_key", F.lit(4)), F.lit(1 << 30)) / float(1 << 30)
    if n > rows:
        marked = marked.where(share < 0.95 * rows / n).orderBy(F.xxhash64("_key", F.lit(4)), "_key").limit(rows)
    # At most ``rows`` ids, one text of each: bounded, so the texts stay where they are.
    sample = df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(marked), "_key").groupBy("_key", "_y").agg(F.min("_text").alias("_text")).select("_key", "_text", "_y")

    def run(batches):
        held = sorted(((k, t or "", y) for b in batches for k, t, y in zip(*(b.column(i).to_pylist() for i in range(3)))))
        weights = fit([h[1] for h in held], [h[2] for h in held])
        yield pa.RecordBatch.from_arrays([pa.array(list(weights), pa.string()), pa.array(list(weights.values()), pa.float64())], ["feature", "weight"])

    fitted = sample.repartition(1).mapInArrow(run, "feature string, weight double")
    return {r.feature: r.weight for r in fitted.collect()} or {"": math.log(1e-4)}


def scores(df: DataFrame, weights: dict[str, float], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every row and its ``score``."""
    import uuid

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema)
    held, tag = df.sparkSession.sparkContext.broadcast(weights), uuid.uuid4().hex

    def run(batches):
        if tag not in _scorers:
            _scorers.clear()
            _scorers[tag] = Scorer(held.value)
        score = _scorers[tag]
        for b in batches:
            s = [score(t) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(s, pa.float64())], [*keep, "score"])

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, f"{kinds}, score double")


def toxicity(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = 0.3) -> DataFrame:
    """One row per row of ``df``: ``key``, ``held_out``, ``score`` (0 to 1), ``predicted`` (0 or 1)."""
    found = scores(df, train(df, labels, text, key), text, (key,))
    return found.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_civil(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = 0.3) -> DataFrame:
    """Rows of ``df``, all columns, that score below ``threshold``."""
    import uuid

    held, tag = df.sparkSession.sparkContext.broadcast(train(df, labels, text, key)), uuid.uuid4().hex
    at = df.columns.index(text)

    def run(batches):
        hold("toxicity", _scorers.clear)
        if tag not in _scorers:
            _scorers.clear()
            _scorers[tag] = Scorer(held.value)
        score = _scorers[tag]
        for b in batches:
            yield b.filter(pa.array([score(t) < threshold for t in b.column(at).to_pylist()], pa.bool_()))

    return df.mapInArrow(run, df.schema)
