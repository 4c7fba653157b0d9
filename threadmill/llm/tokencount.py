"""Token counts of a unigram vocabulary by dynamic programming shared over a trie.

A text is cut into pre-tokens (runs without ASCII white space, a word mark put before each). A
pre-token's tokens are those of its best-scored segmentation into vocabulary pieces; between
equal scores the one with fewer tokens counts. The best score of a prefix does not depend on what follows, so the
distinct pre-tokens of a batch are put in a trie and forward scores are computed once per trie
node: words in order walk the trie depth first, and the scores along the path to a word are kept
on a stack. Counts at terminals are remembered in a bounded cache and summed for each text.

Characters outside the vocabulary are spelt in UTF-8 bytes, one token each. Scores are whole numbers
(millionths), so results do not depend on the order of additions. A vocabulary file whose scores
are merge ranks (-0, -1, -2, ...) is read by Zipf's law: rank r has log-probability -ln(r + 2).

Defined results: null and empty texts and texts of white space have no tokens; repeated rows give
a row each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens whose counts a worker remembers, at most.
CACHE_WORDS = 800_000
#: Characters of a pre-token that is remembered, at most: longer ones are counted anew in each text.
CACHE_LENGTH = 64
#: The mark before a word (a fixed value of the vocabulary files).
MARK = "▁"

_WORDS = re.compile("[^\x20\x09-\x0d]+")


class TrieCounter:
    """Token counts of pre-tokens, for pieces with whole-number scores."""

    def __init__(self, pieces: dict[str, int], byte_score: int | None = None):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.byte_score = min([*pieces.values(), 0]) - 10_000_000 if byte_score is None else byte_score
        self.counts: dict[str, int] = {}

    def walk(self, words: list[str]) -> dict[str, int]:
        """Terminal counts of sorted distinct words, each trie node scored once."""
        out: dict[str, int] = {}
        get, longest, unit = self.pieces.get, self.longest, self.byte_score
        last, score, count = "", [0], [0]
        for word in words:
            shared, most = 0, min(len(last), len(word))
            while shared < most and last[shared] == word[shared]:
                shared += 1
            del score[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                n = len(word[end - 1].encode("utf-8", "surrogatepass"))
                best, tokens = None, 0
                for start in range(max(0, end - longest), end):
                    s = get(word[start:end])
                    if s is not None:
                        s += score[start]
                        k = count[start] + 1
                        if best is None or s > best or s == best and k < tokens:
                            best, tokens = s, k
                spelt = score[end - 1] + n * unit
                if best is None or spelt > best:
                    best, tokens = spelt, count[end - 1] + n
                score.append(best)
                count.append(tokens)
            out[word] = count[-1]
            last = word
        return out

    def text(self, text: str | None) -> tuple[int, int]:
        """Pre-tokens and tokens of a text."""
        words = [MARK + w for w in _WORDS.findall(text or "")]
        counts = self.counts
        try:
            return len(words), sum(map(counts.__getitem__, words))
        except KeyError:
            self.learn(words)
            total = sum(map(self.counts.__getitem__, words))
            for w in {w for w in words if len(w) > CACHE_LENGTH}:
                del self.counts[w]
            return len(words), total

    def learn(self, words) -> None:
        """Count those of ``words`` that the cache lacks, in one walk."""
        new = sorted({w for w in words if w not in self.counts})
        if len(self.counts) + len(new) > CACHE_WORDS:
            self.counts.clear()
            new = sorted(set(words))
        self.counts.update(self.walk(new))


def zipf(score: float) -> int:
    """Millionths of the log-probability of a merge rank given as a score of minus rank."""
    return -round(1_000_000 * math.log(min(-score, 1e9) + 2))


@lru_cache(maxsize=4)
def load(path: str) -> TrieCounter:
    """Counter for a sentencepiece model file; control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]
    return TrieCounter({model.id_to_piece(i): zipf(model.get_score(i)) for i in ids})


def token_counts(df: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of ``df``: ``key``, ``n_pretokens``, ``n_tokens``. One pass, no shuffle."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        counter = load(path)
        for b in batches:
            texts = b.column(1).to_pylist()
            for at in range(0, len(texts), 500):  # one walk for the new words of these texts
                part = {MARK + w for t in texts[at : at + 500] for w in set(_WORDS.findall(t or ""))}
                counter.learn(part)
                found = [counter.text(t) for t in texts[at : at + 500]]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, 500), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], [key, "n_pretokens", "n_tokens"])

    return df.select(key, F.col(text).alias("_text")).mapInArrow(run, f"`{key}` {kind}, n_pretokens long, n_tokens long")
