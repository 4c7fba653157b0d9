"""Byte-level BPE encoding and decoding with the ``tokenizers`` library over Arrow batches.

A rank file (base64 token, rank) becomes a ``tokenizers`` BPE model: each byte is written as
one printable character (the byte table), tokens are strings of these characters, and every
way of building a token from two others is a merge at that token's rank. A text is cut by the
pre-token pattern; each distinct pre-token is encoded once per worker by the library (in
batches, in a bounded cache) and the ids of a text are the ids of its pre-tokens in order.

Decoding reverses the byte table. Tokens may hold part of a character: bytes are joined over
the whole id sequence before they are read as UTF-8, so a character split over tokens is whole
again, and bytes that are no UTF-8 at all become U+FFFD in ``decode_text`` only.

Defined results: a null text is encoded as the empty text (no ids); lone surrogates cannot
occur in Spark strings; an empty table gives an empty result; repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import hold

#: Pre-tokens kept in a worker's cache, at most (about 200 bytes each).
CACHE_ENTRIES = 600_000
#: Characters of a pre-token that is kept, at most: longer runs (no white space, base64) are encoded anew in each text.
CACHE_LENGTH = 64


def byte_table() -> list[str]:
    """Character of each byte: printable Latin-1 stands for itself, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    table, spare = [], 0x100
    for b in range(256):
        if b in plain:
            table.append(chr(b))
        else:
            table.append(chr(spare))
            spare += 1
    return table


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, of a ``.tiktoken`` file."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    return ranks


class ByteBPE:
    """Encoder and decoder of one rank file and pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        table = byte_table()
        written = {t: "".join(map(table.__getitem__, t)) for t in ranks}
        merges = []
        for token in sorted(ranks, key=ranks.get):
            for cut in range(1, len(token)):
                left, right = token[:cut], token[cut:]
                if left in ranks and right in ranks:
                    merges.append((written[left], written[right]))
        self.model = Tokenizer(models.BPE({written[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False, trim_offsets=False)
        self.split = regex.compile(pattern).findall
        back = {c: b for b, c in enumerate(table)}
        size = max(ranks.values()) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for t, r in ranks.items():
            self.bytes_of[r] = bytes(back[c] for c in written[t])
        self.cache: dict[str, bytes] = {}

    def learn(self, pieces) -> None:
        """Encode those of ``pieces`` that the cache lacks."""
        cache = self.cache
        new = [p for p in pieces if p not in cache]
        if len(cache) + len(new) > CACHE_ENTRIES:
            cache.clear()
            new = list(pieces)
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            for p, e in zip(part, self.model.encode_batch_fast(part, add_special_tokens=False)):
                ids = e.ids
                cache[p] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of a text, as little-endian unsigned 32-bit integers."""
        pieces = self.split(text)
        try:
            return b"".join(map(self.cache.__getitem__, pieces))
        except KeyError:
            self.learn(dict.fromkeys(pieces))
            ids = b"".join(map(self.cache.__getitem__, pieces))
            for p in {p for p in pieces if len(p) > CACHE_LENGTH}:
                del self.cache[p]
            return ids

    def encode_with_offsets(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids and, for each, the characters of ``text`` it has bytes of, as [start, end)."""
        ids, spans, at = [], [], 0
        for piece in self.split(text):
            start = np.cumsum([0, *(len(c.encode()) for c in piece)])
            byte = 0
            for i in struct.iter_unpack("<I", self.encode(piece)):
                end = byte + len(self.bytes_of[i[0]])
                first = int(np.searchsorted(start, byte, "right")) - 1
                last = int(np.searchsorted(start, end, "left"))
                ids.append(i[0])
                spans.append((at + first, at + last))
                byte = end
            at += len(piece)
        return ids, spans

    def decode(self, ids) -> bytes:
        """Bytes of an id sequence (a list, or packed as by ``encode``)."""
        if isinstance(ids, (bytes, bytearray, memoryview)):
            ids = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_text(self, ids) -> str:
        """Text of an id sequence; characters split over tokens are joined first."""
        return self.decode(ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(path, pattern)


def _texts(batch: pa.RecordBatch, at: int) -> list[str]:
    return [t or "" for t in batch.column(at).to_pylist()]


def encode_frame(df: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), offsets: bool = False) -> DataFrame:
    """Columns ``keep`` of ``df`` with ``ids`` (array<int>) and, if asked for, ``starts``/``ends`` (characters)."""
    kept = df.select(*keep)
    extra = ", starts array<int>, ends array<int>" if offsets else ""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", ids array<int>" + extra

    def run(batches):
        bpe = load(path, pattern)
        for b in batches:
            ids, starts, ends = [], [], []
            for t in _texts(b, len(keep)):
                if offsets:
                    i, spans = bpe.encode_with_offsets(t)
                    starts.append([s for s, _ in spans])
                    ends.append([e for _, e in spans])
                    ids.append(i)
                else:
                    ids.append(np.frombuffer(bpe.encode(t), "<i4"))
            cols = [b.column(i) for i in range(len(keep))] + [pa.array(ids, pa.list_(pa.int32()))]
            names = [*keep, "ids"]
            if offsets:
                cols += [pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))]
                names += ["starts", "ends"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def decode_frame(df: DataFrame, path: str, pattern: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with the decoded ``bytes`` and ``text`` of ``ids``; null ids decode to nothing."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema) + ", bytes binary, text string"

    def run(batches):
        bpe = load(path, pattern)
        for b in batches:
            out = [bpe.decode(i or []) for i in b.column(len(keep)).to_pylist()]
            cols = [b.column(i) for i in range(len(keep))]
            cols += [pa.array(out, pa.binary()), pa.array([o.decode("utf-8", "replace") for o in out], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, [*keep, "bytes", "text"])

    return df.select(*keep, F.col(ids).alias("_ids")).mapInArrow(run, schema)


def encode_checked(df: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with ``ids`` (array<int>), ``n_tokens`` and ``decodes`` (the ids give back the text's bytes)."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema) + ", ids array<int>, n_tokens long, decodes boolean"

    def run(batches):
        hold("bpe", load.cache_clear)
        bpe = load(path, pattern)
        for b in batches:
            texts = _texts(b, len(keep))
            for at in range(0, len(texts), 1_000):
                part = texts[at : at + 1_000]
                packed = [bpe.encode(t) for t in part]
                same = [bpe.decode(i) == t.encode("utf-8", "surrogatepass") for i, t in zip(packed, part)]
                ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(i) // 4 for i in packed)]), pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4"), pa.int32()))
                cols = [b.column(i).slice(at, len(part)) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*cols, ids, pa.array([len(i) // 4 for i in packed], pa.int64()), pa.array(same, pa.bool_())], [*keep, "ids", "n_tokens", "decodes"])

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode every text, decode its ids, and give counts and digests of both.

    One pass, no shuffle: ``key``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        bpe = load(path, pattern)
        sha = hashlib.sha256
        for b in batches:
            n, of_ids, of_bytes = [], [], []
            for t in _texts(b, 1):
                ids = bpe.encode(t)
                n.append(len(ids) // 4)
                of_ids.append(sha(ids).hexdigest())
                of_bytes.append(sha(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(key, F.col(text).alias("_text")).mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
