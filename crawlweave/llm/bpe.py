"""Operator 9: byte-level BPE, encoding by a two-tier lookup and decoding.

A pre-token that is a whole vocabulary entry is resolved by a minimal perfect
hash over the vocabulary (one probe, one comparison).  Any other is merged
from its bytes: a heap of adjacent pairs by rank over a linked list.

Null and empty texts have no ids.  Special strings are ordinary text.
Repeated rows give repeated results; columns other than the id and the text
are not read, so their names cannot clash.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from crawlweave.llm.common import map_texts, mix64, prepare
from crawlweave.llm.pieces import PieceCache, piece_of

#: Mean keys per bucket of the perfect hash.
KEYS_PER_BUCKET = 4
_TURN = np.uint64(0xD6E8FEB86659FD93)


class PerfectHash:
    """Minimal perfect hash (hash and displace): n keys to slots 0 .. n-1.

    Buckets are placed from the largest on, each with the first displacement
    that sends its keys to free slots.
    """

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.buckets = max(1, self.n // KEYS_PER_BUCKET)
        hashes = self.hashes(keys)
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(sizes)
        self.displacement = np.zeros(self.buckets, np.uint32)
        self.index = np.full(self.n, -1, np.int64)  # slot -> place in ``keys``
        free = np.ones(self.n, bool)
        for b in np.argsort(-sizes, kind="stable").tolist():
            size = int(sizes[b])
            if not size:
                break
            members = order[ends[b] - size:ends[b]]
            tried, step = 0, 256
            while True:
                turns = np.arange(tried, tried + step, dtype=np.uint64)
                slots = self._slot(hashes[members][None, :], turns[:, None])
                good = free[slots].all(axis=1)
                if size > 1:
                    ordered = np.sort(slots, axis=1)
                    good &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if good.any():
                    hit = int(good.argmax())
                    self.displacement[b] = tried + hit
                    free[slots[hit]] = False
                    self.index[slots[hit]] = members
                    break
                tried, step = tried + step, min(step * 2, 1 << 16)
        self.keys = [keys[i] for i in self.index.tolist()]  # by slot

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def _slot(self, hashes: np.ndarray, turns: np.ndarray) -> np.ndarray:
        return (mix64(hashes ^ (turns * _TURN)) % np.uint64(self.n)).astype(np.int64)

    def find(self, keys: list[bytes]) -> list[int]:
        """The place of each key among those it was built from, -1 where it is none."""
        if not keys or not self.n:
            return [-1] * len(keys)
        h = self.hashes(keys)
        slots = self._slot(h, self.displacement[(h % np.uint64(self.buckets)).astype(np.int64)].astype(np.uint64))
        own = self.keys
        return [place if own[s] == k else -1
                for k, s, place in zip(keys, slots.tolist(), self.index[slots].tolist(), strict=True)]


def merge_bytes(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: lowest rank first, leftmost among equals.

    A piece is known by its start; ``end[start]`` links it to the next one.
    Heap entries that no longer name two neighbours are passed over.
    """
    n = len(token)
    end = list(range(1, n + 1))
    before = list(range(-1, n))
    rank_of = ranks.get
    heap = []
    for i in range(n - 1):
        rank = rank_of(token[i:i + 2])
        if rank is not None:
            heap.append((rank, i, i + 1, i + 2))
    heapify(heap)
    while heap:
        _, i, mid, stop = heappop(heap)
        if end[i] != mid or end[mid] != stop:
            continue
        end[i] = stop
        end[mid] = -1
        if stop < n:
            before[stop] = i
            rank = rank_of(token[i:end[stop]])
            if rank is not None:
                heappush(heap, (rank, i, stop, end[stop]))
        left = before[i]
        if left >= 0:
            rank = rank_of(token[left:stop])
            if rank is not None:
                heappush(heap, (rank, left, i, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[token[i:end[i]]])
        i = end[i]
    return ids


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.words = list(self.ranks)
        self.whole = PerfectHash(self.words)
        self.split = regex.compile(pattern).findall
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.cache = PieceCache(self._encode_keys)

    def _encode_pretokens(self, tokens: list[str]) -> dict[str, bytes]:
        """Little-endian 32-bit ids of each distinct pre-token."""
        distinct = list(set(tokens))
        raw = [t.encode("utf-8", "surrogatepass") for t in distinct]
        out = {}
        for token, b, place in zip(distinct, raw, self.whole.find(raw), strict=True):
            ids = [self.ranks[self.words[place]]] if place >= 0 else merge_bytes(b, self.ranks)
            out[token] = b"".join([i.to_bytes(4, "little") for i in ids])
        return out

    def _encode_keys(self, keys: list[str]) -> list[bytes]:
        tokens = [self.split(piece_of(k)) for k in keys]
        ids = self._encode_pretokens([t for ts in tokens for t in ts])
        return [b"".join([ids[t] for t in ts]) for ts in tokens]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, as little-endian 32-bit integers."""
        out = []
        for text, keys in zip(texts, self.cache.learn(texts), strict=True):
            if keys is None:
                tokens = self.split(text)
                ids = self._encode_pretokens(tokens)
                out.append(b"".join(map(ids.__getitem__, tokens)))
            else:
                out.append(b"".join(map(self.cache.known.__getitem__, keys)))
        return out

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(2)
def encoder(path: str, pattern: str) -> ByteBpe:
    """One per worker process: the vocabulary file is read where the task runs."""
    return ByteBpe(path, pattern)


def encode_texts(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` (binary, little-endian 32-bit) of each whole text."""
    prepare(df.sparkSession)

    def make():
        bpe = encoder(path, pattern)
        return lambda texts: [pa.array(bpe.encode(texts), pa.binary())]

    return map_texts(df, text_col, [id_col], [T.StructField("ids", T.BinaryType())], make)


def decode_ids(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col``, ``decoded`` (binary) for each row of ids; null ids give empty bytes."""
    prepare(df.sparkSession)
    id_field = df.schema[id_col]
    schema = T.StructType([id_field, T.StructField("decoded", T.BinaryType())])

    def run(batches):
        bpe = encoder(path, pattern)
        for b in batches:
            out = [bpe.decode(x or b"") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=[id_col, "decoded"])

    return df.select(id_col, ids_col).mapInArrow(run, schema)


def round_trip_digest(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Encode every text, decode its ids, and give both as SHA-256 (one pass, nothing shuffled)."""
    prepare(df.sparkSession)

    def make():
        bpe = encoder(path, pattern)

        def digest(texts):
            ids = bpe.encode(texts)
            return [pa.array([len(x) // 4 for x in ids], pa.int64()),
                    [hashlib.sha256(x).hexdigest() for x in ids],
                    [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids]]

        return digest

    return map_texts(df, text_col, [id_col], [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ], make)
