"""Byte-level BPE by given ranks: a minimal perfect hash over whole pre-tokens, a heap of merges for the rest."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.words import chunks, hash_pieces, mix

_GOLDEN = np.array(0x9E3779B97F4A7C15, np.uint64)

#: Pre-tokens of which a worker remembers the ids; the memory of its table is bounded by this.
CACHED = 600_000


class PerfectHash:
    """A minimal perfect hash over distinct byte strings (hash and displace): n keys, n slots.

    Keys fall into buckets. The largest buckets come first and look for a displacement that puts all their keys
    into free slots; a bucket of one key takes any free slot, which is stored as it is. A slot also holds a second
    hash of its key, so that other strings are told apart.
    """

    def __init__(self, keys: list[bytes]):
        n = max(1, len(keys))
        lengths = np.array([len(k) for k in keys], np.int64)
        data = np.frombuffer(b"".join(keys), np.uint8)
        one, two = hash_pieces(data, lengths, 1), hash_pieces(data, lengths, 2)
        self.n, self.buckets = n, max(1, n // 4)
        self.displace = np.zeros(self.buckets, np.int64)
        self.check, self.index = np.zeros(n, np.uint64), np.full(n, -1, np.int64)
        bucket = (one % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(keys) else []
        taken = np.zeros(n, bool)
        single, tries = [], 256
        for members in sorted(groups, key=len, reverse=True):
            if len(members) == 1:
                single.append(int(members[0]))
                continue
            slots = None
            for first in range(0, 1 << 24, tries):
                d = np.arange(first, first + tries, dtype=np.uint64)[:, None]
                tried = np.sort(self._slots(one[members], d), axis=1)
                good = np.flatnonzero(~taken[tried].any(axis=1) & (np.diff(tried, axis=1) > 0).all(axis=1))
                if len(good):
                    d = first + int(good[0])
                    slots = self._slots(one[members], np.uint64(d))
                    break
            if slots is None:
                raise ValueError("keys repeat")
            taken[slots] = True
            self.displace[bucket[members[0]]] = d
            self.check[slots], self.index[slots] = two[members], members
        free = np.flatnonzero(~taken)
        for member, slot in zip(single, free.tolist(), strict=False):
            self.displace[bucket[member]] = -1 - slot
            self.check[slot], self.index[slot] = two[member], member

    def _slots(self, one: np.ndarray, d: np.ndarray | np.uint64) -> np.ndarray:
        return (mix(one + d * _GOLDEN) % np.uint64(self.n)).astype(np.int64)

    def find(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """For each byte string in data its place among the keys, or -1."""
        one, two = hash_pieces(data, lengths, 1), hash_pieces(data, lengths, 2)
        d = self.displace[(one % np.uint64(self.buckets)).astype(np.int64)]
        slot = np.where(d < 0, -1 - d, self._slots(one, np.maximum(d, 0).astype(np.uint64)))
        return np.where((self.check[slot] == two) & (self.index[slot] >= 0), self.index[slot], -1)


class ByteBPE:
    """Encoder and decoder for a rank file (a base64 token and its rank on each line)."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        tokens = [base64.b64decode(token) for token, _ in pairs]
        self.ids = [int(rank) for _, rank in pairs]
        self.rank = dict(zip(tokens, self.ids, strict=True))
        self.bytes_of = [b""] * (max(self.ids) + 1)
        for token, i in self.rank.items():
            self.bytes_of[i] = token
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        self.table = PerfectHash(tokens)
        self.pattern = regex.compile(pattern)
        self.byte_ids = [self.rank[bytes([b])] for b in range(256)]
        self.pairs = {(left, right): i for token, i in self.rank.items() for k in range(1, len(token))
                      if (left := self.rank.get(token[:k])) is not None and (right := self.rank.get(token[k:])) is not None}
        self.cache: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of a piece that is no token itself: bytes in a linked list, the pairs that may merge in a heap.

        The pair of the lowest rank merges first, of equal ones the leftmost. An entry whose pair has changed since is
        passed over. Time grows with n log n, also for very long pieces.
        """
        ids = [self.byte_ids[b] for b in piece]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of, pop, push = self.pairs.get, heapq.heappop, heapq.heappush
        heap = [r * n + i for i, pair in enumerate(zip(ids, ids[1:], strict=False)) if (r := rank_of(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, at = divmod(pop(heap), n)
            right = after[at]
            if right >= n or rank_of((ids[at], ids[right])) != rank:
                continue
            ids[at], ids[right] = rank, -1
            after[at] = following = after[right]
            after[right] = n
            if following < n:
                before[following] = at
                if (r := rank_of((rank, ids[following]))) is not None:
                    push(heap, r * n + at)
            left = before[at]
            if left >= 0 and (r := rank_of((ids[left], rank))) is not None:
                push(heap, r * n + left)
        return tuple([i for i in ids if i >= 0])

    def learn(self, pieces: set[str]) -> None:
        """Puts the ids of new pre-tokens into the cache: first all by the perfect hash, then the misses by merging."""
        names = list(pieces)
        raw = [x.encode() for x in names]
        lengths = np.array([len(x) for x in raw], np.int64)
        found = self.table.find(np.frombuffer(b"".join(raw), np.uint8), lengths).tolist()
        cache, ids, merge = self.cache, self.ids, self.merge
        for name, piece, at in zip(names, raw, found, strict=True):
            cache[name] = (ids[at],) if at >= 0 else merge(piece)

    def encode(self, texts: list[str]) -> list[list[int]]:
        split = self.pattern.findall
        pieces = [split(text) for text in texts]
        new = set().union(*pieces) - self.cache.keys()
        if new:
            if len(self.cache) + len(new) > CACHED:
                self.cache.clear()
                new = set().union(*pieces)
            self.learn(new)
        known = self.cache.__getitem__
        return [list(chain.from_iterable(map(known, p))) for p in pieces]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def digest(self, ids: list[int]) -> str:
        return hashlib.sha256(",".join(map(self.decimal.__getitem__, ids)).encode()).hexdigest()


@lru_cache(maxsize=2)
def tokenizer(rank_file: str, pattern: str) -> ByteBPE:
    """One encoder for each worker process and rank file."""
    return ByteBPE(rank_file, pattern)


def encode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text") -> DataFrame:
    """docs with the column ids (array<int>): the tokens of each whole text, without special tokens.

    A null or empty text has no tokens. The ids are decoded again; were the bytes not those of the text, the task would
    fail. A narrow map: nothing is shuffled. The rank file must lie at the same
    place on all executors, as an installed package does. A column ids that docs has is replaced.
    """
    kept = docs.drop("ids")
    schema = T.StructType([*kept.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(rank_file, pattern)
        for batch in batches:
            for part in chunks(batch, text):
                texts = [t or "" for t in part.column(text).to_pylist()]
                ids = coder.encode(texts)
                if any(coder.decode(i) != t.encode() for i, t in zip(ids, texts, strict=True)):
                    raise ValueError("decoded bytes differ from the text")
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.list_(pa.int32()))], [*part.schema.names, "ids"])

    return kept.mapInArrow(run, schema)


def encode_digests(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """For each document the number of its tokens, the sha256 of the ids, and that of the text decoded from the ids.

    Encoding, decoding and digests are one narrow map over doc_id and text, so that ids needn't leave the worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(rank_file, pattern)
        for batch in batches:
            for part in chunks(batch, "text"):
                encoded = coder.encode([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(i) for i in encoded], pa.int64()),
                    pa.array([coder.digest(i) for i in encoded], pa.string()),
                    pa.array([hashlib.sha256(coder.decode(i)).hexdigest() for i in encoded], pa.string()),
                ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
