"""Byte-level BPE in two tiers.

Tier one: a minimal perfect hash over the vocabulary answers pre-tokens that
are tokens as a whole. Tier two: a miss is merged pair by pair, lowest rank
first, with a heap over a linked list of its bytes. Each distinct stretch
between blanks is encoded once per batch and the ids of the texts are gathered.
"""

from __future__ import annotations

import base64
import hashlib
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame

from .arrow import WIDE_SLICE, lean, per_text, ranges

_LOW = (1 << 64) - 1
_CACHED = 300_000

def _slot(low: int, d: int, n: int) -> int:
    return ((((low ^ (d * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9) & _LOW) >> 24) % n


class PerfectHash:
    """Minimal perfect hash of distinct byte strings: n keys on n slots.

    Keys fall into small buckets; the largest buckets first seek a displacement
    that sends their keys to free slots, and a bucket of one key stores its slot.
    """

    def __init__(self, keys: list[bytes], values: list[int]):
        n = self.size = max(1, len(keys))
        self.buckets = max(1, n // 3)
        self.keys: list[bytes | None] = [None] * n
        self.values = [0] * n
        self.shift = [0] * self.buckets
        groups: list[list[tuple[int, int, int]]] = [[] for _ in range(self.buckets)]
        for i, key in enumerate(keys):
            h = xxhash.xxh3_128_intdigest(key)
            groups[(h >> 64) % self.buckets].append((h & _LOW, h >> 64, i))
        free = [True] * n
        single = []
        for b in sorted(range(self.buckets), key=lambda b: -len(groups[b])):
            members = groups[b]
            if len(members) < 2:
                single += [(b, m[2]) for m in members]
                continue
            d = 1
            while True:
                slots = [_slot(low, d, n) for low, _, _ in members]
                if all(free[s] for s in slots) and len(set(slots)) == len(slots):
                    break
                d += 1
            self.shift[b] = d
            for s, (_, _, i) in zip(slots, members, strict=True):
                free[s], self.keys[s], self.values[s] = False, keys[i], values[i]
        rest = (s for s in range(n) if free[s])
        for b, i in single:
            s = next(rest)
            self.shift[b], self.keys[s], self.values[s] = -s - 1, keys[i], values[i]

    def get(self, key: bytes) -> int | None:
        h = xxhash.xxh3_128_intdigest(key)
        high = h >> 64
        d = self.shift[high % self.buckets]
        slot = -d - 1 if d < 0 else _slot(h & _LOW, d, self.size)
        return self.values[slot] if self.keys[slot] == key else None


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.whole = PerfectHash(list(self.ranks), list(self.ranks.values()))
        self.bytes_of = {i: token for token, i in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.seen: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of a piece that is no token itself.

        Heap entries hold rank, start and end of a candidate pair in one integer.
        ``after[i]`` is the end of the part that starts at i, -1 where none does.
        """
        get, n = self.ranks.get, len(piece)
        bits = n.bit_length()
        mask = (1 << bits) - 1
        after, before = list(range(1, n + 1)), list(range(-1, n))
        heap = []
        for i in range(n - 1):
            rank = get(piece[i : i + 2])
            if rank is not None:
                heap.append(((rank << bits) + i << bits) + i + 2)
        heapify(heap)
        while heap:
            entry = heappop(heap)
            end = entry & mask
            i = entry >> bits & mask
            middle = after[i]
            if middle < 0 or middle >= n or after[middle] != end:
                continue  # one of the two parts has changed since
            after[i], after[middle] = end, -1
            before[end] = i
            if end < n:
                further = after[end]
                rank = get(piece[i:further])
                if rank is not None:
                    heappush(heap, ((rank << bits) + i << bits) + further)
            left = before[i]
            if left >= 0:
                rank = get(piece[left:end])
                if rank is not None:
                    heappush(heap, ((rank << bits) + left << bits) + end)
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return tuple(out)

    def token(self, token: str) -> tuple[int, ...]:
        """Ids of one pre-token."""
        ids = self.seen.get(token)
        if ids is None:
            raw = token.encode()
            one = self.whole.get(raw)
            ids = self.merge(raw) if one is None else (one,)
            if len(self.seen) >= _CACHED:
                self.seen.clear()
            self.seen[token] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out = []
        for token in self.split(text):
            out.extend(self.token(token))
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@cache
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


_ENDS = regex.compile(r"\s$").search
_STARTS = regex.compile(r"\s").match


def encode_texts(texts: pa.Array, codec: Codec) -> list[np.ndarray]:
    """Ids of each text.

    A cut before a blank never splits a pre-token if the blank follows or
    precedes something that is no white space. Texts with other blanks are
    encoded as they are.
    """
    lists = pc.split_pattern(texts, " ")
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    encoded = lists.flatten().dictionary_encode()
    codes, vocab = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary.to_pylist()
    ends = np.fromiter((not v or _ENDS(v) is not None for v in vocab), bool, len(vocab))
    starts = np.fromiter((not v or _STARTS(v) is not None for v in vocab), bool, len(vocab))
    firsts = bounds[:-1]
    inner = np.ones(len(codes), bool)
    inner[firsts] = False
    doubtful = np.zeros(len(codes), bool)
    doubtful[1:] = ends[codes[:-1]] & starts[codes[1:]] & inner[1:]
    whole = np.add.reduceat(doubtful, firsts) > 0 if len(firsts) else np.zeros(0, bool)
    needed = np.zeros(len(vocab), bool)
    needed[codes[inner]] = True
    flat, sizes = [], np.zeros(len(vocab), np.int64)
    for k in np.flatnonzero(needed).tolist():
        ids = codec.encode(" " + vocab[k])
        sizes[k] = len(ids)
        flat.extend(ids)
    flat = np.array(flat, np.uint32)
    at = np.cumsum(sizes) - sizes
    per = np.where(inner, sizes[codes], 0)
    ids = flat[ranges(at[codes], per)]
    spans = np.concatenate([[0], np.cumsum(per)])[bounds]
    out = []
    for i, text in enumerate(texts.to_pylist()):
        if whole[i]:
            out.append(np.array(codec.encode(text), np.uint32))
        else:
            head = np.array(codec.encode(vocab[codes[firsts[i]]]), np.uint32)
            out.append(np.concatenate([head, ids[spans[i] : spans[i + 1]]]))
    return out


def encode(df: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the ids of the whole text as array<int>; a null text has none."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        ids = encode_texts(part.column("text"), codec(ranks, pattern))
        sizes = np.array([len(i) for i in ids], np.int32)
        values = np.concatenate([*ids, np.empty(0, np.uint32)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.array(values))
        return pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return lean(df, id_col, text_col).mapInArrow(per_text(run), f"doc_id {kind}, ids array<int>")


def decode(df: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """doc_id and the bytes of its ids; null ids give no bytes."""

    def run(batches):
        own = codec(ranks, pattern)
        for batch in batches:
            data = [own.decode(ids or ()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "data"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, "ids").mapInArrow(run, f"doc_id {kind}, data binary")


def round_trip(df: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of the ids and of the bytes that they decode to, both made in one pass over the texts.

    Columns doc_id, n_tokens, ids_sha256, decoded_sha256. A null text counts as
    empty: no tokens and the digests of nothing.
    """

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(ranks, pattern)
        counts, first, second = [], [], []
        for ids in encode_texts(part.column("text"), own):
            counts.append(len(ids))
            first.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
            second.append(hashlib.sha256(own.decode(ids.tolist())).hexdigest())
        columns = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[id_col].dataType.simpleString()
    return lean(df, id_col, text_col).mapInArrow(
        per_text(run, WIDE_SLICE), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
