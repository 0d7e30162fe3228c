"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier 1: a minimal perfect hash over the vocabulary resolves a whole pre-token that is itself a token, with one vectorised
probe for all distinct pre-tokens of a batch and a comparison of bytes. Tier 2, for the misses: the bytes are linked into
a list, a heap holds the mergeable neighbours by rank, and the lowest, leftmost pair is merged until none is left.

The vocabulary is a rank file (base64 token, space, rank a line), read by path on each worker; nothing is trained and no
special token exists, so any text is ordinary text.

Defined results: a null text counts as empty and has no ids; repeated rows, null ids and ties stay rows of their own; an
empty table gives an empty result; other columns are ignored. Memory is bounded by the batch: distinct pre-tokens are
remembered up to `remember` of them (about 160 bytes each) and then forgotten, which costs time but changes no result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from ._units import in_slices, tidy

REMEMBER = 200_000
#: White space as the rank files' own library sees it: the Unicode property, without U+001C to U+001F.
SPACE = r"\p{White_Space}"


class PerfectHash:
    """A minimal perfect hash of distinct 128-bit keys: levels of bit arrays, each of `gamma` bits per key still open. A
    key's place is the number of set bits before its own, over all levels."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray, gamma: float = 2.0):
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        base, open_ = 0, np.arange(len(hi))
        while len(open_):
            size = max(64, int(len(open_) * gamma))
            slot = self._slot(hi[open_], lo[open_], len(self.levels), size)
            alone = np.bincount(slot, minlength=size) == 1
            self.levels.append((alone, base + np.concatenate([[0], np.cumsum(alone)]), size))
            base += int(alone.sum())
            open_ = open_[~alone[slot]]

    @staticmethod
    def _slot(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
        x = hi + lo * np.uint64(2 * level + 1)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        return (x % np.uint64(size)).astype(np.int64)

    def __call__(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Each key's place; for an unknown key -1 or any place."""
        out = np.full(len(hi), -1, np.int64)
        open_ = np.arange(len(hi))
        for k, (bits, before, size) in enumerate(self.levels):
            slot = self._slot(hi[open_], lo[open_], k, size)
            hit = bits[slot]
            out[open_[hit]] = before[slot[hit]]
            open_ = open_[~hit]
            if not len(open_):
                break
        return out


def _keys(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, tokens)), ">u8").reshape(-1, 2).astype(np.uint64)
    return both[:, 0].copy(), both[:, 1].copy()


class Vocabulary:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.rank = {base64.b64decode(t): int(r) for t, r in pairs}
        tokens = list(self.rank)
        self.hash = PerfectHash(*_keys(tokens))
        place = self.hash(*_keys(tokens))
        self.at: list[bytes] = [b""] * len(tokens)
        for p, t in zip(place.tolist(), tokens, strict=True):
            self.at[p] = t
        self.id_at = [self.rank[t] for t in self.at]
        self.bytes_of = {r: t for t, r in self.rank.items()}
        self.of_byte = [self.rank[bytes([b])] for b in range(256)]
        get = self.rank.get
        self.pair = {
            a << 32 | b: r for t, r in self.rank.items() for i in range(1, len(t)) if (a := get(t[:i])) is not None and (b := get(t[i:])) is not None
        }

    def merge(self, token: bytes) -> list[int]:
        """Ids of a pre-token by merging the lowest rank first, the leftmost of equals. A heap entry is rank and place in
        one integer; an entry whose pair has changed since is stale and skipped."""
        get, n = self.pair.get, len(token)
        ids = list(map(self.of_byte.__getitem__, token))
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r << 32 | i for i in range(n - 1) if (r := get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            x = heapq.heappop(heap)
            i, r = x & 0xFFFFFFFF, x >> 32
            j = after[i]
            if j >= n or ids[i] < 0 or get(ids[i] << 32 | ids[j]) != r:
                continue
            ids[i], ids[j] = r, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (q := get(r << 32 | ids[k])) is not None:
                    heapq.heappush(heap, q << 32 | i)
            if (h := before[i]) >= 0 and (q := get(ids[h] << 32 | r)) is not None:
                heapq.heappush(heap, q << 32 | h)
        return [x for x in ids if x >= 0]

    def resolve(self, tokens: list[bytes]) -> list[bytes]:
        """Ids, as little-endian unsigned 32-bit integers, of distinct pre-tokens."""
        out = []
        for t, p in zip(tokens, self.hash(*_keys(tokens)).tolist() if tokens else (), strict=True):
            ids = [self.id_at[p]] if p >= 0 and self.at[p] == t else self.merge(t)
            out.append(array("I", ids).tobytes())
        return out


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _pattern(pattern: str) -> regex.Pattern:
    """The pattern with white space as Unicode has it; every part that depends on it must be one of the three known ones."""
    out = pattern.replace(r"[^\s", rf"[^{SPACE}").replace(r"\s", SPACE).replace(r"(?!\S)", r"(?!\P{White_Space})")
    if re.search(r"\\[sSwWdDbBhHvR]", out):
        raise ValueError(f"a class that isn't known here: {pattern}")
    return regex.compile(out)


class Encoder:
    """Encodes texts one after another; remembers what it has resolved, up to a bound."""

    def __init__(self, path: str, pattern: str, remember: int = REMEMBER):
        self.vocab, self.find, self.known, self.remember = vocabulary(path), _pattern(pattern).findall, {}, remember

    def __call__(self, text: str) -> bytes:
        parts = self.find(text)
        known = self.known
        if new := set(parts).difference(known):
            if len(known) > self.remember:
                known = self.known = {}
                new = set(parts)
            fresh = list(new)
            known.update(zip(fresh, self.vocab.resolve([x.encode() for x in fresh]), strict=True))
        return b"".join(map(known.__getitem__, parts))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocab.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@cache
def encoder(path: str, pattern: str, remember: int = REMEMBER) -> Encoder:
    """One a worker process, so that what it remembers serves the next task too."""
    return Encoder(path, pattern, remember)


def _encoded(path: str, pattern: str, with_ids: bool, remember: int):
    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, pattern, remember)
        for batch in in_slices(batches, "text"):
            texts = batch.column("text")
            n, ids_sha, back_sha, kept = [], [], [], []
            for i in range(len(batch)):
                ids = encode(texts[i].as_py() or "")
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                back_sha.append(hashlib.sha256(encode.decode(ids)).hexdigest())
                if with_ids:
                    kept.append(np.frombuffer(ids, "<u4").astype(np.int32))
            cols = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(back_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return tidy(f)


REPORT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, path: str, pattern: str, with_ids: bool = True, remember: int = REMEMBER) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the bytes decoded from them and, on request, ids array<int>. A narrow
    map: no shuffle, and a lost task is simply run again."""
    d = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return d.mapInArrow(_encoded(path, pattern, with_ids, remember), REPORT + (", ids array<int>" if with_ids else ""))


def decode(ids: DataFrame, path: str) -> DataFrame:
    """doc_id, body binary from a table with doc_id and ids."""

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = vocabulary(path).bytes_of
        for batch in batches:
            body = [b"".join(of[x] for x in (row.as_py() or ())) for row in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(body, pa.binary())], names=["doc_id", "body"])

    return ids.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "ids").mapInArrow(f, "doc_id long, body binary")
