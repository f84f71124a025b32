"""Byte-level BPE by ranks: pieces as rows of padded matrices, one merge per row and round."""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from outpulse.llm.common import by_batch, texts
from outpulse.llm.units import IdCache, spaced_units

NONE = np.int32(2**31 - 1)
CELLS = 1 << 20  # of a matrix at once
LONGEST_ROW = 256  # bytes; longer pieces are merged one by one with a heap, to the same result
MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Open-addressed hash table in arrays: (left id, right id) to the rank of the merge."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        self.bits = max(4, int(2 * max(1, len(keys)) - 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[at[put]], self.ranks[at[put]] = keys[put], ranks[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NONE where there is no merge or an id is padding (negative)."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -2
        at = self._slot(keys)
        out = np.full(len(keys), NONE, np.int32)
        open_ = np.flatnonzero(keys >= 0)
        while len(open_):
            there = self.keys[at[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
        return out


class RankBpe:
    """Encodes and decodes by the rank file at ``path``; ``pattern`` cuts texts into pieces."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.cut = regex.compile(pattern).findall
        self.letters = pattern == public_tokenizers.PATTERN
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        pairs = [
            (self.ranks[token[:i]] << 32 | self.ranks[token[i:]], rank)
            for token, rank in self.ranks.items() for i in range(1, len(token))
            if token[:i] in self.ranks and token[i:] in self.ranks
        ]
        self.pairs = PairTable(*np.array(pairs, np.int64).reshape(-1, 2).T)
        self.merges = dict(pairs)
        size = max(self.ranks.values()) + 1
        self.length = np.zeros(size, np.int64)
        by_id = [b""] * size
        for token, rank in self.ranks.items():
            by_id[rank], self.length[rank] = token, len(token)
        self.start = np.cumsum(self.length) - self.length
        self.blob = np.frombuffer(b"".join(by_id), np.uint8)
        self.cache = IdCache(self._units)

    def encode(self, many: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        return self.cache.ids([spaced_units(t) for t in many])

    def decode(self, ids: bytes) -> bytes:
        n = np.frombuffer(ids, "<u4").astype(np.int64)
        length = self.length[n]
        ends = np.cumsum(length)
        return self.blob[np.repeat(self.start[n] - (ends - length), length) + np.arange(ends[-1] if len(n) else 0)].tobytes()

    def _units(self, units: list[str]) -> list[bytes]:
        # letters alone, or behind one blank, are one match of the pattern
        split = [[u] if u.isalpha() or u[0] == " " and u[1:].isalpha() else self.cut(u) for u in units] if self.letters else [self.cut(u) for u in units]
        distinct = list({p for pieces in split for p in pieces})
        known = dict(zip(distinct, self.pieces([p.encode() for p in distinct])))
        return [b"".join([known[p] for p in pieces]) for pieces in split]

    def pieces(self, many: list[bytes]) -> list[bytes]:
        """Ids of each piece; rows of one matrix have lengths within a factor of two."""
        out: list[bytes] = [b""] * len(many)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(many):
            if (rank := self.ranks.get(piece)) is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(piece) > LONGEST_ROW:
                out[i] = self._one(piece)
            else:
                buckets.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for width, rows in buckets.items():
            step = max(1, CELLS // width)
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                for i, ids in zip(part, self._matrix([many[i] for i in part], width)):
                    out[i] = ids
        return out

    def _matrix(self, rows: list[bytes], width: int) -> list[bytes]:
        lengths = np.array([len(r) for r in rows])
        flat = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(len(rows), width)
        ids = np.where(np.arange(width) < lengths[:, None], self.byte[flat], np.int32(-1))
        ranks = self._find(ids[:, :-1], ids[:, 1:])
        done: list[bytes] = [b""] * len(rows)
        which = np.arange(len(rows))
        while len(which):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(which)), at]
            if (over := best == NONE).any():  # compaction: finished rows leave the matrix
                full = ids[over]
                joined, ends = full[full >= 0].astype("<u4").tobytes(), np.cumsum(4 * (full >= 0).sum(axis=1)).tolist()
                for k, start, end in zip(which[over].tolist(), [0, *ends], ends):
                    done[k] = joined[start:end]
                which, ids, ranks, at, best = (x[~over] for x in (which, ids, ranks, at, best))
                if not len(which):
                    break
            n = np.arange(len(which))
            columns = np.arange(ids.shape[1] - 1)
            moved = columns + (columns > at[:, None])
            new = np.take_along_axis(ids, moved, 1)
            new[n, at] = best
            # the pairs keep their ranks but for those on both sides of the merge
            ranks = np.take_along_axis(ranks, moved[:, :-1], 1) if ids.shape[1] > 2 else ranks[:, :0]
            ids = new
            if ids.shape[1] < 2:
                ranks = np.full((len(which), 1), NONE, np.int32)
                continue
            for shift in (-1, 0):
                k = at + shift
                ok = np.flatnonzero((k >= 0) & (k < ids.shape[1] - 1))
                ranks[ok, k[ok]] = self.pairs.find(ids[ok, k[ok]], ids[ok, k[ok] + 1])
        return done

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.pairs.find(left.ravel(), right.ravel()).reshape(left.shape)

    def _one(self, piece: bytes) -> bytes:
        """The same merges in the same order for one long piece, n log n in its length."""
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 1) for i in range(n - 1) if (r := self.merges.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, j = heapq.heappop(heap)
            if ids[i] < 0 or after[i] != j or ids[j] < 0 or self.merges.get(ids[i] << 32 | ids[j]) != rank:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b < n and (r := self.merges.get(ids[a] << 32 | ids[b])) is not None:
                    heapq.heappush(heap, (r, a, b))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> RankBpe:
    return RankBpe(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id``, ``ids`` (little-endian unsigned 32-bit) and ``decoded`` bytes of every whole text.

    A null text is empty, an empty text has no ids, a repeated row is encoded
    again, an empty table gives no row; columns other than doc_id and text are
    ignored.  ``path`` is read by each executor.
    """

    def work(batch):
        bpe = codec(path, pattern)
        ids = bpe.encode(batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id"), "ids": ids, "decoded": [bpe.decode(x) for x in ids]}

    return by_batch(texts(docs), "doc_id long, ids binary, decoded binary", work)


def digests(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """As ``encode``, with the counts and digests of ids and decoded bytes in place of them."""

    def work(batch):
        bpe = codec(path, pattern)
        ids = bpe.encode(batch.column("text").to_pylist())
        return {
            "doc_id": batch.column("doc_id"), "n_tokens": [len(x) // 4 for x in ids],
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids],
        }

    return by_batch(texts(docs), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", work)
