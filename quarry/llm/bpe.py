"""Byte-level BPE with numpy matrices.

The pattern cuts a text into pieces; a piece that is a token stands for it. Of
the others every distinct one becomes a row of byte ids in a padded matrix of
its length bucket. In each round every row merges its leftmost pair of minimum
rank: one ``argmin`` a row, one shift that closes the gap. Ranks of pairs come
from an open-addressing hash table held in two arrays. Rows without a pair
left drop out; the matrix is one column narrower after each round.

A piece wider than ``LONG`` is a square matrix by itself: its rows are blocks of
places, each with its least rank. A round merges the leftmost least pair of all
rows and looks again only at the rows it touched; instead of closing the gap,
places are linked to their neighbours. A round thus costs as much as one row.
"""

from __future__ import annotations

import base64
import hashlib
import math
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from quarry.llm.common import map_texts

NONE = np.int32(2**31 - 1)
LONG = 512  # bytes of a piece that shares its matrix with others
CELLS = 1 << 20  # of a matrix
KEPT = 96 << 20  # bytes that the pieces of a worker take, about; then it starts anew
ENTRY = 190  # of which for a piece, beside its own and its ids' bytes


class PairTable:
    """Hash table (left id, right id) -> id of the merged token, which is its rank."""

    def __init__(self, left: np.ndarray, right: np.ndarray, value: np.ndarray):
        bits = max(4, int(len(left) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, NONE, np.int32)
        key = (left.astype(np.int64) << 32) | right
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] < 0
            first = np.zeros(len(key), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.values[slot[put]] = key[put], value[put]
            key, value, slot = key[~put], value[~put], slot[~put]
            taken = self.keys[slot] >= 0
            slot = np.where(taken, (slot + 1) & self.mask, slot)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def one(self, left: int, right: int) -> int:
        """Merged id of one pair."""
        key = left << 32 | right
        slot = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> int(self.shift)
        while (there := int(self.keys[slot])) != key:
            if there < 0:
                return int(NONE)
            slot = slot + 1 & self.mask
        return int(self.values[slot])

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids; NONE where the pair is no token (or an id is padding, -1)."""
        shape = left.shape
        left, right = left.ravel().astype(np.int64), right.ravel().astype(np.int64)
        out = np.full(len(left), NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        key = (left[todo] << 32) | right[todo]
        slot = self._slot(key)
        while len(todo):
            there = self.keys[slot]
            hit = there == key
            out[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (there >= 0)
            todo, key, slot = todo[on], key[on], (slot[on] + 1) & self.mask
        return out.reshape(shape)


class Codec:
    """Encoder and decoder of a vocabulary of byte strings with ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens: list = [None] * (max(ranks.values()) + 1)
        for b, r in ranks.items():
            self.tokens[r] = b
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.byte < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        pairs = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.pairs = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)
        self.known: dict[str, bytes] = {}
        self.size = 0

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def encode_batch(self, texts: list) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers. None is the empty text."""
        cut = [self.pieces(t or "") for t in texts]
        if self.size > KEPT:
            self.known, self.size = {}, 0
        known = self.known
        new = [p for p in set().union(*cut) if p not in known] if cut else []
        for p, ids in zip(new, self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in new])):
            known[p] = ids
            self.size += ENTRY + len(p) + len(ids)
        return [b"".join(map(known.__getitem__, c)) for c in cut]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        out: list = [None] * len(pieces)
        rows: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            r = self.ranks.get(p)
            if r is not None:
                out[i] = r.to_bytes(4, "little")
            elif p:
                rows.setdefault(_bucket(len(p)), []).append(i)
            else:
                out[i] = b""
        for width, at in rows.items():
            step = max(1, CELLS // width)
            for k in range(0, len(at), step):
                part = at[k: k + step]
                if width > LONG:
                    for i in part:
                        out[i] = self._merge_long(np.frombuffer(pieces[i], np.uint8))
                else:
                    self._merge(part, pieces, width, out)
        return out

    def _merge(self, at: list[int], pieces: list[bytes], width: int, out: list) -> None:
        lens = np.array([len(pieces[i]) for i in at])
        flat = self.byte[np.frombuffer(b"".join([pieces[i] for i in at]), np.uint8)]
        ids = np.full((len(at), width), -1, np.int32)
        ids[np.arange(width) < lens[:, None]] = flat
        row = np.array(at)
        rank = self.pairs.get(ids[:, :-1], ids[:, 1:])
        while True:
            if rank.shape[1]:
                j = rank.argmin(axis=1)
                best = rank[np.arange(len(j)), j]
                live = best < NONE
            else:
                live = np.zeros(len(row), bool)
            if not live.all():
                done = ids[~live]
                real = done >= 0
                ends = np.cumsum(real.sum(axis=1)) * 4
                data, start = done[real].astype("<u4").tobytes(), 0
                for i, end in zip(row[~live].tolist(), ends.tolist()):
                    out[i], start = data[start:end], end
                if not live.any():
                    return
                ids, rank, row, j, best = ids[live], rank[live], row[live], j[live], best[live]
            n, w = ids.shape
            r = np.arange(n)
            ids[r, j] = best
            cols = np.arange(w - 1)
            source = cols + (cols > j[:, None])
            ids = np.take_along_axis(ids, source, axis=1)
            rank = np.take_along_axis(rank, source[:, : w - 2], axis=1)
            k = np.flatnonzero(j < w - 2)
            rank[k, j[k]] = self.pairs.get(ids[k, j[k]], ids[k, j[k] + 1])
            k = np.flatnonzero(j > 0)
            rank[k, j[k] - 1] = self.pairs.get(ids[k, j[k] - 1], ids[k, j[k]])

    def _merge_long(self, raw: np.ndarray) -> bytes:
        n = len(raw)
        width = max(LONG, math.isqrt(n))
        ids = self.byte[raw]
        rank = np.full(-(-n // width) * width, NONE, np.int32)
        rank[: n - 1] = self.pairs.get(ids[:-1], ids[1:])
        rows = rank.reshape(-1, width)
        least = rows.min(axis=1)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)  # n and -1: none
        while True:
            block = int(least.argmin())
            best = int(least[block])
            if best == NONE:
                return ids[ids >= 0].astype("<u4").tobytes()
            j = block * width + int(rows[block].argmin())
            gone = int(after[j])
            right, left = int(after[gone]), int(before[j])
            ids[j], ids[gone], after[j], rank[gone] = best, -1, right, NONE
            rank[j] = NONE
            if right < n:
                before[right] = j
                rank[j] = self.pairs.one(best, int(ids[right]))
            if left >= 0:
                rank[left] = self.pairs.one(int(ids[left]), best)
            for touched in {block, gone // width, max(left, 0) // width}:
                least[touched] = rows[touched].min()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _bucket(n: int) -> int:
    """Padded width of a piece of n bytes: exact up to 24, then by quarters."""
    if n <= 24:
        return n
    step = 1 << (n.bit_length() - 3)
    return -(-n // step) * step


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each vocabulary and worker."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return Codec(ranks, pattern)


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` replaced by ``ids`` (little-endian unsigned 32-bit
    integers) and ``decoded``, the bytes that the ids stand for.

    ``vocabulary`` is a file of base64 tokens and ranks that every worker can
    read. A null text is empty and has no ids; all other columns stay.
    """

    def make(texts: list) -> dict:
        c = codec(vocabulary, pattern)
        ids = c.encode_batch(texts)
        return {"ids": ids, "decoded": [c.decode(x) for x in ids]}

    return map_texts(docs, make, "ids binary, decoded binary", text, batch_bytes=4 << 20)


def digests(docs: DataFrame, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row.

    The decoded bytes come from the ids. A null or empty text has no ids and
    the digests of nothing; null ids, repeated rows and ties stay as they are;
    other columns are ignored; an empty table gives no rows.
    """

    def make(texts: list) -> dict:
        c = codec(vocabulary, pattern)
        ids = c.encode_batch(texts)
        return {"n_tokens": [len(x) // 4 for x in ids], "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(c.decode(x)).hexdigest() for x in ids]}

    rows = docs.selectExpr(f"`{doc_id}` as doc_id", f"`{text}` as text")
    return map_texts(rows, make, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", "text", batch_bytes=4 << 20)
