"""Byte-level BPE: texts to token ids and back, as the rank file says.

A text is split by the pattern; pieces are encoded once per worker and kept in a bounded
cache.  New pieces are encoded together: pieces of similar length form a padded matrix of
token ids.  Each round, every row merges its leftmost pair of least rank; pair ranks
come from an open-addressing hash table.  Rows shrink by a column per merge, and rows
without a pair to merge leave the matrix.  A piece longer than ``LONG`` bytes, for which
such rounds would take quadratic time, is merged with a heap, in the same order.

NULL text is empty and has no ids.  Other columns pass through unchanged.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of a piece up to which it goes to a matrix; cells of a matrix; pieces kept; characters and pieces at a time.
LONG, CELLS, CACHED, CHARACTERS, PIECES = 512, 1 << 21, 400_000, 1 << 20, 1 << 18
#: Rows handed on at a time.
ROWS = 128
_NONE = np.int32(2**31 - 1)


class Vocabulary:
    """Ranks of byte strings, and the rank of every pair of tokens whose bytes joined are a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        pairs = {
            (ranks[t[:i]] << 32) | ranks[t[i:]]: r
            for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks
        }
        self.pairs = pairs
        self.bits = max(len(pairs) * 4, 16).bit_length()
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NONE, np.int32)
        keys, values = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(keys)
        while len(keys):  # each round one claimant of a free slot gets it, all others go on to the next slot
            wins = np.zeros(len(slot), bool)
            wins[np.unique(slot, return_index=True)[1]] = True
            wins &= self.keys[slot] == -1
            self.keys[slot[wins]], self.values[slot[wins]] = keys[wins], values[wins]
            keys, values, slot = keys[~wins], values[~wins], (slot[~wins] + 1) & (len(self.keys) - 1)
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or a number above all ranks; negative ids pair with nothing."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        key[(left < 0) | (right < 0)] = -2
        shape, key = key.shape, key.ravel()
        slot = self._slot(key)
        out = np.full(len(key), _NONE, np.int32)
        open_ = np.flatnonzero(key >= 0)
        while len(open_):
            held = self.keys[slot[open_]]
            hit = held == key[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
        return out.reshape(shape)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if piece in self.ranks:
                out[i] = np.array([self.ranks[piece]], np.int32)
            elif len(piece) > LONG:
                out[i] = self._merge_long(piece)
            else:
                buckets.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for k, members in buckets.items():
            step = max(CELLS >> k, 1)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                for i, ids in zip(part, self._merge_matrix([pieces[i] for i in part], 1 << k)):
                    out[i] = ids
        return out

    def _merge_matrix(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        length = np.array([len(p) for p in pieces])
        ids = np.where(np.arange(width) < length[:, None], self.bytes[raw], np.int32(-1))
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        row, out = np.arange(len(pieces)), [None] * len(pieces)
        while len(row):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(row), np.int64)
            best = ranks[np.arange(len(row)), at] if ranks.shape[1] else np.full(len(row), _NONE)
            ended = best == _NONE
            if ended.any():
                for r, line, n in zip(row[ended], ids[ended], length[ended]):
                    out[r] = line[:n].copy()
                go = ~ended
                row, ids, ranks, length, at, best = row[go], ids[go], ranks[go], length[go], at[go], best[go]
                if not len(row):
                    break
            lines = np.arange(len(row))
            columns = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, columns + (columns > at[:, None]), 1)
            ids[lines, at] = best
            length = length - 1
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), 1)
            if ranks.shape[1]:
                before = np.flatnonzero(at > 0)
                ranks[before, at[before] - 1] = self.pair_ranks(ids[before, at[before] - 1], ids[before, at[before]])
                after = np.flatnonzero(at < ranks.shape[1])
                ranks[after, at[after]] = self.pair_ranks(ids[after, at[after]], ids[after, at[after] + 1])
            if (most := int(length.max())) < ids.shape[1]:  # columns that only hold padding go
                ids, ranks = ids[:, :most], ranks[:, : max(most - 1, 0)]
        return out

    def _merge_long(self, piece: bytes) -> np.ndarray:
        ids = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before, pairs = list(range(1, n + 1)), list(range(-1, n - 1)), self.pairs
        heap = [(r, i) for i in range(n - 1) if (r := pairs.get((ids[i] << 32) | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or pairs.get((ids[i] << 32) | ids[j]) != r:
                continue  # one of the two has been merged since
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (s := pairs.get((r << 32) | ids[after[i]])) is not None:
                    heapq.heappush(heap, (s, i))
            if (h := before[i]) >= 0 and (s := pairs.get((ids[h] << 32) | r)) is not None:
                heapq.heappush(heap, (s, h))
        return np.array([t for t in ids if t >= 0], np.int32)


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    """The vocabulary of a rank file: a base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


class Encoder:
    def __init__(self, path: str, pattern: str):
        self.vocabulary, self.pattern, self.cache = load(path), regex.compile(pattern), {}

    def learn(self, pieces: list[str]) -> None:
        new = list(set(pieces).difference(self.cache))
        if len(self.cache) + len(new) > CACHED:
            self.cache.clear()
            new = list(set(pieces))
        encoded = self.vocabulary.encode_pieces([p.encode("utf-8", "surrogatepass") for p in new])
        self.cache.update((p, ids.tobytes()) for p, ids in zip(new, encoded))

    def lookup(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.cache.__getitem__, pieces))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text, as the bytes of 32-bit numbers."""
        at = 0
        while at < len(texts):
            size, to = 0, at
            while to < len(texts) and (to == at or size + len(texts[to] or "") <= CHARACTERS):
                size += len(texts[to] or "")
                to += 1
            if size > CHARACTERS:  # one text that is long by itself
                found, parts = self.pattern.finditer(texts[at]), []
                while some := [m.group() for m in islice(found, PIECES)]:
                    self.learn(some)
                    parts.append(self.lookup(some))
                yield b"".join(parts)
            else:
                split = [self.pattern.findall(t) if t else [] for t in texts[at:to]]
                self.learn([p for pieces in split for p in pieces])
                yield from map(self.lookup, split)
            at = to


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], values], names=[*kept, name])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from (batch.slice(at, ROWS) for at in range(0, batch.num_rows, ROWS))


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*[f for f in df.schema.fields if f.name != name], T.StructField(name, kind)])


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text`` as an array of int in ``into``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in _slices(batches):
            coded = list(own.encode(batch.column(text).to_pylist()))
            offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(coded), np.int32))
            yield _with_column(batch, into, pa.ListArray.from_arrays(pa.array(offsets), values))

    return df.mapInArrow(run, _schema(df, into, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with the bytes that the token ids stand for in ``into``; NULL stays NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = load(path).tokens.__getitem__
        for batch in _slices(batches):
            out = [None if x is None else b"".join(map(token, x)) for x in (v.as_py() if v.is_valid else None for v in batch.column(ids))]
            yield _with_column(batch, into, pa.array(out, pa.binary()))

    return df.mapInArrow(run, _schema(df, into, T.BinaryType()))
