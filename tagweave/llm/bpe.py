"""Byte-level BPE over padded numpy matrices, with ranks as the tiktoken format stores them.

Texts are split by the pattern; pieces not met before by this worker are bucketed by length and
merged together: in each round every row merges its leftmost pair of least rank, found by a
hashed pair lookup, and the matrix is compacted. Ids of pieces are kept in a bounded cache, so a
word is merged once per worker and not once per occurrence.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import by_size, ragged_take, slices

NONE = np.int32(2**31 - 1)  # rank of a pair that does not merge
MAX_CACHE = 100_000  # pieces a worker remembers
MATRIX_CELLS = 1 << 17
LONG_PIECE = 256  # bytes from which a piece is merged with a heap, in n log n steps
CHUNK_CHARS = 1 << 19  # characters that are split at a time
CHUNK_PIECES = 1 << 17

_ENCODERS: dict[str, Encoder] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file with one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class PairTable:
    """Open-addressing hash table from a pair of token ids to the id that it merges to."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.bits = max(4, (2 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = self._slot(keys)
        while len(keys):
            free = self.keys[slots] < 0
            _, first = np.unique(slots, return_index=True)
            placed = np.zeros(len(keys), bool)
            placed[first] = True
            placed &= free
            self.keys[slots[placed]] = keys[placed]
            self.values[slots[placed]] = values[placed]
            keys, values = keys[~placed], values[~placed]
            slots = (slots[~placed] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id for each pair, ``NONE`` if there is none; ids below 0 are padding."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        keys = np.where((left < 0) | (right < 0), np.int64(-2), keys).ravel()
        slots = self._slot(keys)
        at = self.keys[slots]
        out = np.where(at == keys, self.values[slots], NONE)
        open_ = np.flatnonzero((at != keys) & (at >= 0) & (keys >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            at = self.keys[slots[open_]]
            hit = at == keys[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (at >= 0)]
        return out.reshape(left.shape)

    def find_one(self, left: int, right: int) -> int:
        """As :meth:`find`, for one pair of ids."""
        key = left << 32 | right
        slot = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)
        while (at := self.keys.item(slot)) != key:
            if at < 0:
                return int(NONE)
            slot = (slot + 1) & (len(self.keys) - 1)
        return self.values.item(slot)


def merge_rows(ids: np.ndarray, pairs: PairTable) -> list[np.ndarray]:
    """Token ids of each row of a matrix of byte tokens, padded with -1 at the end."""
    out: list[np.ndarray] = [ids[:0, 0]] * len(ids)
    row = np.arange(len(ids))
    rank = pairs.find(ids[:, :-1], ids[:, 1:])
    while len(row):
        if ids.shape[1] > 1:
            j = rank.argmin(axis=1)
            least = rank[np.arange(len(row)), j]
            done = least == NONE
        else:
            j, least, done = None, None, np.ones(len(row), bool)
        if done.any():
            for r, tokens, n in zip(row[done], ids[done], (ids[done] >= 0).sum(axis=1)):
                out[r] = tokens[:n].copy()
            if done.all():
                break
            row, ids, rank, j, least = row[~done], ids[~done], rank[~done], j[~done], least[~done]
        # Each row that is left loses one column, so the matrix narrows by one in each round.
        rows = np.arange(len(row))
        ids[rows, j] = least
        columns = np.arange(ids.shape[1] - 1)[None, :]
        ids = np.take_along_axis(ids, columns + (columns > j[:, None]), axis=1)
        if ids.shape[1] == 1:
            continue
        columns = columns[:, :-1]
        rank = np.take_along_axis(rank, columns + (columns >= j[:, None]), axis=1)
        right = np.minimum(j, ids.shape[1] - 2)
        rank[rows, right] = pairs.find(ids[rows, right], ids[rows, right + 1])
        left = np.maximum(j - 1, 0)
        rank[rows, left] = pairs.find(ids[rows, left], ids[rows, left + 1])
    return out


def merge_long(ids: np.ndarray, pairs: PairTable) -> list[int]:
    """The same merges for one long piece, by a heap over a linked list."""
    tokens, n = ids.tolist(), len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    ranks = pairs.find(ids[:-1], ids[1:])
    places = np.flatnonzero(ranks != NONE)
    heap = [(rank, i, (tokens[i], tokens[i + 1])) for rank, i in zip(ranks[places].tolist(), places.tolist())]
    heapq.heapify(heap)
    while heap:
        rank, i, (left, right) = heapq.heappop(heap)
        j = after[i]
        if tokens[i] != left or j >= n or tokens[j] != right:
            continue
        tokens[i], tokens[j] = rank, -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (rank := pairs.find_one(tokens[a], tokens[b])) != NONE:
                heapq.heappush(heap, (rank, a, (tokens[a], tokens[b])))
    return [t for t in tokens if t >= 0]


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str, pairs: PairTable | None = None):
        self.ranks, self.pattern, self.pairs = ranks, regex.compile(pattern), pairs or PairTable(ranks)
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the ranks lack single bytes")
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.flat, self.starts, self.lens = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def learn(self, pieces: set[str]) -> None:
        """Add the ids of new pieces to the cache; a full cache starts anew."""
        new = [p for p in pieces if p not in self.code]
        if not new:
            return
        if len(self.code) + len(new) > MAX_CACHE:
            self.forget()
            new = list(pieces)
        raw = [p.encode() for p in new]
        ids: list[np.ndarray] = [self.flat[:0]] * len(new)
        buckets: dict[int, list[int]] = {}
        for i, b in enumerate(raw):
            if (whole := self.ranks.get(b)) is not None:
                ids[i] = np.array([whole], np.int32)
            elif len(b) >= LONG_PIECE:
                ids[i] = self.merge_long(b)
            else:
                buckets.setdefault(-(-len(b) // 4) * 4, []).append(i)
        for width, rows in buckets.items():
            for start in range(0, len(rows), MATRIX_CELLS // width):
                part = rows[start : start + MATRIX_CELLS // width]
                lens = np.array([len(raw[i]) for i in part])
                matrix = np.full((len(part), width), -1, np.int32)
                filled = np.arange(width)[None, :] < lens[:, None]
                matrix[filled] = self.byte_ids[np.frombuffer(b"".join(raw[i] for i in part), np.uint8)]
                for i, found in zip(part, merge_rows(matrix, self.pairs)):
                    ids[i] = found
        lens = np.array([len(x) for x in ids], np.int32)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lens, dtype=np.int64) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.flat = np.concatenate([self.flat, *ids])
        first = len(self.code)
        self.code.update((p, first + k) for k, p in enumerate(new))

    def merge_long(self, piece: bytes) -> np.ndarray:
        return np.array(merge_long(self.byte_ids[np.frombuffer(piece, np.uint8)], self.pairs), np.int32)

    def take(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and the number of ids of each."""
        self.learn(set(pieces))
        codes = np.fromiter(map(self.code.__getitem__, pieces), np.int64, len(pieces))
        lens = self.lens[codes]
        return ragged_take(self.flat, self.starts[codes], lens), lens

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each text."""
        parts, counts = [], np.zeros(len(texts), np.int64)
        for start, end in by_size([len(t or "") for t in texts], CHUNK_CHARS):
            if end == start + 1:
                found = self.pattern.finditer(texts[start] or "")
                while pieces := [m[0] for m in islice(found, CHUNK_PIECES)]:
                    ids, _ = self.take(pieces)
                    parts.append(ids)
                    counts[start] += len(ids)
                continue
            split = [self.pattern.findall(t or "") for t in texts[start:end]]
            ids, lens = self.take([p for pieces in split for p in pieces])
            ends = np.cumsum([len(pieces) for pieces in split])
            total = np.concatenate([[0], np.cumsum(lens, dtype=np.int64)])
            counts[start:end] = np.diff(total[np.concatenate([[0], ends])])
            parts.append(ids)
        return np.concatenate([np.zeros(0, np.int32), *parts]), counts


class TokenBytes:
    """The bytes of every token id, one after the other."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values(), default=-1) + 1
        self.lens = np.full(self.size, -1, np.int64)
        for token, rank in ranks.items():
            self.lens[rank] = len(token)
        self.flat = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)
        self.starts = np.cumsum(np.maximum(self.lens, 0)) - np.maximum(self.lens, 0)

    def decode(self, tokens: np.ndarray) -> bytes | None:
        """What the ids stand for, null if the vocabulary lacks one of them."""
        if not len(tokens):
            return b""
        if tokens.min() < 0 or tokens.max() >= self.size or (self.lens[tokens] < 0).any():
            return None
        parts = (tokens[i : i + CHUNK_CHARS] for i in range(0, len(tokens), CHUNK_CHARS))
        return b"".join(ragged_take(self.flat, self.starts[t], self.lens[t]).tobytes() for t in parts)


def _encoder(key: str, ranks: dict[bytes, int], pattern: str, pairs: PairTable) -> Encoder:
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(ranks, pattern, pairs)
    return _ENCODERS[key]


def _run_encoder(df: DataFrame, id_col: str, text_col: str, ranks_path: str, pattern: str, decoded: bool) -> DataFrame:
    ranks = load_ranks(ranks_path)
    shared = df.sparkSession.sparkContext.broadcast((ranks, PairTable(ranks), TokenBytes(ranks) if decoded else None))
    key = f"{ranks_path}\n{pattern}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, pairs, token_bytes = shared.value
        encoder = _encoder(key, ranks, pattern, pairs)
        for batch in slices(batches, 1):
            ids, counts = encoder.encode(batch.column(1).to_pylist())
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            columns = [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))]
            if token_bytes:
                columns.append(pa.array([token_bytes.decode(ids[a:b]) for a, b in zip(offsets, offsets[1:])], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "ids", "decoded"][: len(columns)])

    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"_id {kind}, ids array<int>" + (", decoded binary" if decoded else ""))
    return found.withColumnRenamed("_id", id_col)


def encode(df: DataFrame, id_col: str, text_col: str, ranks_path: str, pattern: str) -> DataFrame:
    """``(id_col, ids array<int>)`` for each row, as encoding without special tokens gives them.

    A null or empty text has an empty array; repeated rows and null ids are kept as they are;
    other columns are dropped. The rank file is read on the driver and broadcast, so its path
    need not exist on the executors; a vocabulary has a fixed size. Its pair table is made once, on
    the driver, since making it takes several times its size.
    """
    return _run_encoder(df, id_col, text_col, ranks_path, pattern, False)


def round_trip(df: DataFrame, id_col: str, text_col: str, ranks_path: str, pattern: str) -> DataFrame:
    """``(id_col, ids, decoded binary)``: as :func:`encode`, with what :func:`decode` makes of the ids.

    Both are done by one Python worker a task, so the ids do not go through Spark in between.
    """
    return _run_encoder(df, id_col, text_col, ranks_path, pattern, True)


def decode(df: DataFrame, id_col: str, ids_col: str, ranks_path: str) -> DataFrame:
    """``(id_col, ids, decoded binary)``: the bytes that the ids stand for.

    Null or empty ids decode to no bytes; an id that the vocabulary lacks makes ``decoded`` null.
    """
    shared = df.sparkSession.sparkContext.broadcast(TokenBytes(load_ranks(ranks_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int32)
        for batch in slices(batches, 1):
            lists = (t.values.to_numpy(zero_copy_only=False) if t.is_valid else none for t in batch.column(1))
            decoded = pa.array([shared.value.decode(tokens) for tokens in lists], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), decoded], names=["_id", "ids", "decoded"])

    rows = df.select(F.col(id_col).alias("_id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"_id {kind}, ids array<int>, decoded binary")
    return found.select(F.col("_id").alias(id_col), "ids", "decoded")
