"""Keys of sampled phrases that recur in a corpus, and the documents that hold them.

All keys are counted, but a row is made only for those that recur. Tasks pack their keys sorted
and as differences, about half the size of the keys. The recurring ones set the bits of a filter
of fixed size, and a second pass over the texts makes rows for keys that pass it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import materialize
from tagweave.llm.hashing import mix

KEY_BITS = 48  # of a phrase hash; two phrases with one key only cost a comparison
PACK_KEYS = 250_000  # phrases that a task packs together
BUCKET_TEXT = 16 << 20  # characters of text whose keys one task counts
FILTER_BITS = 1 << 28  # 32 MB, whatever the input
FILTER_PART = 1 << 22
BROADCAST_ROWS = 200_000

# Takes a batch with ``d`` and ``_text``, gives keys and the document of each, chunk by chunk.
Extract = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]]


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df``, marked for broadcast if its counted size allows it, else to be hashed within partitions, as sorting costs more."""
    rows = BROADCAST_ROWS if rows is None else rows
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df.hint("shuffle_hash")


def key_of(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - KEY_BITS)


def recurring_set(rows: DataFrame, extract: Extract, buckets: int, across: bool) -> DataFrame:
    """The recurring keys, each once."""
    packed = rows.mapInArrow(_packed(extract, buckets, across), "bucket int, body binary")
    return materialize(packed.groupBy("bucket").applyInArrow(_recurring, "key long"), "recurring")


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys the filter lets through: all recurring ones, and some others."""
    slot = _filter_slot(keys)
    return (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


def recurring_keys(texts: DataFrame, extract: Extract, across: bool) -> DataFrame:
    """``(d, keys array<long>)``: the recurring keys of each document of ``texts (d, _text)``.

    A key recurs if it occurs twice, or, with ``across``, in two documents.
    """
    size = texts.agg(F.coalesce(F.sum(F.length("_text")), F.lit(0))).first()[0]
    recurring = recurring_set(texts, extract, size // BUCKET_TEXT + 1, across)
    shared = texts.sparkSession.sparkContext.broadcast(key_filter(recurring))
    rows = texts.mapInArrow(_passing(extract, shared), "key long, d long")
    return materialize(rows.join(small(recurring), "key").groupBy("d").agg(F.collect_set("key").alias("keys")), "document_keys")


def _packed(extract: Extract, buckets: int, across: bool):
    """Rows ``(bucket, body)``: the distinct keys of about ``PACK_KEYS`` phrases, sorted, in a range of keys.

    The lowest bit of an entry says that the key recurs within the pack. Entries are
    differences, laid out by byte significance, of which the upper ones are nearly all zero.
    """
    step = -(-(1 << KEY_BITS) // buckets)

    def emit(keys: list[np.ndarray], docs: list[np.ndarray]) -> pa.RecordBatch:
        key, doc = np.concatenate(keys), np.concatenate(docs)
        order = np.argsort(key)
        key, doc = key[order], doc[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        if across:
            twice = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)
        else:
            twice = np.diff(np.append(first, len(key))) > 1
        entry = key[first] << np.uint64(1) | twice.astype(np.uint64)
        cut = np.searchsorted(key[first], np.arange(1, buckets, dtype=np.uint64) * np.uint64(step))
        parts = [(b, e) for b, e in enumerate(np.split(entry, cut)) if len(e)]
        bodies = [np.diff(e, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes() for _, e in parts]
        return pa.RecordBatch.from_pydict({"bucket": pa.array([b for b, _ in parts], pa.int32()), "body": pa.array(bodies, pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, held = [], [], 0
        for batch in batches:
            for key, doc in extract(batch):
                if len(key):
                    keys.append(key)
                    docs.append(doc)
                    held += len(key)
                if held >= PACK_KEYS:
                    yield emit(keys, docs)
                    keys, docs, held = [], [], 0
        if held:
            yield emit(keys, docs)

    return run


def _unpacked(body: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(8, -1).T).view(np.uint64).ravel())


def _recurring(group: pa.Table) -> pa.Table:
    """Keys of a bucket that recur. No key is there more than once per pack, however frequent it is."""
    entry = np.sort(np.concatenate([_unpacked(b) for b in group.column("body").to_pylist()]))
    key = entry >> np.uint64(1)
    again = np.zeros(len(key), bool)
    again[1:] = key[1:] == key[:-1]
    again |= (entry & np.uint64(1)) == 1
    return pa.table({"key": pa.array(np.unique(key[again]).view(np.int64))})


def _filter_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for batch in batches:
        slot = _filter_slot(batch.column("key").to_numpy().view(np.uint64))
        np.bitwise_or.at(bits, slot >> 3, np.left_shift(1, 7 - (slot & 7)).astype(np.uint8))
    step = FILTER_PART // 8
    for i in range(0, len(bits), step):
        if bits[i : i + step].any():
            yield pa.RecordBatch.from_pydict({"at": pa.array([8 * i], pa.int64()), "body": pa.array([bits[i : i + step].tobytes()], pa.binary())})


def _either(group: pa.Table) -> pa.Table:
    bodies = [np.frombuffer(b, np.uint8) for b in group.column("body").to_pylist()]
    return pa.table({"at": group.column("at").slice(0, 1), "body": pa.array([np.bitwise_or.reduce(bodies).tobytes()], pa.binary())})


def _filter_slot(keys: np.ndarray) -> np.ndarray:
    return (mix(keys) % np.uint64(FILTER_BITS)).astype(np.int64)


def key_filter(keys: DataFrame) -> np.ndarray:
    """A bit per hash slot of the keys. Its size is fixed; when full it only stops saving rows."""
    parts = keys.mapInArrow(_filter_parts, "at long, body binary").groupBy("at").applyInArrow(_either, "at long, body binary")
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in parts.collect():
        body = np.frombuffer(r["body"], np.uint8)
        out[r["at"] // 8 : r["at"] // 8 + len(body)] = body
    return out


def _passing(extract: Extract, shared):
    """Distinct ``(key, d)`` of the phrases that pass the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, doc in extract(batch):
                some = passes(shared.value, key)
                key, doc = key[some], doc[some]
                order = np.lexsort((key, doc))
                key, doc = key[order], doc[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(key[new].view(np.int64)), pa.array(doc[new])], names=["key", "d"])

    return run
