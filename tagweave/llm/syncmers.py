"""Document fingerprints of closed syncmers.

A k-mer of bytes is an anchor if the least hash of its inner s-mers lies at one of its edges. That
depends on the k-mer alone, so texts that share a passage share its anchors, whatever stands around
it, and any k - s + 1 neighbouring k-mers hold an anchor. A fingerprint lists all anchors of a
text with their distances; two fingerprints are matched by anchors that follow each other in both.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import by_size
from tagweave.llm.hashing import buffer_of, mix, sliding_min

K = 20  # bytes of an anchor
S = 4  # bytes of an inner substring; K - S + 1 is at most 63, so that a distance is one character
PIECE = 256 << 10  # bytes that are hashed at a time; longer texts are cut with an overlap
NO_ID = -(2**63)  # stands for a null id, which comes before all others

_DIGITS = np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-_", np.uint8)
_VALUES = np.zeros(256, np.int64)
_VALUES[_DIGITS] = np.arange(64)
_WIDTH = 6  # characters of an anchor: its distance to the one before, and 30 bits of its hash

_U = np.uint64


def _edge_kmers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the closed syncmers of a byte buffer, and 30 bits of the hash of each."""
    n = len(data) - S + 1
    grams = np.zeros(n, np.uint32)
    for i in range(S):
        grams <<= np.uint32(8)
        grams |= data[i : i + n]
    order = (mix(grams.astype(np.uint64) + _U(1)) >> _U(32)).astype(np.uint32)
    span = K - S + 1
    least = sliding_min(order, span)
    at = np.flatnonzero((order[: len(least)] == least) | (order[span - 1 :] == least))
    h = np.zeros(len(at), np.uint64)
    for i in range(0, K, S):
        h = mix(h ^ grams[at + i].astype(np.uint64)) + _U(i + 1)
    return at, (mix(h) >> _U(34)).astype(np.int64)


def anchors(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(positions, hashes)`` of the anchors of each text, in bytes.

    A text too short to hold one is an anchor as a whole; an empty or null text has none.
    """
    sizes = pc.binary_length(texts.cast(pa.large_binary())).fill_null(0).to_pylist()
    for a, b in by_size(sizes, PIECE):
        data, bounds = buffer_of(texts.slice(a, b - a))
        if b - a == 1 and len(data) > PIECE:
            parts = [(s, *_edge_kmers(data[s : s + PIECE + K - 1])) for s in range(0, len(data) - K + 1, PIECE)]
            yield np.concatenate([p + s for s, p, _ in parts]), np.concatenate([h for _, _, h in parts])
            continue
        at, h = _edge_kmers(data) if len(data) >= K else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        # Of the k-mers over a border none counts.
        text = np.searchsorted(bounds, at, side="right") - 1
        inside = at + K <= bounds[text + 1]
        at, h, text = at[inside], h[inside], text[inside]
        first = np.searchsorted(text, np.arange(b - a + 1))
        for t in range(b - a):
            start, end = int(bounds[t]), int(bounds[t + 1])
            if start < end and first[t] == first[t + 1]:
                digest = sha256(data[start:end].tobytes()).digest()
                yield np.zeros(1, np.int64), np.array([int.from_bytes(digest[:8], "little") >> 34])
            else:
                yield at[first[t] : first[t + 1]] - start, h[first[t] : first[t + 1]]


def pack(at: np.ndarray, h: np.ndarray) -> str:
    """Six characters per anchor: how far it is from the one before, and its hash."""
    out = np.empty((len(at), _WIDTH), np.uint8)
    out[:, 0] = _DIGITS[np.diff(at, prepend=0)]
    for i in range(1, _WIDTH):
        out[:, i] = _DIGITS[(h >> (6 * (_WIDTH - 1 - i))) & 63]
    return out.tobytes().decode("ascii")


def unpack(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """The positions and hashes of a fingerprint."""
    values = _VALUES[np.frombuffer(fingerprint.encode("ascii"), np.uint8)].reshape(-1, _WIDTH)
    h = np.zeros(len(values), np.int64)
    for i in range(1, _WIDTH):
        h = (h << 6) | values[:, i]
    return np.cumsum(values[:, 0]), h


def _numbered(h: np.ndarray) -> np.ndarray:
    """Each hash with the number of its occurrence, as one integer."""
    order = np.argsort(h, kind="stable")
    ordered = h[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    number = np.empty(len(h), np.int64)
    number[order] = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
    return (h << 32) | number


Anchors = tuple[np.ndarray, np.ndarray]


def likeness(a: Anchors, b: Anchors) -> float:
    """Share of two texts, given by the positions and hashes of their anchors, that is the same in both.

    The i-th occurrence of an anchor is matched with the i-th one of the other text, and of the
    matches the longest chain that ascends in both counts. An anchor weighs as much as the bytes up
    to the next one, so that repetitive stretches, where anchors are dense, do not count for more.
    Two texts without anchors are alike.
    """
    (at_a, a), (at_b, b) = a, b
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    _, i, j = np.intersect1d(_numbered(a), _numbered(b), assume_unique=True, return_indices=True)
    order = np.argsort(i)
    i, j = i[order], j[order]
    if not (np.diff(j) > 0).all():
        chain = _longest_ascent(j.tolist())
        i, j = i[chain], j[chain]
    w_a, w_b = (np.diff(at, append=at[-1] + K) for at in (at_a, at_b))
    return 2.0 * float(np.minimum(w_a[i], w_b[j]).sum()) / float(w_a.sum() + w_b.sum())


def _longest_ascent(values: list[int]) -> list[int]:
    """Places of a longest ascending subsequence of distinct values."""
    ends: list[int] = []  # the least end of an ascent of each length, and its place
    places: list[int] = []
    before = [-1] * len(values)
    for i, x in enumerate(values):
        p = bisect_left(ends, x)
        before[i] = places[p - 1] if p else -1
        ends[p : p + 1], places[p : p + 1] = [x], [i]
    out, i = [], places[-1]
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def edited_text(text: str, after: str) -> str:
    """The last half of the code points, rounded down, replaced by as many of ``after`` from its start."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def fingerprints(docs: DataFrame, text_col: str, out_col: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each text; a column of that name is replaced.

    Equal texts have equal fingerprints. Null and empty texts have an empty one, and a text without a
    closed syncmer, of fewer than K + K - S bytes, is one anchor. Texts of any length are read whole, a piece at a time.
    """

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([pack(at, h) for at, h in anchors(texts)], pa.string())

    return docs.withColumn(out_col, run(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


PAIR_SCHEMA = "d long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_next(docs: DataFrame, id_col: str, text_col: str, edit=edited_text, ranges: int | None = None) -> DataFrame:
    """``(id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` per row.

    Each text is compared with its edited text and with the text of the next row by ascending id;
    the last row is followed by the first. Rows that share an id are ordered by a hash of their
    text; a null id comes before all others. A null text is empty. Texts move once: ids are cut
    into ranges of rows, each range gets the first row of the one after it as well, and is read in
    order. An empty table gives no rows, one row follows itself. Other columns are dropped.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("d"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    ranges = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ids = rows.select("d").repartitionByRange(ranges, "d")
    # One id per range comes to the driver.
    firsts = sorted(r["d"] for r in ids.groupBy(F.spark_partition_id().alias("p")).agg(F.min("d").alias("d")).collect())
    shared = spark.sparkContext.broadcast(np.array(firsts, np.int64))

    @F.arrow_udf("array<int>")
    def places(d: pa.Array) -> pa.Array:
        """The range of an id, and for a range's first id the range before it."""
        opens, ids = shared.value, d.to_numpy()
        own = np.searchsorted(opens, ids, side="right") - 1
        first = opens[own] == ids
        lists = np.stack([own, np.where(own > 0, own - 1, len(opens) - 1)], axis=1)
        keep = np.stack([np.ones(len(ids), bool), first], axis=1)
        offsets = np.concatenate([[0], np.cumsum(keep.sum(axis=1))])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(lists[keep].astype(np.int32)))

    if not firsts:
        return spark.createDataFrame([], PAIR_SCHEMA).withColumnRenamed("d", id_col)
    # The row that follows a range comes behind all of it, also where the last range is followed by the first.
    placed = rows.select("d", "_text", F.posexplode(places("d")).alias("guard", "r"))
    placed = placed.repartitionById(len(firsts), F.col("r")).sortWithinPartitions("r", "guard", "d", F.xxhash64("_text"))
    found = placed.select("r", "guard", "d", "_text").mapInArrow(_pairs(edit), PAIR_SCHEMA)
    return found.withColumn("d", F.when(F.col("d") != NO_ID, F.col("d"))).withColumnRenamed("d", id_col)


def _pairs(edit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row of the part before
        for part in _parts(batches):
            r, guard, d, texts = (c.to_pylist() for c in part.columns)
            if held is not None:
                r, guard, d, texts = [held[0], *r], [0, *guard], [held[2], *d], [held[3], *texts]
            own = [i for i in range(len(r) - 1) if guard[i] == 0 and r[i + 1] == r[i]]
            if own:
                yield _results([d[i] for i in own], [texts[i] for i in own], [texts[i + 1] for i in own], edit)
            held = (r[-1], 0, d[-1], texts[-1]) if guard[-1] == 0 else None

    return run


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.binary_length(batch.column(3)).to_pylist()
        for a, b in by_size(sizes, 2 * PIECE):
            yield batch.slice(a, b - a)


def _results(ids: list[int], texts: list[str], after: list[str], edit) -> pa.RecordBatch:
    edited = [edit(t, a) for t, a in zip(texts, after)]
    own, changed, following = (list(anchors(pa.array(x, pa.large_string()))) for x in (texts, edited, after))
    columns = [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([sha256(t.encode()).hexdigest() for t in edited]),
        pa.array([pack(*x) for x in own]),
        pa.array([pack(*x) for x in changed]),
        pa.array([likeness(x, y) for x, y in zip(own, changed)], pa.float64()),
        pa.array([likeness(x, y) for x, y in zip(own, following)], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["d", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
