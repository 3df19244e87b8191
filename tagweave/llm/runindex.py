"""Substring dedup with a run-length index.

Repeats are found in three steps. Sampled phrases of bytes (minimizers) that recur tell which
windows may occur again; the windows around one sampled phrase form a context. Distinct contexts
are dealt to shards by their phrase, and each shard builds a run-compressed Burrows-Wheeler
transform with a sample at every run end. Contexts are streamed through it backwards; the
matching statistics say for each window the smallest document in which it also starts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import by_size, materialize, ragged_take, release
from tagweave.llm.hashing import BASE, buffer_of, mix, phrases, sliding_any, sliding_min
from tagweave.llm.recurring import KEY_BITS, key_of, recurring_keys

WINDOW = 50  # bytes of a string that counts as repeated
ANCHOR = 20  # bytes of a sampled phrase
CHUNK_BYTES = 32 << 10  # text that is hashed at a time, so that its hashes stay in cache; longer texts are cut with an overlap
SHARD_BYTES = 256 << 10  # context bytes of one index
BODIES = 4_096  # contexts that are cut out, or whose windows are listed, at a time
HOT_CONTEXTS = 4_000  # distinct contexts of one phrase from which its windows are grouped instead
BROADCAST_ROWS = 200_000
NO_ID = -(2**63)  # stands for a null id, which comes before all others


def small(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if its counted size allows it, else to be hashed within partitions, as sorting costs more."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df.hint("shuffle_hash")


def with_lists(texts: DataFrame, lists: DataFrame, on: list[str]) -> DataFrame:
    """The texts that have a row in ``lists``, with it; where few have one the others are not shuffled."""
    if lists.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(lists.select(on)), on, "left_semi")
    return texts.join(lists.hint("shuffle_hash"), on)


# --- the index --------------------------------------------------------------------------------


@dataclass(frozen=True)
class RunIndex:
    """Run-length BWT of a set of texts. A run also ends where the next ``window`` bytes change."""

    run: np.ndarray  # rank over the marked run starts: the run of each row
    shift: np.ndarray  # what takes a row of the run to the row of the suffix one byte longer
    sample: np.ndarray  # at the run's end: least label of the texts that hold its window

    def stream(self, lengths: np.ndarray, window: int) -> np.ndarray:
        """For each byte of each text, the least label of a text with the window from there.

        Texts are those of the index, in order; all are walked backwards side by side. Bytes
        from which no whole window follows have the largest label.
        """
        out = np.full(int(lengths.sum()), np.iinfo(np.int64).max)
        ends = np.cumsum(lengths)
        alive = np.flatnonzero(lengths)
        row = alive.copy()  # the row of the end of text i is i
        run = self.run[row]
        for step in range(1, int(lengths.max(initial=0)) + 1):
            row = row + self.shift[run]
            run = self.run[row]
            if step >= window:
                out[ends[alive] - step] = self.sample[run]
            keep = lengths[alive] > step
            if not keep.all():
                alive, row, run = alive[keep], row[keep], run[keep]
        return out


def _ordered(order_by: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of at most ``bits`` bits in order, and where each stood.

    Sorting numbers is several times faster than sorting places by them, so both go into one where they fit.
    """
    low = len(order_by).bit_length()
    if bits + low > 63:
        order = np.argsort(order_by)
        return order_by[order], order
    both = order_by << low
    both |= np.arange(len(order_by))
    both.sort()
    return both >> low, both & ((1 << low) - 1)


def _ranks(order_by: np.ndarray, bits: int) -> np.ndarray:
    ordered, order = _ordered(order_by, bits)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]))
    return rank


def build_index(data: np.ndarray, lengths: np.ndarray, labels: np.ndarray, window: int) -> RunIndex:
    """Index of texts laid out one after the other in ``data``, with an integer label each.

    Every text gets an end of its own, smaller than all bytes, so suffixes of different texts
    are never equal and sorting need not look past an end.
    """
    m, n = len(lengths), int(lengths.sum()) + len(lengths)
    ends = np.cumsum(lengths + 1) - 1
    symbol = np.zeros(n, np.int64)
    inside = np.ones(n, bool)
    inside[ends] = False
    symbol[inside] = data.astype(np.int64) + 1
    text_of = np.repeat(np.arange(m), lengths + 1)
    left = ends[text_of] - np.arange(n)  # bytes from here to the end

    def ahead(values: np.ndarray, by: int) -> np.ndarray:
        """``values`` ``by`` places on, 0 past the end of the text."""
        out = np.zeros(n, np.int64)
        if by < n:
            out[: n - by] = np.where(left[: n - by] >= by, values[by:] + 1, 0)
        return out

    # Prefix doubling. The first key packs as many symbols as fit; equal rests of different texts
    # stay in the order of the texts, as their ends are.
    seen = np.zeros(257, bool)
    seen[symbol] = True
    seen[0] = True
    dense = (np.cumsum(seen) - 1)[symbol]
    bits = int(dense.max(initial=1)).bit_length()
    size = n.bit_length()
    depth = max(min((63 - size) // bits, window), 1)
    key = np.zeros(n, np.int64)
    for i in range(depth):
        key <<= bits
        key[: n - i] |= np.where(left[: n - i] >= i, dense[i:], 0)
    rank, ranks = _ranks(key, depth * bits), {}
    longest = int(lengths.max(initial=0)) + 1
    while True:
        if depth <= window:
            ranks[depth] = rank
        if depth >= longest:
            break
        rank = _ranks((rank << size) | ahead(rank, depth), 2 * size)
        depth *= 2
    order = _ordered((rank << m.bit_length()) | text_of, size + m.bit_length())[1]

    # Neighbouring suffixes start with the same window if two overlapping parts of it are equal.
    part = max(ranks)
    whole = left[order] >= window
    pieces = [ranks[part][order]] + [ahead(ranks[part], s)[order] for s in (*range(part, window - part, part), window - part)]
    same = whole[1:] & whole[:-1]
    for p in pieces:
        same &= p[1:] == p[:-1]
    same |= ~whole[1:] & ~whole[:-1]  # shorter rests are never asked for
    group = np.concatenate([[0], np.cumsum(~same)]) if n else np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], ~same])) if n else np.zeros(0, np.int64)
    least = np.minimum.reduceat(labels[text_of[order]], first) if n else np.zeros(0, np.int64)

    # The byte before each suffix; 0 where a text begins, from where no walk goes on.
    begins = np.zeros(n, bool)
    begins[np.concatenate([[0], ends[:-1] + 1])[: len(ends)]] = True
    before = np.where(begins, 0, np.concatenate([[0], symbol[:-1]]))[order]
    change = np.concatenate([[True], (before[1:] != before[:-1]) | ~same]) if n else np.zeros(0, bool)
    starts = np.flatnonzero(change)
    sizes = np.diff(np.append(starts, n))
    byte = before[starts]
    by_byte = np.argsort(byte, kind="stable")
    # Rows of suffixes that begin with a byte follow each other, in the order of the runs before it.
    target = np.empty(len(starts), np.int64)
    base = np.searchsorted(np.sort(symbol), byte[by_byte])
    within = np.cumsum(sizes[by_byte]) - sizes[by_byte]
    opens = np.concatenate([[0], np.flatnonzero(np.diff(byte[by_byte])) + 1]) if len(starts) else np.zeros(0, np.int64)
    within = within - np.repeat(within[opens], np.diff(np.append(opens, len(starts))))
    target[by_byte] = base + within
    return RunIndex((np.cumsum(change) - 1).astype(np.int32), target - starts, least[group[starts]])


# --- candidates -------------------------------------------------------------------------------


def pieces(texts: pa.Array, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes in chunks, with bounds, row and offset of each piece; long texts are cut.

    Neighbouring pieces of one text overlap by ``window - 1`` bytes, so each window is in one.
    """
    binary = texts.cast(pa.large_binary())
    sizes = pc.binary_length(binary).fill_null(0).to_pylist()
    for a, b in by_size(sizes, CHUNK_BYTES):
        data, bounds = buffer_of(binary.slice(a, b - a))
        if b - a > 1 or len(data) <= CHUNK_BYTES:
            yield data, bounds, np.arange(a, b), np.zeros(b - a, np.int64)
            continue
        for s in range(0, len(data) - window + 1, CHUNK_BYTES):
            part = data[s : s + CHUNK_BYTES + window - 1]
            yield part, np.array([0, len(part)]), np.array([a]), np.array([s])


def _runs(data: np.ndarray, bounds: np.ndarray, window: int, anchor: int):
    """Runs of neighbouring windows of a piece that have one sampled phrase, the least of a window.

    Gives the hashes of all phrases, and key, piece, start and number of windows of each run.
    Equal windows have equal least keys, so a window that occurs again has a least key that does.
    """
    whole = phrases(data.astype(np.uint64) + np.uint64(1), anchor)
    least = sliding_min(key_of(whole), window - anchor + 1)
    n = len(least)
    fits = np.maximum(np.diff(bounds) - window + 1, 0)
    new = np.zeros(n + 1, bool)
    np.not_equal(least[1:], least[:-1], out=new[1:n])
    some = fits > 0
    new[bounds[:-1][some]] = True
    new[(bounds[:-1] + fits)[some]] = True  # from here on windows would reach into the next piece
    new[n] = True
    begin = np.flatnonzero(new)
    count, begin = np.diff(begin), begin[:-1]
    piece = np.searchsorted(bounds, begin, side="right") - 1
    inside = begin < (bounds[:-1] + fits)[piece]
    begin, count, piece = begin[inside], count[inside], piece[inside]
    return whole, least[begin], piece, begin, count


def _sampled(window: int, anchor: int):
    """Keys of the sampled phrases of a batch, chunk by chunk, with the document of each."""

    def extract(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        d = batch.column("d").to_numpy()
        for data, bounds, rows, _ in pieces(batch.column("_text"), window):
            _, key, piece, _, _ = _runs(data, bounds, window, anchor)
            yield key, d[rows[piece]]

    return extract


def _contexts(window: int, anchor: int):
    """Rows ``(key, cx, d, h, pos, k)``: ``k`` windows from ``pos`` with one recurring phrase."""
    width = window - anchor + 1

    def of_row(rows: np.ndarray, key: np.ndarray) -> np.ndarray:
        # Rows beyond 2^16 share numbers; a context too many has nothing to be compared with.
        return key | (rows.astype(np.uint64) << np.uint64(KEY_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, h, lists = batch.column("d").to_numpy(), batch.column("h").to_numpy(), batch.column("keys")
            owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))
            known = np.sort(of_row(owner, lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)))
            for data, bounds, rows, offset in pieces(batch.column("_text"), window):
                whole, key, piece, start, count = _runs(data, bounds, window, anchor)
                asked = of_row(rows[piece], key)
                at = np.searchsorted(known, asked)
                recurs = np.flatnonzero(known[np.minimum(at, len(known) - 1)] == asked) if len(known) else at[:0]
                if not len(recurs):
                    continue
                # The windows of a context fit one bit mask.
                parts = -(-count[recurs] // width)
                since = width * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
                recurs = np.repeat(recurs, parts)
                k = np.minimum(count[recurs] - since, width)
                start, p = start[recurs] + since, piece[recurs]
                # A context's hash: those of phrases that together cover it.
                last = start + k + (window - 1 - anchor)
                cx = k.astype(np.uint64)
                for o in range(0, window + width - 1, anchor):
                    cx = mix(cx * np.uint64(BASE) + whole[np.minimum(start + o, last)])
                columns = [
                    pa.array(key[recurs].view(np.int64)),
                    pa.array(cx.view(np.int64)),
                    pa.array(d[rows[p]]),
                    pa.array(h[rows[p]]),
                    pa.array((start - bounds[p] + offset[p]).astype(np.int32)),
                    pa.array(k.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "cx", "d", "h", "pos", "k"])

    return run


def binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _bodies(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = buffer_of(batch.column("_text"))
            lists = batch.column("spans")
            owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            spans = lists.flatten()
            md = batch.column("d").to_numpy()[owner]
            start = bounds[owner] + spans.field("pos").to_numpy(zero_copy_only=False)
            size = spans.field("k").to_numpy(zero_copy_only=False).astype(np.int64) + (window - 1)
            for a in range(0, len(owner), BODIES):
                b = slice(a, a + BODIES)
                body = binary(ragged_take(data, start[b], size[b]), np.concatenate([[0], np.cumsum(size[b])]))
                yield pa.RecordBatch.from_arrays([spans.field("key")[b], spans.field("cx")[b], pa.array(md[b]), body], names=["key", "cx", "md", "body"])

    return run


def _index_shard(window: int):
    """Bit i of ``bits``: the context's window i also starts in a document before ``md``."""

    def run(group: pa.Table) -> pa.Table:
        md = group.column("md").to_numpy()
        data, bounds = buffer_of(group.column("body").combine_chunks())
        lengths = np.diff(bounds)
        index = build_index(data, lengths, md, window)
        earlier = index.stream(lengths, window) < np.repeat(md, lengths)
        at = np.arange(len(data)) - np.repeat(bounds[:-1], lengths)
        weight = np.where(earlier, np.left_shift(np.int64(1), np.minimum(at, 62)), 0)
        bits = np.add.reduceat(weight, bounds[:-1]) if len(lengths) else weight
        return pa.table({"key": group.column("key"), "cx": group.column("cx"), "md": group.column("md"), "bits": pa.array(bits, pa.int64())})

    return run


def _mark(window: int):
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column("_text")).to_pylist()
            for a, b in by_size(sizes, CHUNK_BYTES):
                part = batch.slice(a, b - a)
                data, bounds = buffer_of(part.column("_text"))
                marks = part.column("marks")
                owner = np.repeat(np.arange(len(marks)), pc.list_value_length(marks).fill_null(0).to_numpy(zero_copy_only=False))
                marks = marks.flatten()
                pos = bounds[owner] + marks.field("pos").to_numpy(zero_copy_only=False)
                bits = marks.field("bits").to_numpy(zero_copy_only=False).astype("<i8")
                starts = np.zeros(len(data) + window - 1, bool)  # of a removed window; none reaches into the next text
                for i in range(0, len(bits), BODIES):
                    each = np.unpackbits(bits[i : i + BODIES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    row, bit = np.nonzero(each)
                    starts[pos[i + row] + bit + window - 1] = True
                gone = sliding_any(starts, window)
                cut = np.zeros(len(data) + 1, bool)
                cut[bounds] = True
                begins = np.flatnonzero(gone & (cut[:-1] | ~np.concatenate([[False], gone[:-1]])))
                ends = np.flatnonzero(gone & (cut[1:] | ~np.append(gone[1:], False))) + 1
                first = np.searchsorted(begins, bounds)
                base = np.repeat(bounds[:-1], np.diff(first))
                items = pa.StructArray.from_arrays([pa.array((x - base).astype(np.int32)) for x in (begins, ends)], fields=list(span))
                left = np.concatenate([[0], np.cumsum(~gone)])[bounds]
                columns = [part.column("_id"), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), items), binary(data[~gone], left)]
                yield pa.RecordBatch.from_arrays(columns, names=["_id", "spans", "kept"])

    return run


def contexts_before(texts: DataFrame, window: int, anchor: int, repeated: bool = True) -> DataFrame:
    """``(d, h, marks)``: per text ``(d, h, _text)`` the windows that also start in a smaller document, as ``(pos, bits)``.

    ``repeated`` says that several rows may have one ``(d, h)``.
    """
    keys = recurring_keys(texts.select("d", "_text"), _sampled(window, anchor), across=True)
    some = with_lists(texts, keys, ["d"])
    contexts = materialize(some.mapInArrow(_contexts(window, anchor), "key long, cx long, d long, h long, pos int, k int"), "contexts")
    release(keys)

    # Equal contexts are one. Where a phrase has one context only, there is no other to match.
    # All of the aggregates take the same row, as they see the same rows in the same order; unlike a
    # least struct, which Spark sorts for, numbers are kept in a hash map.
    first = [F.min("d").alias("d"), *(F.min_by(c, "d").alias(c) for c in ("h", "pos", "k"))]
    distinct = materialize(contexts.groupBy("key", "cx").agg(*first, F.count("*").alias("times")), "distinct_contexts")
    variants = distinct.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    variants = materialize(variants, "variants")
    varied = distinct.join(small(variants.select("key")), "key", "left_semi")
    places = varied.groupBy("d", "h").agg(F.collect_list(F.struct("key", "cx", "pos", "k")).alias("spans"))
    places = materialize(places, "context_places")
    bodies = with_lists(texts, places, ["d", "h"]).mapInArrow(_bodies(window), "key long, cx long, md long, body binary")
    bodies = materialize(bodies.dropDuplicates(["key", "cx"]) if repeated else bodies, "context_bodies")
    release(places)

    hot = small(materialize(variants.where(F.col("n") > HOT_CONTEXTS).select("key"), "hot_phrases"))
    total = bodies.agg(F.coalesce(F.sum(F.length("body")), F.lit(0))).first()[0]
    shard = F.pmod(F.xxhash64("key"), F.lit(total // SHARD_BYTES + 1))
    out = "key long, cx long, md long, bits long"
    indexed = bodies.join(hot, "key", "left_anti").groupBy(shard.alias("shard")).applyInArrow(_index_shard(window), out)
    found = indexed.unionByName(_grouped(bodies.join(hot, "key", "left_semi"), window)).where("bits <> 0")
    found = materialize(found.select("key", "cx", "bits"), "context_bits")
    release(bodies, variants)

    # In the smallest document of a context the index decides; in the others all windows go.
    # A context that stands once and repeats nothing marks nothing.
    bits = distinct.select("key", "cx", F.col("d").alias("md"), "times").join(small(found), ["key", "cx"], "left")
    bits = materialize(bits.where("times > 1 or bits is not null").drop("times"), "bits")
    release(distinct, found)
    every = F.expr("shiftleft(1L, k) - 1L")
    value = F.when(F.col("d") > F.col("md"), every).otherwise(F.coalesce("bits", F.lit(0)))
    joined = contexts.join(small(bits), ["key", "cx"]).select("d", "h", "pos", value.alias("bits")).where("bits <> 0")
    marks = materialize(joined.groupBy("d", "h").agg(F.collect_set(F.struct("pos", "bits")).alias("marks")), "marks")
    release(contexts, bits)
    return marks


def _grouped(bodies: DataFrame, window: int) -> DataFrame:
    """The same bits for phrases with too many contexts for one index, by grouping their windows."""
    i = F.sequence(F.lit(0), F.length("body") - window)
    rows = bodies.select("key", "cx", "md", "body", F.explode(i).alias("i"))
    rows = materialize(rows.select("key", "cx", "md", "i", F.expr(f"substring(body, i + 1, {window})").alias("w")), "hot_windows")
    least = materialize(rows.groupBy("w").agg(F.min("md").alias("least")), "hot_least")
    bit = F.when(F.col("least") < F.col("md"), F.expr("shiftleft(1L, i)")).otherwise(F.lit(0).cast("long"))
    return rows.join(least, "w").groupBy("key", "cx", "md").agg(F.sum(bit).alias("bits"))


def dedup(df: DataFrame, id_col: str, text_col: str, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``(id_col, n_bytes, spans, kept binary)`` for each row of ``df``.

    Texts are UTF-8 bytes. A byte goes if a string of ``window`` bytes over it also starts in a
    text with a smaller id; ``spans`` are the maximal runs of removed bytes, ends exclusive, and
    ``kept`` the other bytes. A null text is empty. A null id comes before all others. Rows that
    share an id do not count for each other, and those that repeat a text too have one result,
    given for each row. Other columns are dropped.
    """
    if window - anchor + 1 > 62 or anchor < 1:
        raise ValueError("a context holds 1 to 62 windows")
    data = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = df.select(F.col(id_col).cast("long").alias("_id"), data.alias("_text"))
    rows = rows.withColumn("d", F.coalesce("_id", F.lit(NO_ID)))
    again = rows.groupBy("d").agg(F.count("*").alias("n")).where("n > 1").select("d", F.lit(True).alias("_again"))
    again = materialize(again, "repeated_ids")
    # The hash tells apart the texts of one id; where there is one text it is 0, which costs nothing to carry.
    repeated = not again.isEmpty()
    rows = rows.select("_id", "d", F.lit(0).cast("long").alias("h"), "_text") if not repeated else rows.join(small(again), "d", "left").select(
        "_id", "d", F.when(F.col("_again"), F.xxhash64("_text")).otherwise(F.lit(0)).alias("h"), "_text"
    )
    marks = contexts_before(rows.select("d", "h", "_text"), window, anchor, repeated)
    # Texts without marks take the same way, so that all are shuffled once.
    found = rows.join(marks.hint("shuffle_hash"), ["d", "h"], "left").select("_id", "_text", "marks")
    found = found.mapInArrow(_mark(window), "_id long, spans array<struct<start:int,end:int>>, kept binary")
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(F.col("_id").alias(id_col), (F.length("kept") + gone).cast("long").alias("n_bytes"), "spans", "kept")
