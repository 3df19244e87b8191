"""Substring dedup by repeated-phrase automata.

Recurring passages are confirmed by counting hashed windows of words; each passage is read from
the place where it stands first; Aho-Corasick automata of the passages that a shard of documents
asks for locate every occurrence in its texts, and all but the first are removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagweave.llm.common import by_size, materialize, slices
from tagweave.llm.hashing import Words, anchors, mix, phrases, powers, starts_of
from tagweave.llm.recurring import key_of, recurring_keys

WINDOW = 20  # words of a passage that counts as repeated
ANCHOR = 5  # words of a sampled phrase; a window holds WINDOW - ANCHOR + 1 of them
PIECE = 2000  # windows of a passage that go into an automaton as one pattern
SHARD_CHARS = 1_000_000  # characters of the patterns of one automaton
CHUNK_BYTES = 256 << 10  # text that is hashed at a time
BROADCAST_ROWS = 200_000
NO_ID = -(2**63)  # stands for a null id, which comes before all others

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    yield from by_size(pc.binary_length(texts.cast(pa.large_binary())).fill_null(0).to_pylist(), CHUNK_BYTES)


def _sampled(window: int, anchor: int):
    """Keys of the sampled phrases of a batch, chunk by chunk, with the document of each."""

    def extract(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for a, b in chunks(batch.column("_text")):
            words = Words(batch.column("_text").slice(a, b - a), lower=False)
            keys = key_of(phrases(words.hashes(), anchor))
            at, _ = starts_of(words.first, words.counts, window)
            found, _ = anchors(keys, at, window - anchor + 1)
            doc = np.searchsorted(words.first, found, side="right") - 1
            yield keys[found], batch.column("d").slice(a, b - a).to_numpy()[doc]

    return extract


def _contexts(window: int, anchor: int):
    """Rows ``(key, cx, d, h, pos, k, inner)``: ``k`` windows from word ``pos`` with one recurring phrase.

    ``inner`` says that the context holds the phrase twice, so that a window may repeat inside it.
    """
    width = window - anchor + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in chunks(batch.column("_text")):
                part = batch.slice(a, b - a)
                words = Words(part.column("_text"), lower=False)
                hashes = words.hashes()
                at, fits = starts_of(words.first, words.counts, window)
                keys = key_of(phrases(hashes, anchor))
                _, least = anchors(keys, at, width)
                doc, ends, lists = np.repeat(np.arange(len(fits)), fits), np.cumsum(fits), part.column("keys")
                recurs = np.zeros(len(at), bool)
                for t in np.flatnonzero(fits).tolist():
                    own = slice(ends[t] - fits[t], ends[t])
                    recurs[own] = np.isin(least[own].view(np.int64), lists[t].values.to_numpy(zero_copy_only=False))
                hit = np.flatnonzero(recurs)
                if not len(hit):
                    continue
                new = np.concatenate([[True], (np.diff(at[hit]) != 1) | (least[hit][1:] != least[hit][:-1]) | (np.diff(doc[hit]) != 0)])
                begin = np.flatnonzero(new)
                since = np.arange(len(hit)) - np.repeat(begin, np.diff(np.append(begin, len(hit))))
                begin = np.flatnonzero(since % width == 0)
                k = np.diff(np.append(begin, len(hit)))
                start, t = at[hit[begin]], doc[hit[begin]]
                # A context's hash: the differences of prefix sums over its words, as for a phrase.
                sums = np.zeros(len(hashes) + 1, np.uint64)
                np.cumsum(hashes * powers(len(hashes)), out=sums[1:])
                cx = mix((sums[start + k + window - 1] - sums[start]) * powers(len(hashes) + 1, inverse=True)[start] + k.astype(np.uint64))
                spots = k + width - 1
                opens = np.cumsum(spots) - spots
                at_spot = np.arange(spots.sum()) + np.repeat(start - opens, spots)
                inner = np.add.reduceat((keys[at_spot] == np.repeat(least[hit[begin]], spots)).astype(np.int64), opens) > 1
                columns = [
                    pa.array(least[hit[begin]].view(np.int64)),
                    pa.array(cx.view(np.int64)),
                    pa.array(part.column("d").to_numpy()[t]),
                    pa.array(part.column("h").to_numpy()[t]),
                    pa.array((start - words.first[t]).astype(np.int32)),
                    pa.array(k.astype(np.int32)),
                    pa.array(inner),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "cx", "d", "h", "pos", "k", "inner"])

    return run


def _window_hashes(window: int):
    """Rows ``(key, cx, i, w)``: hash of each window of the contexts listed in ``spans``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in chunks(batch.column("_text")):
                part = batch.slice(a, b - a)
                words = Words(part.column("_text"), lower=False)
                whole = phrases(words.hashes(), window)
                spans = part.column("spans")
                flat = spans.flatten()
                owner = np.repeat(np.arange(len(spans)), pc.list_value_length(spans).to_numpy(zero_copy_only=False))
                key, cx, pos, k = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("key", "cx", "pos", "k"))
                each = np.repeat(np.arange(len(k)), k)
                i = np.arange(len(each)) - np.repeat(np.cumsum(k) - k, k)
                w = whole[(words.first[owner] + pos)[each] + i]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[each]), pa.array(cx[each]), pa.array(i.astype(np.int32)), pa.array(w.view(np.int64))], names=["key", "cx", "i", "w"]
                )

    return run


def repeated_passages(texts: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``(d, h, fd, fh, fstart, n)``: a passage of ``n`` words of text ``(d, h)`` and where it stands first.

    Texts come as ``(d, h, _text)``. Equal windows have the same sampled phrase, so windows whose
    phrase does not recur are left out. Neighbouring windows with one phrase form a context, and
    contexts are compared whole; only where a phrase has several, or stands twice in one, are their
    windows compared.
    """
    keys = recurring_keys(texts.select("d", "_text"), _sampled(window, anchor), across=False)
    some = texts.join(small(keys.select("d")), "d", "left_semi").join(keys, "d")
    contexts = materialize(some.mapInArrow(_contexts(window, anchor), "key long, cx long, d long, h long, pos int, k int, inner boolean"), "contexts")
    distinct = contexts.groupBy("key", "cx").agg(F.min(F.struct("d", "h", "pos", "k", "inner")).alias("f"), F.count("*").alias("n"))
    distinct = materialize(distinct.select("key", "cx", "f.*", "n"), "distinct_contexts")

    # First places of windows, as runs of neighbours; a context without variants is one run.
    variants = distinct.groupBy("key").agg(F.count("*").alias("v"), F.bool_or("inner").alias("inner")).where("v > 1 or inner").select("key")
    varied = materialize(distinct.join(small(materialize(variants, "variants")), "key", "left_semi"), "varied")
    places = varied.groupBy("d", "h").agg(F.collect_list(F.struct("key", "cx", "pos", "k")).alias("spans"))
    places = materialize(places, "context_places")
    holders = texts.join(small(places.select("d", "h")), ["d", "h"], "left_semi").join(places, ["d", "h"])
    windows = holders.mapInArrow(_window_hashes(window), "key long, cx long, i int, w long").distinct()
    windows = windows.join(varied.select("key", "cx", "d", "h", "pos", F.col("n").alias("times")), ["key", "cx"])
    windows = materialize(windows.withColumn("f", F.struct("d", "h", (F.col("pos") + F.col("i")).alias("pos"))).select("key", "cx", "i", "w", "f", "times"), "windows")
    first = windows.groupBy("w").agg(F.min("f").alias("first"), F.sum("times").alias("times")).where("times > 1").select("w", "first")
    known = windows.drop("times").join(materialize(first, "first_places"), "w")
    known = known.select("key", "cx", "i", F.col("first.d").alias("fd"), F.col("first.h").alias("fh"), F.col("first.pos").alias("fpos"))
    known = known.withColumn("by", F.col("fpos") - F.col("i"))
    order = Window.partitionBy("key", "cx", "fd", "fh", "by").orderBy("i")
    known = known.withColumn("run", F.col("i") - F.row_number().over(order))
    runs = known.groupBy("key", "cx", "fd", "fh", "by", "run").agg(F.min("i").alias("i"), F.min("fpos").alias("fpos"), F.count("*").cast("int").alias("m"))
    runs = runs.select("key", "cx", "i", "fd", "fh", "fpos", "m")
    single = distinct.where("n > 1").join(varied.select("key", "cx"), ["key", "cx"], "left_anti")
    single = single.select("key", "cx", F.lit(0).alias("i"), F.col("d").alias("fd"), F.col("h").alias("fh"), F.col("pos").alias("fpos"), F.col("k").alias("m"))
    runs = materialize(runs.unionByName(single), "runs")

    later = contexts.join(runs, ["key", "cx"]).withColumn("pos", F.col("pos") + F.col("i"))
    here = (F.col("d") == F.col("fd")) & (F.col("h") == F.col("fh")) & (F.col("pos") == F.col("fpos"))
    later = later.where(~here).select("d", "h", "fd", "fh", "pos", "fpos", "m").distinct()
    # Runs that follow each other here and at the first place make one passage.
    along = Window.partitionBy("d", "h", "fd", "fh", "by").orderBy("pos")
    before = F.sum("m").over(along.rowsBetween(Window.unboundedPreceding, -1))
    joined = later.withColumn("by", F.col("pos") - F.col("fpos")).withColumn("run", F.col("pos") - F.coalesce(before, F.lit(0)))
    joined = joined.groupBy("d", "h", "fd", "fh", "by", "run").agg(F.min("fpos").alias("fpos"), F.sum("m").cast("int").alias("k"))
    cut = joined.select("d", "h", "fd", "fh", "fpos", "k", F.explode(F.sequence(F.lit(0), F.col("k") - 1, F.lit(PIECE))).alias("o"))
    n = F.least(F.lit(PIECE), F.col("k") - F.col("o")) + (window - 1)
    return materialize(cut.select("d", "h", "fd", "fh", (F.col("fpos") + F.col("o")).alias("fstart"), n.alias("n")).distinct(), "passages")


def _read_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            words = _WORD.findall(row["_text"])
            spans = [(s["fstart"], s["n"]) for s in row["spans"]]
            k = len(spans)
            columns = [
                pa.array([row["d"]] * k, pa.int64()),
                pa.array([row["h"]] * k, pa.int64()),
                pa.array([s for s, _ in spans], pa.int32()),
                pa.array([n for _, n in spans], pa.int32()),
                pa.array([" ".join(words[s : s + n]) for s, n in spans], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["fd", "fh", "fstart", "n", "phrase"])


def mark(words: list[str], place: tuple[int, int], automata: list[ahocorasick.Automaton]) -> np.ndarray:
    """Which words an occurrence of a phrase covers, at another than the phrase's first place."""
    line = f" {' '.join(words)} "
    spaces = np.cumsum([0, *(len(w) + 1 for w in words)])
    cover = np.zeros(len(words) + 1, np.int64)
    for automaton in automata:
        hits = [(end, *info) for end, info in automaton.iter(line)]
        if not hits:
            continue
        last = np.searchsorted(spaces, [h[0] for h in hits])
        for stop, (_, n, d, h, start) in zip(last.tolist(), hits):
            if (d, h, start) != (*place, stop - n):
                cover[stop - n] += 1
                cover[stop] -= 1
    return np.cumsum(cover[:-1]) > 0


def compile_automata(wanted: dict[str, tuple[int, int, int, int]]) -> list[ahocorasick.Automaton]:
    """Automata over all phrases, each of about ``SHARD_CHARS`` characters."""
    phrases_ = sorted(wanted)
    out = []
    for a, b in by_size([len(p) for p in phrases_], SHARD_CHARS):
        automaton = ahocorasick.Automaton()
        for p in phrases_[a:b]:
            # With a space on both sides a phrase matches whole words only.
            automaton.add_word(f" {p} ", wanted[p])
        automaton.make_automaton()
        out.append(automaton)
    return out


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 3):
        sizes = [sum(len(p["phrase"]) for p in row.as_py() or ()) for row in batch.column("phrases")]
        for a, b in by_size(sizes, SHARD_CHARS):
            part = batch.slice(a, b - a).to_pylist()
            wanted = {p["phrase"]: (p["n"], p["fd"], p["fh"], p["fstart"]) for row in part for p in row["phrases"] or ()}
            automata = compile_automata(wanted)
            ids, totals, removed, spans, kept = [], [], [], [], []
            for row in part:
                words = _WORD.findall(row["_text"])
                gone = mark(words, (row["d"], row["h"]), automata) if automata else np.zeros(len(words), bool)
                edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                ids.append(row["_id"])
                totals.append(len(words))
                removed.append(int(gone.sum()))
                spans.append([{"start": s, "end": e} for s, e in edges.reshape(-1, 2).tolist()])
                kept.append(" ".join(w for w, g in zip(words, gone) if not g) if len(edges) else " ".join(words))
            span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
            columns = [pa.array(ids, pa.int64()), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "n_words", "n_removed", "spans", "kept"])


def dedup(df: DataFrame, id_col: str, text_col: str, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``(id_col, n_words, n_removed, spans, kept)`` for each row of ``df``.

    Words are runs without white space. A word goes if a window of ``window`` words over it also
    starts earlier: in a text with a smaller id, or earlier in the same text. ``spans`` are the
    runs of removed words, ends exclusive, and ``kept`` the other words with single spaces.
    Null, empty and blank texts have no words. A null id comes before all others. Texts that
    share an id are told apart by their hash and ordered by it; rows that repeat both are one
    text with one result, given for each row. Other columns are dropped.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text"))
    rows = rows.withColumn("d", F.coalesce("_id", F.lit(NO_ID)))
    again = rows.groupBy("d").agg(F.count("*").alias("n")).where("n > 1").select("d", F.lit(True).alias("_again"))
    again = materialize(again, "repeated_ids")
    # The hash tells apart the texts of one id; where there is one text it is 0, which costs nothing to carry.
    rows = rows.select("_id", "d", F.lit(0).cast("long").alias("h"), "_text") if again.isEmpty() else rows.join(small(again), "d", "left").select(
        "_id", "d", F.when(F.col("_again"), F.xxhash64("_text")).otherwise(F.lit(0)).alias("h"), "_text"
    )
    once = rows.select("d", "h", "_text")

    passages = repeated_passages(once, window, anchor)
    asked = passages.groupBy("fd", "fh").agg(F.collect_set(F.struct("fstart", "n")).alias("spans"))
    asked = materialize(asked.withColumnsRenamed({"fd": "d", "fh": "h"}), "asked")
    holders = once.join(small(asked.select("d", "h")), ["d", "h"], "left_semi").join(asked, ["d", "h"])
    known = holders.mapInArrow(_read_passages, "fd long, fh long, fstart int, n int, phrase string").distinct()
    known = materialize(known, "phrases")
    wanted = passages.join(known, ["fd", "fh", "fstart", "n"])
    wanted = wanted.groupBy("d", "h").agg(F.collect_set(F.struct("phrase", "n", "fd", "fh", "fstart")).alias("phrases"))
    wanted = materialize(wanted, "wanted")

    out = "_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept string"
    holding = small(wanted.select("d", "h"))
    some = rows.join(holding, ["d", "h"], "left_semi").join(wanted, ["d", "h"]).select("_id", "d", "h", "_text", "phrases")
    none = F.lit(None).cast(some.schema["phrases"].dataType)
    rest = rows.join(holding, ["d", "h"], "left_anti").select("_id", "d", "h", "_text", none.alias("phrases"))
    found = some.mapInArrow(_remove, out).unionByName(rest.mapInArrow(_remove, out))
    return found.withColumnRenamed("_id", id_col)
