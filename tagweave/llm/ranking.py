"""Ranked lexical search over a length-stratified index.

Documents with one normaliser m form a stratum, cut into blocks of bounded size. A block keeps,
for each term, its documents by term frequency. All documents of such a list score the same for
the term, so an impact is computed once per term, stratum and frequency. The largest impacts of a
stratum bound the score of all its documents: a query visits strata from the highest bound down
until it has enough documents, and after that only strata whose bound reaches the score it has.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagweave.llm.common import materialize, ragged_take

BATCH_POSTINGS = 50_000  # postings that a task makes rows of at a time
BLOCK_POSTINGS = 100_000  # postings of a block of a stratum; a longer document is a block of its own
CHUNK_BYTES = 1 << 20  # text that is cut into terms at a time
QUERY_TERMS = 50_000  # (item, term) pairs that are searched for in one pass over the index
SEED_FACTOR = 4  # documents a query first visits, as a multiple of k
BROADCAST_BYTES = 32 << 20
NO_ID = -(2**63)  # stands for a null id, which comes before all others

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_FOLDED = bytes(32 if b in _SEPARATORS else b for b in range(256))
# The table makes separators spaces and A-Z lower case; A-Z are between the separators above.
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else _FOLDED[b] for b in range(256))


def terms_of(text: bytes, chunk: int = CHUNK_BYTES) -> Counter:
    """How often each term occurs in a UTF-8 text, which is cut at separators."""
    counts: Counter = Counter()
    data = text.translate(_FOLDED)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + chunk)
        end = len(data) if end < 0 else end
        counts.update(data[at:end].split(b" "))
        at = end
    counts.pop(b"", None)
    return counts


def term_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(d, n, terms, tf)``: terms of each row in byte order, and how often each occurs; ``n`` is their sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, rows, size = 0, [], 0
            texts = batch.column("_text").cast(pa.large_binary())
            for i in range(batch.num_rows):
                value = texts[i]
                counts = terms_of(value.as_buffer().to_pybytes()) if value.is_valid else Counter()
                rows.append(counts)
                size += len(counts)
                if size > BATCH_POSTINGS or i + 1 == batch.num_rows:
                    yield _count_rows(batch.column("d").slice(start, len(rows)), rows)
                    start, rows, size = i + 1, [], 0

    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("d"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, "d long, n long, terms array<string>, tf array<int>")


def _count_rows(ids: pa.Array, rows: list[Counter]) -> pa.RecordBatch:
    listed = [sorted(c.items()) for c in rows]
    offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in listed])]), pa.int32())
    terms = pa.array([t for x in listed for t, _ in x], pa.binary()).cast(pa.string())
    tf = pa.array([k for x in listed for _, k in x], pa.int32())
    n = pa.array([sum(c.values()) for c in rows], pa.int64())
    lists = [pa.ListArray.from_arrays(offsets, terms), pa.ListArray.from_arrays(offsets, tf)]
    return pa.RecordBatch.from_arrays([ids, n, *lists], names=["d", "n", "terms", "tf"])


@dataclass(frozen=True)
class Index:
    """``blocks (m, block, ids, terms, n_lists, tf, sizes, members)`` and the corpus totals.

    ``n_lists`` gives the lists of each term, ``tf`` and ``sizes`` the frequency and length of each
    list, and ``members`` the places in ``ids`` of its documents.
    """

    blocks: DataFrame
    n_docs: int
    n_terms: int


INDEX_SCHEMA = "m long, block int, ids array<long>, terms array<string>, n_lists array<int>, tf array<int>, sizes array<int>, members array<int>"


def build_index(docs: DataFrame, id_col: str, text_col: str) -> Index:
    """The stored index of all rows with a term.

    Terms are runs of letters, digits and characters above ASCII, with A-Z lower-cased. Null,
    empty and blank texts have none and are not counted; a text of any length is cut into terms
    a chunk at a time. Each row is a document, also where ids repeat; a null id is kept and comes
    before all others. Other columns are dropped. An empty table gives an empty index.
    """
    counts = materialize(term_counts(docs, id_col, text_col).where("n > 0"), "term_counts")
    n_docs, n_terms = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    m = F.expr(f"10 + (90 * n * {n_docs}L) div {max(n_terms, 1)}L")
    rows = counts.withColumn("m", m)
    # A stratum that holds many postings is dealt to blocks; there are as many strata as lengths.
    sizes = rows.groupBy("m").agg(F.sum(F.size("terms").cast("long")).alias("postings"))
    sizes = sizes.select("m", (F.expr(f"postings div {BLOCK_POSTINGS}") + 1).cast("int").alias("blocks")).where("blocks > 1")
    rows = rows.join(bounded_broadcast(materialize(sizes, "strata")), "m", "left")
    block = F.coalesce(F.pmod(F.xxhash64("d"), "blocks"), F.lit(0)).cast("int")
    rows = rows.select("m", block.alias("block"), "d", "terms", "tf")
    return Index(materialize(rows.groupBy("m", "block").applyInArrow(_block_of, INDEX_SCHEMA), "index"), n_docs, n_terms)


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if its estimated size is below ``BROADCAST_BYTES``."""
    rows = df.count()
    width = sum(24 if f.dataType.simpleString() == "string" else 8 for f in df.schema.fields) + 16
    return F.broadcast(df) if rows * width <= BROADCAST_BYTES else df


def _block_of(group: pa.Table) -> pa.Table:
    """One stratum block: its documents by id, and per term the documents of each frequency."""
    group = group.sort_by("d").combine_chunks()
    lens = pc.list_value_length(group.column("terms").chunk(0)).to_numpy()
    terms = pc.dictionary_encode(group.column("terms").chunk(0).flatten())
    order_of = pc.array_sort_indices(terms.dictionary).to_numpy()
    rank = np.empty(len(order_of), np.int64)
    rank[order_of] = np.arange(len(order_of))
    term = rank[terms.indices.to_numpy()]
    tf = group.column("tf").chunk(0).flatten().to_numpy()
    member = np.repeat(np.arange(len(lens)), lens)
    order = np.lexsort((member, tf, term))
    term, tf, member = term[order], tf[order], member[order]
    first = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])]))
    columns = {
        "m": group.column("m").slice(0, 1),
        "block": group.column("block").slice(0, 1),
        "ids": _one_list(group.column("d").chunk(0)),
        "terms": _one_list(terms.dictionary.take(pa.array(order_of))),
        "n_lists": _one_list(pa.array(np.bincount(term[first], minlength=len(order_of)).astype(np.int32))),
        "tf": _one_list(pa.array(tf[first].astype(np.int32))),
        "sizes": _one_list(pa.array(np.diff(np.append(first, len(term))).astype(np.int32))),
        "members": _one_list(pa.array(member.astype(np.int32))),
    }
    return pa.table(columns)


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


# --- search -----------------------------------------------------------------------------------


def query_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``(item, term)``, each once; rows that share an item id are one item with the terms of all."""
    rows = items.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["item"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("_text").cast(pa.large_binary())):
                terms = sorted(terms_of(text.as_py())) if text.is_valid else []
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item").take(pa.array([i] * len(terms), pa.int64())), pa.array(terms, pa.binary()).cast(pa.string())], names=["item", "term"]
                )

    return rows.mapInArrow(run, f"item {kind}, term string").distinct()


def search(index: Index, items: DataFrame, item_col: str, text_col: str, k: int = 10) -> DataFrame:
    """``(item_col, rank, doc, score)``: the ``k`` best documents of each item with a score above 0.

    A term's weight is floor(1000 ln((2N+2)/(2df+1))); a document's score sums, over the item's
    terms, weight * (10^9 tf div (1000 tf + 8 m)). Equal scores are ranked by ascending id, a null
    id first. Items without terms, or whose terms no document has, have no rows. Scores are exact:
    a stratum is left out only if its bound is below a score that ``k`` documents reach.

    Many items are searched for in passes of bounded size, each with its own broadcast.
    """
    asked = materialize(query_terms(items, item_col, text_col), "query_terms")
    passes = asked.count() // QUERY_TERMS + 1
    number = F.pmod(F.xxhash64("item"), F.lit(passes))
    found = [_search_pass(index, asked.where(number == p), k) for p in range(passes)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    doc = F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc")
    return out.select(F.col("item").alias(item_col), "rank", doc, "score")


def _search_pass(index: Index, asked: DataFrame, k: int) -> DataFrame:
    spark = asked.sparkSession
    rows = asked.collect()  # QUERY_TERMS of them, more only where one item has more
    items = list(dict.fromkeys(r["item"] for r in rows))
    terms = sorted({r["term"] for r in rows})
    number, place = {x: i for i, x in enumerate(items)}, {t: i for i, t in enumerate(terms)}
    pairs = sorted((number[r["item"]], place[r["term"]]) for r in rows)
    wanted = spark.sparkContext.broadcast(terms)

    stats = materialize(index.blocks.select("m", "terms", "n_lists", "tf", "sizes").mapInArrow(_list_stats(wanted), "m long, term int, tf int, docs long"), "posting_stats")
    df = stats.groupBy("term").agg(F.sum("docs").alias("df"))
    weight = F.floor(F.lit(1000) * F.log(F.lit(float(2 * index.n_docs + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weights = np.zeros(len(terms), np.int64)
    for r in df.select("term", weight.alias("w")).collect():  # one row per asked term
        weights[r["term"]] = r["w"]

    query = Query(np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int), weights, np.zeros(len(items), np.int64))
    if not pairs:
        query = Query(np.zeros(0, int), np.zeros(0, int), weights, np.zeros(0, np.int64))
    best = _visit(index.blocks, stats, query, wanted, items, k)
    kind = asked.schema["item"].dataType
    names = spark.createDataFrame([(i, x) for i, x in enumerate(items)], _pair_schema(kind))
    return best.join(bounded_broadcast(names), "q").select("item", "rank", "doc", "score")


def _pair_schema(kind):
    from pyspark.sql import types as T

    return T.StructType([T.StructField("q", T.IntegerType()), T.StructField("item", kind)])


def _list_stats(wanted):
    """``(m, term, tf, docs)`` for the asked terms of each block; no document is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.array(wanted.value, pa.string())
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch, i, asked)
                m = pa.array(np.full(len(block.term), block.m), pa.int64())
                columns = [m, pa.array(block.term.astype(np.int32)), pa.array(block.tf.astype(np.int32)), pa.array(block.sizes.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["m", "term", "tf", "docs"])

    return run


class Block:
    """The lists of a block that belong to asked terms: number of the term, frequency, length, start."""

    def __init__(self, batch: pa.RecordBatch, i: int, asked: pa.Array):
        self.m = batch.column("m")[i].as_py()
        here = pc.index_in(batch.column("terms")[i].values, value_set=asked)
        n_lists = batch.column("n_lists")[i].values.to_numpy()
        sizes = batch.column("sizes")[i].values.to_numpy().astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        known = np.repeat(here.fill_null(-1).to_numpy(), n_lists)
        some = np.flatnonzero(known >= 0)
        self.term, self.sizes, self.starts = known[some], sizes[some], starts[some]
        self.tf = batch.column("tf")[i].values.to_numpy().astype(np.int64)[some]


def impact(weight, tf, m):
    """What a term adds to the score of every document of a list, in 64-bit integers."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


@dataclass(frozen=True)
class Query:
    """Pairs of item and term by number, in order of items; the weights; the score each item has."""

    item: np.ndarray
    term: np.ndarray
    weights: np.ndarray
    floor: np.ndarray


def _visit(blocks: DataFrame, stats: DataFrame, query: Query, wanted, items: list, k: int) -> DataFrame:
    spark = blocks.sparkSession
    # Bounds: the largest impact of each term in a stratum, summed over the terms of an item.
    weights = spark.createDataFrame([(i, int(w)) for i, w in enumerate(query.weights)], "term int, w long")
    lists = stats.groupBy("m", "term").agg(F.max("tf").alias("tf"), F.sum("docs").alias("docs")).join(bounded_broadcast(weights), "term")
    largest = lists.select("m", "term", "docs", F.expr("w * ((1000000000L * tf) div (1000L * tf + 8 * m))").alias("most"))
    pairs = spark.createDataFrame(list(zip(query.item.tolist(), query.term.tolist())), "q int, term int")
    bounds = largest.join(bounded_broadcast(pairs), "term").groupBy("q", "m").agg(F.sum("most").alias("bound"), F.max("docs").alias("docs"))
    down = Window.partitionBy("q").orderBy(F.desc("bound"), "m")
    before = F.coalesce(F.sum("docs").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = bounds.withColumn("before", before).where((F.col("before") < SEED_FACTOR * k) & (F.col("bound") > 0)).select("q", "m")
    first = materialize(first, "first_strata")

    # The strata visited first tell the score that k documents of an item reach.
    by_stratum = first.groupBy("m").agg(F.collect_list("q").alias("visitors"))
    seeded = blocks.join(bounded_broadcast(by_stratum), "m")
    reached = _top(seeded.mapInArrow(_score(spark.sparkContext.broadcast(query), wanted, k, True), "q int, doc long, score long"), k)
    floor = query.floor.copy()
    for r in reached.where(F.col("rank") == k).select("q", "score").collect():  # one row per item
        floor[r["q"]] = r["score"]
    asked = Query(query.item, query.term, query.weights, floor)
    return _top(blocks.mapInArrow(_score(spark.sparkContext.broadcast(asked), wanted, k, False), "q int, doc long, score long"), k)


def _top(rows: DataFrame, k: int) -> DataFrame:
    rank: Column = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "doc"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


def _score(shared, wanted, k: int, seeds: bool):
    """``(q, doc, score)``: the ``k`` best documents of a block for each item that visits it.

    With ``seeds`` the block names its visitors, else those items visit it whose bound there
    reaches the score that they have.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, asked = shared.value, pa.array(wanted.value, pa.string())
        n_items = len(query.floor)
        opens = np.searchsorted(query.item, np.arange(n_items + 1))
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch, i, asked)
                if not len(block.term):
                    continue
                points = impact(query.weights[block.term], block.tf, block.m)
                # Lists of a term follow each other.
                first = np.flatnonzero(np.concatenate([[True], block.term[1:] != block.term[:-1]]))
                lists = np.diff(np.append(first, len(block.term)))
                most, slot = np.zeros(len(query.weights), np.int64), np.full(len(query.weights), -1)
                most[block.term[first]] = np.maximum.reduceat(points, first)
                slot[block.term[first]] = np.arange(len(first))
                if seeds:
                    visitors = np.unique(batch.column("visitors")[i].values.to_numpy())
                else:
                    bound = np.zeros(n_items, np.int64)
                    np.add.at(bound, query.item, most[query.term])
                    visitors = np.flatnonzero((bound >= query.floor) & (bound > 0))
                if len(visitors):
                    yield _best_of(batch, i, block, points, first, lists, slot, query, opens, visitors, k)

    return run


def _best_of(batch, i, block, points, first, lists, slot, query, opens, visitors, k) -> pa.RecordBatch:
    ids = batch.column("ids")[i].values.to_numpy()
    members = batch.column("members")[i].values.to_numpy()
    out = []
    for q in visitors.tolist():
        terms = slot[query.term[opens[q] : opens[q + 1]]]
        terms = terms[terms >= 0]
        at = ragged_take(np.arange(len(points)), first[terms], lists[terms])
        docs = ragged_take(members, block.starts[at], block.sizes[at])
        # Sums of integers below 2^53 are exact in doubles.
        score = np.bincount(docs, weights=np.repeat(points[at], block.sizes[at]).astype(np.float64), minlength=len(ids))
        least = max(float(query.floor[q]), 1.0)
        if len(score) > k:
            least = max(least, np.partition(score, len(score) - k)[len(score) - k])
        some = np.flatnonzero(score >= least)
        # Documents are in order of ids, so a stable sort ranks equal scores by id.
        some = some[np.argsort(-score[some], kind="stable")[:k]]
        out.append((np.full(len(some), q), ids[some], score[some]))
    q, doc, score = (np.concatenate(x) for x in zip(*out))
    return pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(doc), pa.array(score.astype(np.int64))], names=["q", "doc", "score"])
