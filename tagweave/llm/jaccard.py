"""N-gram Jaccard join with adaptive multi-match prefixes.

A text is its set of word shingles, as 64-bit hashes, in one global order from rare to frequent.
Two sets with Jaccard >= t share at least l tokens of their prefixes of n - ceil(t n) + l tokens,
for any l. Each set picks its l by the estimated cost of its candidates: a longer prefix reads
more lists but asks for more shared tokens before a pair is verified. A pair uses the smaller l.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import by_size, materialize, ragged_take
from tagweave.llm.components import connected
from tagweave.llm.hashing import Words, mix, phrases, starts_of
from tagweave.llm.recurring import key_filter, key_of, passes, recurring_set

SHINGLE = 4
PERCENT = 85
LEVELS = 4  # the largest l
VERIFY_COST = 20.0  # cost of a verification in list entries
SKETCH_BITS = 20  # counters of the frequency sketch, 4 MB whatever the input
SKETCH_CHUNK = 1 << 14
BLOCK_ROWS = 1024  # sets of a side that are compared in one task
BLOCK_TOKENS = 1_000_000
CHUNK_BYTES = 256 << 10  # text that is hashed at a time
BUCKET_KEYS = 1_000_000  # prefix tokens that one task counts
PLACED = ["hub", "size_class", "i", "j", "asks", "rep", "n", "ell", "home"]
BROADCAST_ROWS = 200_000


def text_chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``CHUNK_BYTES`` of text, or one longer text."""
    sizes = pc.binary_length(texts.cast(pa.large_binary())).fill_null(0).to_pylist()
    yield from by_size(sizes, CHUNK_BYTES)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; the whole sequence if it has fewer words."""
    for a, b in text_chunks(texts):
        words = Words(texts.slice(a, b - a), lower=True)
        hashes = words.hashes()
        at, fits = starts_of(words.first, words.counts, size)
        all_ = phrases(hashes, size)[at] if len(at) else np.zeros(0, np.uint64)
        ends = np.cumsum(fits)
        for t, n in enumerate(words.counts.tolist()):
            if n >= size:
                yield np.unique(all_[ends[t] - fits[t] : ends[t]])
            elif n:
                # Mixed with the length, as the phrase of fewer words is another kind of token.
                own = hashes[words.first[t] : words.first[t + 1]]
                yield mix(phrases(own, n) + np.uint64(n))
            else:
                yield all_[:0]


def prefix_length(n: int, percent: int) -> int:
    """Tokens of the prefix for l = 1."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def frequency_sketch(rows: DataFrame, size: int) -> np.ndarray:
    """How often shingles of each hash bucket occur, over all texts; counters add up by chunk."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for tokens in shingle_sets(batch.column(1), size):
                np.add.at(total, _bucket(tokens), 1)
        parts = [(i, total[i : i + SKETCH_CHUNK]) for i in range(0, len(total), SKETCH_CHUNK)]
        parts = [(i, c) for i, c in parts if c.any()]
        yield pa.RecordBatch.from_pydict({"at": pa.array([i for i, _ in parts], pa.int32()), "c": pa.array([c.astype(np.int64).tobytes() for _, c in parts], pa.binary())})

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(SKETCH_CHUNK, np.int64)
        for c in group.column("c").to_pylist():
            total += np.frombuffer(c, np.int64)
        # Only the order matters, so a counter that is too large for 32 bits may stop there.
        body = np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()
        return pa.table({"at": group.column("at").slice(0, 1), "c": pa.array([body], pa.binary())})

    parts = rows.mapInArrow(count, "at int, c binary").groupBy("at").applyInArrow(add, "at int, c binary").collect()
    out = np.zeros(1 << SKETCH_BITS, np.uint32)
    for r in parts:
        out[r["at"] : r["at"] + SKETCH_CHUNK] = np.frombuffer(r["c"], np.uint32)
    return out


def in_order(tokens: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Tokens from rare to frequent; equal counts by hash, so that the order is total."""
    return tokens[np.argsort(sketch[_bucket(tokens)], kind="stable")]


def small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def link(df: DataFrame, id_col: str, text_col: str, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(id_col, n_shingles, component, n_links)`` for each row of ``df``.

    Words are runs without white space, A-Z lower-cased. Two rows link when 100 * shared shingles
    >= ``percent`` * shingles of either; ``component`` is the least id reachable over links
    and ``n_links`` counts the other rows that a row links with. A
    text with fewer words than a shingle has its whole sequence as one; null, empty and blank
    texts have no shingle and link with nothing. Rows with equal sets are one class, compared
    once. A row with a null id keeps its number of shingles, has a null component and links
    nothing; rows that repeat an id are kept, and link what each of them links. Other columns are
    dropped. The join is whole: no list or group is cut, large ones are compared in blocks, and
    every pair of candidates is verified.
    """
    texts = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    context = df.sparkSession.sparkContext
    sketch = context.broadcast(frequency_sketch(texts, size))
    sets = materialize(_prefixes(texts, size, percent, sketch), "sets")

    full = sets.where("n > 0 and _id is not null")
    # A class is known by its digest: its least id may also be that of another class.
    reps = full.groupBy("rep").agg(F.min("_id").alias("first_id"), F.count("*").alias("m"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    reps = materialize(reps, "classes")
    found = _links(texts, reps, size, percent, sketch)
    counts = found.where("k is not null").groupBy("rep").agg(F.sum("k").alias("k"))
    counts = reps.join(counts, "rep", "left").select("rep", "first_id", (F.coalesce("k", F.lit(0)) + F.col("m") - 1).alias("n_links"))
    counts = materialize(counts, "link_counts")
    # Rows of a class link to its first row, whose id may itself repeat.
    own = full.join(counts, "rep").select(F.col("_id").alias("a"), F.col("first_id").alias("b")).where("a <> b")
    comps = connected(found.where("k is null").select("a", "b").unionByName(own))
    # A row without shingles or id has no class.
    linking = F.when((F.col("n") > 0) & F.col("_id").isNotNull(), F.col("rep"))
    rows = sets.select("_id", "n", linking.alias("rep")).join(counts.select(F.col("rep").alias("_rep"), "n_links"), F.col("rep") == F.col("_rep"), "left")
    rows = rows.join(comps.withColumnRenamed("node", "_node"), F.col("_id") == F.col("_node"), "left")
    # An id may repeat with an empty text beside others; the empty text itself links nothing.
    component = F.when(F.col("n") > 0, F.coalesce("component", "_id")).otherwise(F.col("_id"))
    n_links = F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    return rows.select(F.col("_id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), component.alias("component"), n_links)


def representatives(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group of linked rows, with all its columns.

    The row with the least id stays, as does every row with a null id. Rows that repeat an id
    and its text count as one; of an id with different texts each text stays.
    """
    found = materialize(link(docs, id_col, text_col, size, percent).where(F.col(id_col).isNotNull()), "near_duplicates")
    gone = found.where(F.col("component") < F.col(id_col)).select(F.col(id_col).alias("_gone")).distinct()
    again = found.groupBy(id_col).agg(F.count("*").alias("k")).where("k > 1").select(F.col(id_col).alias("_again"))
    again = materialize(again, "repeated_ids")
    ids = docs[id_col].cast("long")
    kept = docs.join(small(materialize(gone, "removed_ids")), ids == F.col("_gone"), "left_anti")
    if again.isEmpty():
        return kept
    once = kept.join(small(again), ids == F.col("_again"), "left_anti")
    return once.unionByName(kept.join(small(again), ids == F.col("_again"), "left_semi").dropDuplicates([id_col, text_col]))


def class_of(tokens: np.ndarray) -> int:
    """Number of the class of equal sets: 64 bits of a digest, as the shingles are."""
    return int.from_bytes(blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _prefixes(texts: DataFrame, size: int, percent: int, sketch) -> DataFrame:
    """``(_id, n, rep, prefix)``: the class and the prefix of the largest l, in the global order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, rep, prefix = [], [], []
            for tokens in shingle_sets(batch.column(1), size):
                n.append(len(tokens))
                rep.append(class_of(tokens))
                prefix.append(in_order(tokens, sketch.value)[: prefix_length(len(tokens), percent) + LEVELS - 1].view(np.int64))
            lens = np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *prefix])
            columns = [batch.column(0), pa.array(n, pa.int32()), pa.array(rep, pa.int64()), pa.ListArray.from_arrays(pa.array(lens), pa.array(flat))]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "n", "rep", "prefix"])

    return texts.mapInArrow(run, "_id long, n int, rep long, prefix array<long>")


def _links(texts: DataFrame, reps: DataFrame, size: int, percent: int, sketch) -> DataFrame:
    """Rows ``(rep, k)``: rows of other classes that a class links with, in one group; and rows
    ``(a, b)`` of first ids: edges that connect what the links between classes connect."""
    lists = materialize(_recurring_tokens(reps), "tokens")
    df = materialize(lists.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "lists")
    base = F.col("n") - F.ceil(F.col("n") * F.lit(percent) / 100) + 1
    level = F.greatest(F.lit(1), F.col("pos") - base + 2).cast("int").alias("level")
    shared = materialize(lists.join(small(df), "token").select("token", "rep", "n", level, "df"), "shared")

    # Cost of l: entries of its lists, and at most entries / l candidates to verify.
    reads = [F.sum(F.when(F.col("level") <= k, F.col("df") - 1).otherwise(F.lit(0))) for k in range(1, LEVELS + 1)]
    most = F.ceil(F.first("n") * F.lit(percent) / 100)
    costs = [F.when(most >= k, r * (1 + VERIFY_COST / k)) for k, r in enumerate(reads, 1)]
    ell = F.lit(LEVELS)
    least = F.least(*costs)
    for k in range(LEVELS - 1, 0, -1):
        ell = F.when(costs[k - 1] == least, F.lit(k)).otherwise(ell)
    chosen = materialize(shared.groupBy("rep").agg(ell.cast("int").alias("ell")), "levels")
    used = shared.join(small(chosen), "rep").where("level <= ell")

    # Sets of linked sizes fall into the same or neighbouring size classes; each enters its own
    # and, as a guest, the next one. Every pair that can link meets where one of them is at home.
    step = math.log(100 / percent)
    own = F.floor(F.log(F.col("n").cast("double")) / step + 1e-9).cast("int")
    used = used.select("token", "rep", "n", "ell", F.posexplode(F.array(own, own + 1)).alias("guest", "size_class"))
    used = materialize(used.select("token", "rep", "n", "ell", "size_class", (F.col("guest") == 0).alias("home")), "used")
    # Lists with the same least member are compared together.
    hubs = used.groupBy("token", "size_class").agg(F.min("rep").alias("hub"), F.count("*").alias("k"), F.bool_or("home").alias("home"))
    hubs = hubs.where("k > 1 and home").drop("k", "home")
    hubs = materialize(hubs, "hubs")
    members = used.join(hubs, ["token", "size_class"]).select("hub", "size_class", "rep", "n", "ell", "home").distinct()
    members = materialize(members, "members")

    sizes = members.groupBy("hub", "size_class").agg(F.count("*").alias("rows"), F.sum("n").alias("tokens"))
    blocks = F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("int")
    sizes = materialize(sizes.select("hub", "size_class", blocks.alias("blocks")), "sizes")
    members = materialize(members.join(sizes, ["hub", "size_class"]), "placed")

    # Every block of a group meets itself and every later one: the earlier block asks.
    block = F.pmod(F.xxhash64("rep"), "blocks").cast("int")
    asks = members.select("*", block.alias("i"), F.explode(F.sequence(block, F.col("blocks") - 1)).alias("j"), F.lit(True).alias("asks"))
    told = members.select("*", F.explode(F.sequence(F.lit(0), block)).alias("i"), block.alias("j"), F.lit(False).alias("asks"))
    placed = asks.select(*PLACED).unionByName(told.select(*PLACED))
    # Prefixes tell which sets of a group are candidates; only those are read whole.
    kept = materialize(_with_candidates(placed, reps.select("rep", "prefix"), percent), "candidates")
    # Candidates may meet in several groups, and are counted in the least of them.
    meets = kept.select("rep", _group().alias("g"), "home").distinct().groupBy("rep").agg(
        F.collect_list("g").alias("meets"), F.collect_list(F.when(~F.col("home"), F.col("g"))).alias("visits")
    )
    facts = materialize(reps.select("rep", "first_id", "m").join(meets, "rep"), "facts")
    bodies = _bodies(texts, facts.select("first_id").distinct(), size, sketch)
    return materialize(_compare(kept.join(facts, "rep"), bodies, percent), "links")


def _group() -> Column:
    return F.xxhash64("hub", "size_class")


def _recurring_tokens(reps: DataFrame) -> DataFrame:
    """``(token, rep, n, pos)`` of the prefix tokens that another set has too, and a few others."""

    def extract(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        tokens = batch.column("prefix").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        yield key_of(tokens), np.zeros(len(tokens), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lens = pc.list_value_length(batch.column("prefix")).to_numpy(zero_copy_only=False)
            tokens = batch.column("prefix").flatten().to_numpy(zero_copy_only=False)
            pos = np.arange(len(tokens)) - np.repeat(np.cumsum(lens) - lens, lens)
            some = passes(shared.value, key_of(tokens.view(np.uint64)))
            row = np.repeat(np.arange(len(lens)), lens)[some]
            columns = [pa.array(tokens[some]), pa.array(batch.column("rep").to_numpy()[row]), pa.array(batch.column("n").to_numpy()[row]), pa.array(pos[some].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["token", "rep", "n", "pos"])

    total = reps.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0]
    keys = recurring_set(reps.select("prefix"), extract, total // BUCKET_KEYS + 1, across=False)
    shared = reps.sparkSession.sparkContext.broadcast(key_filter(keys))
    return reps.select("rep", "n", "prefix").mapInArrow(run, "token long, rep long, n int, pos int")


def _bodies(texts: DataFrame, ids: DataFrame, size: int, sketch) -> DataFrame:
    """``(rep, body)``: whole sets, in the global order, of the texts with one of ``ids (first_id)``."""
    wanted = small(materialize(ids.select(F.col("first_id").alias("_id")), "wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, bodies = [], []
            for tokens in shingle_sets(batch.column(1), size):
                reps.append(class_of(tokens))
                bodies.append(in_order(tokens, sketch.value).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(bodies, pa.binary())], names=["rep", "body"])

    # An id that repeats stands for each of its texts, so that a class may come more than once.
    return texts.join(wanted, "_id", "left_semi").mapInArrow(run, "rep long, body binary").where("length(body) > 0")


def _with_candidates(placed: DataFrame, prefixes: DataFrame, percent: int) -> DataFrame:
    """The rows of ``placed`` that have a candidate in their group."""

    def run(group: pa.Table) -> pa.Table:
        prefix = [np.asarray(x, np.int64).view(np.uint64) for x in group.column("prefix").to_pylist()]
        ask = group.column("asks").to_numpy(zero_copy_only=False)
        home = group.column("home").to_numpy(zero_copy_only=False)
        kept = candidate_rows(prefix, group.column("rep").to_numpy(), group.column("n").to_numpy(), group.column("ell").to_numpy(), ask, percent, home)
        return group.select(PLACED).filter(pa.array(kept))

    kinds = {"hub": "long", "rep": "long", "asks": "boolean", "home": "boolean"}
    ddl = ", ".join(f"{c} {kinds.get(c, 'int')}" for c in PLACED)
    return placed.join(prefixes, "rep").groupBy("hub", "size_class", "i", "j").applyInArrow(run, ddl)


def _compare(placed: DataFrame, bodies: DataFrame, percent: int) -> DataFrame:
    def run(group: pa.Table) -> pa.Table:
        # A class may come with several equal bodies.
        rep, asks = group.column("rep").to_numpy(), group.column("asks").to_numpy(zero_copy_only=False)
        once = np.unique(np.rec.fromarrays([rep, asks]), return_index=True)[1]
        group, rep, asks = group.take(pa.array(once)), rep[once], asks[once]
        here = group.column("g")[0].as_py()
        earlier, visited = ([np.asarray([g for g in gs if g < here], np.int64) for gs in group.column(c).to_pylist()] for c in ("meets", "visits"))
        home = group.column("home").to_numpy(zero_copy_only=False)
        first, m = group.column("first_id").to_numpy(), group.column("m").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in group.column("body").to_pylist()]
        a, b, k = count_links(sets, group.column("ell").to_numpy(), asks, percent, rep, m, (earlier, visited), home)
        some = np.flatnonzero(k)
        none = lambda n: pa.nulls(n, pa.int64())
        edges, counts = (none(len(a)), pa.array(first[a]), pa.array(first[b]), none(len(a))), (pa.array(rep[some]), none(len(some)), none(len(some)), pa.array(k[some]))
        return pa.table({c: pa.concat_arrays([x, y]) for c, x, y in zip(("rep", "a", "b", "k"), edges, counts)})

    rows = placed.withColumn("g", _group()).join(bodies, "rep")
    return rows.groupBy("hub", "size_class", "i", "j").applyInArrow(run, "rep long, a long, b long, k long")


class Overlaps:
    """Numbers of shared tokens between one of some token lists and many others."""

    def __init__(self, lists: list[np.ndarray]):
        self.n = np.array([len(x) for x in lists])
        _, self.flat = np.unique(np.concatenate(lists), return_inverse=True)
        self.starts = np.cumsum(self.n) - self.n
        self.flags = np.zeros(self.flat.max() + 1, bool)

    def of(self, x: int, x_len: int, others: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Tokens among the first ``x_len`` of list ``x`` and the first ``lens`` of the others."""
        mine = self.flat[self.starts[x] : self.starts[x] + x_len]
        self.flags[mine] = True
        hit = self.flags[ragged_take(self.flat, self.starts[others], lens)]
        self.flags[mine] = False
        return np.add.reduceat(hit.astype(np.int64), np.cumsum(lens) - lens)


def _candidates(overlaps: Overlaps, x: int, others: np.ndarray, n: np.ndarray, ell: np.ndarray, percent: int) -> np.ndarray:
    """Those of ``others`` that share as many prefix tokens with ``x`` as the smaller l asks for."""
    others = others[100 * np.minimum(n[x], n[others]) >= percent * np.maximum(n[x], n[others])]
    if not len(others):
        return others
    most = -(-percent * n // 100)
    base = n - most
    least = np.minimum(ell[x], ell[others])
    found = []
    for k in np.unique(least).tolist():
        some = others[least == k]
        asked = np.minimum(np.minimum(k, most[x]), most[some])
        shared = overlaps.of(x, base[x] + min(k, most[x]), some, base[some] + np.minimum(k, most[some]))
        found.append(some[shared >= asked])
    return np.concatenate(found)


def candidate_rows(
    prefixes: list[np.ndarray], rep: np.ndarray, n: np.ndarray, ell: np.ndarray, asks: np.ndarray, percent: int, home: np.ndarray
) -> np.ndarray:
    """Which sets are candidates of another one; a set that asks and is told is not its own.

    Two guests are not compared: both are at home in one other size class.
    """
    overlaps, n = Overlaps(prefixes), n.astype(np.int64)
    told, kept = np.flatnonzero(~asks), np.zeros(len(n), bool)
    for x in np.flatnonzero(asks).tolist():
        found = _candidates(overlaps, x, told[(rep[told] != rep[x]) & (home[told] | home[x])], n, ell, percent)
        kept[found] = True
        kept[x] = len(found) > 0
    return kept


def _common(lists: Overlaps, x: int, others: np.ndarray) -> np.ndarray:
    """How many entries list ``x`` has in common with each other list; any may be empty."""
    out = np.zeros(len(others), np.int64)
    at = np.flatnonzero(lists.n[others])
    if lists.n[x] and len(at):
        out[at] = lists.of(x, lists.n[x], others[at], lists.n[others[at]])
    return out


def compare_sets(bodies: list[np.ndarray], ell: np.ndarray, asks: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links found between sets that ask and sets that are told, less those that close a cycle."""
    return count_links(bodies, ell, asks, percent)[:2]


def count_links(
    bodies: list[np.ndarray], ell: np.ndarray, asks: np.ndarray, percent: int,
    rep: np.ndarray | None = None, m: np.ndarray | None = None,
    earlier: tuple[list[np.ndarray], list[np.ndarray]] | None = None, home: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between sets that ask and sets that are told: edges without cycles, and per set the
    ``m`` of those it links with.

    Where classes ``rep`` ask and are told, a pair is compared once, and two guests are not.
    ``earlier`` lists the groups of each set that come before this one, and those of them where
    it is a guest: a pair with a common group of which one is at home has been counted there.
    """
    overlaps = Overlaps(bodies)
    n = overlaps.n
    rep = np.arange(len(n)) if rep is None else rep
    m = np.ones(len(n), np.int64) if m is None else m
    home = np.ones(len(n), bool) if home is None else home
    groups, guests = (Overlaps(lists) if any(map(len, lists)) else None for lists in earlier or ([], []))
    # Both rows of a class that asks and is told have one label.
    label = np.unique(rep, return_inverse=True)[1]
    counts = np.zeros(len(n), np.int64)
    edges: list[tuple[int, int]] = []
    told = np.flatnonzero(~asks)
    both = np.isin(rep, rep[asks]) & np.isin(rep, rep[told])
    for x in np.flatnonzero(asks).tolist():
        others = told[(rep[told] != rep[x]) & (home[told] | home[x]) & ~(both[x] & both[told] & (rep[told] < rep[x]))]
        some = _candidates(overlaps, x, others, n, ell, percent)
        if not len(some):
            continue
        shared = overlaps.of(x, n[x], some, n[some])
        some = some[100 * shared >= percent * (n[x] + n[some] - shared)]
        new = np.ones(len(some), bool)
        if groups is not None:
            new = _common(groups, x, some) == (_common(guests, x, some) if guests else 0)
        counts[x] += m[some[new]].sum()
        counts[some[new]] += m[x]
        for y in some[label[some] != label[x]].tolist():
            if label[y] != label[x]:
                edges.append((x, y))
                label[label == label[y]] = label[x]
    return np.array([x for x, _ in edges], int), np.array([y for _, y in edges], int), counts
