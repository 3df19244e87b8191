"""Benchmark decontamination over a positional inverted index, with built-in functions alone.

The index stores postings of training tokens. A test window is looked up from its rarest terms:
their postings, shifted by the term's offset in the window, are intersected, and what is left is
confirmed on the words of the document as an exact phrase or a proximity match.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import materialize

WINDOW = 10
# Tables of test terms, windows or candidate documents are broadcast up to this many rows, which
# is some tens of MB; larger ones are shuffled.
BROADCAST_ROWS = 200_000

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KEY = ["_id", "_hash"]


def words_of(text: Column) -> Column:
    """Words in order: runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    # lower() also changes letters beyond A-Z, so it serves only texts that have none.
    ascii_only = F.octet_length(text) == F.length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.coalesce(F.array_remove(F.split(low, _SEPARATORS, -1), ""), F.array().cast("array<string>"))


def test_windows(bench: DataFrame, item_col: str, text_col: str, size: int = WINDOW) -> DataFrame:
    """Distinct ``(item, phrase, terms)``; an item of fewer words is one window, one of none has none."""
    items = bench.select(F.col(item_col).cast("string").alias("item"), words_of(F.col(text_col).cast("string")).alias("w"))
    n = F.size("w")
    starts = F.sequence(F.lit(0), F.greatest(n - size, F.lit(0)))
    rows = items.where((n > 0) & F.col("item").isNotNull())
    rows = rows.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, size))).alias("terms"))
    return rows.select("item", F.concat_ws(" ", "terms").alias("phrase"), "terms").distinct()


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast if its counted size allows it."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Index ``(term, _id, _hash, pos)`` of the given terms over ``docs (_id, _hash, _text)``."""
    tokens = docs.select(*_KEY, F.posexplode(words_of(F.col("_text"))).alias("pos", "word"))
    return tokens.join(small(terms), "word").select("term", *_KEY, "pos")


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(term, n)``: length of each term's postings; combined before the shuffle."""
    tokens = docs.select(F.explode(words_of(F.col("_text"))).alias("word"))
    return tokens.join(small(terms), "word").groupBy("term").agg(F.count("*").alias("n"))


def matches(
    docs: DataFrame, bench: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, size: int = WINDOW, slop: int = 1
) -> DataFrame:
    """``(_id, _hash, start, length, win, exact)`` and the windows ``(win, item, ...)`` they refer to.

    Exact matches are phrases. A proximity match has every term of the window within ``slop``
    words of the window's place; it starts where the rarest term puts it. The two rarest terms
    of a window must lie within ``slop`` of their offsets to be confirmed at all.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    rows = rows.withColumn("_hash", F.xxhash64("_text"))

    of_items = materialize(test_windows(bench, item_col, item_text_col, size), "windows")
    windows = of_items.select("phrase", "terms").distinct().withColumn("win", F.monotonically_increasing_id())
    windows = materialize(windows, "window_ids")
    vocabulary = windows.select(F.explode("terms").alias("word")).distinct().withColumn("term", F.monotonically_increasing_id())
    vocabulary = materialize(vocabulary, "test_terms")
    counts = materialize(term_counts(rows, vocabulary), "term_counts")

    # A window with a term that no document has cannot occur.
    placed = windows.select("win", F.posexplode("terms").alias("off", "word")).join(vocabulary, "word")
    placed = placed.join(counts, "term", "left").groupBy("win", "term").agg(F.min("off").alias("off"), F.max("n").alias("n"))
    ranked = F.array_sort(F.collect_list(F.struct("n", "off", "term")))
    lists = placed.groupBy("win").agg(F.count_if(F.col("n").isNull()).alias("missing"), ranked.alias("r"))
    lists = lists.where(F.col("missing") == 0).select("win", F.col("r")[0].alias("first"), F.get("r", F.lit(1)).alias("second"))
    lists = materialize(lists, "rarest_terms")

    used = lists.select(F.explode(F.array_compact(F.array("first.term", "second.term"))).alias("term")).distinct()
    index = materialize(postings(rows, vocabulary.join(used, "term")), "postings")

    # The rarest list gives the places, the second one is intersected at the shifted position.
    head = small(lists.select("win", F.col("first.term").alias("term"), F.col("first.off").alias("off"), F.col("second.term").alias("term2"), F.col("second.off").alias("off2")))
    start = (F.col("pos") - F.col("off")).alias("start")
    found = index.join(head, "term").select("win", "term2", "off2", *_KEY, start)
    alone = found.where("term2 is null").select("win", *_KEY, "start")
    shifts = F.explode(F.sequence(F.lit(-slop), F.lit(slop)))
    asked = found.where("term2 is not null").select("*", shifts.alias("_by")).withColumn("pos2", F.col("start") + F.col("off2") + F.col("_by"))
    other = index.select(F.col("term").alias("term2"), *[F.col(k).alias(f"{k}2") for k in _KEY], F.col("pos").alias("pos2")).distinct()
    same = (F.col("asked.term2") == F.col("other.term2")) & (F.col("asked.pos2") == F.col("other.pos2"))
    for k in _KEY:
        same = same & F.col(f"asked.{k}").eqNullSafe(F.col(f"other.{k}2"))
    both = asked.alias("asked").join(other.alias("other"), same, "left_semi").select("win", *_KEY, "start")
    candidates = materialize(alone.unionByName(both).distinct(), "candidates")

    places = candidates.groupBy(*_KEY).agg(F.collect_list(F.struct("win", "start")).alias("places"))
    places = small(materialize(places.select(F.col("_id").alias("_id2"), F.col("_hash").alias("_hash2"), "places"), "places"))
    texts = rows.join(places, F.col("_id").eqNullSafe(F.col("_id2")) & (F.xxhash64("_text") == F.col("_hash2")))
    texts = texts.select(*_KEY, words_of(F.col("_text")).alias("w"), F.explode("places").alias("p"))
    texts = texts.select(*_KEY, "w", F.col("p.win").alias("win"), F.col("p.start").alias("start")).join(small(windows), "win")
    length = F.size("terms")
    # slice() takes no start before the first word.
    here = F.when(F.col("start") >= 0, F.slice("w", F.greatest(F.col("start") + 1, F.lit(1)), length))
    near = F.slice("w", F.greatest(F.col("start") + 1 - slop, F.lit(1)), length + slop + F.least(F.col("start") + 1, F.lit(slop)))
    exact = F.coalesce(F.concat_ws(" ", here) == F.col("phrase"), F.lit(False))
    confirmed = texts.select(*_KEY, "start", length.alias("length"), "win", exact.alias("exact"), (F.size(F.array_except("terms", near)) == 0).alias("close"))
    confirmed = materialize(confirmed.where("exact or close").drop("close").distinct(), "matches")
    return confirmed, windows.join(of_items, "phrase").select("win", "item")


def contaminated(
    docs: DataFrame, bench: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, size: int = WINDOW, slop: int = 1
) -> DataFrame:
    """Per row of ``docs``: ``id_col, n_words, n_hit, n_items, items, n_near``.

    ``n_hit`` counts the words inside an exact occurrence of a window, ``items`` are the sorted
    ids, as strings, of the items with such a window; ``n_near`` counts proximity matches that
    are not exact. A null or empty text has no words; rows that repeat have equal results; a row
    with a null id is judged like any other; items with a null id or without words are ignored.
    Other columns are dropped.
    """
    found, items = matches(docs, bench, id_col, text_col, item_col, item_text_col, size, slop)
    exact = found.where("exact")
    spans = exact.groupBy(*_KEY).agg(F.collect_set(F.struct("start", "length")).alias("s"))
    covered = F.flatten(F.transform("s", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))
    hits = spans.select(*_KEY, F.size(F.array_distinct(covered)).cast("long").alias("n_hit"))
    named = exact.join(small(items), "win").groupBy(*_KEY).agg(F.sort_array(F.collect_set("item")).alias("items"))
    near = found.groupBy(*_KEY).agg(F.count_if(~F.col("exact")).alias("n_near"))

    def keyed(df: DataFrame, i: int) -> DataFrame:
        return df.select(F.col("_id").alias(f"_id{i}"), F.col("_hash").alias(f"_hash{i}"), *[c for c in df.columns if c not in _KEY])

    text = F.col(text_col).cast("string")
    separated = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_hash"), separated.cast("long").alias("n_words"))
    facts = keyed(near, 1)
    for i, part in ((2, hits), (3, named)):
        same = F.col("_id1").eqNullSafe(F.col(f"_id{i}")) & (F.col("_hash1") == F.col(f"_hash{i}"))
        facts = facts.join(keyed(part, i), same, "left")
    facts = small(materialize(facts.select("_id1", "_hash1", "n_near", "n_hit", "items"), "facts"))
    rows = rows.join(facts, F.col("_id").eqNullSafe(F.col("_id1")) & (F.col("_hash") == F.col("_hash1")), "left")
    none = F.array().cast("array<string>")
    return rows.select(
        F.col("_id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def clean(docs: DataFrame, bench: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without an exact occurrence of a window, with all their columns."""
    found, _ = matches(docs, bench, id_col, text_col, item_col, item_text_col, size, slop=0)
    hit = materialize(found.where("exact").select(F.col("_id").alias("_hit_id"), F.col("_hash").alias("_hit_hash")).distinct(), "contaminated")
    same = docs[id_col].eqNullSafe(F.col("_hit_id")) & (F.xxhash64(docs[text_col].cast("string")) == F.col("_hit_hash"))
    return docs.join(small(hit), same, "left_anti")
