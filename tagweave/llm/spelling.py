"""Spelling variant grouping with asymmetric q-chunks.

Of two words with one edit between them, the longer one (of equal ones, the smaller) contributes
two disjoint chunks, its first and its last half, and the other one its grams by position. One
edit preserves one of the chunks, at the same place or, where a letter before it went, one place
earlier. So words are joined on equal chunks and grams within a shift of one, and then verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import materialize

LETTERS = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIECE = 1 << 20  # code points of a text whose words are listed at a time
MIN_LENGTH = 6  # code points of a word
MIN_COUNT = 5  # occurrences of a word
DOMINANCE = 5  # how many times more often a form occurs than its variant
BLOCK_WORDS = 2048  # words with one chunk that meet the grams in one task
HOT_KEYS_BYTES = 32 << 20
# A form occurs DOMINANCE times as often, so a chain has at most log(2^63) / log(5) = 27 forms.
DOUBLINGS = 5
MASK_BITS = 64


def lower_ascii(word: Column) -> Column:
    """A-Z lower-cased; the built-in function would change other letters too."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def runs_of_letters(text: Column, piece: int = PIECE) -> Column:
    """Arrays of the letter runs of a text, by pieces that are cut behind the run at each border."""

    def border(i: Column) -> Column:
        at = i * piece
        return at + F.length(F.regexp_extract(F.substring(text, at + 1, F.length(text)), f"^(?:{LETTERS})?", 0))

    pieces = F.ceil(F.length(text) / F.lit(piece)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), F.greatest(pieces, F.lit(1)) - 1),
        lambda i: F.substring(text, F.when(i == 0, 0).otherwise(border(i)) + 1, F.when(i + 1 >= pieces, F.length(text)).otherwise(border(i + 1)) - F.when(i == 0, 0).otherwise(border(i))),
    )
    return F.when(F.length(text) <= piece, F.array(text)).otherwise(cut)


def occurrences(docs: DataFrame, id_col: str, text_col: str, slip: int | None = 199) -> DataFrame:
    """``word``: one row per letter run, A-Z lower-cased.

    With ``slip`` a run loses a code point where the crc32 of id and run is divisible by it, which
    plants a known share of misspellings. A null id counts as an empty one; null texts have no words.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    parts = rows.select("_id", F.explode(runs_of_letters(F.col("_text"))).alias("_part"))
    found = parts.select("_id", F.explode(F.regexp_extract_all("_part", F.lit(LETTERS), F.lit(0))).alias("_run"))
    words = found.select("_id", lower_ascii(F.col("_run")).alias("word"))
    if slip is None:
        return words.select("word")
    words = words.withColumn("_h", F.crc32(F.concat("_id", F.lit(":"), "word")))
    gone = F.pmod(F.col("_h"), F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), gone), F.substring("word", gone + 2, F.length("word")))
    return words.select(F.when(F.pmod("_h", F.lit(slip)) == 0, cut).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of the words that are long and frequent enough; short ones never meet the shuffle."""
    counted = words.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_count)


def _letter_mask(word: Column) -> Column:
    """One bit per letter, modulo 64: words with one edit differ in two bits at most."""
    letters = F.filter(F.split(word, ""), lambda c: c != "")
    return F.aggregate(letters, F.lit(0).cast("long"), lambda a, c: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.ascii(c), F.lit(MASK_BITS)).cast("int"))))


def _small(df: DataFrame) -> DataFrame:
    """A written table of ``(c, size, last, chunk, blocks)``, broadcast if its bytes are few."""
    size = df.agg(F.coalesce(F.sum(F.octet_length("chunk") + 48), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= HOT_KEYS_BYTES else df


def near_pairs(words: DataFrame) -> DataFrame:
    """``(x, nx, y, ny)``: each pair of words ``(word, n)`` with exactly one edit between them, once.

    ``x`` is the longer word, or the smaller one of equal length. Words of fewer than two code
    points are not compared.
    """
    rows = words.where(F.length("word") >= 2).select("word", "n", F.length("word").alias("size"), _letter_mask(F.col("word")).alias("mask"))
    rows = materialize(rows, "vocabulary")
    half = lambda size: (size / 2).cast("int")

    # Chunk side: a word of c code points asks for words of c and of c - 1.
    c = F.col("size")
    sides = F.array(
        F.struct(F.lit(False).alias("last"), F.substring("word", F.lit(1), half(c)).alias("chunk")),
        F.struct(F.lit(True).alias("last"), F.substring("word", c - half(c) + 1, half(c)).alias("chunk")),
    )
    chunks = rows.withColumn("sides", sides).select("word", "n", "mask", c.alias("c"), "sides", F.explode(F.array(c, c - 1)).alias("size"))
    chunks = chunks.select("word", "n", "mask", "c", "size", F.inline("sides"))

    # Gram side: of its positional grams of that length only those within the shift can meet a
    # chunk: the one at the front, and the one as far from the end as the last chunk is.
    grams = rows.select(F.col("word").alias("gword"), F.col("n").alias("gn"), F.col("mask").alias("gmask"), "size", F.explode(F.array(c, c + 1)).alias("c"))
    q = half(F.col("c"))
    sides = F.array(
        F.struct(F.lit(False).alias("last"), F.substring("gword", F.lit(1), q).alias("chunk")),
        F.struct(F.lit(True).alias("last"), F.substring("gword", F.col("size") - q + 1, q).alias("chunk")),
    )
    grams = grams.select("gword", "gn", "gmask", "c", "size", sides.alias("sides"))
    grams = grams.select("gword", "gn", "gmask", "c", "size", F.inline("sides"))

    key = ["c", "size", "last", "chunk"]
    # A chunk with many words is met in blocks of its words, each by all of its grams.
    hot = chunks.groupBy(*key).agg(F.count("*").alias("k")).where(F.col("k") > BLOCK_WORDS)
    hot = _small(materialize(hot.select(*key, F.ceil(F.col("k") / BLOCK_WORDS).cast("int").alias("blocks")), "hot_chunks"))
    chunks = chunks.join(hot, key, "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64("word"), "blocks").cast("int"), F.lit(0))).drop("blocks")
    grams = grams.join(hot, key, "left").withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))).drop("blocks")

    met = chunks.join(grams, [*key, "block"])
    once = (F.col("c") != F.col("size")) | (F.col("word") < F.col("gword"))
    # Where both chunks are preserved, the pair belongs to the first one.
    first = ~F.col("last") | (F.substring("word", F.lit(1), half(F.col("c"))) != F.substring("gword", F.lit(1), half(F.col("c"))))
    alike = F.bit_count(F.col("mask").bitwiseXOR(F.col("gmask"))) <= 2
    met = met.where(once & alike & first & (F.levenshtein("word", "gword", 1) == 1))
    return met.select(F.col("word").alias("x"), F.col("n").alias("nx"), F.col("gword").alias("y"), F.col("gn").alias("ny"))


def forms(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each row of ``words (word, n)``.

    A word's form is its near word with the most occurrences, of equal ones the smallest, if it
    has ``dominance`` times as many as the word; ``root`` is the end of the chain of forms.
    """
    if dominance < 2:
        raise ValueError("a chain of forms ends only if each occurs more often than the one before")
    words = materialize(words, "words")
    pairs = materialize(near_pairs(words), "near_words")
    ways = pairs.select(F.col("x").alias("word"), F.struct((-F.col("ny")).alias("order"), F.col("y").alias("form")).alias("f"))
    ways = ways.unionByName(pairs.select(F.col("y").alias("word"), F.struct((-F.col("nx")).alias("order"), F.col("x").alias("form")).alias("f")))
    best = ways.groupBy("word").agg(F.count("*").alias("n_near"), F.min("f").alias("f"))
    rows = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("f.form").alias("form"), (-F.col("f.order")).alias("form_n"))
    has = F.col("form_n") >= dominance * F.col("n")
    rows = materialize(rows.select("word", "n", "n_near", F.when(has, F.col("form")).alias("form"), F.when(has, F.col("form_n")).alias("form_n")), "forms")

    # Each step doubles how far a word has followed its forms.
    steps = rows.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        steps = materialize(steps, "roots")
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = steps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    rows = rows.join(steps, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, id_col: str, text_col: str, slip: int | None = 199) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for the words of all texts.

    Words are runs of Latin letters with A-Z lower-cased, of 6 code points and 5 occurrences at
    least. Two words are near if one code point inserted, deleted or replaced makes one of the
    other. Null, empty and blank texts have no words, a text of any length is cut into pieces
    at word borders, rows that repeat count again, and an empty table gives no words. Other
    columns are dropped.
    """
    return forms(vocabulary(occurrences(docs, id_col, text_col, slip)))
