"""Building the image-caption pair table: grouping, sampling, negatives and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave import fixed_values as fixed
from tagweave.functions.numbers import int_div, uniform
from tagweave.operators.skew import hash_block, running_sum, skew_join
from tagweave.session import materialize

# Caption numbers are unique per image, so a block holds at most this many of its captions.
CAPTIONS_PER_BLOCK = 1024

# Pool positions per block of the look-up by position.
POSITIONS_PER_BLOCK = 65_536

# The histogram of a sample is broadcast, so it has to stay small.
SAMPLE_BLOCKS = 16_384

PAIR_COLUMNS = ["image_id", "image_path", "text_positive", "text_negative", "category", "split"]
REQUIRED = [c for c in PAIR_COLUMNS if c != "text_negative"]


def captions_by_image(captions: DataFrame) -> DataFrame:
    """Each image's captions in source order: ``(image_id, position, caption, n_captions)``.

    The list is kept as numbered rows, since an array would have to fit one row of one task.
    """
    block = int_div("cap_no", CAPTIONS_PER_BLOCK)
    ranked = running_sum(captions, ["image_id"], block, [F.col("cap_no")], "position", total="n_captions")
    return ranked.select("image_id", "position", "caption", "n_captions")


def caption_totals(captions: DataFrame) -> DataFrame:
    per_image = captions.groupBy("image_id").agg(F.count("*").alias("n"))
    return per_image.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_captions"), F.count("*").alias("n_images")
    )


def eligible_images(captions: DataFrame, at_least: int = fixed.MIN_CAPTIONS) -> DataFrame:
    counts = captions.groupBy("image_id").agg(F.count("*").alias("n_captions"))
    return counts.where(F.col("n_captions") >= at_least)


def sample_images(images: DataFrame, n: int, seed: int = fixed.SEED) -> DataFrame:
    """Exactly ``min(n, available)`` images, uniformly and without replacement.

    The n lowest keyed draws win. Whole hash blocks are taken or left by a histogram of at
    most ``SAMPLE_BLOCKS`` rows, so only the one block on the border is sorted.
    """
    u = uniform(seed, "image_id")
    drawn = images.withColumn("_u", u).withColumn("_block", hash_block(F.col("_u"), SAMPLE_BLOCKS))
    upto = F.sum("_n").over(Window.orderBy("_block"))
    blocks = drawn.groupBy("_block").agg(F.count("*").alias("_n"))
    blocks = blocks.select("_block", (upto - F.col("_n")).alias("_before"), upto.alias("_upto"))
    blocks = blocks.where(F.col("_before") < n)
    drawn = drawn.join(F.broadcast(blocks), "_block")
    inside = drawn.where(F.col("_upto") <= n)
    border = drawn.where(F.col("_upto") > n)
    rank = F.row_number().over(Window.partitionBy("_block").orderBy("_u", "image_id"))
    border = border.withColumn("_rank", rank).where(F.col("_rank") + F.col("_before") <= n)
    return inside.unionByName(border.drop("_rank")).select(*images.columns)


def image_paths(ids: DataFrame, images: DataFrame, root: str) -> DataFrame:
    """Add the file path by the image list; one row per image on both sides.

    Neither side is broadcast by hint, as both grow with the data.
    """
    path = F.concat_ws("/", F.lit(root), F.col("file_name")).alias("image_path")
    return ids.join(images.select(F.col("id").alias("image_id"), path), "image_id")


def captions_of_loaded(captions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Captions of the images that loaded; an image with very many captions is salted.

    ``outcomes`` has one row per image. If it has ``n_captions``, the hot images are known without another pass.
    """
    loaded = outcomes.where("ok")
    counts = None
    if "n_captions" in loaded.columns:
        counts = loaded.select("image_id", F.col("n_captions").alias("n_rows"))
    ids = loaded.select("image_id")
    joined = skew_join(captions, ids, ["image_id"], counts=counts, spread_by=["image_id", "cap_no"])
    return joined.select(*captions.columns)


def sample_negatives(captions: DataFrame, seed: int = fixed.SEED) -> DataFrame:
    """One caption per image, drawn uniformly from all captions but those with an own text.

    Captions are excluded by text, and the pool keeps copies. Put the pool in digest order, so
    that copies of a text are one interval ``[start, start + copies)``. If ``a`` positions are
    left after taking out the image's own intervals, draw ``r`` below ``a``; the position in
    the whole pool is ``r`` plus the length of every own interval that begins at or before it.
    There are no rejected draws and no image meets the pool row by row. Null where nothing is left.
    A null caption is no text and not in the pool.

    Texts are read twice, to hash them and to give the chosen ones back; the tables in between
    are narrow and are written, since each is used more than once.
    """
    digest = F.sha2("caption", 256).alias("digest")
    captions = captions.where("caption IS NOT NULL")
    own = captions.groupBy("image_id", digest).agg(F.count("*").alias("n"))
    own = materialize(own, "own_texts")
    first_bits = F.conv(F.substring("digest", 1, 3), 16, 10).cast("long")
    order = [F.col("digest")]

    texts = own.groupBy("digest").agg(F.sum("n").alias("copies"), F.count("*").alias("n_images"))
    texts = running_sum(texts, [], first_bits, order, "start", weight=F.col("copies"), total="pool")
    texts = materialize(texts, "text_intervals")

    images_per_text = texts.select("digest", F.col("n_images").alias("n_rows"))
    placed = skew_join(
        own.select("image_id", "digest"), texts.drop("n_images"), ["digest"], counts=images_per_text
    )
    placed = materialize(placed, "own_intervals")
    placed = running_sum(
        placed, ["image_id"], first_bits, order, "own_before", weight=F.col("copies"), total="own"
    )
    left = F.col("pool") - F.col("own")
    draw = F.floor(uniform(seed, F.lit("negative"), F.col("image_id")) * left).cast("long")
    # ``gap``: pool positions before the interval that are not the image's own.
    placed = placed.withColumn("draw", draw).withColumn("gap", F.col("start") - F.col("own_before"))
    skipped = F.coalesce(F.sum(F.when(F.col("gap") <= F.col("draw"), F.col("copies"))), F.lit(0))
    positions = placed.groupBy("image_id").agg(
        (F.max("draw") + skipped).alias("pool_pos"), F.max(left).alias("left")
    )
    positions = materialize(positions, "pool_positions")
    found = _text_at(positions.where("left > 0"), texts)
    none = positions.where("left = 0").select("image_id", F.lit(None).cast("string").alias("digest"))
    by_digest = materialize(found.unionByName(none), "chosen_texts")

    # Copies of a text collapse before the shuffle, so a text with very many copies is one row.
    wanted = by_digest.select("digest").distinct()
    texts_back = captions.groupBy(digest).agg(F.first("caption").alias("text_negative"))
    texts_back = texts_back.join(wanted, "digest", "left_semi")
    return skew_join(by_digest, texts_back, ["digest"], how="left").select("image_id", "text_negative")


def _text_at(positions: DataFrame, texts: DataFrame) -> DataFrame:
    """The text whose interval holds each pool position: forward fill over blocks of positions."""
    starts = texts.select(F.col("start").alias("at"), F.lit(0).alias("kind"), "digest", F.lit(None).alias("image_id"))
    asks = positions.select(F.col("pool_pos").alias("at"), F.lit(1).alias("kind"), F.lit(None).alias("digest"), "image_id")
    both = starts.unionByName(asks).withColumn("block", int_div("at", POSITIONS_PER_BLOCK))

    last = both.groupBy("block").agg(F.max(F.when(F.col("kind") == 0, F.struct("at", "digest"))).alias("_last"))
    # A text with very many copies spans blocks without a start of their own: carry it over.
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("block", F.last("_last", ignorenulls=True).over(earlier)["digest"].alias("_carried"))

    inside = Window.partitionBy("block").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    filled = both.withColumn("_here", F.last("digest", ignorenulls=True).over(inside)).where("kind = 1")
    return filled.join(carried, "block").select("image_id", F.coalesce("_here", "_carried").alias("digest"))


def assign_split(key: Column | str, seed: int = fixed.SEED) -> Column:
    u = uniform(seed, key)
    return (
        F.when(u < fixed.TRAIN_SHARE, "train").when(u < fixed.TRAIN_AND_VALID_SHARE, "valid").otherwise("test")
    )


def build_pairs(
    captions: DataFrame,
    images: DataFrame,
    outcomes: DataFrame,
    root: str,
    seed: int = fixed.SEED,
    category: str = fixed.CATEGORY,
) -> DataFrame:
    """The six-column pair table for the images that loaded."""
    loaded = captions_of_loaded(captions, outcomes)
    first = loaded.groupBy("image_id").agg(F.min_by("caption", "cap_no").alias("text_positive"))
    rows = image_paths(first, images, root).join(sample_negatives(loaded, seed), "image_id", "left")
    rows = rows.withColumn("category", F.lit(category)).withColumn("split", assign_split("image_id", seed))
    return typed_pairs(rows)


def typed_pairs(rows: DataFrame) -> DataFrame:
    """All six columns as text. A null in a required column stops the write that reads it."""

    def column(name: str) -> Column:
        text = F.col(name).cast("string")
        if name in REQUIRED:
            text = F.coalesce(text, F.raise_error(F.lit(f"{name} must not be null")).cast("string"))
        return text.alias(name)

    return rows.select(*[column(c) for c in PAIR_COLUMNS])


def split_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("split").agg(F.count("*").alias("total")).orderBy("split")


def split_counts_wide(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        *[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "valid", "test")],
        F.count("*").alias("n_records"),
    )


def pair_preview(pairs: DataFrame, n: int = 10, width: int = 40) -> DataFrame:
    shown = pairs.select(
        "image_id",
        "split",
        F.left("text_positive", F.lit(width)).alias("text_positive_preview"),
        F.left("text_negative", F.lit(width)).alias("text_negative_preview"),
    )
    return shown.orderBy("image_id").limit(n)


def distinct_categories(pairs: DataFrame) -> DataFrame:
    return pairs.select("category").distinct().orderBy("category")


def assign_batches(
    rows: DataFrame, groups: list[str], id_col: str, size: int = fixed.BATCH_SIZE, seed: int = fixed.SEED
) -> DataFrame:
    """Random permutation of each group cut into batches of ``size``, the last one short.

    Adds ``batch_id`` and ``batch_pos``. The permutation is keyed by the group columns too, so
    a group column ``epoch`` gives a new order each epoch.
    """
    u = uniform(seed, *groups, id_col)
    drawn = rows.withColumn("_u", u)
    order = [F.col("_u"), F.col(id_col)]
    ranked = running_sum(drawn, groups, hash_block(F.col("_u")), order, "_rank")
    return ranked.withColumn("batch_id", int_div("_rank", size)).withColumn(
        "batch_pos", (F.col("_rank") % size).cast("int")
    ).drop("_u", "_rank")
