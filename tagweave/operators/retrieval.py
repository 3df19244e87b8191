"""Similarity search, Recall@1 and triplet accuracy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.functions import vectors as V
from tagweave.operators.arrow import matrix
from tagweave.operators.skew import bounded
from tagweave.session import materialize

# One side of a block product has this many bytes at most. Every row is sent to as many block
# pairs as there are blocks, so large blocks save shuffle. Nothing here depends on the cluster.
BLOCK_BYTES = 32 * 1024 * 1024
# A product's last bits depend on the shape of its block, so similarities are rounded before
# they are compared, and equal ones are decided by id.
SIMILARITY_PLACES = 12
# Cells are smaller than blocks, as small ones have narrow bounds.
CELLS_PER_BLOCK = 8
# Pivots have this many bytes at most, and all groups together this many cells.
PIVOT_BYTES = 8 * 1024 * 1024
MAX_FACTS = 100_000
# Room for rounding in the bounds.
ANGLE_MARGIN = 1e-7
SIMILARITY_MARGIN = 1e-9
# Images and texts multiplied at a time, so that the similarities stay in the processor's caches.
PRODUCT_ROWS, PRODUCT_TEXTS = 256, 1024
# A component, product or sum in single precision is off by this share at most, with room; vectors
# that are this long may leave its range.
SHORT_ROUNDING = 1.2e-7
LONGEST_SHORT = 1e15
# Tasks that the images of a group of one block are dealt to.
IMAGE_PARTS = 8
# Pairs of one product that are computed one by one.
MAX_PAIRS = 16_384
# Vectors times cells that are placed at a time.
PLACED_CELLS = 1 << 20


def similar_images(images: DataFrame, query_id, id_col: str, k: int = 10) -> DataFrame:
    """The ``k`` images most like the query image, which is left out by id.

    The query vector is a scalar subquery, normalised once, so the corpus is neither joined nor
    shuffled: each partition keeps its best k and only those meet.
    """
    query = images.where(F.col(id_col) == query_id).select(V.l2_normalize("emb")).scalar()
    scored = images.where(F.col(id_col) != query_id).withColumn("_query", query)
    similarity = F.try_divide(V.dot("emb", "_query"), V.l2_norm("emb"))
    scored = scored.select(F.col(id_col), similarity.alias("similarity"))
    best = scored.orderBy(F.desc("similarity"), id_col).limit(k)
    rank = F.row_number().over(Window.orderBy(F.desc("similarity"), id_col))
    return best.withColumn("rank", rank)


def similar_results(results: DataFrame, filename: str, k: int = 10) -> DataFrame:
    """The ``k`` stored results most like the one of ``filename``: ``(filename, similarity, rank)``."""
    rows = results.select("filename", F.from_json("embedding_json", "array<double>").alias("emb"))
    return similar_images(rows, filename, "filename", k)


class TextBlock:
    """The texts of one block, and the best of them for images that come in parts.

    Products are made in single precision first. Only pairs that may be as similar as the best one so far,
    with room for the rounding, are computed in double precision, so the result is that of the
    double product, and the memory is that of the texts and one small product.
    """

    def __init__(self, ids: np.ndarray, texts: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.texts = ids[order], texts[order]
        with np.errstate(over="ignore", invalid="ignore"):
            self.short = self.texts.astype(np.float32)
            self.longest = np.linalg.norm(self.texts, axis=1).max(initial=0.0)

    def best(self, images: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, similarity, text id)`` of the images that have a text here as similar as ``least``.

        An image whose similarities are no numbers gets the lowest id, at minus infinity.
        """
        sim, at = np.full(len(images), -np.inf), np.zeros(len(images), np.int64)
        with np.errstate(over="ignore", invalid="ignore"):
            lengths = np.linalg.norm(images, axis=1)
            narrow = self.longest < LONGEST_SHORT and bool((lengths < LONGEST_SHORT).all())
        for start in range(0, len(images), PRODUCT_ROWS):
            part = slice(start, start + PRODUCT_ROWS)
            if narrow:
                room = 2 * (images.shape[1] + 4) * SHORT_ROUNDING * self.longest * lengths[part] + 2 * 10.0**-SIMILARITY_PLACES
                self._by_short(images[part], least[part] - room, room, sim[part], at[part])
            else:
                self._whole(images[part], 0, len(self.ids), sim[part], at[part])
        rows = np.flatnonzero(np.isneginf(least) | (sim > -np.inf))
        return rows, sim[rows], self.ids[at[rows]]

    def _by_short(self, images: np.ndarray, floor: np.ndarray, room: np.ndarray, sim: np.ndarray, at: np.ndarray) -> None:
        short = images.astype(np.float32)
        for first in range(0, len(self.ids), PRODUCT_TEXTS):
            some = slice(first, first + PRODUCT_TEXTS)
            product = short @ self.short[some].T
            top = product.max(axis=1)
            floor = np.maximum(floor, top - room)
            near = np.flatnonzero(top >= floor)
            row, text = np.nonzero(product[near] >= floor[near, None])
            if len(row) > MAX_PAIRS:  # many texts that are nearly equal
                found_sim, found_at = sim[near], at[near]
                self._whole(images[near], first, first + product.shape[1], found_sim, found_at)
                sim[near], at[near] = found_sim, found_at
            elif len(row):
                exact = np.round(np.einsum("ij,ij->i", images[near[row]], self.texts[first + text]), SIMILARITY_PLACES)
                self._take(near[row], exact, first + text, sim, at)

    def _whole(self, images: np.ndarray, first: int, end: int, sim: np.ndarray, at: np.ndarray) -> None:
        for start in range(first, end, PRODUCT_TEXTS):
            with np.errstate(over="ignore", invalid="ignore"):
                sims = np.round(images @ self.texts[start : min(start + PRODUCT_TEXTS, end)].T, SIMILARITY_PLACES)
            sims[np.isnan(sims)] = -np.inf
            top = sims.argmax(axis=1)
            self._take(np.arange(len(top)), sims[np.arange(len(top)), top], start + top, sim, at)

    @staticmethod
    def _take(row: np.ndarray, exact: np.ndarray, text: np.ndarray, sim: np.ndarray, at: np.ndarray) -> None:
        """Keep the best of the pairs ``(row, text)`` where it exceeds what is known; texts come in order of ids."""
        order = np.lexsort((text, -exact, row))
        row, exact, text = row[order], exact[order], text[order]
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        first = first[exact[first] > sim[row[first]]]
        sim[row[first]], at[row[first]] = exact[first], text[first]


def _nearest_in_blocks(groups: list[str]):
    """A task over rows sorted by block pair, texts before images: holds the texts of one block at a time."""
    names = [*groups, "_r", "_c"]

    def run(batches):
        current, ids, vectors, block = None, [], [], None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = list(zip(*(batch.column(c).to_pylist() for c in [*names, "is_image"])))
            starts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for start, end in zip(starts, starts[1:]):
                *key, is_image = keys[start]
                if key != current:
                    current, ids, vectors, block = key, [], [], None
                part = batch.slice(start, end - start)
                numbers = part.column("id").to_numpy()
                if not is_image:
                    ids.append(numbers)
                    vectors.append(matrix(part.column("vector")).copy())
                    continue
                if block is None and ids:
                    block = TextBlock(np.concatenate(ids), np.concatenate(vectors))
                    ids, vectors = [], []
                if block is None:
                    continue
                row, sim, best = block.best(matrix(part.column("vector")), part.column("least").to_numpy())
                labels = [part.column(g).take(pa.array(row)) for g in groups]
                columns = [*labels, pa.array(numbers[row]), pa.array(sim), pa.array(best)]
                yield pa.RecordBatch.from_arrays(columns, names=[*groups, "id", "best_sim", "best_id"])

    return run


class Layout:
    """How texts and images of each group are dealt to blocks, and which blocks can hold a nearest text.

    Vectors go to the cell of the pivot they are most like. A large cell is cut into blocks by id,
    and neighbouring small ones share a block. Of a text cell the largest angle to its pivot and the range of lengths are known, which
    bounds the similarity of an image to all of its texts.
    """

    def __init__(self, pivots: np.ndarray, owners: list[tuple], cells: list, block_rows: int):
        self.pivots = pivots
        lengths = np.linalg.norm(pivots, axis=1)
        self.units = pivots / np.where(lengths > 0, lengths, 1.0)[:, None]
        n = len(pivots)
        self.own: dict[tuple, np.ndarray] = {}
        for j, group in enumerate(owners):
            self.own.setdefault(group, np.zeros(n, bool))[j] = True
        self.facts: dict[tuple, dict[str, np.ndarray]] = {}
        for r in cells:
            kinds = ("angle", "longest", "shortest", "texts", "images")
            facts = self.facts.setdefault(tuple(r["group"]), {k: np.zeros(n) for k in kinds})
            for k in kinds:
                facts[k][r["cell"]] = r[k] or 0
        chain = self._chain()
        for facts in self.facts.values():
            for side in ("texts", "images"):
                facts[f"{side}_first"], facts[f"{side}_blocks"] = _packed_cells(facts[side], chain, block_rows)

    def _chain(self) -> list[int]:
        """The cells, each followed by the most similar one that is left."""
        left, chain = np.ones(len(self.units), bool), [0]
        left[0] = False
        while left.any():
            alike = np.where(left, np.nan_to_num(self.units @ self.units[chain[-1]], nan=-2.0), -3.0)
            chain.append(int(alike.argmax()))
            left[chain[-1]] = False
        return chain

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Cell, angle to its pivot and length of each vector, and cosines with all pivots."""
        lengths = np.linalg.norm(vectors, axis=1)
        cosines = vectors @ self.units.T / np.where(lengths > 0, lengths, 1.0)[:, None]
        cell = np.where(np.isnan(cosines), -2.0, cosines).argmax(axis=1)
        angle = np.arccos(np.clip(cosines[np.arange(len(cell)), cell], -1.0, 1.0))
        return cell, angle, lengths, cosines

    @property
    def step(self) -> int:
        """Vectors that are placed at a time."""
        return max(PLACED_CELLS // len(self.units), 1)

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, ...]:
        """Cell, angle to its pivot and length of each of many vectors."""
        found = [self.nearest(vectors[i : i + self.step])[:3] for i in range(0, len(vectors), self.step)]
        return tuple(np.concatenate(part) for part in zip(*found)) or (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))

    def block(self, group: tuple, cell: np.ndarray, ids: np.ndarray, side: str) -> np.ndarray:
        facts = self.facts[group]
        spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return facts[f"{side}_first"][cell] + (spread % np.maximum(facts[f"{side}_blocks"][cell], 1).astype(np.uint64)).astype(np.int64)

    def visits(self, group: tuple, images: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per image and cell, whether a text there may be as similar as the image's own text; and that similarity.

        ``texts`` are the images' own; a missing one is not a number. So are the texts that are
        pivots of this group, which give a bound as well. What is not a number excludes nothing.
        """
        facts = self.facts[group]
        with np.errstate(invalid="ignore"):
            _, _, lengths, cosines = self.nearest(images)
            least = (images * texts).sum(axis=1)
            least = np.where(np.isnan(least), -np.inf, least)
            if group in self.own:
                own = images @ self.pivots[self.own[group]].T
                least = np.maximum(least, np.where(np.isnan(own), -np.inf, own).max(axis=1))
            # The angle to a text is at least the angle to its pivot less that between the two.
            gap = np.cos(np.maximum(np.arccos(np.clip(cosines, -1.0, 1.0)) - facts["angle"] - ANGLE_MARGIN, 0.0))
            most = lengths[:, None] * np.where(gap >= 0, facts["longest"], facts["shortest"]) * gap
            return (facts["texts"] > 0) & ~(most + SIMILARITY_MARGIN < least[:, None]), least


def _packed_cells(sizes: np.ndarray, chain: list[int], block_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each cell; cells along the chain share one while they fit."""
    first, blocks = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    block, held = -1, block_rows
    for cell in chain:
        n = int(sizes[cell])
        if held + n > block_rows:
            block, held = block + 1, 0
        first[cell], blocks[cell] = block, max(-(-n // block_rows), 1)
        block, held = block + blocks[cell] - 1, block_rows if blocks[cell] > 1 else held + n
    return first, blocks


def _per_group(batch: pa.RecordBatch, groups: list[str]) -> list[tuple[tuple, np.ndarray]]:
    """The rows of each group of a batch; without groups all are of one."""
    if not groups:
        return [((0,), np.arange(batch.num_rows))]
    found: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(*(batch.column(g).to_pylist() for g in groups))):
        found.setdefault(key, []).append(i)
    return [(key, np.array(rows)) for key, rows in found.items()]


def _layout(rows: DataFrame, texts: DataFrame, groups: list[str], block_rows: int | None) -> Layout | None:
    """The layout of ``rows`` and their different ``texts``, or None if every group is one block.

    Pivots and facts per cell come to the driver.
    """
    first = rows.where("img IS NOT NULL").select(F.size("img").alias("d")).first()
    dims = max(first["d"], 1) if first else 1
    block_rows = block_rows or max(BLOCK_BYTES // (8 * dims), 1)
    largest, n_groups = rows.groupBy(*groups).agg(F.count("*").alias("n")).agg(F.max("n"), F.count("*")).first()
    blocks = -(-(largest or 0) // block_rows)
    if blocks <= 1:
        return None
    cells = min(CELLS_PER_BLOCK * blocks, max(PIVOT_BYTES // (8 * dims), 1), max(MAX_FACTS // n_groups, 1))
    chosen = texts.orderBy(F.xxhash64("id", *groups), "id").limit(cells).select(*groups, "txt").collect()
    if not chosen:
        return None  # and no text is sent anywhere
    pivots, owners = np.array([r["txt"] for r in chosen]), [tuple(r[g] for g in groups) or (0,) for r in chosen]
    return Layout(pivots, owners, _cell_facts(rows, texts, groups, Layout(pivots, owners, [], 1)), block_rows)


def _cell_facts(rows: DataFrame, texts: DataFrame, groups: list[str], layout: Layout) -> list:
    shared = rows.sparkSession.sparkContext.broadcast(layout)

    def cell_of(vectors: pa.Array) -> pa.Array:
        cell, angle, length = shared.value.cells(matrix(vectors))
        columns = {"cell": pa.array(cell, pa.int32()), "angle": pa.array(angle), "length": pa.array(length)}
        return pa.StructArray.from_arrays(list(columns.values()), list(columns))

    place = F.arrow_udf(cell_of, "struct<cell:int,angle:double,length:double>").asNondeterministic()
    group = F.struct(*groups) if groups else F.struct(F.lit(0).alias("none"))
    sides = []
    for side, source in (("txt", texts), ("img", rows)):
        there = source.where(F.col(side).isNotNull()).select(group.alias("group"), place(side).alias("at"))
        is_text = F.lit(side == "txt")
        sides.append(there.select("group", "at.cell", F.when(is_text, F.col("at.angle")).alias("angle"), F.when(is_text, F.col("at.length")).alias("length"), is_text.alias("is_text")))
    facts = sides[0].unionByName(sides[1]).groupBy("group", "cell").agg(
        F.max("angle").alias("angle"), F.max("length").alias("longest"), F.min("length").alias("shortest"),
        F.count_if("is_text").alias("texts"), F.count_if(~F.col("is_text")).alias("images"),
    )
    return facts.collect()


def _placed_images(rows: DataFrame, groups: list[str], layout: Layout) -> DataFrame:
    """``(groups, id, img, least, _r, _c)``: the block of each image, once per text block that it has to see."""
    shared = rows.sparkSession.sparkContext.broadcast(layout)

    def place(batches):
        for whole in batches:
            plan = shared.value
            for first in range(0, whole.num_rows, plan.step):
                batch = whole.slice(first, plan.step)
                images, texts = batch.column("img"), batch.column("txt")
                image_rows, text_rows = matrix(images), matrix(texts)
                if not text_rows.shape[1]:
                    text_rows = np.zeros_like(image_rows)
                text_rows = np.where(texts.is_valid().to_numpy(zero_copy_only=False)[:, None], text_rows, np.nan)
                ids = batch.column("id").to_numpy()
                for key, at in _per_group(batch, groups):
                    facts = plan.facts[key]
                    own = plan.block(key, plan.nearest(image_rows[at])[0], ids[at], "images")
                    seen_cells, least = plan.visits(key, image_rows[at], text_rows[at])
                    row, cell = np.nonzero(seen_cells)
                    blocks = facts["texts_blocks"][cell]
                    row = np.repeat(row, blocks)
                    inside = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                    # Cells that share a block are seen together.
                    row, seen = np.unique(np.stack([row, np.repeat(facts["texts_first"][cell], blocks) + inside]), axis=1)
                    part = batch.select([*groups, "id", "img"]).take(pa.array(at[row]))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(least[row]), pa.array(own[row].astype(np.int32)), pa.array(seen.astype(np.int32))], names=[*groups, "id", "img", "least", "_r", "_c"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    ddl = ", ".join([*(f"{g} {kinds[g]}" for g in groups), f"id {kinds['id']}", "img array<double>", "least double", "_r int", "_c int"])
    return rows.where("img IS NOT NULL").select(*groups, "id", "img", "txt").mapInArrow(place, ddl)


def _placed_texts(texts: DataFrame, groups: list[str], layout: Layout) -> DataFrame:
    """``(groups, id, txt, _c)``: the block of each text."""
    shared = texts.sparkSession.sparkContext.broadcast(layout)

    def place(batches):
        for batch in batches:
            plan = shared.value
            cell, ids = plan.cells(matrix(batch.column("txt")))[0], batch.column("id").to_numpy()
            block = np.zeros(len(ids), np.int32)
            for key, at in _per_group(batch, groups):
                block[at] = plan.block(key, cell[at], ids[at], "texts")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block)], names=[*groups, "id", "txt", "_c"])

    kinds = {f.name: f.dataType.simpleString() for f in texts.schema.fields}
    ddl = ", ".join([*(f"{g} {kinds[g]}" for g in groups), f"id {kinds['id']}", "txt array<double>", "_c int"])
    return texts.select(*groups, "id", "txt").mapInArrow(place, ddl)


def _different_texts(rows: DataFrame, groups: list[str]) -> DataFrame:
    """``(groups, id, txt)``: each text of a group once, under its lowest id, as no other copy can win."""
    found = rows.where("txt IS NOT NULL").groupBy(*groups, "txt").agg(F.min("id").alias("id"))
    return materialize(found.select(*groups, "id", "txt"), "texts")


def nearest_text(rows: DataFrame, groups: list[str], block_rows: int | None = None) -> DataFrame:
    """For each image, the most similar text of its group: ``(groups, id, best_id, best_sim)``.

    ``rows`` is ``(groups, id, img, txt)``. Texts and images are dealt to blocks of similar vectors.
    An image is at least as similar to its nearest text as to its own, so it is sent only to
    blocks whose bound reaches that, and a pair of blocks that no image has to see is not formed.
    The result is exact. A task holds the texts of one block and reads the images in parts, so its
    memory depends on the block size alone, a group that holds most rows is spread over many tasks,
    and an image is sent to no more blocks than the different texts of its group fill. Only one row
    per image and block leaves a task, if the block holds a text as similar as the image's own.

    Similarities are compared at 12 decimal places and the lowest id wins a tie, so the result
    does not depend on the blocks. A null text is no candidate; a null image, or one in a group
    without texts, has no row here.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join([f"{g} {kinds[g]}" for g in groups] + ["id bigint", "best_sim double", "best_id bigint"])
    different = _different_texts(rows, groups)
    layout = _layout(rows, different, groups, block_rows)
    if layout:
        images = _placed_images(rows, groups, layout)
        # A text goes to the image blocks that have an image for its block.
        pairs = materialize(images.select(*groups, "_r", "_c").distinct(), "block_pairs")
        texts = _placed_texts(different, groups, layout).join(bounded(pairs), [*groups, "_c"])
    else:
        # A group is one block of texts, of which each part of its images has a copy.
        at = F.pmod(F.xxhash64("id"), F.lit(IMAGE_PARTS)).cast("int").alias("_r")
        images = rows.where("img IS NOT NULL").select(*groups, "id", "img", F.lit(float("-inf")).alias("least"), at, F.lit(0).alias("_c"))
        copies = F.explode(F.array(*map(F.lit, range(IMAGE_PARTS)))).alias("_r")
        texts = different.select("*", copies, F.lit(0).alias("_c"))
    keys = [*groups, "_r", "_c"]
    both = texts.select(*keys, F.lit(False).alias("is_image"), "id", F.col("txt").alias("vector"), F.lit(None).cast("double").alias("least")).unionByName(
        images.select(*keys, F.lit(True).alias("is_image"), "id", F.col("img").alias("vector"), "least")
    )
    dealt = both.repartition(*keys).sortWithinPartitions(*keys, "is_image")
    partial = dealt.mapInArrow(_nearest_in_blocks(groups), schema)
    best = F.max(F.struct("best_sim", (-F.col("best_id")).alias("order")))
    return partial.groupBy(*groups, "id").agg(best.alias("_best")).select(
        *groups, "id", (-F.col("_best.order")).alias("best_id"), F.col("_best.best_sim").alias("best_sim")
    )


def block_copies(rows: DataFrame, groups: list[str], block_rows: int | None = None) -> DataFrame:
    """How often ``nearest_text`` ships each side, and how many text blocks there are, per group:
    ``(groups, image_copies, n_images, text_blocks)``."""
    images = _placed_images(rows, groups, _layout(rows, _different_texts(rows, groups), groups, block_rows))
    return images.groupBy(*groups).agg(F.count("*").alias("image_copies"), F.count_distinct("id").alias("n_images"), F.count_distinct("_c").alias("text_blocks"))


def recall_at_1(rows: DataFrame, groups: list[str], block_rows: int | None = None) -> DataFrame:
    """Share of images whose nearest text is their own, per group; a null image is a miss."""
    nearest = nearest_text(rows.select(*groups, "id", "img", "txt"), groups, block_rows)
    # Hits and images are counted in one sum, so the two need no join.
    hits = nearest.where(F.col("best_id") == F.col("id")).select(*groups, F.lit(1).alias("_hit"), F.lit(0).alias("_image"))
    counted = hits.unionByName(rows.select(*groups, F.lit(0).alias("_hit"), F.lit(1).alias("_image")))
    sums = counted.groupBy(*groups).agg(F.sum("_hit").alias("_hits"), F.sum("_image").alias("n_images"))
    return sums.select(*groups, (F.col("_hits").cast("double") / F.col("n_images")).alias("recall_at_1"), "n_images")


def _pos_beats_neg() -> Column:
    return V.cosine("img", "txt") > V.cosine("img", "neg")


def triplet_accuracy(rows: DataFrame, groups: list[str]) -> DataFrame:
    """Share of images nearer to their own text than to the negative; null without negatives."""
    return rows.groupBy(*groups).agg(F.avg(_pos_beats_neg().cast("double")).alias("triplet_accuracy"))


def evaluate(rows: DataFrame, groups: list[str], block_rows: int | None = None) -> DataFrame:
    """Both metrics for every group in one plan: ``(groups, recall_at_1, triplet_accuracy)``.

    ``rows`` is ``(groups, id, img, txt, neg)``; ``neg`` is null where a group has no negatives.
    """
    recall = recall_at_1(rows, groups, block_rows).drop("n_images")
    return recall.join(triplet_accuracy(rows, groups), groups)


def metric_rows(metrics: DataFrame, groups: list[str]) -> DataFrame:
    """Wide metrics as ``(groups, metric, value)``, nulls left out."""
    named = F.explode(
        F.array(
            F.struct(F.lit("recall_at_1").alias("metric"), F.col("recall_at_1").alias("value")),
            F.struct(F.lit("triplet_accuracy").alias("metric"), F.col("triplet_accuracy").alias("value")),
        )
    )
    long = metrics.select(*groups, named.alias("m")).select(*groups, "m.metric", "m.value")
    return long.where("value is not null")


def metric_delta(metrics: DataFrame) -> DataFrame:
    """Baseline beside final value for each split and metric, from rows keyed by phase and split."""
    long = metric_rows(metrics, ["phase", "split"])
    sides = long.groupBy("split", "metric").agg(
        F.max(F.when(F.col("phase") == "baseline", F.col("value"))).alias("baseline"),
        F.max(F.when(F.col("phase") == "final", F.col("value"))).alias("final"),
    )
    return sides.withColumn("delta", F.col("final") - F.col("baseline"))
