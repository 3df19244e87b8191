"""The tagger: image embedding and candidate tags to ranked, selected and encoded tags."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave import fixed_values as fixed
from tagweave.functions import tags as T
from tagweave.functions import vectors as V
from tagweave.operators.arrow import list_column, matrix, plain
from tagweave.operators.encoders import Encoder, encode_content, image_encoder, strict_base64
from tagweave.operators.skew import skew_join
from tagweave.session import materialize
from tagweave.sources.tables import check_columns

# A tag table goes to every task only while its matrix is at most this large.
TAG_MATRIX_BYTES = 64 * 1024 * 1024
TAG_MATRIX_ROWS = 10_000
# Images and tags of one product, where images meet a large tag table. A block pair's scores are
# this many cells at most, and a vector is shuffled once per 256 or 4096 scores it takes part in.
BLOCK_IMAGES, BLOCK_TAGS = 256, 4096


def mean_vectors(rows: DataFrame, key: str, embedding: str) -> DataFrame:
    """Unit-length mean vector per key: ``(key, emb)``.

    Vectors are summed per Arrow batch first, so what is exploded and shuffled is one row per
    key and batch, however many rows a key has.
    """
    keyed = rows.select(F.col(key).alias("key"), V.doubles(embedding).alias("emb"))
    key_type = keyed.schema["key"].dataType.simpleString()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            codes = pc.dictionary_encode(batch.column("key"))
            index = codes.indices.to_numpy()
            vectors = matrix(batch.column("emb"))
            sums = np.zeros((len(codes.dictionary), vectors.shape[1]))
            np.add.at(sums, index, vectors)
            yield pa.RecordBatch.from_arrays([codes.dictionary, list_column(sums)], ["key", "sums"])

    partial = keyed.where("key is not null and emb is not null").mapInArrow(
        add_up, f"key {key_type}, sums array<double>"
    )
    cells = partial.select("key", F.posexplode("sums").alias("i", "x"))
    cells = cells.groupBy("key", "i").agg(F.sum("x").alias("x"))
    vectors = cells.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("cells"))
    # The mean and the sum have the same direction.
    return vectors.select(F.col("key").alias(key), V.l2_normalize(F.col("cells")["x"]).alias("emb"))


def _tag_rows(tags: DataFrame) -> list:
    return tags.select("tag", "emb").orderBy("pos").collect()


def _is_small(tags: DataFrame) -> bool:
    measured = tags.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("emb")), F.lit(0)).alias("d")).first()
    return measured["n"] <= TAG_MATRIX_ROWS and measured["n"] * measured["d"] * 8 <= TAG_MATRIX_BYTES


def _bounded_tag_rows(tags: DataFrame) -> list:
    if not _is_small(tags):
        raise ValueError(f"a SQL function holds {TAG_MATRIX_ROWS} tags and {TAG_MATRIX_BYTES} bytes of vectors at most")
    return _tag_rows(tags)


def _all_tags(tags: DataFrame) -> Column:
    """The default candidates of a small tag table as a scalar subquery: no list of literals enters the plan."""
    return tags.agg(F.array_sort(F.collect_list(F.struct("pos", "tag")))["tag"].alias("t")).scalar()


def tag_scorer(names: list[str], vectors: np.ndarray, default: list[str], logits: V.Logits):
    """Arrow UDF ``(embedding, candidates) -> scores``, aligned with the candidates.

    Null candidates stand for the default list, which thus is not sent along with every row.
    A candidate that is not in the tag table scores null, and so does an image without a vector.
    """
    known = pa.array(names, pa.string())
    default_column = pc.index_in(pa.array(default, pa.string()), value_set=known).fill_null(-1).to_numpy()
    scale, bias = logits.scale, logits.bias

    @F.arrow_udf("array<double>")
    def scores(embedding: pa.Array, candidates: pa.Array) -> pa.Array:
        embedding, candidates = plain(embedding), plain(candidates)
        images = matrix(embedding)
        if images.shape[1] == 0:
            images = np.zeros((len(images), vectors.shape[1]))
        table = 1.0 / (1.0 + np.exp(-(scale * (images @ vectors.T) + bias)))

        by_default = candidates.is_null().to_numpy(zero_copy_only=False)
        lengths = pc.list_value_length(candidates).fill_null(len(default)).to_numpy()
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        row = np.repeat(np.arange(len(candidates)), lengths)
        column = np.empty(len(row), dtype=np.int64)
        column[by_default[row]] = np.tile(default_column, by_default.sum())
        column[~by_default[row]] = pc.index_in(candidates.flatten(), value_set=known).fill_null(-1).to_numpy()
        missing = (column < 0) | embedding.is_null().to_numpy(zero_copy_only=False)[row]
        values = pa.array(table[row, column], pa.float64(), mask=missing)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    # The optimiser may copy a deterministic expression, here into a filter it derives for a later
    # explode, and would then score every image twice.
    return scores.asNondeterministic()


def score_candidates(
    images: DataFrame,
    tags: DataFrame,
    candidates: Column,
    default_tags: list[str] | None = None,
    logits: V.Logits = V.Logits(),
    by_join: bool | None = None,
) -> DataFrame:
    """Add ``ranked``: the row's candidates, or the default ones, with rounded scores, best first.

    ``images`` has ``emb``, ``tags`` is ``(tag, pos, emb)``, and ``candidates`` is a list or null. Without
    ``default_tags`` all tags are the default. A small tag table becomes a matrix in every task; a
    large one, or any with ``by_join``, is joined on the tag instead, with hot tags salted. Both give
    each row its own scores, whether or not ids repeat.
    """
    asked = images.withColumn("_asked", candidates)
    given = F.array(*[F.lit(t) for t in default_tags]).cast("array<string>") if default_tags is not None else None
    if by_join or (by_join is None and not _is_small(tags)):
        return _score_by_join(asked if given is None else asked.withColumn("_asked", F.coalesce("_asked", given)), tags, logits)
    asked = asked.withColumn("_default", _all_tags(tags) if given is None else given)
    listed = F.coalesce("_asked", "_default")
    rows = _tag_rows(tags)
    names = [r["tag"] for r in rows]
    vectors = np.array([r["emb"] for r in rows], dtype=np.float64) if rows else np.zeros((0, 0))
    score = tag_scorer(names, vectors, names if default_tags is None else default_tags, logits)
    scored = asked.withColumn("_scores", score(F.col("emb"), F.col("_asked")))
    return scored.withColumn("ranked", T.rank_tags(listed, F.col("_scores"))).drop("_scores", "_asked", "_default")


def _score_by_join(asked: DataFrame, tags: DataFrame, logits: V.Logits) -> DataFrame:
    """Rows get a key of their own, written with them, so that repeated ids stay apart.

    Rows that list no candidates meet the tag table block by block; no task or driver holds all of it.
    """
    rows = materialize(asked.withColumn("_row", F.monotonically_increasing_id()), "asked")
    cells = rows.select("_row", "emb", F.posexplode("_asked").alias("cand_pos", "tag"))
    vectors = tags.select("tag", F.col("emb").alias("tag_emb"))
    pairs = skew_join(cells, vectors, ["tag"], how="left", spread_by=["_row", "cand_pos"])
    score = V.sigmoid(V.logit(V.dot("emb", "tag_emb"), logits))
    cell = F.struct(F.col("cand_pos").cast("long").alias("cand_pos"), "tag", score.alias("score"))
    lists = pairs.groupBy("_row").agg(F.array_sort(F.collect_list(cell)).alias("_cells"))
    unlisted = rows.where("_asked is null").select("_row", "emb")
    n = unlisted.count()
    if n:
        lists = lists.unionByName(_score_in_blocks(unlisted, n, tags, logits))
    joined = rows.join(lists, "_row", "left")
    ranked = T.rank_tags(F.col("_cells")["tag"], F.col("_cells")["score"])
    none = F.array().cast(fixed.TAGS_DDL)
    return joined.withColumn("ranked", F.coalesce(ranked, none)).drop("_cells", "_row", "_asked")


def _score_in_blocks(rows: DataFrame, n_rows: int, tags: DataFrame, logits: V.Logits) -> DataFrame:
    """Cells ``(cand_pos, tag, score)`` of every row with every tag, in one list per row.

    Rows and tags are dealt to blocks by hash. A pair of blocks is one matrix product in one task, which
    returns a list per row, so that no pair of vectors becomes a row of its own.
    """
    row_blocks, tag_blocks = -(-n_rows // BLOCK_IMAGES), max(1, -(-tags.count() // BLOCK_TAGS))
    all_blocks = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda key, n: F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")
    left = rows.select("_row", "emb", dealt(["_row"], row_blocks).alias("i"), all_blocks(tag_blocks).alias("j"))
    right = tags.select(
        F.col("pos").cast("long").alias("cand_pos"), "tag", F.col("emb").alias("tag_emb"),
        dealt(["pos", "tag"], tag_blocks).alias("j"), all_blocks(row_blocks).alias("i"),
    )
    scale, bias = logits.scale, logits.bias

    def product(images: pa.Table, of: pa.Table) -> pa.Table:
        n, m = images.num_rows, of.num_rows
        scores = np.zeros((n, m))
        unknown = np.ones((n, m), bool)
        if n and m:
            x, y = matrix(images.column("emb")), matrix(of.column("tag_emb"))
            if x.shape[1] and y.shape[1]:
                scores = 1.0 / (1.0 + np.exp(-(scale * (x @ y.T) + bias)))
                no_image = images.column("emb").is_null().to_numpy()
                no_tag = of.column("tag_emb").is_null().to_numpy()
                unknown = no_image[:, None] | no_tag[None, :]
        every = np.tile(np.arange(m), n)
        parts = [plain(of.column(c).combine_chunks()).take(pa.array(every)) for c in ("cand_pos", "tag")]
        parts.append(pa.array(scores.ravel(), pa.float64(), mask=unknown.ravel()))
        cells = pa.StructArray.from_arrays(parts, ["cand_pos", "tag", "score"])
        offsets = pa.array(np.arange(n + 1) * m, pa.int32())
        return pa.table({"_row": images.column("_row"), "_cells": pa.ListArray.from_arrays(offsets, cells)})

    ddl = "_row long, _cells array<struct<cand_pos:long,tag:string,score:double>>"
    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(product, ddl)
    return found.groupBy("_row").agg(F.array_sort(F.flatten(F.collect_list("_cells"))).alias("_cells"))


def tag_images(
    images: DataFrame,
    tags: DataFrame,
    candidates_json: str | None = None,
    threshold: str | None = None,
    default_tags: list[str] | None = None,
    logits: V.Logits = V.Logits(),
    by_join: bool | None = None,
) -> DataFrame:
    """Add ``ranked`` (all candidates with scores) and ``selected`` (those that pass).

    ``candidates_json`` and ``threshold`` name columns that override the defaults row by row.
    The default candidates are the tags of ``tags`` in ``pos`` order.
    """
    asked = F.from_json(F.col(candidates_json), "array<string>") if candidates_json else F.lit(None).cast("array<string>")
    limit = F.col(threshold) if threshold else F.lit(None).cast("string")
    rows = score_candidates(images, tags, asked, default_tags, logits, by_join)
    selected = T.select_tags(F.col("ranked"), T.threshold_or_default(limit))
    # An image without a vector has no best tags either.
    return rows.withColumn("selected", F.when(F.col("emb").isNull(), F.array().cast(fixed.TAGS_DDL)).otherwise(selected))


def batch_infer(tagged: DataFrame, filename: Column) -> DataFrame:
    """``(filename, prediction)`` with the three JSON texts, from the rows of :func:`tag_images`."""
    response = T.encode_response(F.col("selected"), F.col("ranked"), F.col("emb"))
    return tagged.select(filename.alias("filename"), response.alias("prediction"))


REQUEST_COLUMNS = {"image_base64": "string"}
OPTIONAL_REQUEST_COLUMNS = {"tag_candidates_json": "string", "tag_score_threshold": "string"}


def predict(
    requests: DataFrame,
    tags: DataFrame,
    load: Callable[[], Encoder],
    id_col: str,
    default_tags: list[str] | None = None,
    logits: V.Logits = V.Logits(),
) -> DataFrame:
    """Answer requests that carry image bytes: ``(filename, prediction, load_ok)``, one row per request.

    Candidates and threshold may be given per request; their columns may also be absent. Bytes that
    are null, empty or no valid base64 give a null embedding, null scores, no tags and ``load_ok`` false.
    """
    rows = check_columns(requests, REQUEST_COLUMNS, OPTIONAL_REQUEST_COLUMNS)
    rows = rows.withColumn("emb", image_encoder(load)(F.try_to_binary("image_base64", F.lit("base64"))))
    tagged = tag_images(
        rows, tags, "tag_candidates_json", "tag_score_threshold", default_tags=default_tags, logits=logits
    )
    response = T.encode_response(F.col("selected"), F.col("ranked"), F.col("emb"))
    return tagged.select(F.col(id_col).alias("filename"), response.alias("prediction"), F.col("emb").isNotNull().alias("load_ok"))


def create_inference_view(
    spark: SparkSession,
    source: str,
    result: str,
    tags: DataFrame,
    load: Callable[[], Encoder],
    id_col: str = "filename",
    default_tags: list[str] | None = None,
) -> DataFrame:
    """Answer the requests of view ``source`` and show the answers as view ``result``.

    The answers are written first. A lazy view would run the model again for every query on it.
    """
    answers = predict(spark.table(source), tags, load, id_col, default_tags)
    stored = materialize(answers, "inference")
    stored.createOrReplaceTempView(result)
    return stored


def register_tag_scores(spark: SparkSession, tags: DataFrame, name: str, logits: V.Logits = V.Logits()) -> None:
    """Make the scorer callable from SQL as ``name(embedding, candidates)``; null means all tags.

    A SQL function cannot join, so a tag table beyond ``TAG_MATRIX_ROWS`` or ``TAG_MATRIX_BYTES`` is an
    error; use score_candidates else.
    """
    rows = _bounded_tag_rows(tags)
    vectors = np.array([r["emb"] for r in rows], dtype=np.float64)
    names = [r["tag"] for r in rows]
    spark.udf.register(name, tag_scorer(names, vectors, names, logits))


RESPONSE_DDL = "struct<tags_json:string,embedding:string,metrics_json:string>"


def register_tagger(
    spark: SparkSession, tags: DataFrame, name: str, load: Callable[[], Encoder], logits: V.Logits = V.Logits()
) -> None:
    """Make the tagger callable from SQL as ``name(image_base64, tag_candidates_json, tag_score_threshold)``.

    It returns the response struct as :func:`predict` does; a null override stands for the default, and an
    image that cannot be decoded has a null embedding and no tags. The elapsed time is that of its batch,
    per image. A SQL function cannot join, so a tag table beyond ``TAG_MATRIX_ROWS`` or
    ``TAG_MATRIX_BYTES`` is an error; use predict else.
    """
    rows = _bounded_tag_rows(tags)
    names, vectors = [r["tag"] for r in rows], np.array([r["emb"] for r in rows], dtype=np.float64)
    place = {t: i for i, t in enumerate(names)}

    def respond(emb: np.ndarray | None, listed: str | None, limit: str | None, ms: float) -> dict:
        asked = T.parse_list(listed)
        asked = names if asked is None else asked
        if emb is None:
            scores = [None] * len(asked)
        else:
            all_ = np.floor(1e4 / (1.0 + np.exp(-(logits.scale * (vectors @ emb) + logits.bias))) + 0.5) / 1e4
            scores = [float(all_[place[t]]) if t in place else None for t in asked]
        ranked = sorted(zip(asked, scores), key=lambda p: (p[1] is None, -(p[1] or 0.0)))
        cut = T.parse_number(limit, fixed.TAG_SCORE_THRESHOLD)
        passing = [p for p in ranked if p[1] is not None and p[1] >= cut] or ranked[: fixed.FALLBACK_TAGS]
        pairs = lambda some: [{"tag": t} | ({} if s is None else {"score": s}) for t, s in some]
        metrics = {"inference_time_ms": round(ms, 1), **dict.fromkeys(("gpu_memory_allocated_mb", "gpu_memory_peak_mb", "gpu_utilization_pct"))}
        return {
            "tags_json": json.dumps({"tags": pairs(passing if emb is not None else []), "all_scores": pairs(ranked)}, ensure_ascii=False),
            "embedding": None if emb is None else json.dumps(emb.tolist()),
            "metrics_json": json.dumps(metrics),
        }

    @F.arrow_udf(RESPONSE_DDL)
    def tagger(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        model = load()
        kind = pa.struct([(f, pa.string()) for f in ("tags_json", "embedding", "metrics_json")])
        for image, listed, limit in batches:
            began = time.perf_counter()
            vectors_of = encode_content(model, pa.array([strict_base64(b) for b in plain(image).to_pylist()], pa.binary()))
            ms = 1000 * (time.perf_counter() - began) / max(1, len(vectors_of))
            answers = [respond(v, a, t, ms) for v, a, t in zip(vectors_of, plain(listed).to_pylist(), plain(limit).to_pylist())]
            yield pa.array(answers, kind)

    spark.udf.register(name, tagger.asNondeterministic())


def pair_scores(triplets: DataFrame, logits: V.Logits = V.Logits()) -> DataFrame:
    """Score of the right and of the wrong text for each image, and whether the right one wins."""
    scored = triplets.select(
        "image_id",
        V.sigmoid(V.logit(V.dot("img", "pos"), logits)).alias("pos_score"),
        V.sigmoid(V.logit(V.dot("img", "neg"), logits)).alias("neg_score"),
    )
    return scored.withColumn("correct", F.col("pos_score") > F.col("neg_score"))
