"""Registered queries: one per operator, each over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave import fixed_values as fixed
from tagweave.functions import tags as T
from tagweave.functions import vectors as V
from tagweave.functions.numbers import uniform
from tagweave.operators import analytics, encoders, pairs, retrieval, runs, scoring, training
from tagweave.operators.skew import spread
from tagweave.plans import inputs
from tagweave.session import materialize, new_path
from tagweave.sources import captions as caption_source
from tagweave.sources import files as file_source
from tagweave.sources import images as image_source
from tagweave.sources import tables

Query = Callable[[SparkSession, str], DataFrame]

SAMPLE_SIZE = 100
FIRST_IMAGES = 100
TRAINABLE_PARTS = ["en_model.src1", "fr_model.src"]
RUN_ID = "run-1"


def _r(c: Column | str, places: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, places)


def _ranked_rows(rows: DataFrame, id_col: str, ranked: str) -> DataFrame:
    """One row per tag. The outer explode keeps Spark from computing the list a second time for a filter."""
    cells = rows.select(id_col, F.posexplode_outer(ranked).alias("pos", "t")).where("pos IS NOT NULL")
    return cells.select(id_col, (F.col("pos") + 1).alias("rank"), "t.tag", "t.score")


# --- sources ----------------------------------------------------------------------------------


def scan_captions(spark: SparkSession, d: str) -> DataFrame:
    path = new_path(spark, "captions")
    caption_source.write_caption_objects(inputs.captions(spark, d), path)
    annotations, images = caption_source.scan_captions(spark, path, multi_line=False)
    names = images.select(F.col("id").alias("image_id"), "file_name").distinct()
    return annotations.join(names, "image_id").select("image_id", "file_name", "caption")


def scan_images(spark: SparkSession, d: str) -> DataFrame:
    files = image_source.scan_images(spark, inputs.packed_files(spark, d), ["txt"])
    lines = files.select(F.explode(F.split(F.col("content").cast("string"), "\n")).alias("line")).where("line <> ''")
    parts = F.split("line", "\t")
    return lines.select(
        F.get(parts, F.lit(0)).cast("bigint").alias("doc_id"),
        F.octet_length(F.unbase64(F.get(parts, F.lit(1)))).cast("bigint").alias("n_bytes"),
    )


def scan_split(spark: SparkSession, d: str) -> DataFrame:
    return tables.scan_split(inputs.stored_pairs(spark, d), "train")


def scan_results(spark: SparkSession, d: str) -> DataFrame:
    results = inputs.stored_results(spark, d)
    num_tags = F.size(F.from_json("tags", fixed.TAGS_DDL)).alias("num_tags")
    return results.select("filename", num_tags, *analytics.vector_summary(F.from_json("embedding_json", "array<double>")))


def typed_pairs(spark: SparkSession, d: str) -> DataFrame:
    return inputs.pair_table(spark, d)


def build_requests(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("IMG_"), F.col("doc_id").cast("string"), F.lit(".jpg"))
    files = inputs.table(spark, d, "documents").select(name.alias("filename"), F.col("text").cast("binary").alias("content"))
    return image_source.build_requests(files)


def load_with_placeholder(spark: SparkSession, d: str) -> DataFrame:
    first = inputs.captions(spark, d).groupBy("image_id").agg(F.min_by("caption", "cap_no").alias("caption"))
    outcomes = materialize(inputs.outcomes(spark, d), "outcomes")
    files = outcomes.where("ok").join(first, "image_id").select(
        F.col("path_or_err").alias("path"), F.col("caption").cast("binary").alias("content")
    )
    paths = pairs.image_paths(outcomes, inputs.images(spark, d), inputs.IMAGE_ROOT)
    loaded = image_source.load_with_placeholder(paths, files)
    size = F.coalesce(F.octet_length("content"), F.lit(len(image_source.placeholder())))
    return loaded.select("image_id", "load_ok", size.cast("bigint").alias("n_bytes"))


def resume_ingest(spark: SparkSession, d: str) -> DataFrame:
    wanted = inputs.table(spark, d, "documents").select("doc_id", "source")
    return tables.resume_ingest(wanted, inputs.table(spark, d, "labels"), "doc_id")


def ingest_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return tables.ingest_counts(inputs.outcomes(spark, d))


def _ingest_batches(spark: SparkSession, d: str) -> tuple[str, DataFrame, list[tuple[int, int, int]]]:
    """English and German images, the same batch again, and then all images with what failed before."""
    outcomes = materialize(inputs.outcomes(spark, d), "outcomes")
    path, ids = new_path(spark, "ledger"), outcomes.select("image_id")
    early = ids.where(F.pmod("image_id", F.lit(10)) < 2)
    counts = []
    for batch, wanted in ((1, early), (1, early), (2, ids)):
        n = tables.ingest(wanted, path, "image_id", batch, lambda todo: todo.join(outcomes, "image_id"))
        counts.append((batch, n["n_loaded"], n["n_failed"]))
    return path, ids, counts


def ingest_ledger(spark: SparkSession, d: str) -> DataFrame:
    path, ids, _ = _ingest_batches(spark, d)
    return tables.scan_ledger(spark, path, ids.schema["image_id"])


def ingest_batch_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of each batch as they were taken during its write."""
    counts = _ingest_batches(spark, d)[2]
    return spark.createDataFrame(counts, "batch int, n_loaded bigint, n_failed bigint")


# --- sinks ------------------------------------------------------------------------------------


def write_pairs(spark: SparkSession, d: str) -> DataFrame:
    return inputs.write_pairs(spark, d)


def write_results(spark: SparkSession, d: str) -> DataFrame:
    results = inputs.write_results(spark, d)
    decoded = results.select("filename", F.from_json("tags", fixed.TAGS_DDL).alias("tags"), "metrics_json")
    return decoded.select("filename", "metrics_json", F.inline("tags"))


def run_metrics(spark: SparkSession, d: str) -> DataFrame:
    metrics = retrieval.evaluate(inputs.phase_rows(spark, d), ["phase", "split"])
    logged = runs.run_metrics(metrics, _epoch_losses(spark, d), RUN_ID)
    return logged.withColumn("value", _r("value"))


def run_params(spark: SparkSession, d: str) -> DataFrame:
    return _params(spark, d, RUN_ID)


def _params(spark: SparkSession, d: str, run_id: str) -> DataFrame:
    rows = inputs.image_vectors(spark, d).select(pairs.assign_split("image_id").alias("split"))
    params = {
        "base_model": "stored_vectors",
        "training_table": "training_image_text_pairs",
        "num_epochs": fixed.NUM_EPOCHS,
        "batch_size": fixed.BATCH_SIZE,
        "learning_rate": fixed.LEARNING_RATE,
        "trainable_layers": fixed.TRAINABLE_LAYERS,
        "loss_function": fixed.LOSS_NAME,
    }
    return runs.run_params(pairs.split_counts_wide(rows), run_id, params)


def logged_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of three runs, appended one after the other; the second is first cut short and then repeated."""
    metrics = materialize(retrieval.evaluate(inputs.phase_rows(spark, d), ["phase", "split"]), "metrics")
    path, losses = new_path(spark, "run_metrics"), _epoch_losses(spark, d)
    whole = {run: runs.run_metrics(metrics, losses, run).withColumn("value", _r("value")) for run in ("run-1", "run-2", "run-3")}
    for run, rows in (("run-1", whole["run-1"]), ("run-2", whole["run-2"].where("step <= 2")), ("run-3", whole["run-3"]), ("run-2", whole["run-2"])):
        tables.append_runs(rows, path)
    return tables.scan_runs(spark, path, whole["run-1"].schema)


def logged_params(spark: SparkSession, d: str) -> DataFrame:
    """Parameters of two runs; the first is logged twice."""
    path = new_path(spark, "run_params")
    for run in ("run-1", "run-2", "run-1"):
        tables.append_runs(_params(spark, d, run), path)
    return tables.scan_runs(spark, path, _params(spark, d, "run-1").schema)


def register_head(spark: SparkSession, d: str) -> DataFrame:
    weights = training.weight_rows(spark, inputs.fitted(spark, d).weights)
    stored = runs.publish_head(weights, inputs.model_versions(spark, d), new_path(spark, "registry"), "READY", RUN_ID)
    return stored.select("version", "status", "run_id", "head", "row", F.size("weights").alias("dims"))


def row_counts(spark: SparkSession, d: str) -> DataFrame:
    return tables.row_count(inputs.stored_pairs(spark, d), "pairs").unionByName(
        tables.row_count(inputs.stored_results(spark, d), "results")
    )


# --- pairs ------------------------------------------------------------------------------------


def captions_by_image(spark: SparkSession, d: str) -> DataFrame:
    return pairs.captions_by_image(inputs.captions(spark, d))


def caption_totals(spark: SparkSession, d: str) -> DataFrame:
    return pairs.caption_totals(inputs.captions(spark, d))


def eligible_images(spark: SparkSession, d: str) -> DataFrame:
    return pairs.eligible_images(inputs.captions(spark, d))


def sample_images(spark: SparkSession, d: str) -> DataFrame:
    return pairs.sample_images(eligible_images(spark, d), SAMPLE_SIZE)


def image_paths(spark: SparkSession, d: str) -> DataFrame:
    ids = eligible_images(spark, d).select("image_id")
    return pairs.image_paths(ids, inputs.images(spark, d), inputs.IMAGE_ROOT)


def captions_of_loaded(spark: SparkSession, d: str) -> DataFrame:
    return pairs.captions_of_loaded(inputs.captions(spark, d), inputs.outcomes(spark, d))


def sample_negatives(spark: SparkSession, d: str) -> DataFrame:
    return pairs.sample_negatives(inputs.loaded_captions(spark, d))


def assign_split(spark: SparkSession, d: str) -> DataFrame:
    docs = inputs.table(spark, d, "documents")
    return docs.select("doc_id", _r(uniform(fixed.SEED, "doc_id"), 9).alias("u"), pairs.assign_split("doc_id").alias("split"))


def split_counts(spark: SparkSession, d: str) -> DataFrame:
    return pairs.split_counts(inputs.stored_pairs(spark, d))


def split_counts_wide(spark: SparkSession, d: str) -> DataFrame:
    return pairs.split_counts_wide(inputs.stored_pairs(spark, d))


def pair_preview(spark: SparkSession, d: str) -> DataFrame:
    return pairs.pair_preview(inputs.stored_pairs(spark, d))


def distinct_categories(spark: SparkSession, d: str) -> DataFrame:
    return pairs.distinct_categories(tables.scan_split(inputs.stored_pairs(spark, d), "train"))


# --- vectors ----------------------------------------------------------------------------------


def l2_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Normalises vectors stretched by their label; norm, sum and projection describe the result."""
    rows = inputs.image_vectors(spark, d)
    stretched = F.transform("emb", lambda x: x * (F.col("label") + 2))
    unit = rows.select("image_id", "emb", V.l2_normalize(stretched).alias("unit"))
    total = F.aggregate("unit", F.lit(0.0), lambda acc, x: acc + x)
    return unit.select(
        "image_id",
        _r(V.l2_norm("unit")).alias("norm"),
        _r(total).alias("total"),
        _r(V.dot("unit", "emb")).alias("projection"),
    )


def dot_product(spark: SparkSession, d: str) -> DataFrame:
    return inputs.triplets(spark, d).select("image_id", _r(V.dot("img", "pos")).alias("dot"))


def cosine_similarity(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.triplets(spark, d)
    return rows.select("image_id", _r(V.cosine("pos", "neg")).alias("cosine"))


def pair_scores(spark: SparkSession, d: str) -> DataFrame:
    rows = scoring.pair_scores(inputs.triplets(spark, d))
    return rows.withColumns({"pos_score": _r("pos_score"), "neg_score": _r("neg_score")})


def base64_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    docs = inputs.table(spark, d, "documents").select("doc_id", F.col("text").cast("binary").alias("raw"))
    docs = docs.withColumn("image_base64", T.encode_base64(F.col("raw")))
    return docs.select(
        "doc_id",
        F.md5("image_base64").alias("base64_md5"),
        F.length("image_base64").cast("bigint").alias("n_base64"),
        (F.unbase64("image_base64") == F.col("raw")).alias("same"),
    )


def encode_texts(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(inputs.table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    sparse = encoders.encode_texts(docs, "doc_id", "text")
    return sparse.withColumn("weight", _r("weight"))


def pluggable_encoder(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(inputs.table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    docs = docs.select("doc_id", F.col("text").cast("binary").alias("content"))
    vectors = encoders.encode_images(docs, "doc_id", "content", encoders.byte_histogram())
    total = F.aggregate("emb", F.lit(0.0), lambda acc, x: acc + x)
    return vectors.select("doc_id", F.size("emb").alias("dims"), _r(V.l2_norm("emb")).alias("norm"), _r(total).alias("total"))


# --- tagging ----------------------------------------------------------------------------------


def tag_prompts(spark: SparkSession, d: str) -> DataFrame:
    labels = inputs.table(spark, d, "embeddings").select("label").distinct()
    tag = F.concat(F.lit("tag_"), F.col("label").cast("string"))
    return labels.select(tag.alias("tag"), T.tag_prompt(tag).alias("prompt"))


def tag_images(spark: SparkSession, d: str) -> DataFrame:
    return _ranked_rows(inputs.tagged_images(spark, d), "image_id", "selected")


def rank_tags(spark: SparkSession, d: str) -> DataFrame:
    return _ranked_rows(inputs.tagged_images(spark, d), "image_id", "ranked")


def select_tags(spark: SparkSession, d: str) -> DataFrame:
    tagged = inputs.tagged_images(spark, d)
    best = F.get("ranked", F.lit(0))["score"]
    return tagged.select(
        "image_id", F.size("selected").alias("num_tags"), (best < fixed.TAG_SCORE_THRESHOLD).alias("used_fallback")
    )


def tag_overrides(spark: SparkSession, d: str) -> DataFrame:
    asked = tables.check_columns(
        inputs.requests(spark, d),
        required={"emb": "array<double>"},
        optional={"tag_candidates_json": "string", "tag_score_threshold": "string"},
    )
    tagged = scoring.tag_images(asked, inputs.tag_table(spark, d), "tag_candidates_json", "tag_score_threshold")
    return _ranked_rows(tagged, "image_id", "selected")


def tag_custom_candidates(spark: SparkSession, d: str) -> DataFrame:
    names = F.array(
        *[F.concat(F.lit("tag_"), F.pmod(F.col("label") + i, F.lit(10)).cast("string")) for i in (0, 3, 6, 9)]
    )
    asked = inputs.image_vectors(spark, d).withColumn("wanted", F.to_json(names))
    tagged = scoring.tag_images(asked, inputs.tag_table(spark, d), "wanted")
    return _ranked_rows(tagged, "image_id", "ranked")


def tag_many_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Each image asks for three of the documents' tags, one tag per document, through the join."""
    docs = spread(inputs.table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    emb = encoders.dense_vectors(encoders.encode_texts(docs, "doc_id", "text"), "doc_id")
    tag = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"))
    tags = materialize(emb.select(tag.alias("tag"), F.col("doc_id").alias("pos"), "emb"), "document_tags")
    n = inputs.table(spark, d, "documents").agg(F.max("doc_id") + 1).scalar()
    images = inputs.image_vectors(spark, d).withColumn("_n", n)
    names = [F.concat(F.lit("doc_"), F.pmod(F.col("image_id") * 7 + i, F.col("_n")).cast("string")) for i in (0, 31, 77)]
    asked = images.select("image_id", "emb", F.to_json(F.array(*names, F.lit("doc_none"))).alias("wanted"))
    return _ranked_rows(scoring.tag_images(asked, tags, "wanted", by_join=True), "image_id", "ranked")


def tag_image_files(spark: SparkSession, d: str) -> DataFrame:
    """From a folder of files to tags: files of five kinds are written, then listed, read and tagged.

    A document's bytes are a file's content and its id gives the extension, so that only some are
    images. Every eleventh file is empty: it is listed, flagged and gets no tags.
    """
    kinds = F.array(*[F.lit(k) for k in ("jpg", "PNG", "txt", "JpEg", "mp4")])
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit("."), F.get(kinds, F.pmod("doc_id", F.lit(5)).cast("int")))
    content = F.when(F.pmod("doc_id", F.lit(11)) != 0, F.col("text")).otherwise(F.lit("")).cast("binary")
    docs = spread(inputs.table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    folder = new_path(spark, "image_files")
    file_source.write_files(docs.select(name.alias("filename"), content.alias("content")), folder)
    images = file_source.scan_files(spark, folder)
    answers = scoring.predict(image_source.build_requests(images, None), inputs.tag_table(spark, d), encoders.byte_histogram(), "filename")
    tags = F.from_json(F.get_json_object("prediction.tags_json", "$.tags"), fixed.TAGS_DDL)
    rows = answers.select("filename", "load_ok", F.posexplode_outer(tags).alias("pos", "t"))
    return rows.select("filename", "load_ok", "pos", "t.tag", "t.score")


def batch_infer_sql(spark: SparkSession, d: str) -> DataFrame:
    """The tagger as a SQL function over requests; it returns the response struct."""
    docs = spread(inputs.table(spark, d, "documents").select("doc_id", "text", "lang"), "doc_id")
    limit = F.when(F.col("lang") == "en", "0.5").when(F.col("lang") == "de", "bad")
    asked = docs.select("doc_id", T.encode_base64(F.col("text").cast("binary")).alias("image_base64"), limit.alias("tag_score_threshold"))
    asked.createOrReplaceTempView("tagger_requests")
    scoring.register_tagger(spark, inputs.tag_table(spark, d), "tag_image", encoders.byte_histogram())
    answers = spark.sql(
        "SELECT doc_id AS filename, tag_image(image_base64, CAST(NULL AS STRING), tag_score_threshold) AS prediction FROM tagger_requests"
    )
    tags = F.from_json(F.get_json_object("prediction.tags_json", "$.tags"), fixed.TAGS_DDL)
    return _ranked_rows(answers.select("filename", tags.alias("tags")), "filename", "tags")


def _decoded(rows: DataFrame) -> DataFrame:
    return rows.select(
        "filename",
        F.from_json(F.get_json_object("prediction.tags_json", "$.tags"), fixed.TAGS_DDL).alias("tags"),
        F.from_json(F.get_json_object("prediction.tags_json", "$.all_scores"), fixed.TAGS_DDL).alias("all_scores"),
        F.from_json("prediction.embedding", "array<double>").alias("emb"),
        F.col("prediction.metrics_json").alias("metrics_json"),
    )


def batch_infer(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("IMG_"), F.col("image_id").cast("string"), F.lit(".jpg"))
    rows = _decoded(scoring.batch_infer(inputs.tagged_images(spark, d), name))
    return rows.select(
        "filename",
        F.size("tags").alias("num_tags"),
        F.size("all_scores").alias("num_scores"),
        F.size("emb").alias("dims"),
        _r(V.l2_norm("emb")).alias("norm"),
        "metrics_json",
    )


def predict_requests(spark: SparkSession, d: str) -> DataFrame:
    """Requests with the documents as image bytes and a threshold that depends on the language."""
    docs = spread(inputs.table(spark, d, "documents").select("doc_id", "text", "lang"), "doc_id")
    limit = F.when(F.col("lang") == "en", "0.5").when(F.col("lang") == "de", "bad")
    asked = docs.select(
        F.col("doc_id").alias("filename"),
        T.encode_base64(F.col("text").cast("binary")).alias("image_base64"),
        limit.alias("tag_score_threshold"),
    )
    answers = scoring.predict(asked, inputs.tag_table(spark, d), encoders.byte_histogram(), "filename")
    tags = F.from_json(F.get_json_object("prediction.tags_json", "$.tags"), fixed.TAGS_DDL)
    return _ranked_rows(answers.select("filename", tags.alias("tags")), "filename", "tags")


def encode_response(spark: SparkSession, d: str) -> DataFrame:
    rows = _decoded(inputs.responses(spark, d))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("list")) for k in ("tags", "all_scores")])
    rows = rows.select("filename", F.inline(kinds)).select("filename", "kind", F.posexplode("list").alias("pos", "t"))
    return rows.select("filename", "kind", "pos", "t.tag", "t.score")


def flatten_results(spark: SparkSession, d: str) -> DataFrame:
    flat = analytics.flatten_results(inputs.responses(spark, d))
    decoded = flat.withColumn("tags", F.from_json("tags", fixed.TAGS_DDL))
    return _ranked_rows(decoded, "filename", "tags")


def response_preview(spark: SparkSession, d: str) -> DataFrame:
    """The preview of a temp view, with its JSON decoded so that numbers compare."""
    inputs.responses(spark, d).createOrReplaceTempView("inference_results")
    preview = analytics.response_preview(spark.table("inference_results"))
    first = F.regexp_extract("embedding_preview", r"^\[([^,]+),", 1).cast("double")
    tags = F.from_json(F.get_json_object("tags_json", "$.tags"), fixed.TAGS_DDL)
    return preview.select(
        "filename",
        "metrics_json",
        F.size(tags).alias("num_tags"),
        F.length("embedding_preview").alias("preview_chars"),
        _r(first).alias("first_value"),
    )


def top_scores_per_image(spark: SparkSession, d: str) -> DataFrame:
    return analytics.top_scores_per_image(inputs.responses(spark, d))


def tag_score_counts(spark: SparkSession, d: str) -> DataFrame:
    return analytics.tag_score_counts(inputs.stored_results(spark, d))


def tag_counts(spark: SparkSession, d: str) -> DataFrame:
    return analytics.tag_counts(inputs.stored_results(spark, d))


def tags_per_image(spark: SparkSession, d: str) -> DataFrame:
    return analytics.tags_per_image(inputs.stored_results(spark, d))


def parse_embeddings(spark: SparkSession, d: str) -> DataFrame:
    return analytics.embedding_summary(inputs.stored_results(spark, d))


def embedding_dims(spark: SparkSession, d: str) -> DataFrame:
    return analytics.embedding_dims(inputs.stored_results(spark, d))


def parse_metrics(spark: SparkSession, d: str) -> DataFrame:
    return analytics.parse_metrics(inputs.metrics_json(spark, d))


def first_n_images(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.stored_results(spark, d).select("filename")
    return image_source.first_n_images(rows, FIRST_IMAGES)


def similar_images(spark: SparkSession, d: str) -> DataFrame:
    best = retrieval.similar_images(inputs.image_vectors(spark, d), 0, "image_id")
    return best.withColumn("similarity", _r("similarity"))


def similar_results(spark: SparkSession, d: str) -> DataFrame:
    best = retrieval.similar_results(inputs.stored_results(spark, d), "IMG_3.jpg")
    return best.withColumn("similarity", _r("similarity"))


# --- evaluation and runs ----------------------------------------------------------------------


def recall_at_1(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.baseline_rows(spark, d).select(F.lit("all").alias("split"), "id", "img", "txt")
    return retrieval.recall_at_1(rows, ["split"]).withColumn("recall_at_1", _r("recall_at_1"))


def recall_at_1_copies(spark: SparkSession, d: str) -> DataFrame:
    """The mean of its label as the text of each image: equal texts, of which the lowest id wins."""
    means = inputs.tag_table(spark, d).select(F.col("pos").alias("label"), F.col("emb").alias("txt"))
    rows = inputs.image_vectors(spark, d).join(F.broadcast(means), "label")  # one row per label
    rows = rows.select(F.lit("all").alias("split"), F.col("image_id").alias("id"), F.col("emb").alias("img"), "txt")
    return retrieval.recall_at_1(rows, ["split"]).withColumn("recall_at_1", _r("recall_at_1"))


def triplet_accuracy(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.baseline_rows(spark, d)
    return retrieval.triplet_accuracy(rows, ["split"]).withColumn("triplet_accuracy", _r("triplet_accuracy"))


def evaluate_splits(spark: SparkSession, d: str) -> DataFrame:
    metrics = retrieval.evaluate(inputs.baseline_rows(spark, d), ["split"])
    return metrics.select("split", _r("recall_at_1").alias("recall_at_1"), _r("triplet_accuracy").alias("triplet_accuracy"))


def metric_delta(spark: SparkSession, d: str) -> DataFrame:
    delta = retrieval.metric_delta(retrieval.evaluate(inputs.phase_rows(spark, d), ["phase", "split"]))
    return delta.select("split", "metric", *[_r(c).alias(c) for c in ("baseline", "final", "delta")])


def best_epoch(spark: SparkSession, d: str) -> DataFrame:
    best = runs.best_epoch(inputs.training_log(spark, d), ["run_id"])
    return best.withColumn("best_recall", _r("best_recall"))


def running_best(spark: SparkSession, d: str) -> DataFrame:
    log = runs.running_best(inputs.training_log(spark, d), ["run_id"])
    return log.withColumns({"recall": _r("recall"), "best_so_far": _r("best_so_far")})


def trainable_share(spark: SparkSession, d: str) -> DataFrame:
    return runs.trainable_share(inputs.model_params(spark, d), TRAINABLE_PARTS)


def latest_version(spark: SparkSession, d: str) -> DataFrame:
    return runs.latest_version(inputs.model_versions(spark, d), ["model"])


def recent_versions(spark: SparkSession, d: str) -> DataFrame:
    return runs.recent_versions(inputs.model_versions(spark, d))


# --- training ---------------------------------------------------------------------------------


def assign_batches(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.image_vectors(spark, d).select(pairs.assign_split("image_id").alias("split"), "image_id")
    return pairs.assign_batches(rows, ["split"], "image_id")


def contrastive_loss(spark: SparkSession, d: str) -> DataFrame:
    rows = inputs.baseline_rows(spark, d).select("split", "id", "img", "txt")
    losses = training.contrastive_loss(pairs.assign_batches(rows, ["split"], "id"), ["split"])
    return losses.withColumn("loss", _r("loss"))


def _epoch_losses(spark: SparkSession, d: str) -> DataFrame:
    return training.epoch_loss(inputs.fitted(spark, d).steps, ["epoch"])


def epoch_loss(spark: SparkSession, d: str) -> DataFrame:
    return _epoch_losses(spark, d).withColumn("loss", _r("loss"))


def head_gradient(spark: SparkSession, d: str) -> DataFrame:
    """Loss and both gradient sums at identity heads, over all train batches, one row per cell."""
    rows = inputs.baseline_rows(spark, d).where("split = 'train'").select("split", "id", "img", "txt")
    packed = training.pack_batches(pairs.assign_batches(rows, ["split"], "id"), ["split"]).select("n", "img", "txt")
    total, _, gradients = training.summed_gradients(packed, training.identity_heads(rows), V.Logits())
    cells = training.weight_rows(spark, gradients).select("head", "row", F.posexplode("weights").alias("col", "value"))
    loss = spark.createDataFrame([("loss", 0, 0, total)], "head string, row int, col int, value double")
    return cells.unionByName(loss).withColumn("value", _r("value"))


def fit_heads(spark: SparkSession, d: str) -> DataFrame:
    log = training.log_frame(spark, inputs.fitted(spark, d).log)
    return log.withColumns({c: _r(c) for c in ("loss", "valid_recall_at_1", "valid_triplet_accuracy")})


def fit_steps(spark: SparkSession, d: str) -> DataFrame:
    """Every optimiser step of the fit, with the loss of its batch before the update."""
    return inputs.fitted(spark, d).steps.withColumn("loss", _r("loss"))


def fitted_heads(spark: SparkSession, d: str) -> DataFrame:
    """The heads after the last step, one row per cell."""
    rows = training.weight_rows(spark, inputs.fitted(spark, d).weights)
    return rows.select("head", "row", F.posexplode("weights").alias("col", "value")).withColumn("value", _r("value"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        scan_captions, scan_images, scan_split, scan_results, typed_pairs, build_requests, load_with_placeholder,
        resume_ingest, ingest_outcomes, ingest_ledger, ingest_batch_counts, write_pairs, write_results, run_metrics, run_params, logged_metrics, logged_params, register_head, row_counts,
        captions_by_image, caption_totals, eligible_images, sample_images, image_paths, captions_of_loaded,
        sample_negatives, assign_split, split_counts, split_counts_wide, pair_preview, distinct_categories,
        l2_normalize, dot_product, cosine_similarity, pair_scores, base64_roundtrip, encode_texts, pluggable_encoder,
        tag_prompts, tag_images, rank_tags, select_tags, tag_overrides, tag_custom_candidates, tag_many_candidates, batch_infer,
        batch_infer_sql, tag_image_files, predict_requests, encode_response, flatten_results, response_preview, top_scores_per_image, tag_score_counts, tag_counts,
        tags_per_image, parse_embeddings, embedding_dims, parse_metrics, first_n_images, similar_images, similar_results, recall_at_1, recall_at_1_copies,
        triplet_accuracy, evaluate_splits, metric_delta, best_epoch, running_best, trainable_share, latest_version,
        recent_versions, assign_batches, contrastive_loss, epoch_loss, head_gradient, fit_heads, fit_steps, fitted_heads,
    )
}
