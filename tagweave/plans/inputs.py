"""The operators' inputs, derived from the given tables by Spark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions import tags as T
from tagweave.functions import vectors as V
from tagweave.functions.numbers import int_div
from tagweave.operators import analytics, pairs, scoring, training
from tagweave.session import materialize, new_path
from tagweave.sources import tables

IMAGE_ROOT = "/images"
LANGS = ["en", "de", "fr", "es"]

_WRITTEN: dict[tuple[str, str, str], DataFrame] = {}


def written_once(spark: SparkSession, d: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table that is written on first use in this application and scanned after that."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _WRITTEN:
        _WRITTEN[key] = build()
    return _WRITTEN[key]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# --- captions and pairs, from documents and labels -------------------------------------------


def image_of(doc_id: Column, lang: Column) -> Column:
    """Image id of a document: four neighbouring documents in one language describe one image."""
    code = F.lit(len(LANGS))
    for i, name in enumerate(LANGS):
        code = F.when(lang == name, i).otherwise(code)
    return int_div(doc_id, 4) * 10 + code


def captions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        image_of(F.col("doc_id"), F.col("lang")).alias("image_id"),
        F.col("doc_id").alias("cap_no"),
        F.col("text").alias("caption"),
    )


def images(spark: SparkSession, d: str) -> DataFrame:
    ids = captions(spark, d).select(F.col("image_id").alias("id")).distinct()
    return ids.select("id", F.concat(F.lit("IMG_"), F.col("id").cast("string"), F.lit(".jpg")).alias("file_name"))


def outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Ingest outcome per image: it failed if a label marks one of its documents as toxic."""
    toxic = table(spark, d, "labels").select(F.col("doc_id").alias("cap_no"), "toxic")
    marked = captions(spark, d).select("image_id", "cap_no").join(toxic, "cap_no", "left")
    per_image = marked.groupBy("image_id").agg((F.max(F.coalesce("toxic", F.lit(0))) == 0).alias("ok"))
    name = F.concat(F.lit("IMG_"), F.col("image_id").cast("string"), F.lit(".jpg"))
    path = F.when(F.col("ok"), F.concat(F.lit(IMAGE_ROOT + "/"), name)).otherwise(F.concat(F.lit("failed: "), name))
    return per_image.select("image_id", path.alias("path_or_err"), "ok")


def usable_images(spark: SparkSession, d: str) -> DataFrame:
    """Outcomes of the images with enough captions, with their number of captions."""
    rows = pairs.eligible_images(captions(spark, d)).join(outcomes(spark, d), "image_id")
    return materialize(rows, "usable_images")


def loaded_captions(spark: SparkSession, d: str) -> DataFrame:
    return pairs.captions_of_loaded(captions(spark, d), usable_images(spark, d))


def pair_table(spark: SparkSession, d: str) -> DataFrame:
    return pairs.build_pairs(captions(spark, d), images(spark, d), usable_images(spark, d), IMAGE_ROOT)


def write_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Overwrite the pair table, stored by split; later queries read what was written last."""
    stored = tables.save_table(
        pair_table(spark, d), _table_name("training_image_text_pairs", d), new_path(spark, "pairs"), ["split"]
    )
    _WRITTEN[spark.sparkContext.applicationId, d, "pairs"] = stored
    return stored.select(*pairs.PAIR_COLUMNS)


def stored_pairs(spark: SparkSession, d: str) -> DataFrame:
    return written_once(spark, d, "pairs", lambda: write_pairs(spark, d)).select(*pairs.PAIR_COLUMNS)


def _table_name(name: str, d: str) -> str:
    return name + "_" + "".join(c if c.isalnum() else "_" for c in d).strip("_").lower()


# --- vectors, from embeddings -----------------------------------------------------------------


def image_vectors(spark: SparkSession, d: str) -> DataFrame:
    """``(image_id, label, emb)`` in double precision."""
    return table(spark, d, "embeddings").select(
        F.col("vec_id").alias("image_id"), "label", V.doubles("embedding").alias("emb")
    )


def triplets(spark: SparkSession, d: str) -> DataFrame:
    """``(image_id, img, pos, neg)``: the text of an image is its vector mixed with the next one's.

    The negative is the text of the image before. Ids wrap around; an image without a
    neighbour mixes with itself.
    """
    vectors = image_vectors(spark, d).select("image_id", "emb")
    n = vectors.agg(F.max("image_id") + 1).scalar()
    base = vectors.select("image_id", F.col("emb").alias("img"))
    base = base.withColumn("_n", n)
    after = vectors.select(F.col("image_id").alias("after_id"), F.col("emb").alias("after"))
    before = vectors.select(F.col("image_id").alias("before_id"), F.col("emb").alias("before"))
    rows = base.join(after, F.pmod(F.col("image_id") + 1, F.col("_n")) == F.col("after_id"), "left")
    rows = rows.join(before, F.pmod(F.col("image_id") - 1, F.col("_n")) == F.col("before_id"), "left")

    def text(own: Column, other: Column) -> Column:
        return V.l2_normalize(F.zip_with(own, other, lambda x, y: x + y))

    img = F.col("img")
    return rows.select(
        "image_id",
        "img",
        text(img, F.coalesce("after", img)).alias("pos"),
        text(F.coalesce("before", img), img).alias("neg"),
    )


def evaluation_rows(spark: SparkSession, d: str) -> DataFrame:
    """``(split, id, img, txt, neg)``; the train split has no negatives."""
    rows = triplets(spark, d).withColumn("split", pairs.assign_split("image_id"))
    neg = F.when(F.col("split") != "train", F.col("neg"))
    return rows.select("split", F.col("image_id").alias("id"), "img", F.col("pos").alias("txt"), neg.alias("neg"))


def baseline_rows(spark: SparkSession, d: str) -> DataFrame:
    """Evaluation rows before training. Stored, as encoded vectors would be, because every metric reads them again."""
    return written_once(spark, d, "baseline_rows", lambda: materialize(evaluation_rows(spark, d), "baseline_rows"))


_FITTED: dict[tuple[str, str], training.Fit] = {}


def fitted(spark: SparkSession, d: str) -> training.Fit:
    """Heads fitted on the train split, one step per batch."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _FITTED:
        _FITTED[key] = training.fit_heads(baseline_rows(spark, d))
    return _FITTED[key]


def phase_rows(spark: SparkSession, d: str) -> DataFrame:
    """Evaluation rows before training, and the same behind the fitted heads."""

    def write() -> DataFrame:
        before = baseline_rows(spark, d)
        after = training.apply_heads(before, fitted(spark, d).weights).withColumn("phase", F.lit("final"))
        return materialize(before.withColumn("phase", F.lit("baseline")).unionByName(after), "phase_rows", ["phase"])

    return written_once(spark, d, "phase_rows", write)


def tag_table(spark: SparkSession, d: str) -> DataFrame:
    """``(tag, pos, emb)``: one candidate tag per label, its vector the mean of the label's images.

    Stored, since scoring looks at its size before reading it.
    """

    def write() -> DataFrame:
        means = scoring.mean_vectors(table(spark, d, "embeddings"), "label", "embedding")
        name = F.concat(F.lit("tag_"), F.col("label").cast("string"))
        return materialize(means.select(name.alias("tag"), F.col("label").alias("pos"), "emb"), "tags")

    return written_once(spark, d, "tags", write)


def tagged_images(spark: SparkSession, d: str) -> DataFrame:
    return scoring.tag_images(image_vectors(spark, d), tag_table(spark, d))


def requests(spark: SparkSession, d: str) -> DataFrame:
    """Images with override columns that depend on the label: absent, good and bad values occur."""
    names = [F.concat(F.lit("tag_"), F.pmod(F.col("label") + i, F.lit(10)).cast("string")) for i in (2, 0, 1)]
    listed = F.when(F.col("label") < 5, F.to_json(F.array(*names)))
    limit = F.when(F.col("label") < 4, F.lit(None)).when(F.col("label") < 7, F.lit("0.5")).otherwise(F.lit("bad"))
    return image_vectors(spark, d).withColumns(
        {"tag_candidates_json": listed, "tag_score_threshold": limit.cast("string")}
    )


def responses(spark: SparkSession, d: str) -> DataFrame:
    """Stored tagger responses. They are written before use, so that inference runs once."""
    name = F.concat(F.lit("IMG_"), F.col("image_id").cast("string"), F.lit(".jpg"))

    def write() -> DataFrame:
        return materialize(scoring.batch_infer(tagged_images(spark, d), name), "responses")

    return written_once(spark, d, "responses", write)


def write_results(spark: SparkSession, d: str) -> DataFrame:
    """Overwrite the result table; later queries read what was written last."""
    flat = analytics.flatten_results(responses(spark, d))
    stored = tables.save_table(flat, _table_name("image_inference_results", d), new_path(spark, "results"))
    _WRITTEN[spark.sparkContext.applicationId, d, "results"] = stored
    return stored


def stored_results(spark: SparkSession, d: str) -> DataFrame:
    return written_once(spark, d, "results", lambda: write_results(spark, d))


# --- logs, versions and parameters ------------------------------------------------------------


def training_log(spark: SparkSession, d: str) -> DataFrame:
    """``(run_id, epoch, recall)``: a user is a run, a day an epoch, recall the share of large values."""
    events = table(spark, d, "events")
    day = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) + 1
    large = (F.col("value") > 50).cast("double")
    log = events.groupBy(F.col("user_id").alias("run_id"), day.alias("epoch"))
    return log.agg(F.avg(large).alias("recall"))


def model_versions(spark: SparkSession, d: str) -> DataFrame:
    """Versions as text, one per order, under the order's priority as model name."""
    return table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("model"),
        F.col("o_orderkey").cast("string").alias("version"),
        F.col("o_orderstatus").alias("status"),
        F.md5(F.col("o_orderkey").cast("string")).alias("run_id"),
    )


def model_params(spark: SparkSession, d: str) -> DataFrame:
    """Named parameters with sizes, one per document."""
    name = F.concat_ws(".", F.concat("lang", F.lit("_model")), "source", F.col("doc_id").cast("string"))
    return table(spark, d, "documents").select(name.alias("name"), F.col("n_chars").alias("numel"))


def metrics_json(spark: SparkSession, d: str) -> DataFrame:
    """Metrics texts as the tagger writes them, one per event; memory was not measured."""
    none = F.lit(None).cast("double")
    body = F.struct(
        F.col("value").alias("inference_time_ms"),
        none.alias("gpu_memory_allocated_mb"),
        none.alias("gpu_memory_peak_mb"),
        F.get_json_object("props", "$.k").cast("double").alias("gpu_utilization_pct"),
    )
    return table(spark, d, "events").select(
        "event_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("metrics_json")
    )


def packed_files(spark: SparkSession, d: str, rows_per_file: int = 256) -> str:
    """A folder of files that hold the documents, an id and base64 content per line."""
    path = new_path(spark, "files")
    line = F.concat_ws("\t", F.col("doc_id").cast("string"), T.encode_base64(F.col("text").cast("binary")))
    table(spark, d, "documents").select(line).write.option("maxRecordsPerFile", rows_per_file).text(path)
    return path
