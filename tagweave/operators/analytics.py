"""Queries over stored tagger responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave import fixed_values as fixed
from tagweave.functions import vectors as V


def response_preview(responses: DataFrame, n: int = 10, width: int = 80) -> DataFrame:
    return responses.select(
        "filename",
        "prediction.tags_json",
        "prediction.metrics_json",
        F.left("prediction.embedding", F.lit(width)).alias("embedding_preview"),
    ).orderBy("filename").limit(n)


def flatten_results(responses: DataFrame) -> DataFrame:
    """The stored form: selected tags only, embedding and metrics, all as JSON text."""
    return responses.select(
        "filename",
        F.get_json_object("prediction.tags_json", "$.tags").alias("tags"),
        F.col("prediction.embedding").alias("embedding_json"),
        F.col("prediction.metrics_json").alias("metrics_json"),
    )


def _tags(results: DataFrame) -> DataFrame:
    tag = F.explode(F.from_json("tags", fixed.TAGS_DDL)).alias("tag")
    return results.select(tag).select("tag.tag", "tag.score")


def tag_score_counts(results: DataFrame, n: int = 20) -> DataFrame:
    """How often each tag has each score, most frequent first."""
    counts = _tags(results).groupBy("tag", "score").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "tag", F.desc("score")).limit(n)


def tag_counts(results: DataFrame) -> DataFrame:
    """How often each tag was selected, most frequent first; all tags."""
    counts = _tags(results).groupBy("tag").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "tag")


def tags_per_image(results: DataFrame) -> DataFrame:
    """Histogram of the number of tags; rows without readable tags count under null."""
    sized = results.select(F.size(F.from_json("tags", fixed.TAGS_DDL)).alias("num_tags"))
    return sized.groupBy("num_tags").agg(F.count("*").alias("image_count")).orderBy("num_tags")


def top_scores_per_image(responses: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` of all scores of each response, one row each."""
    scores = F.from_json(F.get_json_object("prediction.tags_json", "$.all_scores"), fixed.TAGS_DDL)
    top = responses.select("filename", F.posexplode(F.slice(scores, 1, n)).alias("pos", "s"))
    return top.select("filename", (F.col("pos") + 1).alias("rank"), "s.tag", "s.score")


def parse_embeddings(results: DataFrame) -> DataFrame:
    return results.select("filename", F.from_json("embedding_json", "array<double>").alias("emb"))


def embedding_dims(results: DataFrame) -> DataFrame:
    dims = parse_embeddings(results).select(F.size("emb").alias("dims"))
    return dims.groupBy("dims").agg(F.count("*").alias("image_count"))


def parse_metrics(results: DataFrame) -> DataFrame:
    """Metrics JSON as columns, memory and time to one decimal; what is not there is null."""
    m = results.select("*", F.from_json("metrics_json", fixed.METRICS_DDL).alias("m")).drop("metrics_json")
    rounded = [
        F.round(F.col(f"m.{name}"), 1).alias(name)
        for name in ("inference_time_ms", "gpu_memory_allocated_mb", "gpu_memory_peak_mb")
    ]
    return m.select("*", *rounded, F.col("m.gpu_utilization_pct")).drop("m")


def vector_summary(emb: Column) -> list[Column]:
    """Size, norm and sum of a vector, to check a decode by numbers."""
    total = F.aggregate(emb, F.lit(0.0), lambda acc, x: acc + x)
    return [F.size(emb).alias("dims"), F.round(V.l2_norm(emb), 6).alias("norm"), F.round(total, 6).alias("total")]


def embedding_summary(results: DataFrame) -> DataFrame:
    return parse_embeddings(results).select("filename", *vector_summary(F.col("emb")))
