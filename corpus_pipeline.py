"""A training corpus from raw documents, in stages that are written and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm import bpe, decontaminate, jaccard, pii, queries, toxicity
from tagweave.llm.common import table
from tagweave.session import new_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Shingles of five words and a similarity of 0.8 make a near-duplicate.
SHINGLE, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; it learns from the labels of ``sf_dir``."""
    model = toxicity.fit(docs, queries.training_labels(spark, sf_dir), "doc_id", "text", "toxic")
    return toxicity.score(docs, "text", model, "_toxicity").where(F.col("_toxicity") < queries.TOXIC_FROM).drop("_toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return jaccard.representatives(docs, "doc_id", "text", SHINGLE, PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked, and their new lengths."""
    masked = pii.mask(docs, "text")
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, text)``: token ids, and the text that they decode to."""
    path = public_tokenizers.path(queries.RANKS)
    decoded = bpe.round_trip(docs, "doc_id", "text", path, public_tokenizers.PATTERN)
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("text"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("byte_bpe", encode),
]

# Fitted scores, similarity links and merges have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"stage_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
