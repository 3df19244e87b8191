"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm import bpe, decontaminate, jaccard, licenses, phrases, pii, ranking, runindex, spelling, syncmers, toxicity, urls, vectors
from tagweave.llm.common import table

RANKS = "byte_bpe_50k.tiktoken"
TOXIC_FROM = 0.3

URL_RULES: list[urls.Rule] = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.link(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), "n_links")


def op2_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runindex.dedup(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contaminated(docs, bench, "doc_id", "text", "item_id", "text")
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op4_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.dedup(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select("doc_id", "n_sentences", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, training_labels(spark, sf_dir), "doc_id", "text", "toxic")
    scored = toxicity.score(docs, "text", model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~toxicity.held_out(F.col("doc_id")))


def op7_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), "page_id", "url", URL_RULES, html_col="html")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    decoded = bpe.round_trip(table(spark, sf_dir, "documents"), "doc_id", "text", path, public_tokenizers.PATTERN)
    digits = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(digits, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    base = F.filter("spans", lambda s: s["base"])

    def n_of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select("doc_id", *map(n_of, pii.BASE_KINDS), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return found.select("vec_id", "n_links", F.col("component").alias("component_id"), "kept")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), "doc_id", "text")


def op12_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compare_with_next(table(spark, sf_dir, "documents"), "doc_id", "text")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranking.build_index(table(spark, sf_dir, "documents"), "doc_id", "text")
    return ranking.search(index, table(spark, sf_dir, "benchmark"), "item_id", "text").withColumnRenamed("doc", "doc_id")


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_run_length_index": op2_run_length_index,
    "op3_decontamination": op3_decontamination,
    "op4_phrase_automata": op4_phrase_automata,
    "op5_license_scan": op5_license_scan,
    "op6_toxicity": op6_toxicity,
    "op7_redirect_equivalence": op7_redirect_equivalence,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_pii": op9_pii,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_syncmer_fingerprints": op12_syncmer_fingerprints,
    "op13_ranked_search": op13_ranked_search,
}
