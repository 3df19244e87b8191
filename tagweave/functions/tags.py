"""Tag lists and the tagger's JSON response, as column expressions."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagweave import fixed_values as fixed


def tag_prompt(tag: Column) -> Column:
    return F.concat(F.lit(fixed.PROMPT_PREFIX), tag, F.lit(fixed.PROMPT_SUFFIX))


def rank_tags(tags: Column, scores: Column) -> Column:
    """Pair tags with rounded scores, best first; equal scores keep the candidate order.

    Scores are rounded before they are sorted. A tag without a score goes last.
    """
    paired = F.zip_with(tags, scores, lambda t, s: F.struct(t.alias("tag"), F.round(s, fixed.SCORE_DECIMALS).alias("score")))
    keyed = F.transform(
        paired,
        lambda p, i: F.struct(
            F.coalesce(-p["score"], F.lit(float("inf"))).alias("key"), i.alias("pos"), p.alias("pair")
        ),
    )
    return F.transform(F.array_sort(keyed), lambda k: k["pair"])


def select_tags(ranked: Column, threshold: Column, fallback: int = fixed.FALLBACK_TAGS) -> Column:
    """Tags at or above the threshold, or the best few when none is."""
    passing = F.filter(ranked, lambda p: p["score"] >= threshold)
    return F.when(F.size(passing) > 0, passing).otherwise(F.slice(ranked, 1, fallback))


def threshold_or_default(threshold: Column, default: float = fixed.TAG_SCORE_THRESHOLD) -> Column:
    """The threshold travels as text; text that is no number counts as absent."""
    return F.coalesce(threshold.try_cast("double"), F.lit(default))


def parse_list(text: str | None) -> list[str] | None:
    """A JSON list of tags, or None for what is no list."""
    try:
        found = json.loads(text) if text else None
    except ValueError:
        return None
    return [t if isinstance(t, str) else json.dumps(t) for t in found] if isinstance(found, list) else None


def parse_number(text: str | None, default: float) -> float:
    try:
        return float(text) if text else default
    except ValueError:
        return default


def encode_base64(content: Column) -> Column:
    """Base64 on one line, whatever the session says about chunking."""
    one_line = F.replace(F.base64(content), F.lit("\r\n"), F.lit(""))
    return F.replace(one_line, F.lit("\n"), F.lit(""))


def encode_response(
    selected: Column, ranked: Column, embedding: Column, inference_time_ms: Column | None = None
) -> Column:
    """The tagger's answer: three JSON texts in a struct. Metrics not measured stay null."""
    none = F.lit(None).cast("double")
    metrics = F.struct(
        (none if inference_time_ms is None else F.round(inference_time_ms, 1)).alias("inference_time_ms"),
        none.alias("gpu_memory_allocated_mb"),
        none.alias("gpu_memory_peak_mb"),
        none.alias("gpu_utilization_pct"),
    )
    return F.struct(
        F.to_json(F.struct(selected.alias("tags"), ranked.alias("all_scores"))).alias("tags_json"),
        F.to_json(embedding).alias("embedding"),
        F.to_json(metrics, {"ignoreNullFields": "false"}).alias("metrics_json"),
    )
