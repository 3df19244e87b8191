"""Ranking, selection, overrides and the JSON response."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.functions import tags as T
from tagweave.operators import analytics, encoders, scoring
from tagweave.session import new_path
from tagweave.sources import images as image_source
from tagweave.sources import tables


def ranked(spark, tags, scores):
    row = spark.range(1).select(
        T.rank_tags(
            F.lit(tags).cast("array<string>") if tags else F.array().cast("array<string>"),
            F.array(*[F.lit(s) for s in scores]).cast("array<double>"),
        ).alias("r")
    )
    return row


def picked(spark, tags, scores, threshold=0.3):
    out = ranked(spark, tags, scores).select(T.select_tags(F.col("r"), F.lit(threshold)).alias("s")).first()["s"]
    return [(t["tag"], t["score"]) for t in out]


def test_equal_scores_keep_candidate_order(spark):
    out = ranked(spark, ["b", "a", "c"], [0.5, 0.5, 0.9]).first()["r"]
    assert [t["tag"] for t in out] == ["c", "b", "a"]


def test_rounding_comes_before_the_threshold(spark):
    assert picked(spark, ["a", "b"], [0.29996, 0.29994]) == [("a", 0.3)]


def test_best_three_when_none_passes(spark):
    assert [t for t, _ in picked(spark, list("abcd"), [0.1, 0.2, 0.05, 0.15])] == ["b", "d", "a"]
    assert picked(spark, ["a"], [0.1]) == [("a", 0.1)]


def test_empty_candidates(spark):
    assert picked(spark, [], []) == []


def images(spark):
    rows = [(i, [float(i == j) for j in range(3)], c, t) for i, c, t in [
        (0, None, None), (1, '["x", "unknown"]', "0.5"), (2, '["y", "x"]', "bad"), (0, "[]", None),
    ]]
    rows = [(n, *r[1:]) for n, r in enumerate(rows)]
    return spark.createDataFrame(rows, "image_id int, emb array<double>, c string, t string")


def tag_table(spark):
    rows = [("x", 0, [1.0, 0.0, 0.0]), ("y", 1, [0.0, 1.0, 0.0]), ("z", 2, [0.0, 0.6, 0.8])]
    return spark.createDataFrame(rows, "tag string, pos int, emb array<double>")


def score(sim):
    return round(1 / (1 + math.exp(-(10 * sim - 2.5))), 4)


def as_lists(df):
    return {r["image_id"]: ([tuple(x) for x in r["ranked"]], [tuple(x) for x in r["selected"]]) for r in df.collect()}


def test_overrides_and_unknown_tags(spark):
    got = as_lists(scoring.tag_images(images(spark), tag_table(spark), "c", "t"))
    assert got[0] == ([("x", score(1)), ("y", score(0)), ("z", score(0))], [("x", score(1))])
    # Neither known candidate passes 0.5, so both stay; the one without a score is last.
    assert got[1] == ([("x", score(0)), ("unknown", None)],) * 2
    assert got[2][0] == [("y", score(0)), ("x", score(0))]
    assert got[3] == ([], [])


def test_large_tag_table_gives_the_same_by_join(spark, monkeypatch):
    small = as_lists(scoring.tag_images(images(spark), tag_table(spark), "c", "t", ["x", "y", "z"]))
    monkeypatch.setattr(scoring, "TAG_MATRIX_ROWS", 1)
    large = as_lists(scoring.tag_images(images(spark), tag_table(spark), "c", "t", ["x", "y", "z"]))
    assert large == small
    assert as_lists(scoring.tag_images(images(spark), tag_table(spark), "c", "t")) == small


def test_both_paths_agree_on_repeated_ids(spark):
    rows = [(7, [1.0, 0.0, 0.0], '["x", "y"]'), (7, [0.0, 1.0, 0.0], '["x", "y"]'), (7, [0.0, 1.0, 0.0], None), (8, None, '["z", "x"]'),
            (None, [0.0, 0.0, 1.0], '["nobody"]'), (9, [1.0, 0.0, 0.0], "[]"), (9, [1.0, 0.0, 0.0], "[null]")]
    df = spark.createDataFrame(rows, "image_id int, emb array<double>, c string")
    got = [
        sorted(map(repr, scoring.tag_images(df, tag_table(spark), "c", by_join=way).collect())) for way in (False, True)
    ]
    assert got[0] == got[1] and len(got[0]) == len(rows)


def test_join_lists_the_tag_table_nowhere(spark, monkeypatch):
    small = as_lists(scoring.tag_images(images(spark), tag_table(spark), "c", "t", by_join=False))

    def refuse(tags):
        raise AssertionError("the tag table is listed whole")

    monkeypatch.setattr(scoring, "_all_tags", refuse)
    monkeypatch.setattr(scoring, "_tag_rows", refuse)
    assert as_lists(scoring.tag_images(images(spark), tag_table(spark), "c", "t", by_join=True)) == small
    listed = images(spark).where("c is not null")
    plan = scoring.tag_images(listed, tag_table(spark), "c", "t", by_join=True)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_rows_without_candidates_meet_the_tags_in_blocks(spark, monkeypatch):
    rng = random.Random(3)
    vector = lambda: [rng.gauss(0, 0.3) for _ in range(3)]
    tags = spark.createDataFrame([(f"tag{i}", i, vector()) for i in range(40)], "tag string, pos int, emb array<double>")
    # Repeated ids, a null vector, and a few rows with candidates of their own.
    rows = [(i % 90, None if i == 5 else vector(), '["tag3", "nobody"]' if i % 10 == 9 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "image_id int, emb array<double>, c string")
    want = sorted(map(repr, scoring.tag_images(df, tags, "c", by_join=False).collect()))
    monkeypatch.setattr(scoring, "BLOCK_IMAGES", 8)
    monkeypatch.setattr(scoring, "BLOCK_TAGS", 7)
    found = scoring.tag_images(df, tags, "c", by_join=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert sorted(map(repr, found.collect())) == want
    # Without any tag there is nothing to rank.
    assert {len(r.ranked) for r in scoring.tag_images(df.where("c is null"), tags.limit(0), by_join=True).collect()} == {0}


@pytest.mark.parametrize("bad", [[[1.0], [0.0, 1.0, 1.0]], [[1.0, None, 0.0]]])
def test_ragged_vectors_and_null_elements_are_errors(spark, bad):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(bad)], "image_id int, emb array<double>").coalesce(1)
    with pytest.raises(Exception, match="dimensions|null element"):
        scoring.tag_images(df, tag_table(spark)).collect()


def test_image_without_vector_scores_null(spark):
    rows = spark.createDataFrame([(1, None), (2, [0.0, 1.0, 0.0])], "image_id int, emb array<double>")
    got = as_lists(scoring.tag_images(rows, tag_table(spark)))
    assert got[1][0] == [("x", None), ("y", None), ("z", None)]
    assert got[2][0][0] == ("y", score(1))


def test_mean_vectors_equal_numpy_on_a_hot_label(spark):
    rng = np.random.default_rng(5)
    data = [(int(i) if i else 0, v.tolist()) for i, v in zip(rng.integers(0, 3, 300), rng.normal(size=(300, 6)))]
    df = spark.createDataFrame(data, "label int, e array<double>").repartition(5)
    got = {r["label"]: np.array(r["emb"]) for r in scoring.mean_vectors(df, "label", "e").collect()}
    for label in {d[0] for d in data}:
        mean = np.mean([d[1] for d in data if d[0] == label], axis=0)
        np.testing.assert_allclose(got[label], mean / np.linalg.norm(mean), atol=1e-12)


def test_response_round_trip(spark):
    tagged = scoring.tag_images(images(spark), tag_table(spark), "c", "t")
    responses = scoring.batch_infer(tagged, F.concat(F.lit("f"), F.col("image_id")))
    by_name = {r["filename"]: r["prediction"] for r in responses.collect()}
    body = json.loads(by_name["f0"]["tags_json"])
    assert body["tags"] == [{"tag": "x", "score": score(1)}] and len(body["all_scores"]) == 3
    assert json.loads(by_name["f0"]["embedding"]) == [1.0, 0.0, 0.0]
    assert set(json.loads(by_name["f0"]["metrics_json"]).values()) == {None}
    flat = analytics.flatten_results(responses)
    assert flat.columns == ["filename", "tags", "embedding_json", "metrics_json"]
    assert json.loads(flat.where("filename = 'f0'").first()["tags"]) == body["tags"]


def test_tags_with_other_scripts_survive_json(spark):
    r = ranked(spark, ["風景", "犬"], [0.4, 0.2]).select(F.to_json("r").alias("j")).first()["j"]
    assert "風景" in r


def test_histogram_keeps_unreadable_rows(spark):
    rows = spark.createDataFrame(
        [("a", '[{"tag":"x","score":0.5}]'), ("b", None), ("c", "[]")], "filename string, tags string"
    )
    got = {r["num_tags"]: r["image_count"] for r in analytics.tags_per_image(rows).collect()}
    assert got == {None: 1, 0: 1, 1: 1}


def test_metrics_with_missing_fields(spark):
    rows = spark.createDataFrame(
        [('{"inference_time_ms": 12.34, "gpu_memory_peak_mb": null}',), (None,)], "metrics_json string"
    )
    got = [r.asDict() for r in analytics.parse_metrics(rows).collect()]
    assert got[0]["inference_time_ms"] == 12.3 and got[0]["gpu_memory_peak_mb"] is None
    assert set(got[1].values()) == {None}


def test_scores_from_sql(spark):
    scoring.register_tag_scores(spark, tag_table(spark), "tag_scores")
    images(spark).createOrReplaceTempView("input_images")
    got = spark.sql("SELECT tag_scores(emb, array('x', 'z')) AS s FROM input_images ORDER BY image_id LIMIT 1").first()["s"]
    assert [round(s, 4) for s in got] == [score(1), score(0)]


def test_encode_base64_is_one_line(spark):
    got = spark.range(1).select(T.encode_base64(F.repeat(F.lit("x"), 1000).cast("binary")).alias("b")).first()["b"]
    assert "\n" not in got and "\r" not in got and len(got) == 1336


def test_images_are_scored_once_and_not_shuffled(spark):
    # Without default tags the plan also holds the small aggregate that lists them.
    tagged = scoring.tag_images(images(spark), tag_table(spark), "c", "t", ["x", "y", "z"])
    plan = tagged.select("image_id", F.explode("selected"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "Exchange" not in plan and "Join" not in plan


def test_sql_over_views_from_files_to_counts(spark, tmp_path):
    """The batch flow in SQL: requests view, inference view, preview, stored table, tag counts."""
    for i in range(6):
        (tmp_path / f"{i}.jpg").write_bytes(bytes([i % 3]) * 50)
    requests = image_source.build_requests(image_source.scan_images(spark, str(tmp_path)), ["x", "y", "z"])
    requests.createOrReplaceTempView("input_images")
    scoring.create_inference_view(
        spark, "input_images", "inference_results", tag_table(spark), encoders.byte_histogram(3)
    )
    preview = spark.sql(
        "SELECT filename, prediction.tags_json, prediction.metrics_json, LEFT(prediction.embedding, 80) AS e "
        "FROM inference_results ORDER BY filename LIMIT 10"
    ).collect()
    assert [r["filename"] for r in preview] == [f"{i}.jpg" for i in range(6)]
    assert json.loads(preview[0]["e"]) == [1.0, 0.0, 0.0]
    flat = spark.sql(
        "SELECT filename, get_json_object(prediction.tags_json, '$.tags') AS tags, "
        "prediction.embedding AS embedding_json, prediction.metrics_json AS metrics_json FROM inference_results"
    )
    tables.create_schema(spark, "tagging")
    stored = tables.save_table(flat, "tagging.some_results", new_path(spark, "r"))
    assert stored.count() == 6
    counts = {(r["tag"], r["score"]): r["count"] for r in analytics.tag_score_counts(stored).collect()}
    assert counts == {("x", score(1)): 2, ("y", score(1)): 2, ("z", score(0.8)): 2, ("z", score(0.6)): 2}
    spark.sql("DROP TABLE tagging.some_results")
    spark.sql("DROP SCHEMA tagging")


def test_requests_without_optional_columns(spark):
    rows = spark.createDataFrame([("a", "AAAA")], "filename string, image_base64 string")
    got = scoring.predict(rows, tag_table(spark), encoders.byte_histogram(3), "filename").first()
    assert json.loads(got["prediction"]["tags_json"])["tags"] == [{"tag": "x", "score": score(1)}]
    with pytest.raises(ValueError, match="image_base64"):
        scoring.predict(rows.drop("image_base64"), tag_table(spark), encoders.byte_histogram(3), "filename")


def test_sql_functions_refuse_a_tag_table_beyond_the_bound(spark, monkeypatch):
    tags = spark.createDataFrame([(f"t{i}", i, [1.0, 0.0]) for i in range(3)], "tag string, pos int, emb array<double>")
    scoring.register_tag_scores(spark, tags, "bounded_scores")
    monkeypatch.setattr(scoring, "TAG_MATRIX_ROWS", 2)
    with pytest.raises(ValueError, match="at most"):
        scoring.register_tag_scores(spark, tags, "bounded_scores")
    with pytest.raises(ValueError, match="at most"):
        scoring.register_tagger(spark, tags, "bounded_tagger", None)


def test_bytes_are_counted_in_pieces_of_bounded_memory():
    """Contents of any size, empty ones, some that end with a piece and a slice, against a plain count."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(4)
    sizes = [0, 0, 1, encoders.PIECE_BYTES - 1, 0, 5, encoders.PIECE_BYTES, 0, 3 * encoders.PIECE_BYTES + 7, 0, 40, *rng.integers(0, 3000, 4000), 0]
    contents = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in sizes]
    model = encoders.byte_histogram()()
    column = pa.array(contents, pa.binary())
    tracemalloc.start()
    got = model(column.slice(1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = [np.bincount(np.frombuffer(c, np.uint8) % 64, minlength=64) for c in contents[1:]]
    assert (got == np.array(want)).all()
    assert peak < 20e6, peak
    assert model(column.slice(0, 2)).tolist() == [[0.0] * 64] * 2 and model(column.slice(0, 0)).shape == (0, 64)
