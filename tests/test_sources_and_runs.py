"""Files, tables, bookkeeping and encoders."""

import json
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagweave import fixed_values as fixed
from tagweave.functions import tags as T
from tagweave.operators import encoders, runs
from tagweave.session import materialize, new_path, shared_dir
from tagweave.sources import captions, images, tables


def test_one_caption_object_over_many_lines(spark, tmp_path):
    body = {
        "annotations": [{"image_id": 1, "caption": "犬が走る"}, {"image_id": 1, "caption": "b"}, {"image_id": 2, "caption": "c"}],
        "images": [{"id": 1, "file_name": "1.jpg", "width": 3}, {"id": 2, "file_name": "2.jpg"}],
    }
    (tmp_path / "c.json").write_text(json.dumps(body, indent=2, ensure_ascii=False), encoding="utf-8")
    notes, files = captions.scan_captions(spark, str(tmp_path / "c.json"))
    assert sorted(map(tuple, notes.collect())) == [(1, "b"), (1, "犬が走る"), (2, "c")]
    assert sorted(map(tuple, files.collect())) == [(1, "1.jpg"), (2, "2.jpg")]


def test_caption_objects_stay_small_with_a_hot_image(spark, tmp_path):
    rows = spark.range(3000).select(F.lit(7).cast("long").alias("image_id"), F.col("id").alias("cap_no"), F.lit("t").alias("caption"))
    path = str(tmp_path / "objects")
    captions.write_caption_objects(rows, path)
    objects = spark.read.schema(captions.CAPTION_SCHEMA).json(path)
    assert objects.agg(F.max(F.size("annotations"))).first()[0] <= 64
    assert captions.scan_captions(spark, path, multi_line=False)[0].count() == 3000


@pytest.fixture
def folder(tmp_path):
    for name in ("a.jpg", "B.JPG", "c.png", "d.txt", "e.jpeg"):
        (tmp_path / name).write_bytes(name.encode() * 40)
    return tmp_path


def test_image_scan_by_extension(spark, folder):
    found = images.scan_images(spark, str(folder))
    assert {r["filename"] for r in found.select("filename").collect()} == {"a.jpg", "B.JPG", "c.png", "e.jpeg"}
    exact = images.scan_images(spark, str(folder), ["jpg"], any_case=False)
    assert [r["filename"] for r in exact.select("filename").collect()] == ["a.jpg"]
    firsts = images.first_n_images(found.select("filename"), 2).collect()
    assert [r["filename"] for r in firsts] == ["B.JPG", "a.jpg"]


def test_requests_from_files(spark, folder):
    rows = images.build_requests(images.scan_images(spark, str(folder)))
    got = rows.withColumn("raw", F.unbase64("image_base64")).where("filename = 'c.png'").first()
    assert bytes(got["raw"]) == b"c.png" * 40
    assert json.loads(got["tag_candidates_json"]) == fixed.DEFAULT_TAG_CANDIDATES
    assert images.build_requests(images.scan_images(spark, str(folder)), None).first()["tag_candidates_json"] is None


def test_missing_file_keeps_its_row(spark, folder):
    files = images.scan_images(spark, str(folder))
    path = files.where("filename = 'a.jpg'").first()["path"]
    pairs = spark.createDataFrame([("1", path), ("2", "/nowhere.jpg")], "image_id string, image_path string")
    got = {r["image_id"]: r for r in images.load_with_placeholder(pairs, files).collect()}
    assert got["1"]["load_ok"] and bytes(got["1"]["content"]) == b"a.jpg" * 40
    assert not got["2"]["load_ok"] and got["2"]["content"] is None
    encoded = encoders.encode_images(images.load_with_placeholder(pairs, files), "image_id", "content", encoders.byte_histogram(8), images.placeholder())
    want = encoders.byte_histogram(8)()(pa.array([images.placeholder()]))[0]
    assert {r["image_id"]: r["emb"] for r in encoded.collect()}["2"] == pytest.approx((want / np.linalg.norm(want)).tolist())


def test_placeholder_is_a_black_png():
    body = images.placeholder(4, 3)
    assert body[:8] == b"\x89PNG\r\n\x1a\n" and zlib.decompress(body[41:-16]) == bytes(4 * 13)
    assert len(images.placeholder()) < 2000


def test_large_files_of_other_kinds_are_not_read(spark, tmp_path):
    (tmp_path / "a.JpG").write_bytes(b"small")
    (tmp_path / "movie.mp4").write_bytes(bytes(200_000))
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1000")
    try:
        assert [bytes(r["content"]) for r in images.scan_images(spark, str(tmp_path)).collect()] == [b"small"]
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_resume_and_counts(spark):
    wanted, done = spark.range(5), spark.createDataFrame([(1,), (3,), (3,)], "id long")
    assert [r["id"] for r in tables.resume_ingest(wanted, done, "id").orderBy("id").collect()] == [0, 2, 4]
    outcomes = spark.createDataFrame([(True,), (False,), (True,)], "ok boolean")
    assert tuple(tables.ingest_counts(outcomes).first()) == (2, 1, 3)


def test_declared_columns(spark):
    df = spark.createDataFrame([("x",)], "image_base64 string")
    out = tables.check_columns(df, {"image_base64": "string"}, {"tag_score_threshold": "string"})
    assert out.first().asDict() == {"image_base64": "x", "tag_score_threshold": None}
    with pytest.raises(ValueError, match="missing"):
        tables.check_columns(df, {"emb": "array<double>"}, {})
    with pytest.raises(ValueError, match="expected"):
        tables.check_columns(df, {"image_base64": "binary"}, {})


def test_saved_table_is_replaced_and_pruned(spark):
    path = new_path(spark, "t")
    rows = spark.createDataFrame([("1", "train"), ("2", "test")], "id string, split string")
    tables.save_table(rows, "some_pairs", path, ["split"])
    table = tables.save_table(rows, "some_pairs", path, ["split"])
    assert table.count() == 2
    scan = tables.scan_split(table, "train")
    assert scan.count() == 1
    assert "PartitionFilters: [isnotnull(split" in scan._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_dir(spark) == named.rstrip("/")
    df = materialize(spark.createDataFrame([("007", 1)], "k string, v int"), "typed", ["k"])
    assert df.dtypes == [("k", "string"), ("v", "int")] and df.first()["k"] == "007"
    assert "LogicalRDD" not in df._jdf.queryExecution().logical().toString()


def test_versions_are_numbers(spark):
    rows = spark.createDataFrame(
        [("m", v, "READY", "r" * 20) for v in ("9", "10", "2")], "model string, version string, status string, run_id string"
    )
    assert runs.latest_version(rows, ["model"]).first()["latest_version"] == 10
    assert [r["version"] for r in runs.recent_versions(rows, 2).collect()] == ["10", "9"]
    weights = spark.createDataFrame([("image", 0, [1.0])], "head string, row int, weights array<double>")
    assert runs.register_head(weights, rows, "READY", "r").first()["version"] == "11"
    assert runs.register_head(weights, rows.limit(0), "READY", "r").first()["version"] == "1"


def test_best_epoch_earliest_wins_and_may_be_null(spark):
    log = spark.createDataFrame(
        [("a", 1, 0.2), ("a", 2, 0.5), ("a", 3, 0.5), ("a", 4, 0.4), ("b", 1, 0.0), ("b", 2, 0.0)],
        "run_id string, epoch int, recall double",
    )
    got = {r["run_id"]: (r["best_epoch"], r["best_recall"]) for r in runs.best_epoch(log, ["run_id"]).collect()}
    assert got == {"a": (2, 0.5), "b": (None, 0.0)}
    so_far = runs.running_best(log, ["run_id"]).where("run_id = 'a'").orderBy("epoch").collect()
    assert [r["best_so_far"] for r in so_far] == [0.2, 0.5, 0.5, 0.5]


def test_null_metrics_are_not_logged_and_zero_is(spark):
    metrics = spark.createDataFrame(
        [("baseline", "train", 0.5, None), ("final", "test", 0.0, 0.0)],
        "phase string, split string, recall_at_1 double, triplet_accuracy double",
    )
    losses = spark.createDataFrame([(1, 0.7)], "epoch int, loss double")
    got = {(r["name"], r["step"]): r["value"] for r in runs.run_metrics(metrics, losses, "r").collect()}
    assert got == {
        ("baseline_train_recall_at_1", None): 0.5, ("test_recall_at_1", None): 0.0,
        ("test_triplet_accuracy", None): 0.0, ("train_loss", 1): 0.7,
    }


def test_trainable_share(spark):
    params = spark.createDataFrame(
        [("text_model.head.weight", 30), ("vision_model.head.probe", 10), ("text_model.encoder.x", 60)], "name string, numel long"
    )
    assert tuple(runs.trainable_share(params, fixed.TRAINABLE_LAYERS).first()) == (100, 40, 40.0)


def test_byte_histogram_equals_loop(spark):
    texts = ["", "abc", "日本語テキスト", "x" * 1000]
    df = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "id int, content binary")
    got = {r["id"]: np.array(r["emb"]) for r in encoders.encode_images(df, "id", "content", encoders.byte_histogram(16)).collect()}
    assert got.pop(0).shape == ()  # no bytes, no vector
    for i, t in list(enumerate(texts))[1:]:
        want = np.bincount(np.frombuffer(t.encode(), np.uint8) % 16, minlength=16).astype(float)
        np.testing.assert_allclose(got[i], want / (np.linalg.norm(want) or 1.0))


def test_model_is_built_in_the_worker(spark):
    driver = os.getpid()

    def load():
        made_in = os.getpid()
        return lambda content: np.full((len(content), 1), float(made_in != driver))

    df = spark.createDataFrame([(1, b"a"), (2, b"b")], "id int, content binary")
    assert [r["emb"] for r in encoders.encode_images(df, "id", "content", load).collect()] == [[1.0], [1.0]]


def test_text_vectors(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "a  b\na"), (3, "c")], "id int, text string")
    dense = encoders.dense_vectors(encoders.encode_texts(df, "id", "text"), "id")
    got = {r["id"]: r["emb"] for r in dense.collect()}
    assert got[1] == got[2] and len(got[3]) == encoders.TEXT_DIMS
    assert sum(x * x for x in got[1]) == pytest.approx(1.0)


def test_prompt(spark):
    assert spark.range(1).select(T.tag_prompt(F.lit("犬"))).first()[0] == "This is a photo of 犬."


def test_ingest_adds_nothing_twice_and_nothing_of_a_failed_job(spark, tmp_path):
    path = str(tmp_path / "ledger")
    wanted = spark.createDataFrame([(i, "x") for i in range(20)], "id bigint, batch string")
    key = wanted.schema["id"]

    def load(failed):
        return lambda todo: todo.select("id", F.concat(F.lit("/f/"), "id").alias("path_or_err"), (~F.col("id").isin(failed)).alias("ok"))

    def broken(todo):
        bad = F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.lit("/f"))
        return todo.repartition(4).select("id", bad.cast("string").alias("path_or_err"), F.lit(True).alias("ok"))

    with pytest.raises(Exception, match="lost"):
        tables.ingest(wanted, path, "id", 1, broken)
    assert tables.scan_ledger(spark, path, key).count() == 0
    assert tables.ingest(wanted.where("id < 10"), path, "id", 1, load([4, 5])) == {"n_loaded": 8, "n_failed": 2}
    assert tables.ingest(wanted.where("id < 10"), path, "id", 1, load([4, 5])) == {"n_loaded": 8, "n_failed": 2}
    with pytest.raises(Exception, match="lost"):
        tables.ingest(wanted.where("id < 10 or id = 3").unionByName(wanted.where("id = 3").selectExpr("3L + 0 * id AS id", "batch")), path, "id", 1, broken)
    assert tables.ingest(wanted, path, "id", 2, load([5])) == {"n_loaded": 11, "n_failed": 1}
    assert tables.ingest(wanted.where("id < 4"), path, "id", 3, load([])) == {"n_loaded": 0, "n_failed": 0}
    rows = [(r["id"], r["batch"], r["ok"]) for r in tables.scan_ledger(spark, path, key).collect()]
    want = [(i, 1, i not in (4, 5)) for i in range(10)] + [(4, 2, True), (5, 2, False)] + [(i, 2, True) for i in range(10, 20)]
    assert sorted(rows) == sorted(want)


def test_ingest_of_null_keys_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "ledger")
    wanted = spark.createDataFrame([(None,), (1,)], "id bigint")

    def load(todo):
        return todo.select("id", F.lit(None).cast("string").alias("path_or_err"), F.when(F.col("id") == 1, True).alias("ok"))

    assert tables.ingest(wanted.where("false"), path, "id", 1, load) == {"n_loaded": 0, "n_failed": 0}
    assert tables.ingest(wanted, path, "id", 2, load) == {"n_loaded": 1, "n_failed": 1}
    assert tables.ingest(wanted, path, "id", 3, load) == {"n_loaded": 0, "n_failed": 1}
