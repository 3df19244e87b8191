"""Pair building: grouping, sampling, negatives, splits, typed columns."""

import hashlib
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tagweave.operators import pairs

SCHEMA = "image_id bigint, cap_no bigint, caption string"


def uniform(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 16.0**13


def expected_negatives(rows, seed=42):
    """The definition, image by image over the whole pool."""
    pool = sorted(rows, key=lambda r: (hashlib.sha256(r[2].encode()).hexdigest(), r[0], r[1]))
    out = {}
    for image in {r[0] for r in rows}:
        own = {r[2] for r in rows if r[0] == image}
        left = [r[2] for r in pool if r[2] not in own]
        out[image] = left[math.floor(uniform(seed, "negative", image) * len(left))] if left else None
    return out


def negatives(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r["image_id"]: r["text_negative"] for r in pairs.sample_negatives(df).collect()}


def test_negatives_follow_the_definition_with_a_hot_text(spark):
    rows = [(i, 10 * i + j, f"text {i * 31 % 17} {j}") for i in range(40) for j in range(3)]
    rows += [(i, 10 * i + 5, "the same words") for i in range(40)]
    rows += [(99, 5000 + j, f"many {j}") for j in range(80)]
    got = negatives(spark, rows)
    assert got == expected_negatives(rows)
    for image, text in got.items():
        assert text not in {r[2] for r in rows if r[0] == image}


def test_null_captions_are_not_in_the_pool(spark):
    assert negatives(spark, [(1, 1, "a"), (1, 2, None), (2, 3, "b"), (3, 4, None)]) == {1: "b", 2: "a"}


def test_negatives_do_not_depend_on_partitions(spark):
    rows = [(i % 30, i, f"t{i % 50}") for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    one, many = (sorted(map(tuple, pairs.sample_negatives(df.repartition(n)).collect())) for n in (1, 8))
    assert one == many


def test_copies_of_one_text_span_blocks(spark, monkeypatch):
    monkeypatch.setattr(pairs, "POSITIONS_PER_BLOCK", 16)
    rows = [(1, j, "copied") for j in range(200)] + [(2, 500, "x"), (3, 501, "y"), (4, 502, "z")]
    got = negatives(spark, rows)
    assert got == expected_negatives(rows)
    assert got[1] in {"x", "y", "z"}


def test_no_admissible_negative_is_null(spark):
    assert negatives(spark, [(1, 1, "a"), (2, 2, "a")]) == {1: None, 2: None}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6), st.sampled_from("abcdef")), min_size=1, max_size=40))
def test_negatives_on_random_pools(spark, items):
    rows = [(image, n, text) for n, (image, text) in enumerate(items)]
    assert negatives(spark, rows) == expected_negatives(rows)


def test_negatives_are_uniform(spark):
    """800 images draw from a pool in which 'common' has half of the positions."""
    rows = [(i, i, "common" if i % 2 else f"rare {i}") for i in range(800)]
    got = negatives(spark, rows)
    drawn = [got[i] for i in range(800) if i % 2 == 0]
    share = sum(t == "common" for t in drawn) / len(drawn)
    assert abs(share - 0.5) < 0.08


def test_captions_keep_source_order_across_blocks(spark):
    rows = [(1, n, f"c{n}") for n in range(0, 5000, 7)] + [(2, 3, "only")]
    out = pairs.captions_by_image(spark.createDataFrame(rows, SCHEMA)).collect()
    ones = sorted((r["position"], r["caption"]) for r in out if r["image_id"] == 1)
    assert ones == [(i, f"c{n}") for i, n in enumerate(range(0, 5000, 7))]
    assert {r["n_captions"] for r in out if r["image_id"] == 2} == {1}


@pytest.mark.parametrize("n, expected", [(0, 0), (1, 1), (37, 37), (500, 500), (900, 500)])
def test_sample_size_is_exact(spark, n, expected):
    images = spark.range(500).withColumnRenamed("id", "image_id")
    got = {r["image_id"] for r in pairs.sample_images(images, n).collect()}
    want = sorted(range(500), key=lambda i: (uniform(42, i), i))[:expected]
    assert got == set(want)


def test_splits_are_disjoint_and_complete(spark):
    rows = spark.range(2000).select("id", pairs.assign_split("id").alias("split")).collect()
    shares = {s: sum(r["split"] == s for r in rows) / 2000 for s in ("train", "valid", "test")}
    assert sum(shares.values()) == 1.0
    assert abs(shares["train"] - 0.7) < 0.05 and abs(shares["valid"] - 0.15) < 0.03


def test_null_in_required_column_stops_the_write(spark):
    row = spark.createDataFrame(
        [(1, "/p", None, None, "coco", "train")],
        "image_id int, image_path string, text_positive string, text_negative string, category string, split string",
    )
    with pytest.raises(Exception, match="text_positive must not be null"):
        pairs.typed_pairs(row).collect()
    fine = pairs.typed_pairs(row.fillna("t", ["text_positive"]))
    assert [f.dataType.simpleString() for f in fine.schema] == ["string"] * 6
    assert fine.first()["text_negative"] is None
