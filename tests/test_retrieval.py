"""Vector maths, search and evaluation against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.functions import vectors as V
from tagweave.operators import retrieval


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def arr(*xs):
    return F.array(*[F.lit(float(x)) for x in xs])


def test_vector_expressions(spark):
    r = one(
        spark,
        n=V.l2_norm(arr(3, 4)), u=V.l2_normalize(arr(3, 4)), z=V.l2_normalize(arr(0, 0)), d=V.dot(arr(1, 2), arr(3, 4)),
        c=V.cosine(arr(1, 0), arr(1, 1)), cz=V.cosine(arr(0, 0), arr(1, 1)),
    )
    assert (r["n"], r["u"], r["z"], r["d"], r["cz"]) == (5.0, [0.6, 0.8], None, 11.0, None)
    assert r["c"] == pytest.approx(2**-0.5)


def test_log_sigmoid_is_stable(spark):
    r = one(spark, low=V.log_sigmoid(F.lit(-800.0)), high=V.log_sigmoid(F.lit(800.0)), s=V.sigmoid(F.lit(-800.0)))
    assert (r["low"], r["high"], r["s"]) == (-800.0, 0.0, 0.0)


def rows(spark, n=300, d=8, seed=1):
    """Group 'big' has two thirds of the rows."""
    rng = np.random.default_rng(seed)
    img = rng.normal(size=(n, d))
    txt = img + 0.9 * rng.normal(size=(n, d))
    img /= np.linalg.norm(img, axis=1, keepdims=True)
    txt /= np.linalg.norm(txt, axis=1, keepdims=True)
    group = ["small" if i % 3 == 0 else "big" for i in range(n)]
    data = [(group[i], i, img[i].tolist(), txt[i].tolist()) for i in range(n)]
    return spark.createDataFrame(data, "split string, id long, img array<double>, txt array<double>"), img, txt, group


@pytest.mark.parametrize("block_rows", [None, 7, 64, 1000])
def test_nearest_text_equals_full_product(spark, block_rows):
    df, img, txt, group = rows(spark)
    got = {r["id"]: (r["best_id"], r["best_sim"]) for r in retrieval.nearest_text(df, ["split"], block_rows).collect()}
    assert len(got) == 300
    sims = img @ txt.T
    for i in range(300):
        same = np.array([g == group[i] for g in group])
        best = np.where(same, sims[i], -2).argmax()
        assert got[i][0] == best and got[i][1] == pytest.approx(sims[i, best])


def test_ties_go_to_the_lowest_id(spark):
    data = [("s", i, [1.0, 0.0], [1.0, 0.0]) for i in range(20)]
    df = spark.createDataFrame(data, "split string, id long, img array<double>, txt array<double>")
    for block in (None, 3):
        assert {r["best_id"] for r in retrieval.nearest_text(df, ["split"], block).collect()} == {0}
    assert retrieval.recall_at_1(df, ["split"], 3).first()["recall_at_1"] == pytest.approx(1 / 20)


def test_many_groups_take_the_shuffled_path(spark, monkeypatch):
    import tagweave.operators.skew as skew

    df, *_ = rows(spark)
    expected = sorted(map(tuple, retrieval.recall_at_1(df, ["split"]).collect()))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 1)
    assert sorted(map(tuple, retrieval.recall_at_1(df, ["split"]).collect())) == expected


def test_duplicate_of_the_query_stays_in_the_result(spark):
    data = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [2.0, 0.0]), (4, [0.0, 0.0])]
    df = spark.createDataFrame(data, "image_id long, emb array<double>")
    got = [(r["image_id"], r["rank"]) for r in retrieval.similar_images(df, 0, "image_id", 3).collect()]
    assert got == [(1, 1), (3, 2), (2, 3)]


def test_search_neither_joins_nor_sorts_the_corpus(spark):
    df = spark.range(1000).select(F.col("id").alias("image_id"), F.array(F.col("id") + 1.0, F.lit(1.0)).alias("emb"))
    plan = retrieval.similar_images(df, 0, "image_id")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Join" not in plan


def test_triplet_accuracy_is_null_without_negatives(spark):
    data = [("train", 1, [1.0, 0.0], [1.0, 0.0], None), ("test", 2, [1.0, 0.0], [1.0, 0.0], [0.0, 1.0]),
            ("test", 3, [1.0, 0.0], [1.0, 0.0], [1.0, 0.0])]
    df = spark.createDataFrame(data, "split string, id long, img array<double>, txt array<double>, neg array<double>")
    got = {r["split"]: r.asDict() for r in retrieval.evaluate(df, ["split"]).collect()}
    assert got["train"] == {"split": "train", "recall_at_1": 1.0, "triplet_accuracy": None}
    # The negative of the third row equals its positive, which is no win.
    assert got["test"]["triplet_accuracy"] == 0.5
    named = retrieval.metric_rows(retrieval.evaluate(df, ["split"]), ["split"]).collect()
    assert ("train", "triplet_accuracy") not in {(r["split"], r["metric"]) for r in named}


def test_recall_is_the_same_for_all_blocks_with_copied_texts(spark):
    rng = np.random.default_rng(11)
    img = rng.normal(size=(3000, 97))
    img /= np.linalg.norm(img, axis=1, keepdims=True)
    txt = np.repeat(img[::2] + 0.3 * rng.normal(size=(1500, 97)), 2, axis=0)  # each text stands twice
    data = [(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(img, txt))]
    df = spark.createDataFrame(data, "id long, img array<double>, txt array<double>").withColumn("g", F.lit("all")).cache()
    got = {retrieval.recall_at_1(df, ["g"], blocks).first()["recall_at_1"] for blocks in (100, 333, 1500, 3000)}
    assert len(got) == 1


def test_null_and_nan_vectors_never_win(spark):
    nan = float("nan")
    data = [(1, [1.0], [-1.0]), (2, [1.0], None), (3, None, [0.5]), (4, [1.0], [nan])]
    df = spark.createDataFrame(data, "id long, img array<double>, txt array<double>").withColumn("g", F.lit("all"))
    assert {r["id"]: r["best_id"] for r in retrieval.nearest_text(df, ["g"]).collect()} == {1: 3, 2: 3, 4: 3}
    assert tuple(retrieval.recall_at_1(df, ["g"]).first()) == ("all", 0.0, 4)


def clustered(spark, n=1200, d=24, clusters=12, noise=0.02, seed=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, d))
    img = centres[np.arange(n) % clusters] + noise * rng.normal(size=(n, d))
    txt = img + noise * rng.normal(size=(n, d))
    txt[: n // 4] = centres[0]  # a large group of equal texts
    img, txt = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (img, txt))
    data = [("all", i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(img, txt))]
    return spark.createDataFrame(data, "split string, id long, img array<double>, txt array<double>"), img, txt


def test_blocks_that_cannot_hold_the_nearest_text_are_not_visited(spark):
    df, img, txt = clustered(spark)
    for block_rows in (40, 100):
        got = {r["id"]: r["best_id"] for r in retrieval.nearest_text(df, ["split"], block_rows).collect()}
        assert [got[i] for i in range(1200)] == np.round(img @ txt.T, 12).argmax(axis=1).tolist()
        r = retrieval.block_copies(df, ["split"], block_rows).first()
        blocks = -(-1200 // block_rows)
        assert r["n_images"] == 1200 and r["text_blocks"] >= blocks // 2
        assert r["image_copies"] / r["n_images"] < 0.6 * blocks, (r, blocks)
        print(block_rows, r, blocks)


def test_bounds_of_short_long_and_missing_vectors(spark):
    """Random lengths, zero vectors, missing texts and no groups, against the full product."""
    rng = np.random.default_rng(8)
    img, txt = rng.normal(size=(400, 3)), rng.normal(size=(400, 3)) * rng.choice([0.0, 0.01, 1.0, 30.0], size=(400, 1))
    txt[::9] = img[::9]
    data = [(i, None if i % 17 == 5 else a.tolist(), None if i % 13 == 4 else b.tolist()) for i, (a, b) in enumerate(zip(img, txt))]
    df = spark.createDataFrame(data, "id long, img array<double>, txt array<double>")
    sims = np.round(img @ txt.T, 12)
    sims[:, np.arange(400) % 13 == 4] = -np.inf
    want = {i: int(sims[i].argmax()) for i in range(400) if i % 17 != 5}
    for block_rows in (None, 10, 50):
        assert {r["id"]: r["best_id"] for r in retrieval.nearest_text(df, [], block_rows).collect()} == want
    assert retrieval.nearest_text(df.limit(0), []).count() == 0
    assert retrieval.nearest_text(df.withColumn("txt", F.lit(None).cast("array<double>")), []).count() == 0


def test_recall_with_a_constant_group_has_no_join(spark):
    df, *_ = rows(spark)
    plan = retrieval.recall_at_1(df.withColumn("split", F.lit("all")), ["split"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_copied_texts_are_shipped_once(spark):
    """Texts of which most are copies fill one block, whatever the rows, and the lowest id of a copy wins."""
    rng = np.random.default_rng(12)
    few = rng.normal(size=(5, 8))
    img = few[np.arange(600) % 5] + 0.05 * rng.normal(size=(600, 8))
    data = [("all", i + 7, a.tolist(), few[i % 5].tolist()) for i, a in enumerate(img)]
    df = spark.createDataFrame(data, "split string, id long, img array<double>, txt array<double>")
    r = retrieval.block_copies(df, ["split"], 50).first()
    assert r["image_copies"] == r["n_images"] == 600 and r["text_blocks"] == 1
    got = {r["id"]: r["best_id"] for r in retrieval.nearest_text(df, ["split"], 50).collect()}
    assert got == {i + 7: int((few @ a).argmax()) + 7 for i, a in enumerate(img)}


@pytest.mark.parametrize("scale", [1.0, 1e-30, 1e18, 1e200])
def test_a_block_in_single_precision_gives_the_double_result_in_bounded_memory(scale):
    """Nearly equal texts, texts of any length and more of them than one product holds, against the double product."""
    import tracemalloc

    rng = np.random.default_rng(13)
    texts = rng.normal(size=(20_000, 16))
    texts[5_000:9_000] = texts[0] + 1e-9 * rng.normal(size=(4_000, 16))
    texts[9_000:] *= rng.choice([0.0, 0.1, 1.0], size=(11_000, 1))
    images = np.concatenate([rng.normal(size=(700, 16)), texts[:68]])
    ids = rng.permutation(20_000) * 3
    with np.errstate(over="ignore", invalid="ignore"):
        sims = np.round(images @ (texts * scale).T, 12)
    best = sims.max(axis=1)
    want = [ids[row == top].min() for row, top in zip(sims, best)]
    block = retrieval.TextBlock(ids, texts * scale)
    tracemalloc.start()
    rows, sim, found = block.best(images, np.full(len(images), -np.inf))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows.tolist() == list(range(768)) and sim == pytest.approx(best, rel=1e-12, abs=1e-12)
    if scale <= 1:  # larger ones have no 12 places
        assert found.tolist() == want
    assert peak < 30e6, peak  # a whole product has 20,000 x 256 doubles, 41 MB, and several copies
    # A bound that no text reaches leaves no row.
    assert len(block.best(images[:10], best[:10] + abs(best[:10]) * 1e-3 + 1e-3)[0]) == (0 if scale <= 1 else 10)


def test_images_of_one_block_are_dealt_to_several_tasks(spark, monkeypatch):
    """Each task that multiplies gives one file of the partial results."""
    df, *_ = rows(spark)
    calls = spark.sparkContext.accumulator(0)
    kernel = retrieval._nearest_in_blocks

    def counted(groups):
        run = kernel(groups)

        def count(batches):
            found = list(run(batches))
            calls.add(1 if found else 0)
            yield from found

        return count

    monkeypatch.setattr(retrieval, "_nearest_in_blocks", counted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert retrieval.nearest_text(df.withColumn("split", F.lit("all")), ["split"]).count() == 300
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert calls.value > 1
