"""Loss and head fitting against plain numpy."""

import hashlib

import numpy as np
import pytest

from tagweave.functions.vectors import Logits
from tagweave.operators import pairs, retrieval, training

LOGITS = Logits()


def unit(m):
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def make(spark, n=45, d=5, seed=3, parts=4):
    rng = np.random.default_rng(seed)
    img = unit(rng.normal(size=(n, d)))
    txt = unit(img @ rng.normal(size=(d, d)) + 0.2 * rng.normal(size=(n, d)))
    neg = unit(rng.normal(size=(n, d)))
    split = ["valid" if i % 5 == 0 else "train" for i in range(n)]
    data = [(split[i], i, img[i].tolist(), txt[i].tolist(), neg[i].tolist()) for i in range(n)]
    schema = "split string, id long, img array<double>, txt array<double>, neg array<double>"
    return spark.createDataFrame(data, schema).repartition(parts), img, txt, split


def plain_loss(i, t):
    z = LOGITS.scale * unit(i) @ unit(t).T + LOGITS.bias
    z *= 2 * np.eye(len(i)) - 1
    return np.log1p(np.exp(-z)).mean()


def batches_of(ids, epoch, size, seed=42):
    def key(i):
        return int(hashlib.md5(f"{seed}:{epoch}:{i}".encode()).hexdigest()[:13], 16) / 16.0**13, i

    order = sorted(ids, key=key)
    return [order[s : s + size] for s in range(0, len(order), size)]


@pytest.mark.parametrize("rows_per_arrow_batch", ["7", "10000"])
def test_batch_losses_equal_numpy(spark, rows_per_arrow_batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_per_arrow_batch)
    try:
        df, img, txt, split = make(spark)
        batched = pairs.assign_batches(df, ["split"], "id", 8)
        got = {(r["split"], r["batch_id"]): (r["n"], r["loss"]) for r in training.contrastive_loss(batched, ["split"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for name in ("train", "valid"):
        ids = [i for i in range(45) if split[i] == name]
        for b, members in enumerate(batches_of(ids, name, 8)):
            n, loss = got.pop((name, b))
            assert n == len(members) and loss == pytest.approx(plain_loss(img[members], txt[members]))
    assert not got


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    image, text = rng.normal(size=(2, 4, 3)), rng.normal(size=(2, 4, 3))
    weights = {"image": rng.normal(size=(3, 3)), "text": rng.normal(size=(3, 3))}
    _, gradient = training.batch_gradients(image, text, weights, LOGITS)
    for name in weights:
        for i in range(3):
            for j in range(3):
                moved = {k: v.copy() for k, v in weights.items()}
                moved[name][i, j] += 1e-6
                up = training.batch_gradients(image, text, moved, LOGITS)[0].sum()
                moved[name][i, j] -= 2e-6
                down = training.batch_gradients(image, text, moved, LOGITS)[0].sum()
                assert gradient[name][i, j] == pytest.approx((up - down) / 2e-6, abs=1e-6)


@pytest.mark.parametrize("tasks", [1, 3, 8])
def test_one_step_per_batch_is_sequential_training(spark, tasks):
    df, img, txt, split = make(spark)
    fit = training.fit_heads(df, epochs=2, batch_size=16, rate=0.01, validate=False, tasks=tasks)
    weights, log = fit.weights, fit.log
    ids = [i for i in range(45) if split[i] == "train"]
    heads, optimiser, losses = {"image": np.eye(5), "text": np.eye(5)}, training.AdamW(rate=0.01), []
    every = {}
    for epoch in (1, 2):
        epoch_losses = []
        for step, members in enumerate(batches_of(ids, epoch, 16)):
            loss, g = training.batch_gradients(img[members][None], txt[members][None], heads, LOGITS)
            epoch_losses.append(loss[0])
            every[epoch, step] = loss[0]
            heads = optimiser.update(heads, g)
        losses.append(np.mean(epoch_losses))
    np.testing.assert_allclose(weights["image"], heads["image"], atol=1e-9)
    np.testing.assert_allclose(weights["text"], heads["text"], atol=1e-9)
    assert [e["loss"] for e in log] == pytest.approx(losses)
    steps = {(r["epoch"], r["step"]): (r["n_batches"], r["loss"]) for r in fit.steps.collect()}
    assert len(steps) == len(every) == fit.steps.count()
    assert all(steps[k][0] == 1 and steps[k][1] == pytest.approx(loss) for k, loss in every.items())


def test_adamw_first_step():
    """One step moves each weight by the rate against the slope's sign, after decay."""
    new = training.AdamW(rate=0.1).update({"w": np.array([[2.0]])}, {"w": np.array([[5.0]])})
    assert new["w"][0, 0] == pytest.approx(2.0 * (1 - 0.1 * 0.01) - 0.1)


def test_loss_falls_and_log_is_complete(spark):
    df, *_ = make(spark)
    fit = training.fit_heads(df, epochs=3, batch_size=8, steps_per_epoch=2, rate=0.05)
    weights, log = fit.weights, fit.log
    assert log[-1]["loss"] < log[0]["loss"]
    frame = training.log_frame(spark, log)
    assert frame.count() == 3 and frame.where("valid_recall_at_1 is null").count() == 0
    rows = training.weight_rows(spark, weights).collect()
    assert len(rows) == 10 and {r["head"] for r in rows} == {"image", "text"}


def test_heads_keep_missing_negatives(spark):
    df, img, *_ = make(spark)
    df = df.selectExpr("split", "id", "img", "txt", "if(split = 'train', null, neg) AS neg")
    turned = training.apply_heads(df, {"image": 2 * np.eye(5), "text": np.eye(5)})
    rows = {r["id"]: r for r in turned.collect()}
    assert rows[1]["neg"] is None and rows[0]["neg"] is not None
    np.testing.assert_allclose(rows[7]["img"], img[7], atol=1e-12)
    assert retrieval.evaluate(turned, ["split"]).count() == 2


def test_epoch_loss_weighs_batches_equally(spark):
    losses = spark.createDataFrame([(1, 0, 8, 1.0), (1, 1, 2, 3.0)], "epoch int, batch_id long, n int, loss double")
    assert training.epoch_loss(losses, ["epoch"]).first()["loss"] == 2.0


def test_steps_of_several_batches_take_their_mean(spark):
    """Dense sums and factors are exchanged; the number of jobs does not depend on that of the steps."""
    df, img, txt, split = make(spark)
    ids = [i for i in range(45) if split[i] == "train"]
    heads, optimiser = {"image": np.eye(5), "text": np.eye(5)}, training.AdamW(rate=0.01)
    parts = batches_of(ids, 1, 2)
    for step in range(4):
        sums = [training.batch_gradients(img[m][None], txt[m][None], heads, LOGITS)[1] for m in parts[step::4]]
        heads = optimiser.update(heads, {k: sum(g[k] for g in sums) / len(sums) for k in heads})
    fit = training.fit_heads(df, epochs=1, batch_size=2, steps_per_epoch=4, rate=0.01, validate=False)
    np.testing.assert_allclose(fit.weights["image"], heads["image"], atol=1e-9)
    np.testing.assert_allclose(fit.weights["text"], heads["text"], atol=1e-9)
    assert {r["n_batches"] for r in fit.steps.collect()} == {4, 5}

    def jobs(**settings):
        spark.sparkContext.setJobGroup("counted", "")
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
        training.fit_heads(df, epochs=1, validate=False, **settings)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before

    assert jobs(batch_size=1) == jobs(batch_size=8)
