"""Sigmoid contrastive loss over batches, and linear heads fitted by summed gradients."""

from __future__ import annotations

import pickle
from base64 import b64decode, b64encode
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave import fixed_values as fixed
from tagweave.functions.vectors import Logits
from tagweave.operators.arrow import list_column, matrix, plain, unit_rows
from tagweave.operators.pairs import assign_batches
from tagweave.operators.retrieval import evaluate
from tagweave.session import materialize

# Tasks of the barrier stage. More of them speed up large steps only, and each exchange meets all.
MAX_TASKS = 32
# Vectors of the batches that one task steps through before the model goes on to the next task.
RUN_BYTES = 64 * 1024 * 1024


def pair_logit_loss(image: np.ndarray, text: np.ndarray, logits: Logits) -> tuple[np.ndarray, np.ndarray]:
    """Loss of each batch, and its slope by similarity, from unit rows shaped (batch, n, d)."""
    n = image.shape[1]
    label = 2.0 * np.eye(n) - 1.0
    signed = label * (logits.scale * image @ text.transpose(0, 2, 1) + logits.bias)
    loss = np.logaddexp(0.0, -signed).mean(axis=(1, 2))
    slope = -label * np.exp(-np.logaddexp(0.0, signed)) * logits.scale / (n * n)
    return loss, slope


def pack_batches(batched: DataFrame, groups: list[str]) -> DataFrame:
    """One row per batch: ``(groups, batch_id, n, img, txt)`` with the vectors end to end.

    A batch has a fixed number of rows, so the lists are short. Packed batches can be read in any
    partitioning, so later passes over them need no shuffle. A missing vector counts as zeros.
    """

    def zeros(like: str) -> Column:
        return F.transform(like, lambda _: F.lit(0.0))

    row = F.struct(
        "batch_pos", F.coalesce("img", zeros("txt")).alias("img"), F.coalesce("txt", zeros("img")).alias("txt")
    )
    lists = batched.groupBy(*groups, "batch_id").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    vectors = [F.flatten(F.col("rows")[side]).alias(side) for side in ("img", "txt")]
    return lists.select(*groups, "batch_id", F.size("rows").alias("n"), *vectors)


def _stacks(n: pa.Array, img: pa.Array, txt: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Packed batches of equal size together: ``(row numbers, images, texts)``, shaped (k, n, d)."""
    sizes = plain(n).to_numpy()
    for size in np.unique(sizes):
        index = np.flatnonzero(sizes == size)
        images, texts = (matrix(plain(side).take(pa.array(index))) for side in (img, txt))
        shape = (len(index), int(size), images.shape[1] // int(size))
        yield index, images.reshape(shape), texts.reshape(shape)


def loss_of_batches(logits: Logits):
    """Arrow UDF ``(n, img, txt) -> loss`` over packed batches."""

    @F.arrow_udf("double")
    def loss(n: pa.Array, img: pa.Array, txt: pa.Array) -> pa.Array:
        out = np.zeros(len(n))
        for index, images, texts in _stacks(n, img, txt):
            out[index] = pair_logit_loss(unit_rows(images), unit_rows(texts), logits)[0]
        return pa.array(out)

    return loss.asNondeterministic()


def contrastive_loss(batched: DataFrame, groups: list[str], logits: Logits = Logits()) -> DataFrame:
    """Loss per batch: ``(groups, batch_id, n, loss)``.

    ``batched`` is ``(groups, batch_id, batch_pos, img, txt)``. The n x n products are made in
    numpy and never become rows.
    """
    packed = pack_batches(batched, groups)
    return packed.select(*groups, "batch_id", "n", loss_of_batches(logits)("n", "img", "txt").alias("loss"))


def epoch_loss(losses: DataFrame, groups: list[str]) -> DataFrame:
    """Mean of the batch losses; a short batch weighs as much as a full one."""
    return losses.groupBy(*groups).agg(F.avg("loss").alias("loss"), F.count("*").alias("n_batches"))


@dataclass
class AdamW:
    """Decoupled weight decay, with the usual default settings."""

    rate: float = fixed.LEARNING_RATE
    beta1: float = 0.9
    beta2: float = 0.999
    epsilon: float = 1e-8
    decay: float = 0.01
    step: int = 0
    mean: dict[str, np.ndarray] = field(default_factory=dict)
    square: dict[str, np.ndarray] = field(default_factory=dict)

    def copy(self) -> AdamW:
        return replace(self, mean=dict(self.mean), square=dict(self.square))

    def update(self, weights: dict[str, np.ndarray], gradients: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        self.step += 1
        new = {}
        for name, w in weights.items():
            g = gradients[name]
            self.mean[name] = self.beta1 * self.mean.get(name, 0.0) + (1 - self.beta1) * g
            self.square[name] = self.beta2 * self.square.get(name, 0.0) + (1 - self.beta2) * g * g
            m = self.mean[name] / (1 - self.beta1**self.step)
            v = self.square[name] / (1 - self.beta2**self.step)
            new[name] = w * (1 - self.rate * self.decay) - self.rate * m / (np.sqrt(v) + self.epsilon)
        return new


HEADS = {"image": "img", "text": "txt"}


def _through_head(rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    projected = rows @ weights.T
    lengths = np.linalg.norm(projected, axis=-1, keepdims=True)
    lengths[lengths == 0] = 1.0
    return projected / lengths, lengths


def _behind_norm(slope: np.ndarray, unit: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return (slope - (slope * unit).sum(axis=-1, keepdims=True) * unit) / lengths


def batch_factors(
    image: np.ndarray, text: np.ndarray, weights: dict[str, np.ndarray], logits: Logits
) -> tuple[np.ndarray, dict[str, tuple[np.ndarray, np.ndarray]]]:
    """Loss per batch, for rows shaped (batch, n, d), and the factors of the gradients.

    The gradient of a head, summed over the batches, is the transposed first factor times the second.
    """
    i, i_len = _through_head(image, weights["image"])
    t, t_len = _through_head(text, weights["text"])
    loss, slope = pair_logit_loss(i, t, logits)
    at_image = _behind_norm(slope @ t, i, i_len)
    at_text = _behind_norm(slope.transpose(0, 2, 1) @ i, t, t_len)
    d = image.shape[-1]
    flat = lambda m: m.reshape(-1, d)
    return loss, {"image": (flat(at_image), flat(image)), "text": (flat(at_text), flat(text))}


def batch_gradients(
    image: np.ndarray, text: np.ndarray, weights: dict[str, np.ndarray], logits: Logits
) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Loss per batch and the sum of the batches' gradients, for rows shaped (batch, n, d)."""
    loss, factors = batch_factors(image, text, weights, logits)
    return loss, {name: left.T @ right for name, (left, right) in factors.items()}


def summed_gradients(
    packed: DataFrame, weights: dict[str, np.ndarray], logits: Logits
) -> tuple[float, int, dict[str, np.ndarray]]:
    """Loss sum, batch count and gradient sums over the packed batches of one step.

    Each task adds up its own batches. The matrices leave it as rows and are added again by
    (head, row) on the executors, so the driver receives one matrix per head, whose size does
    not depend on the data.
    """
    shared = packed.sparkSession.sparkContext.broadcast(weights)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        sums = {name: np.zeros_like(m) for name, m in w.items()}
        total, count = 0.0, 0
        for batch in batches:
            for _, images, texts in _stacks(batch.column("n"), batch.column("img"), batch.column("txt")):
                loss, gradient = batch_gradients(images, texts, w, logits)
                total, count = total + float(loss.sum()), count + len(loss)
                for name in sums:
                    sums[name] += gradient[name]
        if count:
            yield _rows("stats", np.array([[total, float(count)]]))
            for name, m in sums.items():
                yield _rows(name, m)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            values = batch.column("values")
            keys = zip(batch.column("head").to_pylist(), batch.column("row").to_pylist())
            for i, key in enumerate(keys):
                row = values[i].values.to_numpy()
                sums[key] = sums[key] + row if key in sums else row
        for (head, row), vector in sums.items():
            yield _rows(head, vector[None, :], row)

    schema = "head string, row int, values array<double>"
    reduced = packed.mapInArrow(partial, schema).repartition("head", "row").mapInArrow(add_up, schema)
    total, count = 0.0, 0
    gradients = {name: np.zeros_like(m) for name, m in weights.items()}
    for r in reduced.collect():
        if r["head"] == "stats":
            total, count = r["values"][0], int(r["values"][1])
        else:
            gradients[r["head"]][r["row"]] = r["values"]
    shared.unpersist()
    return total, count, gradients


def _rows(head: str, m: np.ndarray, first: int = 0) -> pa.RecordBatch:
    numbers = pa.array(np.arange(first, first + len(m)), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array([head] * len(m)), numbers, list_column(m)], ["head", "row", "values"])


def apply_heads(rows: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    """Project ``img`` by the image head and ``txt`` and ``neg`` by the text head, to unit length."""
    image_head, text_head = weights["image"], weights["text"]

    def projector(head: np.ndarray) -> Callable:
        @F.arrow_udf("array<double>")
        def project(column: pa.Array) -> pa.Array:
            column = plain(column)
            out = np.zeros((len(column), head.shape[0]))
            present = ~np.asarray(column.is_null())
            if present.any():
                out[present] = _through_head(matrix(column.drop_null()), head)[0]
            offsets = np.concatenate([[0], np.cumsum(present) * head.shape[0]])
            lists = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(out[present].ravel()), mask=pa.array(~present)
            )
            return lists

        return project.asNondeterministic()

    by_image, by_text = projector(image_head), projector(text_head)
    return rows.withColumns({"img": by_image("img"), "txt": by_text("txt"), "neg": by_text("neg")})


def identity_heads(rows: DataFrame) -> dict[str, np.ndarray]:
    dims = rows.where("img IS NOT NULL").select(F.size("img").alias("d")).first()["d"]
    return {name: np.eye(dims) for name in HEADS}


@dataclass
class Fit:
    """Fitted heads, one entry per epoch, and ``steps (epoch, step, n_batches, loss)`` as a stored table."""

    weights: dict[str, np.ndarray]
    log: list[dict]
    steps: DataFrame


def _to_text(value) -> str:
    return b64encode(pickle.dumps(value, protocol=5)).decode("ascii")


def _from_text(text: str):
    return pickle.loads(b64decode(text))


def _add_messages(messages: list[str]) -> tuple[float, int, dict[str, np.ndarray]]:
    total, count, sums = 0.0, 0, {}
    for text in messages:  # in the order of the tasks, so that all of them add up alike
        if not text:
            continue
        loss, n, parts = _from_text(text)
        total, count = total + loss, count + n
        for name, part in parts.items():
            g = part[0] if len(part) == 1 else part[0].T @ part[1]
            sums[name] = sums[name] + g if name in sums else g
    return total, count, sums


def _step_by_step(shared, n_steps: int, logits: Logits):
    """A task of the barrier stage where a step has many batches: rows ``(kind, row, n, values)``.

    Every task holds the heads and the optimiser. In each step it takes the gradient over its own
    batches of the step, the tasks exchange their sums, and all make the same update. A sum is a
    product of as many rows as its batches hold, so its factors are sent where they are smaller.
    The first task returns the state and the losses.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import BarrierTaskContext

        context = BarrierTaskContext.get()
        weights, optimiser = shared.value
        optimiser = optimiser.copy()
        mine = _packed_steps(batches)
        held = next(mine, None)
        losses = []
        for step in range(n_steps):
            total, count, rows = 0.0, 0, {name: [] for name in HEADS}
            while held is not None and held[0] == step:
                loss, factors = batch_factors(held[1][None], held[2][None], weights, logits)
                total, count = total + float(loss[0]), count + 1
                for name, pair in factors.items():
                    rows[name].append(pair)
                held = next(mine, None)
            messages = context.allGather(_to_text((total, count, {k: _smaller(v) for k, v in rows.items()})) if count else "")
            loss, n, gradients = _add_messages(messages)
            weights = optimiser.update(weights, {k: g / n for k, g in gradients.items()})
            losses.append((step, n, loss / n))
        if context.partitionId() == 0:
            yield _loss_rows(losses)
            yield from _model_rows(weights, optimiser)

    return run


def _in_turns(shared, tasks: int, logits: Logits):
    """A task of the barrier stage where a step is one batch, with the same rows.

    Such steps depend on each other one by one, so the batches stay where they are and the model
    travels: a task makes the steps of its own run of batches and hands heads and optimiser on.
    The last one returns the state, each the losses of its steps.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import BarrierTaskContext

        context = BarrierTaskContext.get()
        weights, optimiser = shared.value
        optimiser = optimiser.copy()
        losses = []
        for turn in range(tasks):
            message = ""
            if turn == context.partitionId():
                for step, images, texts in _packed_steps(batches):
                    loss, gradients = batch_gradients(images[None], texts[None], weights, logits)
                    weights = optimiser.update(weights, gradients)
                    losses.append((step, 1, float(loss[0])))
                message = _to_text((weights, optimiser))
            if turn + 1 < tasks:
                weights, optimiser = _from_text(context.allGather(message)[turn])
        if losses:
            yield _loss_rows(losses)
        if context.partitionId() == tasks - 1:
            yield from _model_rows(weights, optimiser)

    return run


def _loss_rows(losses: list[tuple[int, int, float]]) -> pa.RecordBatch:
    numbers, counts, values = zip(*losses)
    return _state_rows("step", numbers, counts, np.array(values)[:, None])


def _model_rows(weights: dict[str, np.ndarray], optimiser: AdamW) -> Iterator[pa.RecordBatch]:
    for kind, matrices in (("weights", weights), ("mean", optimiser.mean), ("square", optimiser.square)):
        for name, m in matrices.items():
            yield _state_rows(f"{kind}/{name}", range(len(m)), [optimiser.step] * len(m), m)


def _state_rows(kind: str, numbers, counts, values: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([kind] * len(values)), pa.array(numbers, pa.int64()), pa.array(counts, pa.int64()), list_column(values)]
    return pa.RecordBatch.from_arrays(columns, ["kind", "row", "n", "values"])


def _smaller(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
    left, right = (np.concatenate(side) for side in zip(*pairs))
    return (left, right) if 2 * len(left) < left.shape[1] else (left.T @ right,)


def _packed_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The packed batches of a task, one at a time, in order of their steps."""
    for batch in batches:
        for i in range(batch.num_rows):
            n = batch.column("n")[i].as_py()
            images, texts = (np.asarray(batch.column(side)[i].values).reshape(n, -1) for side in ("img", "txt"))
            yield batch.column("step")[i].as_py(), images, texts


def train_epoch(
    packed: DataFrame, n_batches: int, n_steps: int, weights: dict[str, np.ndarray], optimiser: AdamW, logits: Logits = Logits(), tasks: int | None = None
) -> tuple[dict[str, np.ndarray], AdamW, DataFrame]:
    """All steps of an epoch in one barrier stage; returns heads, optimiser and ``(step, n_batches, loss)``.

    ``packed`` is ``(step, batch_id, n, img, txt)``. Tasks read their batches in order, one at a
    time. Steps of many batches are dealt over all tasks, which exchange sums in each step. Steps
    of one batch are made in runs, one run after the other. An exchange takes about a second, as
    Spark polls for it, so it is made per step or per run and never per batch. If a task is lost the
    stage starts again from the same state, and ends in the same one. All tasks run at once, so
    there are no more than cores.
    """
    spark = packed.sparkSession
    d = len(next(iter(weights.values())))
    most = min(spark.sparkContext.defaultParallelism, MAX_TASKS, n_batches)
    in_turns = n_steps == n_batches
    if in_turns:
        rows_of = packed.agg(F.max("n")).first()[0]
        tasks = min(tasks or -(-n_batches * rows_of * 2 * d * 8 // RUN_BYTES), most)
        place = F.floor(F.col("step") * F.lit(tasks) / F.lit(n_steps))
    else:
        tasks = min(tasks or most, most)
        place = F.pmod("batch_id", F.lit(tasks))
    dealt = packed.select("step", "batch_id", "n", "img", "txt").repartitionById(tasks, place.cast("int")).sortWithinPartitions("step", "batch_id")
    shared = spark.sparkContext.broadcast((weights, optimiser))
    run = _in_turns(shared, tasks, logits) if in_turns else _step_by_step(shared, n_steps, logits)
    state = materialize(dealt.mapInArrow(run, "kind string, row long, n long, values array<double>", barrier=True), "epoch_state")
    found: dict[str, dict[str, np.ndarray]] = {k: {name: np.zeros_like(m) for name, m in weights.items()} for k in ("weights", "mean", "square")}
    for r in state.where("kind <> 'step'").collect():  # the heads and the optimiser
        k, name = r["kind"].split("/")
        found[k][name][r["row"]] = r["values"]
    shared.unpersist()
    after = replace(optimiser, step=optimiser.step + n_steps, mean=found["mean"], square=found["square"])
    steps = state.where("kind = 'step'").select(F.col("row").alias("step"), F.col("n").alias("n_batches"), F.get("values", F.lit(0)).alias("loss"))
    return found["weights"], after, steps


def fit_heads(
    rows: DataFrame,
    epochs: int = fixed.NUM_EPOCHS,
    batch_size: int = fixed.BATCH_SIZE,
    steps_per_epoch: int | None = None,
    logits: Logits = Logits(),
    rate: float = fixed.LEARNING_RATE,
    seed: int = fixed.SEED,
    validate: bool = True,
    tasks: int | None = None,
) -> Fit:
    """Fit a linear image head and text head on stored vectors.

    ``rows`` is ``(split, id, img, txt, neg)``. Batches are drawn anew each epoch. An optimiser step
    takes the mean gradient of its batches: one batch by default, which is the rule of
    single-machine training, or more where ``steps_per_epoch`` makes fewer steps. An epoch is one
    barrier stage, whatever the number of steps. The last weights are returned, and the log lets
    the caller pick the best epoch.
    """
    train = rows.where("split = 'train'").select("id", "img", "txt")
    valid = rows.where("split = 'valid'")
    n_batches = -(-train.count() // batch_size)
    if n_batches == 0:
        raise ValueError("no rows in the train split")
    weights = identity_heads(train)
    optimiser = AdamW(rate=rate)
    n_steps = n_batches if steps_per_epoch is None else min(steps_per_epoch, n_batches)
    log, steps = [], None
    for epoch in range(1, epochs + 1):
        drawn = assign_batches(train.withColumn("epoch", F.lit(epoch)), ["epoch"], "id", batch_size, seed)
        packed = pack_batches(drawn, []).withColumn("step", F.pmod("batch_id", F.lit(n_steps)).cast("long"))
        weights, optimiser, done = train_epoch(materialize(packed, "epoch"), n_batches, n_steps, weights, optimiser, logits, tasks)
        done = done.select(F.lit(epoch).alias("epoch"), "step", "n_batches", "loss")
        steps = done if steps is None else steps.unionByName(done)
        mean = done.agg((F.sum(F.col("loss") * F.col("n_batches")) / F.sum("n_batches")).alias("loss")).first()["loss"]
        entry = {"epoch": epoch, "loss": mean}
        if validate:
            m = evaluate(apply_heads(valid, weights), ["split"]).first()
            entry["valid_recall_at_1"] = m["recall_at_1"] if m else None
            entry["valid_triplet_accuracy"] = m["triplet_accuracy"] if m else None
        log.append(entry)
    return Fit(weights, log, steps)


def log_frame(spark, log: list[dict]) -> DataFrame:
    columns = "epoch int, loss double, valid_recall_at_1 double, valid_triplet_accuracy double"
    names = ["epoch", "loss", "valid_recall_at_1", "valid_triplet_accuracy"]
    return spark.createDataFrame([tuple(entry.get(n) for n in names) for entry in log], columns)


def weight_rows(spark, weights: dict[str, np.ndarray]) -> DataFrame:
    """Heads as ``(head, row, weights)``: as many rows as the vectors have dimensions."""
    rows = [(name, i, [float(x) for x in m[i]]) for name, m in weights.items() for i in range(len(m))]
    return spark.createDataFrame(rows, "head string, row int, weights array<double>")
