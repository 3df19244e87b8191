"""Counterfactual-regularised toxicity classifier.

A logistic regression on the presence of words and word beginnings, which stand for the stems of
inflected languages, fitted on a bounded sample of labelled texts. In
labelled sentences that name an identity group, the group's term is swapped for others of its
list, and the squared change of the score is added to the loss: a neutral mention of a group
must not move the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import materialize, slices

MAX_ROWS = 20_000  # labelled rows that the model is fitted on
MAX_FEATURES = 512  # words and beginnings with a weight, besides the identity terms
MIN_DF = 8  # labelled rows that a feature must occur in
PENALTY = 5.0  # weight of the counterfactual term
L2 = 1e-3
STEPS = 400
RATE = 0.3

# Identity terms by group; a term is swapped within its group.
IDENTITY = {
    "gender": "woman women man men girl boy female male trans".split(),
    "faith": "muslim christian jewish hindu buddhist catholic atheist".split(),
    "origin": "black white asian latino african european arab mexican immigrant".split(),
    "orientation": "gay straight lesbian bisexual heterosexual".split(),
    "body": "disabled blind deaf old young".split(),
}

PREFIXES = (4, 5)  # letters of word beginnings

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def parts(words: set[str]) -> set[str]:
    """The words and their beginnings, marked by a star."""
    return words.union(*({w[:k] + "*" for w in words if len(w) >= k} for k in PREFIXES))


def features(text: str | None) -> set[str]:
    return parts(set(_WORD.findall((text or "").lower())))


@dataclass(frozen=True)
class Model:
    words: tuple[str, ...]
    weights: tuple[float, ...]
    bias: float

    def score(self, text: str | None) -> float:
        """Probability of label 1; a null or empty text has that of no words."""
        return _sigmoid(self.bias + sum(map(self.table.__getitem__, self.found(text))))

    def found(self, text: str | None) -> list[str]:
        return sorted(self.table.keys() & features(text))

    @property
    def table(self) -> dict[str, float]:
        if "_table" not in self.__dict__:
            object.__setattr__(self, "_table", dict(zip(self.words, self.weights)))
        return self.__dict__["_table"]


def _sigmoid(z: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def _few_rows(batches: Iterator[pa.RecordBatch], rows: int = 128) -> Iterator[pa.RecordBatch]:
    """Smaller batches: the features of many texts at once would be most of a worker's memory."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def sample_labels(labels: DataFrame, id_col: str, label_col: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """At most ``max_rows`` labelled ids, picked by the hash of the id; ids are unique.

    An id that is labelled twice counts as 1 if any of its labels is; null labels and ids go.
    """
    rows = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).dropna()
    rows = rows.groupBy("_id").agg(F.max("_y").alias("_y"))
    return rows.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int = MAX_ROWS) -> Model:
    """Fit on ``max_rows`` labelled rows at most; that sample is all that reaches the driver.

    Without any labelled text the model scores 0 for every text; with one class only it scores
    that class.
    """
    picked = F.broadcast(sample_labels(labels, id_col, label_col, max_rows))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    # Written, as the steps below would each scan all documents for it.
    sample = materialize(texts.join(picked, "_id"), "toxicity_sample")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few_rows(batches):
            found = [sorted(features(t)) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"_id": batch.column("_id"), "_y": batch.column("_y"), "w": pa.array(found, pa.list_(pa.string()))})

    id_kind = sample.schema["_id"].dataType.simpleString()
    bags = sample.mapInArrow(words, f"_id {id_kind}, _y int, w array<string>")
    terms = sorted({t for group in IDENTITY.values() for t in group})
    share, rows = (sample.agg(F.avg("_y").alias("p"), F.count("*").alias("n")).first() or (0.0, 0))
    if not rows:
        return Model((), (), -60.0)
    chosen = _features(bags, share, terms)
    x, y, swaps = _matrices(sample, chosen)
    weights, bias = _descend(x, y, swaps)
    kept = [(w, float(v)) for w, v in zip(chosen, weights) if abs(v) > 1e-9]
    return Model(tuple(w for w, _ in kept), tuple(v for _, v in kept), float(bias))


def _features(bags: DataFrame, share: float, terms: list[str]) -> list[str]:
    """The features whose frequency differs most between the classes, and all identity terms."""
    df = bags.select(F.explode("w").alias("w"), "_y").groupBy("w").agg(F.count("*").alias("n"), F.sum("_y").alias("k"))
    z = F.abs(F.col("k") - F.col("n") * share) / F.sqrt(F.col("n") * max(share * (1 - share), 1e-6))
    top = df.where(F.col("n") >= MIN_DF).orderBy(z.desc(), "w").select("w").limit(MAX_FEATURES).collect()
    return sorted({r.w for r in top} | set(terms))


def _matrices(sample: DataFrame, chosen: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Presence of the chosen words in each sampled text, labels, and changes by swaps."""
    index = {w: i for i, w in enumerate(chosen)}
    group_of = {t: g for g, members in IDENTITY.items() for t in members}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few_rows(batches):
            bags, named = [], []
            for text in batch.column("_text").to_pylist():
                text = (text or "").lower()
                bags.append(sorted(index[w] for w in index.keys() & features(text)))
                changes: Counter = Counter()
                if not group_of.keys().isdisjoint(_WORD.findall(text)):
                    for sentence in _SENTENCE.split(text):
                        for old in group_of.keys() & set(_WORD.findall(sentence)):
                            changes.update(f"{old} {new}" for new in IDENTITY[group_of[old]] if new != old)
                named.append(sorted(changes))
            yield pa.RecordBatch.from_pydict({"y": batch.column("_y"), "x": pa.array(bags, pa.list_(pa.int32())), "s": pa.array(named, pa.list_(pa.string()))})

    found = sample.mapInArrow(rows, "y int, x array<int>, s array<string>").toPandas()
    x = np.zeros((len(found), len(chosen)), np.float32)
    swaps: Counter = Counter()
    for i, (bag, named) in enumerate(zip(found.x, found.s)):
        x[i, np.asarray(bag, int)] = 1
        swaps.update(named)
    change = np.zeros((len(swaps), len(chosen)), np.float32)
    for row, (swap, n) in enumerate(sorted(swaps.items())):
        old, new = swap.split()
        for sign, word in ((-1, old), (1, new)):
            for part in index.keys() & parts({word}):
                change[row, index[part]] += sign * np.sqrt(n)
    return x, found.y.to_numpy(np.float32), change / np.sqrt(max(1, len(found)))


def _descend(x: np.ndarray, y: np.ndarray, swaps: np.ndarray) -> tuple[np.ndarray, float]:
    """Adam on log loss, L2, and squared changes by swaps."""
    n, d = x.shape
    w, b = np.zeros(d, np.float32), np.float32(0)
    m, v = np.zeros(d + 1, np.float32), np.zeros(d + 1, np.float32)
    for step in range(1, STEPS + 1):
        error = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y) / n
        grad = np.append(x.T @ error + L2 * w + 2 * PENALTY * (swaps.T @ (swaps @ w)), error.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        update = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) / (1 + step / 50)
        w, b = w - update[:-1], b - update[-1]
    return w, b


def score(df: DataFrame, text_col: str, model: Model, out_col: str = "score") -> DataFrame:
    """``df`` with the score of each text; no shuffle, and repeated rows are scored alike.

    A column that is already called ``out_col`` is replaced, other columns are kept.
    """
    kept = [c for c in df.columns if c != out_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, len(kept)):
            scores = pa.array([model.score(t) for t in batch.column("_text").to_pylist()], pa.float64())
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, scores], names=[f"c{i}" for i in range(len(kept) + 1)])

    own = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(text_col).cast("string").alias("_text"))
    ddl = "".join(f"c{i} {own.schema[f'c{i}'].dataType.simpleString()}, " for i in range(len(kept)))
    found = own.mapInArrow(run, f"{ddl}c{len(kept)} double")
    return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], F.col(f"c{len(kept)}").alias(out_col))


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learned from: crc32 of the id as text, mod 4, is 2."""
    return F.crc32(doc_id.cast("string")) % 4 == 2
