"""Embedding near-duplicates by an exact metric range join.

Vectors on the unit sphere go to the cell of their nearest pivot. Cosine >= t means a distance of
at most r = sqrt(2 - 2t), and by the triangle inequality a neighbour of a vector of cell i is at
most 2r farther from pivot i than from its own pivot: vectors within that margin are copied into
cell i, and each cell is joined on its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import materialize
from tagweave.llm.components import connected

THRESHOLD = 0.95
MAX_PIVOTS = 1024  # so many vectors at most are broadcast per width
BLOCK_BYTES = 4 << 20  # doubles of a side that are compared in one task; also the size of a cell
PRODUCT_ROWS = 512
SLACK = 1e-9  # rounding of distances
SINGLE = 1e-5  # more than products in single precision can be off
CLOSE = 1e-12  # similarities this near the threshold are summed exactly


def unit(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by their largest component first so that no square overflows."""
    values = values.astype(np.float64)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``(i, j)`` of two unit matrices with a cosine of at least ``threshold``.

    Products in single precision, which are faster, leave out what is clearly below; the rest is
    decided in double precision.
    """
    single, other = a.astype(np.float32), b.astype(np.float32).T
    left, right = [], []
    for start in range(0, len(a), PRODUCT_ROWS):
        i, j = np.nonzero(single[start : start + PRODUCT_ROWS] @ other >= threshold - SINGLE)
        for k in range(0, len(i), 1 << 17):
            x, y = i[k : k + (1 << 17)] + start, j[k : k + (1 << 17)]
            sim = np.einsum("nd,nd->n", a[x], b[y])
            found = sim >= threshold
            for c in np.flatnonzero(np.abs(sim - threshold) < CLOSE).tolist():
                found[c] = math.fsum((a[x[c]] * b[y[c]]).tolist()) >= threshold
            left.append(x[found])
            right.append(y[found])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def forest(i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the least id of its component in the graph ``i - j``."""
    label = ids.copy()
    while True:
        least = np.minimum(label[i], label[j])
        after = label.copy()
        np.minimum.at(after, i, least)
        np.minimum.at(after, j, least)
        if (after == label).all():
            break
        label = after
    moved = label != ids
    return ids[moved], label[moved]


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def near_duplicates(
    df: DataFrame, id_col: str, vec_col: str, threshold: float = THRESHOLD, max_pivots: int = MAX_PIVOTS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``(id_col, n_links, component, kept)`` for each row of ``df``.

    ``n_links`` counts the other rows with cosine >= ``threshold``, ``component`` is the least id
    reachable over such links and ``kept`` marks the row of that id. Rows with equal vectors are
    one class, compared once. A vector that is null, empty or zero, or that has a null or
    non-finite component, links with nothing, and so do vectors of different widths. A row with
    a null id takes no part: it has no links, a null component and is not kept. Other columns
    are dropped.
    """
    rows = df.select(F.col(id_col).cast("long").alias("_id"), F.col(vec_col).alias("_v"))
    if rows.schema["_v"].dataType.simpleString() != "array<float>":  # single precision is kept as it is
        rows = rows.withColumn("_v", F.col("_v").cast("array<double>"))
    odd = F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("_id").isNotNull() & F.col("_v").isNotNull() & ~odd & F.exists("_v", lambda x: x != 0)
    rows = rows.withColumn("_ok", F.coalesce(usable, F.lit(False)))
    classes = rows.where("_ok").groupBy("_v").agg(F.min("_id").alias("rep"), F.count("*").alias("m"))
    classes = materialize(classes.withColumn("dim", F.size("_v")), "classes")

    pivots = _pivots(classes, max_pivots, block_bytes)
    dealt = materialize(_assign(classes, pivots, math.sqrt(max(0.0, 2 - 2 * threshold))), "cells")
    parts = materialize(_join_cells(dealt, threshold, block_bytes), "links")

    counts = parts.where("n is not null").groupBy("rep").agg(F.sum("n").alias("n"))
    comps = connected(parts.where("root is not null").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    facts = classes.join(counts, "rep", "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    total = F.coalesce("n", F.lit(0)) + F.col("m") - 1
    facts = materialize(facts.select(F.col("_v").alias("_w"), total.alias("n_links"), F.coalesce("component", "rep").alias("component")), "facts")
    rows = rows.join(facts, F.when(F.col("_ok"), F.col("_v")) == F.col("_w"), "left")
    component = F.coalesce("component", "_id")
    return rows.select(
        F.col("_id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component"),
        F.coalesce(component == F.col("_id"), F.lit(False)).alias("kept"),
    )


def _pivots(classes: DataFrame, max_pivots: int, block_bytes: int) -> dict[int, np.ndarray]:
    """Unit pivots per width, picked by hash: one for each block of vectors.

    More pivots make smaller cells, but where vectors lie far apart in many dimensions, most
    cells are within reach of most vectors, and each is one more copy.
    """
    out = {}
    for dim, n in classes.groupBy("dim").count().collect():
        want = min(max_pivots, -(-n * 8 * dim // block_bytes))
        picked = classes.where(F.col("dim") == dim).orderBy(F.xxhash64("rep"), "rep").select("_v").limit(want).collect()
        out[dim] = unit(np.array([r["_v"] for r in picked]))
    return out


def _assign(classes: DataFrame, pivots: dict[int, np.ndarray], radius: float) -> DataFrame:
    """``(dim, cell, home, rep, m, v)``: each class in its own cell and, as a guest, near others."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                some = batch.take(pa.array(np.flatnonzero(dims == dim)))
                for start in range(0, some.num_rows, 2048):
                    part = some.slice(start, 2048)
                    away = 2 - 2 * unit(_matrix(part.column("_v"))) @ shared.value[dim].T
                    away = np.sqrt(np.maximum(away, 0))
                    own = away.argmin(axis=1)
                    reach = away[np.arange(len(own)), own] + 2 * radius + SLACK
                    row, cell = np.nonzero(away <= reach[:, None])
                    copies = part.take(pa.array(row))
                    columns = [copies.column("dim"), pa.array(cell.astype(np.int32)), pa.array(own[row] == cell), copies.column("rep"), copies.column("m"), copies.column("_v")]
                    yield pa.RecordBatch.from_arrays(columns, names=["dim", "cell", "home", "rep", "m", "v"])

    kind = classes.schema["_v"].dataType.simpleString()
    return classes.mapInArrow(run, f"dim int, cell int, home boolean, rep long, m long, v {kind}")


def _join_cells(dealt: DataFrame, threshold: float, block_bytes: int) -> DataFrame:
    """Rows ``(rep, n)`` of link counts, and ``(rep, root)`` of links within a block pair.

    A cell with many rows is cut into blocks: every home block meets every block of all rows, so
    no group has more than about two blocks, and each ordered pair is met once.
    """
    sizes = dealt.groupBy("dim", "cell").agg(F.count_if("home").alias("h"), F.count("*").alias("n"))
    blocks = F.broadcast(  # one row per pivot at most
        sizes.select("dim", "cell", *[F.ceil(F.col(c) * F.col("dim") * 8 / block_bytes).cast("int").alias(b) for c, b in (("h", "hb"), ("n", "ab"))]).where("h > 0")
    )
    rows = dealt.join(blocks, ["dim", "cell"])
    mine = F.pmod(F.xxhash64("rep"), "hb").cast("int")
    other = F.pmod(F.xxhash64("rep"), "ab").cast("int")
    asks = rows.where("home").select("dim", "cell", mine.alias("i"), F.explode(F.sequence(F.lit(0), F.col("ab") - 1)).alias("j"), F.lit(True).alias("asks"), "rep", "m", "v")
    told = rows.select("dim", "cell", F.explode(F.sequence(F.lit(0), F.col("hb") - 1)).alias("i"), other.alias("j"), F.lit(False).alias("asks"), "rep", "m", "v")

    def join(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        asks = group.column("asks").to_numpy(zero_copy_only=False)
        v = unit(_matrix(group.column("v").chunk(0)))
        rep, m = group.column("rep").to_numpy(), group.column("m").to_numpy()
        a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
        i, j = linked(v[a], v[b], threshold)
        other = rep[a[i]] != rep[b[j]]
        i, j = i[other], j[other]
        n = np.zeros(len(a), np.int64)
        np.add.at(n, i, m[b[j]])
        some = n > 0
        ids, at = np.unique(rep, return_inverse=True)
        node, root = forest(at[a[i]], at[b[j]], ids)
        none = lambda k, t: pa.nulls(k, t)
        return pa.table(
            {
                "rep": pa.array(np.concatenate([rep[a][some], node]), pa.int64()),
                "n": pa.concat_arrays([pa.array(n[some], pa.int64()), none(len(node), pa.int64())]),
                "root": pa.concat_arrays([none(int(some.sum()), pa.int64()), pa.array(root, pa.int64())]),
            }
        )

    return asks.unionByName(told).groupBy("dim", "cell", "i", "j").applyInArrow(join, "rep long, n long, root long")
