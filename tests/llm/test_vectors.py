"""Links and components against all pairs in double precision."""

import math

import numpy as np
import pytest

from tagweave.llm import vectors


def brute(rows, threshold=0.95):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.setdefault(len(v), []).append((i, np.array(v, np.float64)))
    links, root = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for same in good.values():
        for k, (a, x) in enumerate(same):
            for b, y in same[k + 1 :]:
                x1, y1 = x / np.abs(x).max(), y / np.abs(y).max()
                if x1 @ y1 / math.sqrt((x1 @ x1) * (y1 @ y1)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    p, q = find(a), find(b)
                    root[max(p, q)] = min(p, q)
    return {i: (links[i], find(i), find(i) == i) for i in links}


def got(spark, rows, kind="float", **how):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, n_links string, rep int" if len(rows[0]) > 2 else f"vec_id long, embedding array<{kind}>")
    return {r.vec_id: (r.n_links, r.component, r.kept) for r in vectors.near_duplicates(df, "vec_id", "embedding", **how).collect()}


def clouds(seed, n=300, d=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    v = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, d)) * rng.choice([0.02, 0.15, 0.4], (n, 1))
    v = (v * rng.uniform(0.1, 10, (n, 1))).astype(np.float32)
    v[rng.integers(0, n, n // 4)] = v[0]
    return [(int(i), [float(x) for x in v[i]]) for i in rng.permutation(n)]


@pytest.mark.parametrize("seed,how", [(1, {}), (2, {"block_bytes": 8 * 8 * 20}), (3, {"block_bytes": 8 * 8 * 7, "max_pivots": 3})])
def test_equals_brute_force(spark, seed, how):
    rows = clouds(seed)
    assert got(spark, rows, **how) == brute(rows)


def test_real_embeddings_have_links(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    found = got(spark, rows, threshold=0.35, block_bytes=8 * 64 * 50)
    assert found == brute(rows, 0.35) and sum(n for n, _, _ in found.values()) > 0


def test_odd_rows(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 0.0]),
            (8, [1e300, 0.0]), (9, [1.0, 0.0]), (10, [1.0]), (11, [5e-300, 0.0]), (12, [-1.0, 0.0]), (13, [0.0, -0.0])]
    found = got(spark, [(*r, "clash", 1) for r in rows], "double")
    assert found == brute(rows) and found[7] == (3, 7, True) and found[10] == (0, 10, True)
    df = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    both = [tuple(r) for r in vectors.near_duplicates(df, "vec_id", "embedding").collect()]
    assert sorted(both, key=repr) == sorted([(None, 0, None, False), (1, 1, 1, True), (1, 1, 1, True)], key=repr)
    assert vectors.near_duplicates(df.limit(0), "vec_id", "embedding").count() == 0


def test_a_pair_at_the_threshold(spark):
    c = 0.95
    rows = [(1, [1.0, 0.0]), (2, [c, math.sqrt(1 - c * c)]), (3, [c - 1e-9, math.sqrt(1 - (c - 1e-9) ** 2)])]
    found = got(spark, rows, "double")
    assert found[3][0] == 1 and found[1][0] == brute(rows)[1][0]
