"""Components against brute force over all pairs, with small blocks, ties and odd rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tagweave.llm import jaccard
from tests.llm.odd import odd_docs, odd_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size=4):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, percent=85):
    """Component per id, over the links of all rows; ids are unique."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


def got(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: (r.n_shingles, r.component) for r in jaccard.link(df, "doc_id", "text").collect()}


def near_rows(rng, groups=12, members=14):
    """Groups of edited copies around the threshold, over a few words, with shared lines."""
    words = [f"w{i}" for i in range(60)] + ["É", "the", "The"]
    line = "one very common line that many of the texts share"
    rows, i = [], 0
    for g in range(groups):
        base = rng.choices(words, k=rng.choice([3, 5, 20, 60, 150]))
        for m in range(members):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(text))
                text[at : at + 1] = rng.choices(words, k=rng.choice([0, 1, 2]))
            rows.append((i, rng.choice([" ", "\n"]).join(text) + (" " + line if rng.random() < 0.4 else "")))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = near_rows(random.Random(seed))
    assert got(spark, rows) == brute(rows)


def test_large_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 3)
    rows = near_rows(random.Random(3), groups=4, members=25)
    assert got(spark, rows) == brute(rows)


def test_shuffled_joins(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    rows = near_rows(random.Random(4), groups=5, members=8)
    assert got(spark, rows) == brute(rows)


def test_every_level_is_safe():
    """Whatever l the sets pick, no pair above the threshold is lost."""
    rng = np.random.default_rng(5)
    order = rng.permutation(500).astype(np.uint64)
    for _ in range(300):
        base = rng.choice(500, rng.integers(1, 60), replace=False)
        other = np.where(rng.random(len(base)) < 0.08, rng.integers(500, 900, len(base)), base)
        a, b = np.unique(base), np.unique(other)
        key = lambda x: np.array(sorted(x, key=lambda t: int(order[t]) if t < 500 else int(t)), np.uint64)
        most = lambda x: -(-85 * len(x) // 100)
        ell = np.array([rng.integers(1, min(4, most(a)) + 1), rng.integers(1, min(4, most(b)) + 1)])
        found, _ = jaccard.compare_sets([key(a), key(b)], ell, np.array([True, False]), 85)
        shared = len(np.intersect1d(a, b))
        assert bool(len(found)) == (100 * shared >= 85 * (len(a) + len(b) - shared))


def test_real_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    found = got(spark, rows)
    assert found == brute(rows) and len({c for _, c in found.values()}) < len(rows)


def test_shingle_sets_do_not_cross_texts():
    texts = pa.array(["a b c d", None, "", "A B", "a b c d e", "a b"])
    sets = [set(s.tolist()) for s in jaccard.shingle_sets(texts, 4)]
    assert [len(s) for s in sets] == [1, 0, 0, 1, 2, 1]
    assert sets[0] < sets[4] and sets[3] == sets[5]


def test_odd_rows(spark):
    rows = [*odd_texts(), (5, "a b c d e"), (None, "a b c d e"), (12, LAST := "solo text of its own here")]
    found = jaccard.link(odd_docs(spark, rows), "doc_id", "text").collect()
    assert len(found) == len(rows)
    by = {r.doc_id: (r.n_shingles, r.component) for r in found}
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[3] == (0, 3) and by[4] == (1, 4)
    assert by[5] == by[6] == (2, 5) and by[7][1] == by[8][1] == 7 and by[10] == (1, 10)
    assert by[None] == (2, None) and by[12] == (len(shingles(LAST)), 12)
    assert jaccard.link(odd_docs(spark, []), "doc_id", "text").count() == 0


def brute_links(rows, percent=85):
    """Links per row of ``rows``, whose ids may repeat."""
    sets = [shingles(t) if i is not None else set() for i, t in rows]
    linked = lambda x, y: bool(x and y) and 100 * len(x & y) >= percent * len(x | y)
    return sorted((i, sum(linked(x, y) for k, y in enumerate(sets) if k != at)) for at, ((i, _), x) in enumerate(zip(rows, sets)) if i is not None)


@pytest.mark.parametrize("block", [1024, 3])
def test_every_link_is_counted_once(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    rows = near_rows(random.Random(6), groups=5, members=16)
    # Dense groups close cycles; an id that repeats stands for several texts, or for a text twice.
    base = [f"d{i}" for i in range(80)]
    rows += [(1000 + i, " ".join(base[: 80 - i])) for i in range(9)] + [(1000, " ".join(base[1:])), (1001, " ".join(base[:79])), (1000, None), (None, " ".join(base))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.link(df, "doc_id", "text").collect()
    assert sorted((r.doc_id, r.n_links) for r in found if r.doc_id is not None) == brute_links(rows)
    assert [r.n_links for r in found if r.doc_id is None] == [0]
    assert sum(r.n_links for r in found) > 2 * len(rows)
