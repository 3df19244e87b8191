"""Ranked search against scores of all documents; blocks, passes, bounds and odd rows."""

import math
import random
import re
from collections import Counter

import pytest

from tagweave.llm import ranking
from tests.llm.odd import odd_docs, odd_texts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def plain(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    total = sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for q, text in items:
        asked.setdefault(q, set()).update(terms(text))
    out = set()
    for q, wanted in asked.items():
        scored = []
        for i, bag in bags:
            m = 100 - 90 + 90 * sum(bag.values()) * len(bags) // total
            score = sum(int(math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1)))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t in wanted if t in bag)
            if score > 0:
                scored.append((-score, -(2**63) if i is None else i))
        for rank, (score, i) in enumerate(sorted(scored)[:k], 1):
            out.add((q, rank, None if i == -(2**63) else i, -score))
    return out


def found(spark, docs, items, k=10):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id string, text string")
    rows = ranking.search(ranking.build_index(docs, "doc_id", "text"), items, "item_id", "text", k).collect()
    assert len(rows) == len({tuple(r) for r in rows})
    return {tuple(r) for r in rows}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    words = [f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(20_000)]
    docs = [(i, " ".join(rng.choices(words, k=int(rng.paretovariate(0.8)) % 400))) for i in range(300)]
    docs += [(1000 + i, "W1 w2, w3.w4") for i in range(40)]  # many equal scores in one stratum
    items = [(f"q{i}", " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for i in range(30)]
    return docs, [*items, ("q0", "w1 w77"), ("same", "w1 w2 w3 w4 w4"), ("none", "absent"), ("empty", ""), (None, "w5 w6")]


def test_scores_of_all_documents(spark, corpus):
    docs, items = corpus
    assert found(spark, docs, items) == plain(docs, items)
    assert found(spark, docs, items, 3) == plain(docs, items, 3)


def test_blocks_and_passes(spark, corpus, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_POSTINGS", 40)
    monkeypatch.setattr(ranking, "QUERY_TERMS", 30)
    monkeypatch.setattr(ranking, "BROADCAST_BYTES", 0)
    assert found(spark, *corpus) == plain(*corpus)


def test_only_strata_within_the_bound_are_scored(spark, corpus):
    """Blocks below the score that is reached are left out, and nothing changes."""
    import numpy as np
    import pyarrow as pa

    docs, _ = corpus
    index = ranking.build_index(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    blocks = index.blocks.toArrow().to_batches()
    wanted = ["w1", "w10", "w2"]

    class Shared:
        def __init__(self, value):
            self.value = value

    def scored(floor):
        query = ranking.Query(np.zeros(3, int), np.arange(3), np.array([100, 900, 200]), np.array([floor]))
        out = pa.Table.from_batches(list(ranking._score(Shared(query), Shared(wanted), 10, False)(iter(blocks))))
        return sorted(zip((-out.column("score").to_numpy()).tolist(), out.column("doc").to_pylist()))

    every = scored(0)
    tenth = -every[9][0]
    some = scored(tenth)
    assert some[:10] == every[:10] and len(some) < len(every)


def test_terms_of_cut_texts():
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choices("aBé1 .\n\x00@[`{\x7f\U0001f600", k=rng.randrange(80)))
        for chunk in (1, 7, 1 << 20):
            assert ranking.terms_of(text.encode(), chunk) == Counter(t.encode() for t in terms(text))


def test_odd_rows(spark):
    rows = [*odd_texts(), (None, "one tail"), (None, "tail"), (5, "a b c d e"), (5, "other one")]
    items = [("x", "one TAIL"), ("y", None), ("z", "\U0001f600 É"), ("l", odd_texts()[6][1])]
    docs = odd_docs(spark, rows)
    queries = spark.createDataFrame([(i, t, 1, "clash") for i, t in items], "item_id string, text string, score int, term string")
    index = ranking.build_index(docs, "doc_id", "text")
    got = ranking.search(index, queries, "item_id", "text").collect()
    assert {tuple(r) for r in got} == plain(rows, items) and any(r.doc is None for r in got)
    assert ranking.search(index, queries.limit(0), "item_id", "text").count() == 0
    empty = ranking.build_index(odd_docs(spark, []), "doc_id", "text")
    assert ranking.search(empty, queries, "item_id", "text").count() == 0


def test_query_against_brute_force(spark):
    from tagweave.llm import queries

    read = lambda name, i: [(r[0], r[1]) for r in spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").select(i, "text").collect()]
    got = queries.op13_ranked_search(spark, "/root/testdata/sf0.001")
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == plain(read("documents", "doc_id"), read("benchmark", "item_id"))
