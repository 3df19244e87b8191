"""Windows of the benchmark against brute force, proximity matches and odd rows."""

import random
import re

import pytest

from tagweave.llm import decontaminate
from tests.llm.odd import odd_docs, odd_texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, bench, size):
    windows = {}
    for item, text in bench:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    items |= windows[key]
        out[doc] = (len(w), len(hit), sorted(items))
    return out


def got(spark, docs, bench, size, **how):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    found = decontaminate.contaminated(d, b, "doc_id", "text", "item_id", "text", size, **how)
    return {r.doc_id: (r.n_words, r.n_hit, r.items) for r in found.collect()}


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "été", "Été", "x1", "9"] + [f"w{i}" for i in range(25)]
    bench = [(i, ", ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 6, 12])))) for i in range(25)] + [(90, None), (91, ""), (7, "w1 w2 w3 w4 w5 w6")]
    docs = []
    for i in range(n):
        text = rng.choices(vocabulary, k=rng.randrange(40))
        if rng.random() < 0.6:
            text[rng.randrange(len(text) + 1) : 0] = words(rng.choice(bench)[1])
        docs.append((i, rng.choice([" ", "-", ".\n"]).join(text)))
    return docs, bench


@pytest.mark.parametrize("seed,size", [(1, 4), (2, 6), (3, 2)])
def test_equals_brute_force(spark, seed, size):
    docs, bench = corpus(seed)
    assert got(spark, docs, bench, size) == brute(docs, bench, size)


def test_shuffled_joins(spark, monkeypatch):
    docs, bench = corpus(4, 40)
    monkeypatch.setattr(decontaminate, "small", lambda df, rows=0: df)
    assert got(spark, docs, bench, 4) == brute(docs, bench, 4)


def test_proximity(spark):
    docs = [(1, "a b c d e f"), (2, "z a c b d e f"), (3, "a b c"), (4, "f e d c b a")]
    bench = [(1, "a b c d e f")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    found = decontaminate.contaminated(d, b, "doc_id", "text", "item_id", "text", 6, slop=1).collect()
    assert {r.doc_id: (r.n_hit, r.n_near > 0) for r in found} == {1: (6, False), 2: (0, True), 3: (0, False), 4: (0, False)}


def test_odd_rows_and_clean(spark):
    rows = [*odd_texts(), (None, "a b c d e"), (5, "a b c d e"), (20, "say A, b; C d E now"), (5, "other text")]
    docs = odd_docs(spark, rows)
    bench = spark.createDataFrame([(1, "a b c d e", 1), (None, "one"), (3, None)][0:1], "item_id long, text string, doc_id int")
    found = decontaminate.contaminated(docs, bench, "doc_id", "text", "item_id", "text").collect()
    assert len(found) == len(rows)
    hits = sorted(((r.doc_id, r.n_hit) for r in found if r.n_hit), key=repr)
    assert hits == sorted([(5, 5), (5, 5), (6, 5), (20, 5), (None, 5)], key=repr)
    clean = decontaminate.clean(docs, bench, "doc_id", "text", "item_id", "text")
    assert clean.schema == docs.schema and clean.count() == len(rows) - 5
    assert decontaminate.contaminated(odd_docs(spark, []), bench, "doc_id", "text", "item_id", "text").count() == 0
    none = decontaminate.contaminated(docs, bench.limit(0), "doc_id", "text", "item_id", "text")
    assert none.count() == len(rows) and none.where("n_hit > 0").count() == 0


def test_clean_keeps_documents_with_the_terms_of_a_window_only(spark):
    rows = [(1, "0 0 0 0 1 2 3 4 5 6"), (2, "no"), (3, "it said no once"), (4, "x 0 0 0 0 1 0 0 0 0 0"), (5, "a no, no b"), (6, "1 0 0 0 0 1 1 0 0 0 0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, "0 0 0 0 1 0 0 0 0 0"), (2, "no no")], "item_id long, text string")
    found = {r.doc_id: r.n_hit for r in decontaminate.contaminated(docs, bench, "doc_id", "text", "item_id", "text").collect()}
    kept = {r.doc_id for r in decontaminate.clean(docs, bench, "doc_id", "text", "item_id", "text").collect()}
    assert kept == {i for i, n in found.items() if n == 0} == {1, 2, 3, 6}
