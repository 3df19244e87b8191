"""Variant grouping against edit distances of all pairs; cut texts, hot chunks, odd rows."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tagweave.llm import spelling
from tests.llm.odd import odd_docs, odd_texts

RUN = re.compile("[A-Za-zÀ-ÿ]+")
FOLD = str.maketrans(spelling.UPPER, spelling.LOWER)


def plain_words(rows, slip=199):
    out = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(FOLD)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return out


def one_edit(x, y):
    if len(x) < len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(x) == len(y) + 1 and any(x[:i] + x[i + 1 :] == y for i in range(len(x)))


def plain_forms(counts):
    near = {w: sorted((v for v in counts if one_edit(w, v)), key=lambda v: (-counts[v], v)) for w in counts}
    form = {w: near[w][0] if near[w] and counts[near[w][0]] >= 5 * counts[w] else None for w in counts}

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()}


def random_words(rng, k, letters="abé", longest=9):
    return {"".join(rng.choices(letters, k=rng.randrange(6, longest))): rng.choice([5, 6, 24, 25, 130, 700]) for _ in range(k)}


@pytest.mark.parametrize("block", [spelling.BLOCK_WORDS, 3])
def test_forms_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    counts = random_words(random.Random(1), 400)
    got = spelling.forms(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert len(got) == len(counts)
    assert {tuple(r) for r in got} == plain_forms(counts)
    assert any(r.root != r.form for r in got if r.form)


def test_each_pair_once(spark):
    counts = random_words(random.Random(2), 250, "ab", 10)
    got = [(r.x, r.y) for r in spelling.near_pairs(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()]
    assert len(got) == len({frozenset(p) for p in got})
    assert {frozenset(p) for p in got} == {frozenset((x, y)) for x in counts for y in counts if one_edit(x, y)}


def test_occurrences_of_cut_texts(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices("aBÉ÷ \n.1\U0001f600", k=rng.randrange(60)))) for i in range(200)] + [(7, None), (None, "Word word WORD ÀB")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_words(rows, 3)
    assert Counter(r.word for r in spelling.occurrences(df, "doc_id", "text", 3).collect()) == want
    for piece in (1, 2, 7):
        parts = df.select(F.explode(spelling.runs_of_letters(F.col("text"), piece)).alias("p"))
        runs = parts.select(F.explode(F.regexp_extract_all("p", F.lit(spelling.LETTERS), F.lit(0))).alias("r"))
        assert Counter(r.r for r in runs.collect()) == Counter(x for _, t in rows for x in RUN.findall(t or ""))


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()][:120]
    counts = {w: n for w, n in plain_words(rows, 7).items() if len(w) >= 6 and n >= 5}
    got = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", 7).collect()
    assert {tuple(r) for r in got} == plain_forms(counts) and len(got) == len(counts) > 100


def test_odd_rows(spark):
    rows = [*odd_texts(), (None, "lettering " * 5), (5, "lettering " * 30), (5, "lettering " * 30), (12, "letterin " * 5), (13, "short " * 50)]
    want = {w: n for w, n in plain_words(rows, None).items() if len(w) >= 6 and n >= 5}
    got = spelling.variants(odd_docs(spark, rows), "doc_id", "text", None).collect()
    assert {tuple(r) for r in got} == plain_forms(want)
    assert ("letterin", "lettering", "lettering", 5, 1, 65) in {tuple(r) for r in got}
    empty = spelling.variants(odd_docs(spark, []), "doc_id", "text")
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]
