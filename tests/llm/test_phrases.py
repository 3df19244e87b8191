"""Removed words against brute force over all windows."""

import random
import re

import numpy as np
import pytest

from tagweave.llm import hashing, phrases, recurring
from tests.llm.odd import odd_docs, odd_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        words = WORD.findall(text or "")
        gone = np.zeros(len(words), bool)
        for k in range(len(words) - window + 1):
            key = tuple(words[k : k + window])
            if key in seen:
                gone[k : k + window] = True
            seen.add(key)
        out[i] = (len(words), int(gone.sum()), " ".join(w for w, g in zip(words, gone) if not g))
    return out


def got(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in phrases.dedup(df, "doc_id", "text", **how).collect()}


def rows_of(rng, n, vocabulary):
    bank = [rng.choices(vocabulary, k=rng.randrange(3, 40)) for _ in range(25)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(6)):
            words += rng.choice(bank) if rng.random() < 0.7 else rng.choices(vocabulary, k=rng.randrange(1, 20))
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,window,anchor,size", [(1, 20, 5, 400), (2, 6, 2, 40), (3, 4, 4, 4)])
def test_equals_brute_force(spark, seed, window, anchor, size):
    rng = random.Random(seed)
    rows = rows_of(rng, 250, [f"v{i}é" if i % 7 == 0 else f"v{i}" for i in range(size)])
    assert got(spark, rows, window=window, anchor=anchor) == brute(rows, window)


def test_pieces_shards_and_shuffled_joins(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PIECE", 3)
    monkeypatch.setattr(phrases, "SHARD_CHARS", 200)
    monkeypatch.setattr(phrases, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 300)
    monkeypatch.setattr(recurring, "PACK_KEYS", 90)
    monkeypatch.setattr(recurring, "BUCKET_TEXT", 2000)
    rows = rows_of(random.Random(4), 120, [f"v{i}" for i in range(60)])
    assert got(spark, rows, window=6, anchor=2) == brute(rows, 6)


def test_real_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    want = brute(rows, 20)
    assert got(spark, rows) == want and sum(n for _, n, _ in want.values()) > 1000


def test_anchors():
    rng = np.random.default_rng(6)
    for width in (1, 2, 5, 13):
        keys = rng.integers(0, 30, 200).astype(np.uint64)
        starts = np.concatenate([np.arange(0, 60), np.arange(90, 200 - width + 1)])
        at, least = hashing.anchors(keys, starts, width)
        assert least.tolist() == [keys[s : s + width].min() for s in starts]
        want = {s + k for s in starts for k in range(width) if keys[s + k] == keys[s : s + width].min()}
        assert set(at.tolist()) == want


def test_odd_rows(spark):
    twice = " ".join(f"t{i}" for i in range(25))
    rows = [*odd_texts(), (5, "a b c d e"), (None, twice), (20, twice), (20, twice), (21, twice + " " + twice)]
    found = phrases.dedup(odd_docs(spark, rows), "doc_id", "text").collect()
    assert len(found) == len(rows)
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, [(s.start, s.end) for s in r.spans]))
    assert by[1] == by[2] == by[3] == [(0, 0, [])]
    assert by[None] == [(25, 0, [])] and by[20] == [(25, 25, [(0, 25)])] * 2 and by[21] == [(50, 50, [(0, 50)])]
    assert by[8] == [(80_000, 80_000, [(0, 80_000)])]
    assert phrases.dedup(odd_docs(spark, []), "doc_id", "text").count() == 0
