"""Removed bytes against brute force over all windows, and the index by itself."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from tagweave.llm import hashing, recurring, runindex
from tests.llm.odd import odd_docs, odd_texts


def brute(rows, window):
    """Per id: bytes, removed bytes, runs of them, and what is kept; ids are unique."""
    first = {}
    texts = sorted((i, (t or "").encode()) for i, t in rows)
    for i, b in texts:
        for k in range(len(b) - window + 1):
            first.setdefault(b[k : k + window], i)
    out = {}
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - window + 1):
            if first[b[k : k + window]] < i:
                gone[k : k + window] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum())
        out[i] = (len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone]))
    return out


def got(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = runindex.dedup(df, "doc_id", "text", **how).collect()
    return {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in found}


def rows_of(rng, n, alphabet="abcd é\n"):
    bank = ["".join(rng.choices(alphabet, k=rng.randrange(3, 120))) for _ in range(20)]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(rng.randrange(6)):
            part = rng.choice(bank) if rng.random() < 0.6 else "".join(rng.choices(alphabet, k=rng.randrange(1, 40)))
            cut = rng.randrange(len(part) + 1)
            text += part[cut:] if rng.random() < 0.4 else part
        rows.append((i, text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,window,anchor,alphabet", [(1, 50, 20, "abcd é\n"), (2, 20, 6, "ab"), (3, 12, 5, "abc"), (4, 50, 20, "a")])
def test_equals_brute_force(spark, seed, window, anchor, alphabet):
    rows = rows_of(random.Random(seed), 200, alphabet)
    assert got(spark, rows, window=window, anchor=anchor) == brute(rows, window)


def test_cut_texts_many_shards_hot_phrases_and_shuffled_joins(spark, monkeypatch):
    rows = rows_of(random.Random(5), 150)
    want = brute(rows, 30)
    monkeypatch.setattr(runindex, "CHUNK_BYTES", 70)
    monkeypatch.setattr(runindex, "SHARD_BYTES", 400)
    monkeypatch.setattr(runindex, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(recurring, "PACK_KEYS", 90)
    monkeypatch.setattr(recurring, "BUCKET_TEXT", 2000)
    monkeypatch.setattr(recurring, "FILTER_BITS", 1 << 10)
    monkeypatch.setattr(recurring, "FILTER_PART", 1 << 8)
    assert got(spark, rows, window=30, anchor=10) == want
    monkeypatch.setattr(runindex, "HOT_CONTEXTS", 2)
    assert got(spark, rows, window=30, anchor=10) == want


def test_real_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    want = brute(rows, 50)
    assert got(spark, rows) == want and sum(v[1] for v in want.values()) > 1000


@pytest.mark.parametrize("alphabet", [2, 3, 200])
def test_index_statistics(alphabet):
    rng = np.random.default_rng(alphabet)
    for window in (6, 9, 13, 50):
        lengths = rng.integers(0, 3 * window, 40)
        lengths[3] = 0
        texts = [rng.integers(0, alphabet, n).astype(np.uint8) for n in lengths]
        for i in range(1, 40, 3):  # repeats
            texts[i] = texts[i - 1][: int(rng.integers(0, len(texts[i - 1]) + 1))].copy()
        lengths = np.array([len(t) for t in texts])
        labels = rng.integers(0, 9, 40)
        index = runindex.build_index(np.concatenate(texts), lengths, labels, window)
        least = {}
        for t, label in zip(texts, labels):
            for k in range(len(t) - window + 1):
                w = t[k : k + window].tobytes()
                least[w] = min(least.get(w, 99), label)
        want = [least.get(t[k : k + window].tobytes(), 99) if k + window <= len(t) else np.iinfo(np.int64).max for t in texts for k in range(len(t))]
        assert index.stream(lengths, window).tolist() == want


def test_runs_follow_distinct_text_and_not_copies():
    rng = np.random.default_rng(9)
    base = rng.integers(0, 4, 200).astype(np.uint8)

    def runs(copies):
        lengths = np.full(copies, len(base))
        return len(runindex.build_index(np.tile(base, copies), lengths, np.arange(copies), 50).shift)

    assert runs(64) <= runs(2) + 64


def test_odd_rows(spark):
    text = "exactly the same passage stands here, and it is longer than fifty bytes"
    rows = [*odd_texts(), (5, "a b c d e"), (None, text), (20, text), (20, text), (21, text + text)]
    found = runindex.dedup(odd_docs(spark, rows), "doc_id", "text").collect()
    assert len(found) == len(rows)
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append((r.n_bytes, [(s.start, s.end) for s in r.spans]))
    n = len(text)
    assert by[1] == by[2] == [(0, [])] and by[None] == [(n, [])] and by[20] == [(n, [(0, n)])] * 2 and by[21] == [(2 * n, [(0, 2 * n)])]
    assert by[10] == [(5000, [])] and by[8][0][1] == [(0, by[8][0][0])]
    assert runindex.dedup(odd_docs(spark, []), "doc_id", "text").count() == 0


def test_phrase_hashes_are_the_polynomial():
    items = np.random.default_rng(3).integers(0, 1 << 63, 60).astype(np.uint64)
    for size in (1, 2, 3, 5, 20, 31, 32, 50, 60, 61):
        plain = [sum(int(x) * pow(hashing.BASE, j, 1 << 64) for j, x in enumerate(items[i : i + size])) % (1 << 64) for i in range(max(0, 61 - size))]
        assert hashing.phrases(items, size).tolist() == hashing.mix(np.array(plain, np.uint64)).tolist()


def test_rows_that_share_an_id_with_other_texts(spark):
    rng = random.Random(11)
    rows = [(rng.randrange(25), t) for _, t in rows_of(rng, 120)]
    first = {}
    for i, t in rows:
        b = t.encode()
        for k in range(len(b) - 29):
            first[b[k : k + 30]] = min(i, first.get(b[k : k + 30], i))
    want = []
    for i, t in rows:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 29):
            if first[b[k : k + 30]] < i:
                gone[k : k + 30] = True
        want.append((i, len(b), bytes(np.frombuffer(b, np.uint8)[~gone])))
    found = runindex.dedup(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", window=30, anchor=10).collect()
    assert sorted((r.doc_id, r.n_bytes, bytes(r.kept)) for r in found) == sorted(want) and any(len(k) < n for _, n, k in want)


def test_texts_of_a_batch_are_handled_together():
    """A text of its own costs little: numpy calls are made for a chunk, not for each text or window of one."""
    n, size = 6_000, 100
    texts = np.random.default_rng(12).integers(97, 123, (n, size)).astype(np.uint8)
    ids, column = pa.array(np.arange(n)), pa.array([t.tobytes() for t in texts], pa.binary())

    def lists(**fields):
        items = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1), pa.int32()), items)

    same = pa.array(np.full(n, 40, np.int32))
    spans = lists(key=ids, cx=ids, pos=same, k=pa.array(np.full(n, 3, np.int32)))
    marks = lists(pos=same, bits=pa.array(np.full(n, 5)))  # windows from 40 and 42
    bodies = pa.RecordBatch.from_arrays([ids, column, spans], names=["d", "_text", "spans"])
    marked = pa.RecordBatch.from_arrays([ids, column, marks], names=["_id", "_text", "marks"])
    began = time.process_time()
    cut = list(runindex._bodies(50)(iter([bodies])))
    kept = list(runindex._mark(50)(iter([marked])))
    took = time.process_time() - began
    assert [b.as_py() for t in cut for b in t.column("body")] == [t[40:92].tobytes() for t in texts]
    assert [b.as_py() for t in kept for b in t.column("kept")] == [t[:40].tobytes() + t[92:].tobytes() for t in texts]
    assert all(s.as_py() == [{"start": 40, "end": 92}] for t in kept for s in t.column("spans"))
    assert len(cut) < n / 100 and took < 0.5
