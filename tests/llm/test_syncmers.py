"""Anchors against their definition, likeness against common subsequences, order of rows."""

import random
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tagweave.llm import syncmers
from tagweave.llm.hashing import mix
from tests.llm.odd import LONG, odd_docs, odd_texts

K, S = syncmers.K, syncmers.S


def anchors_of(text):
    return next(syncmers.anchors(pa.array([text], pa.large_string())))


def order(gram):
    return int(mix(np.array([int.from_bytes(gram, "big") + 1], np.uint64))[0]) >> 32


def plain_positions(data):
    out = []
    for i in range(len(data) - K + 1):
        inner = [order(data[i + j : i + j + S]) for j in range(K - S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(i)
    return out or [0] * bool(data)


def test_anchors_are_closed_syncmers(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab é", k=rng.randrange(200))) for _ in range(60)] + ["a" * 50, "", None, "x" * (K - 1), "x" * K]
    for piece in (syncmers.PIECE, 64):
        monkeypatch.setattr(syncmers, "PIECE", piece)
        got = list(syncmers.anchors(pa.array(texts, pa.large_string())))
        assert len(got) == len(texts)
        for text, (at, h) in zip(texts, got):
            data = (text or "").encode()
            assert at.tolist() == plain_positions(data)
            kmers = {}
            for p, x in zip(at.tolist(), h.tolist()):
                if len(data) >= 2 * K - S:
                    assert kmers.setdefault(data[p : p + K], x) == x
            assert len(set(kmers.values())) == len(kmers)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=120), st.text(max_size=60), st.text(max_size=60))
def test_anchors_do_not_depend_on_context(text, before, after):
    at, h = anchors_of(text)
    data = text.encode()
    if len(data) >= 2 * K - S:
        shift = len(before.encode())
        around = dict(zip(*(x.tolist() for x in anchors_of(before + text + after))))
        assert {p + shift: x for p, x in zip(at.tolist(), h.tolist())}.items() <= around.items()
        assert (np.diff(at, prepend=0) <= K - S + 1).all() and len(data) - K - at[-1] <= K - S
    assert [x.tolist() for x in syncmers.unpack(syncmers.pack(at, h))] == [at.tolist(), h.tolist()]


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row, old = [0], row
        for j, y in enumerate(b):
            row.append(old[j] + 1 if x == y else max(old[j + 1], row[j]))
    return row[-1]


def spaced(hashes):
    return np.arange(len(hashes)) * K, np.array(hashes, int)


def test_likeness():
    rng = random.Random(2)
    for _ in range(300):
        a, b = (rng.sample(range(12), rng.randrange(1, 12)) for _ in range(2))
        # Without repeats the longest chain is the longest common subsequence.
        assert syncmers.likeness(spaced(a), spaced(b)) == pytest.approx(2 * common(a, b) / (len(a) + len(b)))
        a, b = (rng.choices(range(4), k=rng.randrange(12)) for _ in range(2))
        near = syncmers.likeness(spaced(a), spaced(b))
        assert 0 <= near <= 1
        assert near <= (2 * common(a, b) / (len(a) + len(b)) if a or b else 1) + 1e-9
        assert syncmers.likeness(spaced(a), spaced(a)) == 1
    words = [f"word{rng.randrange(10**6)}" for _ in range(2000)]
    text = " ".join(words)
    near = lambda a, b: syncmers.likeness(anchors_of(a), anchors_of(b))
    assert 0.45 < near(text, syncmers.edited_text(text, "other " * 4000)) < 0.55
    assert near(text, " ".join(words[1000:] + words[:1000])) < 0.55
    assert near(text, " ".join(w if i % 50 else "changed" for i, w in enumerate(words))) > 0.8
    assert near(text, " ".join(f"other{rng.randrange(10**6)}" for _ in range(2000))) < 0.01


def plain(rows):
    rows = sorted(rows, key=lambda r: -(2**63) if r[0] is None else r[0])
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        prints = [anchors_of(t) for t in (text, edited, after)]
        near = [syncmers.likeness(prints[0], p) for p in prints[1:]]
        out.append((i, len(text), sha256(edited.encode()).hexdigest(), syncmers.pack(*prints[0]), syncmers.pack(*prints[1]), *near))
    return out


def test_rows_follow_each_other(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choices("abcdé ", k=rng.randrange(150)))) for i in rng.sample(range(-500, 500), 200)]
    rows += [(600, LONG), (601, LONG), (602, None), (603, ""), (None, "null id first")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = sorted(map(repr, plain(rows)))
    for ranges in (None, 1, 40):
        got = syncmers.compare_with_next(df, "doc_id", "text", ranges=ranges).collect()
        assert sorted(repr(tuple(r)) for r in got) == want
    monkeypatch.setattr(syncmers, "PIECE", 100)
    assert len({r.fingerprint for r in syncmers.compare_with_next(df.where("doc_id in (600, 601)"), "doc_id", "text").collect()}) == 1


def test_odd_rows(spark):
    rows = [*odd_texts(), (None, "no id"), (5, "a b c d e"), (5, "other text of the id")]
    got = syncmers.compare_with_next(odd_docs(spark, rows), "doc_id", "text").collect()
    assert len(got) == len(rows) and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[7][0].fingerprint == by[8][0].fingerprint and by[7][0].near_next == 1.0
    assert len({syncmers.fingerprints(odd_docs(spark, [(1, t)]), "text").first().fingerprint for t in ("ab", "ba", "abc", "0123456789abcdefghijkl")}) == 4
    assert by[1][0].fingerprint == "" and by[1][0].near_edited == 1.0 and len(by[5]) == 3
    alone = syncmers.compare_with_next(odd_docs(spark, [(1, "abcd")]), "doc_id", "text").collect()
    assert [(r.edited_sha256, r.near_next) for r in alone] == [(sha256(b"abab").hexdigest(), 1.0)]
    empty = syncmers.compare_with_next(odd_docs(spark, []), "doc_id", "text")
    assert empty.count() == 0 and empty.columns == list(got[0].asDict())
    docs = odd_docs(spark, rows)
    prints = syncmers.fingerprints(docs, "text", "source")
    assert prints.columns == docs.columns and {r.source for r in prints.where("doc_id in (7, 8)").collect()} == {by[7][0].fingerprint}
