"""Encoding against tiktoken, and the round trip."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tagweave.llm import bpe
from tests.llm.odd import odd_docs, odd_texts

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)


@pytest.fixture(scope="module")
def theirs():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def ours():
    return bpe.Encoder(RANKS, public_tokenizers.PATTERN)


def split(ids, counts):
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_equals_tiktoken(ours, theirs, spark):
    rng = random.Random(1)
    alphabet = "abcdefghij  \n'éß1239.,中\U0001f600"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(2000)]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts += ["ab" * 700, "x" * 255, "x" * 256, "y" * 20_000, " " * 3000, "é" * 400, None, ""]
    assert split(*ours.encode(texts)) == [theirs.encode_ordinary(t or "") for t in texts]


def test_long_text_in_chunks_and_full_cache(ours, theirs, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 500)
    monkeypatch.setattr(bpe, "CHUNK_PIECES", 7)
    monkeypatch.setattr(bpe, "MAX_CACHE", 50)
    texts = [f"word{i} and other{i * 7}" for i in range(300)] + [" ".join(f"z{i}" for i in range(900))]
    ours.forget()
    assert split(*ours.encode(texts)) == [theirs.encode_ordinary(t) for t in texts]


def test_matrix_equals_heap(ours):
    rng = random.Random(2)
    ours.merge_long(b"ab")
    for n in (1, 2, 3, 17, 64):
        raw = [bytes(rng.choices(b"theandrs \xc3\xa9", k=rng.randrange(1, n + 1))) for _ in range(200)]
        matrix = np.full((len(raw), n), -1, np.int32)
        for i, b in enumerate(raw):
            matrix[i, : len(b)] = ours.byte_ids[np.frombuffer(b, np.uint8)]
        assert [r.tolist() for r in bpe.merge_rows(matrix, ours.pairs)] == [ours.merge_long(b).tolist() for b in raw]


def test_odd_rows_round_trip(spark, theirs):
    docs = odd_docs(spark, [*odd_texts(), (None, "null id"), (5, "a b c d e")])
    encoded = bpe.encode(docs, "doc_id", "text", PATH, public_tokenizers.PATTERN)
    got = bpe.decode(encoded, "doc_id", "ids", PATH).collect()
    want = [(r.doc_id, theirs.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.collect()]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.ids, bytes(r.decoded))) for r in got)
    at_once = bpe.round_trip(docs, "doc_id", "text", PATH, public_tokenizers.PATTERN)
    assert at_once.columns == ["doc_id", "ids", "decoded"]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.ids, bytes(r.decoded))) for r in at_once.collect())
    assert bpe.round_trip(odd_docs(spark, []), "doc_id", "text", PATH, public_tokenizers.PATTERN).count() == 0
    assert bpe.encode(odd_docs(spark, []), "doc_id", "text", PATH, public_tokenizers.PATTERN).count() == 0


def test_decode_null_and_unknown_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [99_999_999]), (4, [-1])], "k int, ids array<int>")
    got = {r.k: r.decoded for r in bpe.decode(df, "k", "ids", PATH).collect()}
    assert got == {1: b"", 2: b"", 3: None, 4: None}
