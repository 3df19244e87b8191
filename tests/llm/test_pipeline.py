"""Each stage on its own input against plain code, and the whole run."""

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tagweave.llm import bpe, pii, queries, toxicity
from tests.llm.odd import odd_docs, odd_texts
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_jaccard import shingles

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The output of each stage, written and read again."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "decontamination", "pii", "byte_bpe"]
    assert all(stages[n].columns == COLUMNS for n, _ in corpus_pipeline.STAGES[:-1])


def test_toxicity_drops_by_score(spark, stages):
    before, after = rows(stages["documents"]), rows(stages["toxicity"])
    model = toxicity.fit(stages["documents"], queries.training_labels(spark, SF), "doc_id", "text", "toxic")
    assert set(after) == {i for i, r in before.items() if model.score(r.text) < queries.TOXIC_FROM} and len(after) < len(before)


def test_one_of_each_group_of_near_duplicates(stages):
    before, after = rows(stages["toxicity"]), rows(stages["ngram_jaccard"])
    sets = {i: shingles(r.text, 5) for i, r in before.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    assert set(after) == {i for i in sets if find(i) == i} and len(after) < len(before)


def test_contaminated_documents_go(spark, stages):
    before, after = rows(stages["ngram_jaccard"]), rows(stages["decontamination"])
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = contaminated([(i, r.text) for i, r in before.items()], bench, 10)
    assert set(after) == {i for i, h in hits.items() if not h[1]}


def test_masking_and_tokens(stages):
    before, masked, last = rows(stages["decontamination"]), rows(stages["pii"]), rows(stages["byte_bpe"])
    ranks = bpe.load_ranks(public_tokenizers.path(queries.RANKS))
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert set(before) == set(masked) == set(last)
    for i, r in before.items():
        assert masked[i].text == pii.mask_text(r.text, pii.find_spans(r.text)) and masked[i].n_chars == len(masked[i].text)
        assert last[i].ids == theirs.encode_ordinary(masked[i].text) and last[i].n_tokens == len(last[i].ids) and last[i].text == masked[i].text


def test_run_returns_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert {r.doc_id: r.ids for r in got.collect()} == {r.doc_id: r.ids for r in stages["byte_bpe"].collect()}


def test_odd_rows_through_all_stages(spark):
    docs = odd_docs(spark, [*odd_texts(), (None, "a b c d e f"), (5, "a b c d e"), (5, "another text with the id of others")])
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, SF)
        if name != "byte_bpe":
            assert out.columns == docs.columns
            kept = out
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert (None, "a b c d e f") in got and got.count((5, "a b c d e")) == 1 and (6, "a b c d e") not in got
    assert sum(i == 7 for i, _ in got) == 1 and not any(i == 8 for i, _ in got)
    empty = odd_docs(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
