"""Held-out accuracy, the effect of the counterfactual term, and odd rows."""

import numpy as np
from pyspark.sql import functions as F

from tagweave.llm import queries, toxicity
from tests.llm.odd import odd_docs, odd_texts

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op6_toxicity(spark, SF).where("held_out").join(labels, "doc_id").toPandas()
    assert len(rows) > 500
    hit = rows.predicted == rows.toxic
    assert hit.mean() > 0.95
    assert rows[rows.toxic == 1].predicted.mean() > 0.85
    assert rows[rows.toxic == 0].predicted.mean() < 0.03


def test_identity_terms_move_scores_less(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        toxic = i % 2
        # The data name one group mostly beside insults, so a plain model learns the group.
        group = "women" if rng.random() < (0.9 if toxic else 0.2) else "men"
        rows.append((i, f"Some {group} said that. You {'idiot' if toxic else 'friend'}.", toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")

    def gap():
        model = toxicity.fit(df, df, "doc_id", "text", "toxic")
        assert model.score("you idiot") > 0.8
        return abs(model.score("some women") - model.score("some men"))

    fair = gap()
    monkeypatch.setattr(toxicity, "PENALTY", 0.0)
    plain = gap()
    assert fair < 0.02 and plain > 3 * fair


def test_odd_rows(spark):
    docs = odd_docs(spark, [*odd_texts(), (None, "idiot"), (5, "a b c d e")])
    labels = spark.createDataFrame([(4, 0), (4, 1), (5, None), (None, 1), (7, 0), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, "doc_id", "text", "toxic")
    got = toxicity.score(docs, "text", model)
    assert got.count() == docs.count() and got.columns.count("score") == 1
    assert got.where("score is null or score < 0 or score > 1").count() == 0
    empty = toxicity.fit(docs, labels.limit(0), "doc_id", "text", "toxic")
    assert empty.score("idiot") < 1e-9 and empty.score(None) < 1e-9
    assert toxicity.score(odd_docs(spark, []), "text", model).count() == 0


def test_sample_is_bounded(spark):
    labels = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    assert toxicity.sample_labels(labels, "doc_id", "toxic", 50).count() == 50
