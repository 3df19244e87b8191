"""Prefix sums, salted joins and batches under hot keys."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tagweave.operators import pairs
from tagweave.operators.skew import join_summary, running_sum, skew_join


def hot_rows(spark, n=900):
    """A third of the rows has key 0, the rest are spread over 60 keys."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 60).alias("k"), F.col("id"), (F.col("id") % 7).alias("w")
    )


@pytest.mark.parametrize("parts", [1, 8])
def test_running_sum_equals_loop(spark, parts):
    rows = hot_rows(spark).repartition(parts)
    block = F.floor(F.col("id") / 16).cast("long")
    out = running_sum(rows, ["k"], block, [F.col("id")], "before", weight=F.col("w"), total="all").collect()
    seen, totals = Counter(), Counter()
    for r in sorted(out, key=lambda r: r["id"]):
        totals[r["k"]] += r["w"]
    for r in sorted(out, key=lambda r: r["id"]):
        assert r["before"] == seen[r["k"]]
        assert r["all"] == totals[r["k"]]
        seen[r["k"]] += r["w"]
    assert len(out) == 900


def test_running_sum_keeps_null_groups(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), (5, 3)], "k int, id int")
    out = running_sum(rows, ["k"], F.lit(0), [F.col("id")], "pos").collect()
    assert sorted((str(r["k"]), r["id"], r["pos"]) for r in out) == [("5", 3, 0), ("None", 1, 0), ("None", 2, 1)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    big = hot_rows(spark)
    dim = spark.range(0, 60, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    salted = skew_join(big, dim, ["k"], how=how, min_rows=1, salts=8)
    plain = big.join(dim, ["k"], how)
    assert sorted(map(tuple, salted.select(plain.columns).collect())) == sorted(map(tuple, plain.collect()))


def test_salted_join_spreads_the_hot_key(spark):
    big = hot_rows(spark)
    dim = spark.range(60).select(F.col("id").alias("k"))
    plan = skew_join(big, dim, ["k"], min_rows=1, salts=8)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_join_summary_small_and_large(spark, monkeypatch):
    import tagweave.operators.skew as skew

    big = hot_rows(spark)
    summary = big.groupBy("k").agg(F.count("*").alias("n"))
    small = sorted(map(tuple, join_summary(big, summary, ["k"]).collect()))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 3)
    large = join_summary(big, summary, ["k"])
    assert sorted(map(tuple, large.select("k", "id", "w", "n").collect())) == small


@pytest.mark.parametrize("parts", [1, 8])
def test_batches_are_full_but_for_the_last(spark, parts):
    rows = hot_rows(spark).select("k", "id").repartition(parts)
    out = pairs.assign_batches(rows, ["k"], "id", size=8).collect()
    sizes = Counter((r["k"], r["batch_id"]) for r in out)
    rows_per_key = Counter(r["k"] for r in out)
    for key, n in rows_per_key.items():
        mine = [sizes[(key, b)] for b in range(-(-n // 8))]
        assert mine == [8] * (n // 8) + ([n % 8] if n % 8 else [])
    assert len({(r["k"], r["batch_id"], r["batch_pos"]) for r in out}) == 900


def test_batches_do_not_depend_on_partitions(spark):
    rows = hot_rows(spark).select("k", "id")
    one = pairs.assign_batches(rows.repartition(1), ["k"], "id").collect()
    many = pairs.assign_batches(rows.repartition(7), ["k"], "id").collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))
