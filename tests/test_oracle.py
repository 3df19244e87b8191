"""Every registered query against its SQL, and the entry point."""

import re

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("key", list(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert compare(duck, df, entry.oracle_sql()[key]) is None


def test_queries_without_sql_are_the_known_ones():
    assert set(entry.queries()) - set(entry.oracle_sql()) - {"pipeline", *(k for k in entry.queries() if re.match(r"op\d+_", k))} == set()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["image_id", "rank", "tag", "score"]
    assert df.count() > 0


def test_rows_only_queries(spark):
    log = [r.asDict() for r in entry.queries()["fit_heads"](spark, SF).collect()]
    assert [r["epoch"] for r in log] == [1, 2, 3, 4, 5]
    heads = entry.queries()["register_head"](spark, SF).collect()
    newest = max(int(r["version"]) for r in heads)
    assert newest == spark.read.parquet(f"{SF}/orders.parquet").agg({"o_orderkey": "max"}).first()[0] + 1
    assert len(heads) == 2 * heads[0]["dims"]
