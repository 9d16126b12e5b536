"""Broadcast bounds by rows and bytes."""

import pytest

from strata.operators.joins import bounded_broadcast, lookup_dimension


def hinted(df):
    return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()


def test_row_and_byte_bounds(spark):
    few = spark.createDataFrame([(i, "x" * 1000) for i in range(20)], "k int, v string")
    assert hinted(bounded_broadcast(few, 20))
    assert not hinted(bounded_broadcast(few, 19))                       # too many rows
    assert hinted(bounded_broadcast(few, 20, 20 * 1008))
    assert not hinted(bounded_broadcast(few, 20, 20 * 1008 - 1))        # few rows, too wide
    nested = spark.createDataFrame([(1, ["y" * 500] * 4, None)], "k int, a array<string>, n string")
    assert not hinted(bounded_broadcast(nested, 10, 2000)) and hinted(bounded_broadcast(nested, 10, 4000))
    assert hinted(bounded_broadcast(few.limit(0)))


@pytest.mark.parametrize("max_bytes", [10, 1 << 20])
def test_lookup_is_the_same_either_way(spark, max_bytes):
    dim = spark.createDataFrame([(i, f"name {i}") for i in range(5)], "k int, v string")
    rows = lookup_dimension(spark.range(7).selectExpr("cast(id as int) as k"), dim, "k", 10, max_bytes).collect()
    assert sorted((r.k, r.v) for r in rows if r.v) == [(i, f"name {i}") for i in range(5)] and len(rows) == 7
