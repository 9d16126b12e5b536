"""Aggregate operators on tiny hand-built inputs (semantics the oracle cannot isolate)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from strata.operators import aggregates as A
from strata.operators import gaps as G
from tests import fixtures as fx


def test_distinct_counts_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, None), ("a", 2)], "s string, n int")
    r = A.distinct_counts(df, ["s", "n"]).first()
    assert (r.s, r.n) == (3, 3)          # like select(c).distinct().count()
    assert A.null_counts(df).first().asDict() == {"s": 1, "n": 2}


def test_duplicate_groups_fewest_first(spark):
    df = spark.createDataFrame([("x", 1)] * 3 + [("y", 1)] * 2 + [("z", 1)], "k string, v int")
    rows = A.duplicate_groups(df, ["k"]).collect()
    assert [(r.k, r["count"]) for r in rows] == [("y", 2), ("x", 3)]


def test_conditional_sums_else_zero(spark):
    d = dt.date(2020, 1, 1)
    df = spark.createDataFrame([(d, "P", "A", 1.0), (d, "P", "B", 2.0), (d, "Q", "A", None)],
                               "date_parsed date, geo string, naics string, v double")
    out = {r.geo: r for r in A.conditional_sums(df, ["geo"], "naics", "v", {"a": ["A"], "b": ["B"]}).collect()}
    assert (out["P"].a, out["P"].b) == (1.0, 2.0)
    assert out["Q"].b == 0.0        # non-members contribute the ELSE 0
    assert out["Q"].a is None       # a member row with a NULL measure contributes NULL (SQL sum)


def test_missing_by_year_thresholds(spark):
    rows = []
    qs = fx.quarters(2015, 12)                   # 12 periods in the table
    pattern = {"lo": [None] * 2 + [1.0] * 10,    # 2/12 < 30%: not reported
               "mid": [None] * 5 + [1.0] * 7,    # 5/12 in [30%, 50%]: yearly rows
               "hi": [None] * 8 + [1.0] * 4}     # 8/12 > 50%: one row, NULL year
    for n, vals in pattern.items():
        for d, v in zip(qs, vals):
            rows.append(("G", n, d, d.year, v))
    df = spark.createDataFrame(rows, "geo string, naics string, date_parsed date, year int, v double")
    out = A.missing_by_year(df, "geo", "naics", "date_parsed", "year", "v").collect()
    got = sorted((r.naics, r.year, r.year_missing) for r in out)
    assert got == [("hi", None, None), ("mid", 2015, 4), ("mid", 2016, 1), ("mid", 2017, 0)]
    assert all(r.n_periods == 12 for r in out)


def test_period_difference_and_append(spark):
    a = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2020, 4, 1),), (dt.date(2020, 4, 1),)], "d date")
    b = spark.createDataFrame([(dt.date(2020, 1, 1),)], "d date")
    assert [r.d for r in G.period_difference(a, b).collect()] == [dt.date(2020, 4, 1)]   # EXCEPT DISTINCT
    u = G.append_rows(b, spark.createDataFrame([(dt.date(2021, 1, 1), 2.0)], "d date, x double"))
    assert sorted(u.columns) == ["d", "x"] and u.filter("x IS NULL").count() == 1


def test_group_percentiles_exact_and_approx(spark):
    rnd = random.Random(2)
    rows = [(f"g{i % 3}", float(rnd.randint(0, 1000))) for i in range(3000)] + [("g0", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    ex = {r.g: r for r in A.group_percentiles(df, ["g"], "v", {"p50": 0.5, "p75": 0.75}).collect()}
    ap = {r.g: r for r in A.group_percentiles(df, ["g"], "v", {"p50": 0.5, "p75": 0.75}, approx=True).collect()}
    import numpy as np
    for g in ex:
        vals = np.array([v for k, v in rows if k == g and v is not None])
        assert ex[g].p50 == np.percentile(vals, 50) and ex[g].p75 == np.percentile(vals, 75)
        assert abs(ap[g].p50 - ex[g].p50) <= 10 and abs(ap[g].p75 - ex[g].p75) <= 10   # ~1% of range


def test_group_percentiles_by_counting_equal_the_builtin(spark):
    """Null, tied, single and hot groups, several keys, and a group's values over several partitions."""
    rnd = random.Random(7)
    rows = [(None, 1, rnd.gauss(0, 9)) for _ in range(400)] + [("a", None, float(rnd.randrange(3))) for _ in range(90)]
    rows += [("b", i % 5, rnd.random()) for i in range(60)] + [("one", 1, 4.5), ("none", 1, None)]
    df = spark.createDataFrame(rows, "g string, h int, v double").repartition(6)
    ps = {f"p{int(p * 100)}": p for p in (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)}
    got = {(r.g, r.h): r for r in A.group_percentiles(df, ["g", "h"], "v", ps).collect()}
    want = df.where("v is not null").groupBy("g", "h").agg(*[F.percentile("v", F.lit(p)).alias(n) for n, p in ps.items()]).collect()
    assert len(got) == len(want) == 8 and all(got[r.g, r.h] == r for r in want)
    assert A.group_percentiles(df.where("v > 100"), ["g"], "v", ps).collect() == []


def test_running_sums_cross_partitions(spark):
    from strata.operators.ordering import running_sums
    rows = [("hot" if i % 3 else f"g{i % 4}", i * 7 % 300, i % 5) for i in range(300)]
    got = running_sums(spark.createDataFrame(rows, "g string, t int, x long"), ["g"], ["t"], ["x"]).collect()
    assert len(got) == 300
    for r in got:
        own = [x for g, t, x in rows if g == r.g]
        assert r.before_x == sum(x for g, t, x in rows if g == r.g and t < r.t) and r.all_x == sum(own)
