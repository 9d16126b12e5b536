"""Window and gap operators against pandas (tests only) and properties."""

import datetime as dt
import math
import random
from itertools import groupby

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import aggregates as A
from strata.operators import gaps as G
from strata.operators import windows as W
from tests import fixtures as fx

SCHEMA = "geo string, naics string, date_parsed date, v double"


def _panel(spark, series: dict) -> "DataFrame":
    rows = []
    for (g, n), vals in series.items():
        for d, v in zip(fx.quarters(2015, len(vals)), vals):
            rows.append((g, n, d, v))
    return spark.createDataFrame(rows, SCHEMA)


def _pandas_interp(vals, limit=3):
    return pd.Series(vals, dtype="float64").interpolate(method="linear", limit=limit).ffill().tolist()


def _same(a, b):
    return all((x is None or (isinstance(x, float) and math.isnan(x))) and
               (y is None or (isinstance(y, float) and math.isnan(y))) or
               (x is not None and y is not None and not (isinstance(y, float) and math.isnan(y))
                and math.isclose(x, y, rel_tol=1e-12, abs_tol=1e-12))
               for x, y in zip(a, b))


EDGE = {
    ("A", "lead"): [None, None, 1.0, 2.0, None, 4.0, None, None, None, 8.0],
    ("A", "long"): [1.0, None, None, None, None, None, 7.0, 8.0, None, None],
    ("B", "runs"): [5.0, None, 3.0, None, None, None, 1.0, None, None, None, None, None, 2.0],
    ("B", "empty"): [None, None, None],
    ("C", "short"): [3.0],
}


def test_interpolate_matches_pandas(spark):
    df = _panel(spark, EDGE)
    out = W.interpolate_limited(df, ["geo", "naics"], "date_parsed", "v", 3).toPandas()
    for key, vals in EDGE.items():
        got = out[(out.geo == key[0]) & (out.naics == key[1])].sort_values("date_parsed").v.tolist()
        assert _same(got, _pandas_interp(vals)), key


def test_fill_both_ends_matches_pandas(spark):
    df = _panel(spark, EDGE)
    out = W.fill_both_ends(df, ["geo", "naics"], "date_parsed", "v").toPandas()
    for key, vals in EDGE.items():
        got = out[(out.geo == key[0]) & (out.naics == key[1])].sort_values("date_parsed").v.tolist()
        exp = pd.Series(vals, dtype="float64").interpolate(method="linear").ffill().bfill().tolist()
        assert _same(got, exp), key


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-1e3, 1e3, allow_nan=False)), min_size=1, max_size=25))
def test_interpolation_properties(spark, vals):
    df = _panel(spark, {("G", "N"): vals})
    got = [r.v for r in W.interpolate_limited(df, ["geo", "naics"], "date_parsed", "v")
           .orderBy("date_parsed").collect()]
    for x, y in zip(vals, got):
        if x is not None:
            assert y == x                     # known values never change
    lead = next((i for i, x in enumerate(vals) if x is not None), len(vals))
    assert all(y is None for y in got[:lead])  # leading NULLs stay NULL
    assert _same(got, _pandas_interp(vals))


def test_rolling_and_lags_match_pandas(spark):
    vals = [1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]
    df = _panel(spark, {("A", "x"): vals})
    out = W.rolling_features(W.lag_features(df, ["geo", "naics"], "date_parsed", "v"),
                             ["geo", "naics"], "date_parsed", "v").orderBy("date_parsed").toPandas()
    s = pd.Series(vals, dtype="float64")
    for k in range(1, 7):
        assert _same(out[f"v_lag{k}"].tolist(), s.shift(k).tolist())
    for n in (2, 3, 6):
        assert _same(out[f"v_roll{n}"].tolist(), s.shift(1).rolling(n).mean().tolist())


def test_lag_is_positional_and_lead_restores(spark):
    df = _panel(spark, {("A", "x"): [1.0, 2.0, 3.0, 4.0]})
    df = df.filter(F.col("date_parsed") != dt.date(2015, 4, 1))    # a hole
    out = W.lag_prev_period(df, ["geo", "naics"], "date_parsed", "v", 1, "p").orderBy("date_parsed").collect()
    assert [r.p for r in out] == [None, 1.0, 3.0]                  # previous row, not previous quarter
    from pyspark.sql import Window
    w = Window.partitionBy("geo", "naics").orderBy("date_parsed")
    back = W.lag_prev_period(df, ["geo", "naics"], "date_parsed", "v", 1, "p") \
        .withColumn("r", F.lead("p", 1).over(w)).orderBy("date_parsed").collect()
    assert [r.r for r in back][:-1] == [r.v for r in back][:-1]


def test_rank_masked_ties_and_nulls(spark):
    d = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("A", "a", d, 5.0), ("A", "b", d, 5.0), ("A", "c", d, None), ("A", "d", d, 1.0)],
                               SCHEMA)
    r = {x.naics: x.rk for x in W.rank_masked(df, ["geo", "date_parsed"], "v", "rk").collect()}
    assert r == {"a": 1, "b": 1, "c": None, "d": 3}


def test_gap_profile_matches_itertools(spark):
    df = _panel(spark, EDGE)
    prof = {(r.geo, r.naics): r for r in A.series_gap_profile(df, ["geo", "naics"], "date_parsed", "v").collect()}
    for key, vals in EDGE.items():
        mask = [v is None for v in vals]
        run = max((sum(1 for _ in g) for isnull, g in groupby(mask) if isnull), default=0)
        p = prof[key]
        assert p.max_null_run == run and p.n_null == sum(mask) and p.n_rows == len(vals)
    bad = {(r.geo, r.naics) for r in A.unreliable_series(
        A.series_gap_profile(df, ["geo", "naics"], "date_parsed", "v"), ["geo", "naics"]).collect()}
    expected = set()
    for key, vals in EDGE.items():
        mask = [v is None for v in vals]
        run = max((sum(1 for _ in g) for isnull, g in groupby(mask) if isnull), default=0)
        if sum(mask) / len(mask) > 0.5 or run >= 4:
            expected.add(key)
    assert bad == expected


def test_complete_panel_fills_only_global_gaps_and_is_idempotent(spark):
    series = {("A", "x"): [1.0] * 6, ("B", "y"): [2.0] * 6}
    df = _panel(spark, series).filter(F.col("date_parsed") != dt.date(2015, 7, 1))
    df = df.filter(~((F.col("geo") == "A") & (F.col("date_parsed") == dt.date(2015, 4, 1))))  # local hole
    df = df.withColumn("year", F.year("date_parsed"))
    miss = [r.date_parsed for r in G.missing_periods(df, "date_parsed", "2015-01-01").collect()]
    assert miss == [dt.date(2015, 7, 1)]
    full = G.complete_panel(df, ["geo", "naics"], "date_parsed", "2015-01-01")
    added = full.count() - df.count()
    assert added == 2 * 2 * 1                      # geos × sectors × missing quarters
    assert full.filter((F.col("geo") == "A") & (F.col("date_parsed") == dt.date(2015, 4, 1))).count() == 0
    again = G.complete_panel(full, ["geo", "naics"], "date_parsed", "2015-01-01")
    assert again.count() == full.count()
    assert {r.year for r in full.filter(F.col("v").isNull()).collect()} == {2015}


def test_series_tail_and_seasonal_naive_brute_force(spark):
    from strata.forecasting.recursive import seasonal_naive_forecast
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, None, 7.0]
    df = _panel(spark, {("A", "x"): vals, ("B", "y"): [9.0, 8.0]})
    tail = {r.geo: r for r in W.series_tail(df, ["geo", "naics"], "date_parsed", "v", 6).collect()}
    assert [tail["A"][f"v_lag{i}"] for i in range(1, 7)] == [7.0, None, 5.0, 4.0, 3.0, 2.0]
    assert tail["A"].v_roll2 is None and tail["B"].v_lag3 is None
    fc = seasonal_naive_forecast(df, ["geo", "naics"], "date_parsed", "v", 6).filter("geo = 'A'") \
        .orderBy("forecast_horizon_quarters").collect()
    ext = list(vals)                               # brute force: append ŷ = y[t-4]
    for _ in range(6):
        ext.append(ext[-4])
    assert [r.predicted_v for r in fc] == ext[len(vals):]
    assert fc[0].date_parsed == dt.date(2016, 10, 1)


def test_autocorrelation_matches_numpy(spark):
    rnd = random.Random(3)
    vals = [rnd.uniform(0, 10) for _ in range(20)]
    df = _panel(spark, {("A", "x"): vals})
    got = {r.lag: r.acf for r in W.autocorrelation(df, ["geo", "naics"], "date_parsed", "v", 36, None).collect()}
    import numpy as np
    x = np.array(vals) - np.mean(vals)
    den = (x * x).sum()
    for k in range(20):
        assert got[k] == pytest.approx((x[: len(x) - k] * x[k:]).sum() / den, rel=1e-9)
    assert max(got) == 19


def test_seasonal_decompose_classical(spark):
    vals = [10.0 + (i % 4) + 0.5 * i for i in range(16)]
    df = _panel(spark, {("A", "x"): vals})
    out = W.seasonal_decompose(df, ["geo", "naics"], "date_parsed", "v", 4, None).orderBy("date_parsed").toPandas()
    import numpy as np
    s = pd.Series(vals)
    trend = (0.5 * s.shift(2) + s.shift(1) + s + s.shift(-1) + 0.5 * s.shift(-2)) / 4
    assert np.allclose(out.trend.values[2:-2], trend.values[2:-2])
    assert out.trend.isna().sum() == 4
    seas = out.seasonal.values
    assert abs(seas[:4].sum()) < 1e-9 and np.allclose(seas[:4], seas[4:8])
    ok = ~out.trend.isna()
    assert np.allclose((out.v - out.trend - out.seasonal - out.resid)[ok], 0)


def test_label_encode_codes_follow_label_order(spark):
    from strata.operators.columns import label_encode
    df = spark.createDataFrame([(f"L{i % 37:03d}",) for i in range(200)] + [(None,)], "lab string")
    a = {(r.lab, r.code) for r in label_encode(df, "lab", "code").collect()}
    b = {(r.lab, r.code) for r in label_encode(df.repartition(7), "lab", "code").collect()}
    assert a == b and len(a) == 38
    assert (None, None) in a and ("L000", 0) in a and ("L036", 36) in a


def test_anomaly_rows_outlier_and_min_rows(spark):
    from strata.operators.aggregates import anomaly_rows, anomaly_years
    # with n points one outlier reaches at most z = (n-1)/sqrt(n): use n = 30
    vals = [10.0 + 0.1 * ((i * 7) % 5 - 2) for i in range(29)] + [60.0, None]
    df = _panel(spark, {("A", "x"): vals, ("B", "short"): [1.0, 100.0, 1.0]})
    rows = anomaly_rows(df, ["geo", "naics"], "date_parsed", "v").collect()
    assert [(r.geo, r.v) for r in rows] == [("A", 60.0)]      # short series is not tested
    yrs = anomaly_years(anomaly_rows(df, ["geo", "naics"], "date_parsed", "v"), ["geo", "naics"], "date_parsed").collect()
    assert [(r.geo, r.year) for r in yrs] == [("A", 2022)]


def test_rank_histogram_equals_window(spark):
    rnd = random.Random(11)
    rows = [("hot" if i % 4 else f"g{i % 3}", f"m{i}", None if i % 17 == 0 else float(rnd.randint(0, 20)))
            for i in range(400)]
    df = spark.createDataFrame(rows, "g string, m string, v double")
    a = {(r.m, r.rk) for r in W.rank_masked(df, ["g"], "v", "rk").collect()}
    b = {(r.m, r.rk) for r in W.rank_masked(df, ["g"], "v", "rk", method="histogram").collect()}
    assert a == b and len(a) == 400
