"""Mart semantics on hand-built edge panels, quality gates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata import spec
from strata.operators import quality as Q
from strata.plans import marts as M
from strata.plans import stage as ST
from tests import fixtures as fx

QSCHEMA = ("date_parsed date, geo string, year int, naics string, job_vacancies double, "
           "job_vacancy_rate double, payroll_employees double, avg_offered_hourly_wage double")


def _thresholds(spark, **kv):
    return spark.createDataFrame([(g, float(v)) for g, v in kv.items()], "geo string, lmia_high_wage_threshold double")


def test_tier_ladder_three_valued_logic(spark):
    d = dt.date(2024, 1, 1)
    rows = [
        (d, "P", 2024, "none", None, None, 100.0, None),        # Insufficient Data
        (d, "P", 2024, "nowage_hi", 10.0, 10.0, 100.0, None),   # High Demand & Sustained, no wage
        (d, "P", 2024, "wage_only", None, None, 100.0, 50.0),   # Wage Eligible, No Vacancy Data
        (d, "P", 2024, "low", 1.0, 1.0, 100.0, 10.0),           # Low
        (d, "P", 2024, "mid", 5.0, 5.0, 100.0, 10.0),           # Above Avg, below wage
        (d, "Q", 2024, "no_thr", 10.0, 10.0, 100.0, 99.0),      # geo without threshold → NULL comparison
    ]
    st = ST.stage_quarterly(spark.createDataFrame(rows, QSCHEMA))
    out = {r.naics: r for r in M.mart_quarterly(st, _thresholds(spark, P=30), "2024-04-01").collect()}
    L = spec.TIER_LABELS
    assert out["none"].foreign_accessibility_tier == L[0]
    assert out["nowage_hi"].foreign_accessibility_tier == L[1]
    assert out["wage_only"].foreign_accessibility_tier == L[3]
    assert out["low"].foreign_accessibility_tier == L[9]
    assert out["mid"].foreign_accessibility_tier == L[8]
    assert out["no_thr"].lmia_high_wage_threshold is None
    assert out["no_thr"].foreign_accessibility_tier == L[7]     # falls through the wage rules
    assert out["wage_only"].demand_rank is None


def test_sustained_pct_counts_null_quarters_in_denominator(spark):
    qs = fx.quarters(2022, 8)
    rates = [5.0, 1.0, None, 5.0, 5.0, 1.0, 1.0, 5.0]
    rows = [(d, "P", d.year, "s", r, r, 100.0, 20.0) for d, r in zip(qs, rates)]
    rows += [(d, "P", d.year, "other", 2.0, 2.0, 100.0, 20.0) for d in qs]
    st = ST.stage_quarterly(spark.createDataFrame(rows, QSCHEMA))
    out = M.mart_quarterly(st, _thresholds(spark, P=30), "2024-01-01").filter("naics = 's'").collect()
    # recent = date >= 2022-01-01: all 8 rows; p75 per year over s and other
    pct = out[0].pct_quarters_above_threshold_2yr
    assert all(r.pct_quarters_above_threshold_2yr == pct for r in out)
    p75 = {r.year: r.p75_vacancy_rate for r in out}
    hits = sum(1 for d, r in zip(qs, rates) if r is not None and r >= p75[d.year])
    assert pct == round(hits / 8 * 100, 1)
    none_recent = M.mart_quarterly(st, _thresholds(spark, P=30), "2030-01-01").first()
    assert none_recent.pct_quarters_above_threshold_2yr is None


def test_yoy_zero_denominator_and_short_series(spark):
    qs = fx.quarters(2020, 6)
    vac = [0.0, 1.0, 1.0, 1.0, 5.0, 2.0]
    rows = [(d, "P", d.year, "s", v, v, 100.0, 10.0) for d, v in zip(qs, vac)]
    rows.append((qs[0], "P", 2020, "short", 1.0, 1.0, 100.0, 10.0))
    st = ST.stage_quarterly(spark.createDataFrame(rows, QSCHEMA))
    out = M.mart_quarterly(st, _thresholds(spark, P=30), "2022-01-01")
    s = out.filter("naics = 's'").orderBy("date_parsed").collect()
    assert s[4].prev_year_vacancies_per_1000 == 0.0 and s[4].vacancy_rate_yoy_change_pct is None
    assert s[5].vacancy_rate_yoy_change_pct == 100.0
    assert out.filter("naics = 'short'").first().prev_year_vacancies_per_1000 is None


def test_monthly_mart_mom_yoy_and_annual(spark):
    ms = fx.months(2019, 14)
    rows = [(d, "P", d.year, float(i + 1), 1.0 + i, 1000.0) for i, d in enumerate(ms)]
    st = ST.stage_monthly(spark.createDataFrame(
        rows, "date_parsed date, geo string, year int, job_vacancies double, job_vacancy_rate double, payroll_employees double"))
    out = M.mart_monthly(st).orderBy("date_parsed").collect()
    assert out[0].mom_change_pct is None and out[1].mom_change_pct == 100.0
    assert out[11].yoy_change_pct is None and out[12].prev_year_vacancies_per_1000 == 1.0
    assert out[0].total_job_vacancies == sum(range(1, 13)) and out[12].total_job_vacancies == 13 + 14
    assert "prev_month_vacancies_per_1000" not in M.mart_monthly(st).columns


def test_employment_concentration_without_aggregate_row(spark):
    d = dt.date(2020, 1, 1)
    rows = [(d, "P", 2020, "ECONOMY", 10.0), (d, "P", 2020, "ALL", 40.0),
            (d, "Q", 2020, "ECONOMY", 5.0)]
    st = ST.stage_employment(spark.createDataFrame(rows, "date_parsed date, geo string, year int, naics string, total_employment double"))
    out = {(r.geo, r.naics): r for r in M.mart_employment(st, ["ECONOMY", "PROMO"], "ALL").collect()}
    assert out[("P", "ECONOMY")].data_digital_employment_concentration_pct == 25.0
    assert out[("Q", "ECONOMY")].total_provincial_employment == 0.0
    assert out[("Q", "ECONOMY")].data_digital_employment_concentration_pct is None


def test_quality_report_and_enforce(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "a", -1.0), (None, "z", None)], "k int, t string, v double")
    rep = {(r.check, r.column): r.failures for r in Q.quality_report(df, [
        Q.NotNull("k"), Q.AcceptedRange("v", 0), Q.AcceptedValues("t", ("a", "b")), Q.UniqueKey(("k", "t"))]).collect()}
    assert rep == {("not_null", "k"): 1, ("accepted_range", "v"): 1, ("accepted_values", "t"): 1,
                   ("unique_key", "k,t"): 1}
    with pytest.raises(AssertionError):
        Q.enforce(Q.quality_report(df, [Q.NotNull("k")]))
    Q.enforce(Q.quality_report(df.filter(F.col("k").isNotNull()), [Q.NotNull("k")]))


def test_topk_salted_equals_single_phase(spark):
    import random
    from strata.operators.ordering import topk_per_group
    rnd = random.Random(1)
    rows = [("hot" if i % 3 else f"g{i % 5}", f"m{i}", rnd.randint(0, 50)) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, m string, s int")
    a = {tuple(r) for r in topk_per_group(df, ["g"], "m", "s", 5, salt_buckets=8).collect()}
    b = {tuple(r) for r in topk_per_group(df, ["g"], "m", "s", 5, salt_buckets=1).collect()}
    assert a == b and len(a) == 5 * len({r[0] for r in rows})
    for g in {r[0] for r in rows}:
        exp = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))[:5]
        got = sorted((r for r in a if r[0] == g), key=lambda r: r[3])
        assert [(r[1], r[2]) for r in got] == [(r[1], r[2]) for r in exp]


def test_save_predictions_and_table_roundtrip(spark):
    import datetime as dt
    from strata.forecasting.runlog import save_predictions
    df = spark.createDataFrame([(dt.date(2026, 1, 1), "P", "s", 1.5, "gbt_regressor", 1)],
                               "date_parsed date, geo string, naics string, predicted_v double, model string, "
                               "forecast_horizon_quarters int")
    back = save_predictions(df, "predictions_test")
    assert back.count() == 1 and back.first().forecast_horizon_quarters == 1
