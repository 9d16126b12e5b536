"""One Spark query per SURVEY §2 key, each over the driver tables at ``sf_dir``.

Every query reads the whole driver tables (through the derived panels) —
no id subsets, samples or row caps; ``limit`` appears only where it *is*
the operator (previews, top-k).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import spec
from strata.operators import aggregates as A
from strata.operators import columns as C
from strata.operators import decompose as D
from strata.operators import gaps as G
from strata.operators import joins as J
from strata.operators import ordering as O
from strata.operators import quality as Q
from strata.operators import windows as W
from strata.plans import curate as CU
from strata.plans import features as FE
from strata.plans import fixture as FX
from strata.plans import stage as ST
from strata.sources import panels as P

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

QK = ["geo", "naics"]
T = "date_parsed"
VPK = spec.VAC
WAGE = spec.WAGE


def q(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# -------------------------------------------------------- 2.1 sources/sinks
def _scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    on a cluster: ``spark.checkpoint.dir`` names shared storage there)."""
    import uuid
    from strata.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/strata-io/{name}-{uuid.uuid4().hex}"


def _raw_quarterly_folder(spark, d) -> str:
    """A landing folder of the quarterly feed: files of the usual column order, files that swap it and have a column
    more, and a file in which one line per geography lacks fields."""
    raw = P.quarterly_long(spark, d)
    cols = [F.col(f"`{c}`") if c in raw.columns else F.lit("").alias(c) for c in spec.RAW_QUARTERLY_COLUMNS]
    whole = raw.select(*cols)
    path = _scratch(spark, "raw-quarterly")
    swapped = [f"`{c}`" for c in reversed(spec.RAW_QUARTERLY_COLUMNS)]
    wages = F.col("Statistics") == spec.STAT_WAGE
    whole.where(~wages).write.option("header", True).csv(path)
    whole.where(wages).select(*swapped, F.lit("n/a").alias("NOTE")).write.mode("append").option("header", True).csv(path)
    short = raw.groupBy("GEO").agg(F.count("*").alias("n")).select(F.concat_ws(",", F.lit("1997-01"), "GEO", "n").alias("value"))
    head = ",".join(f'"{c}"' for c in spec.RAW_QUARTERLY_COLUMNS)
    lines = short.withColumn("at", F.lit(1)).unionByName(spark.range(1).select(F.lit(head).alias("value"), F.lit(0).alias("at")))
    lines.coalesce(1).sortWithinPartitions("at").select("value").write.mode("append").text(path)
    return path


@q("read_raw_csv")
def _(spark, d):
    from strata.plans.clean import clean_quarterly
    from strata.sources.io import read_raw_csv
    return clean_quarterly(read_raw_csv(spark, _raw_quarterly_folder(spark, d), spec.RAW_QUARTERLY_SCHEMA))


@q("read_raw_csv_rejects")
def _(spark, d):
    from strata.sources.io import read_raw_csv_with_rejects
    rows, rejects = read_raw_csv_with_rejects(spark, _raw_quarterly_folder(spark, d), spec.RAW_QUARTERLY_SCHEMA)
    counted = rows.groupBy("Statistics").agg(F.count("*").alias("n"))
    return counted.unionByName(rejects.select(F.col("record").alias("Statistics"), F.lit(1).cast("long").alias("n")))


@q("write_partitioned")
def _(spark, d):
    from strata.sources.io import read_partitioned_parquet, write_partitioned
    path = _scratch(spark, "monthly-curated")
    write_partitioned(FX.monthly_curated(spark, d), path, ("Year", "GEO"))
    return read_partitioned_parquet(spark, path)


@q("read_partitioned_parquet")
def _(spark, d):
    from strata.sources.io import read_partitioned_parquet, write_partitioned
    path = _scratch(spark, "quarterly-curated")
    write_partitioned(FX.quarterly_curated(spark, d), path, ("Year", "GEO"))
    return read_partitioned_parquet(spark, path)


@q("load_threshold_seed")
def _(spark, d):
    from strata.sources.io import load_threshold_seed
    path = _scratch(spark, "threshold-seed")
    P.thresholds(spark, d).write.option("header", True).csv(path)
    return load_threshold_seed(spark, path)


@q("materialize")
def _(spark, d):
    from strata.sources.io import materialize
    return materialize(FX.monthly_stage(spark, d), "stg_monthly_vacancies", "view")


def _fresh_table(spark, name: str) -> str:
    """A new table name in the schema of stored results (the in-memory catalog may lie over an older warehouse)."""
    import uuid
    from strata.sources.io import create_schema
    create_schema(spark, "strata_io")
    return f"strata_io.{name}_{uuid.uuid4().hex}"


@q("save_table")
def _(spark, d):
    from strata.plans.rules import UNIQUE
    from strata.sources.io import read_table
    from strata.sources.publish import publish_table
    key = UNIQUE["stage_quarterly"]
    name = _fresh_table(spark, "quarterly_curated")
    publish_table(CU.to_catalog(FX.quarterly_curated(spark, d)), name, [Q.NotNull(c) for c in key] + [Q.UniqueKey(key)])
    return read_table(spark, "quarterly", {"quarterly": name})


# ----------------------------------------------------------- 2.2 projections
@q("select_columns")
def _(spark, d):
    return C.select_columns(P.employment_long(spark, d), ["REF_DATE", "GEO", spec.NAICS_LABEL_COL, "VALUE"])


@q("rename_columns")
def _(spark, d):
    return CU.to_catalog(FX.quarterly_curated(spark, d))


@q("trim_strings")
def _(spark, d):
    return C.trim_strings(P.monthly_long(spark, d), ["REF_DATE", "GEO", "Statistics"])


@q("cast_measure")
def _(spark, d):
    return C.cast_measure(P.monthly_long(spark, d), "VALUE")


@q("parse_period")
def _(spark, d):
    return C.parse_period(FX.monthly_clean(spark, d), "Date", "Date_parsed")


@q("period_year")
def _(spark, d):
    return C.period_year(P.monthly_long(spark, d), "REF_DATE", "Year")


@q("filter_category")
def _(spark, d):
    return C.filter_category(P.employment_long(spark, d), spec.EMPLOYEE_TYPE_COL, spec.ALL_EMPLOYEES)


@q("filter_since")
def _(spark, d):
    return C.filter_since(P.employment_long(spark, d), "REF_DATE", spec.FIXTURE_SINCE)


@q("filter_not_null")
def _(spark, d):
    return C.filter_not_null(FX.quarterly_stage(spark, d), ["job_vacancy_rate", WAGE])


@q("exclude_members")
def _(spark, d):
    return C.exclude_members(FX.quarterly_stage(spark, d), "geo", spec.FIXTURE_EXCLUDE_GEOS)


@q("rate_per_1000")
def _(spark, d):
    return C.rate_per_1000(P.quarterly(spark, d), "job_vacancies", "payroll_employees", VPK)


@q("pct_change")
def _(spark, d):
    s = W.lag_prev_period(FX.quarterly_stage(spark, d), QK, T, VPK, 4, "prev")
    return C.pct_change(s, VPK, "prev", "yoy_pct").select(*QK, T, VPK, "prev", "yoy_pct")


@q("classify_tier")
def _(spark, d):
    return FX.quarterly_mart(spark, d).select(*QK, T, "foreign_accessibility_tier")


@q("date_window_flags")
def _(spark, d):
    return C.date_window_flags(FX.quarterly_stage(spark, d), T, spec.FIXTURE_FLAG_WINDOWS) \
            .select(*QK, T, *spec.FIXTURE_FLAG_WINDOWS)


@q("calendar_cycle")
def _(spark, d):
    return C.calendar_cycle(FX.quarterly_stage(spark, d), T, spec.QUARTER_PERIOD, digits=9) \
            .select(*QK, T, "quarter", "quarter_sin", "quarter_cos")


@q("recent_window_flag")
def _(spark, d):
    return C.recent_window_flag(FX.quarterly_stage(spark, d), T, spec.FIXTURE_AS_OF,
                                spec.RECENT_MONTHS).select(*QK, T, "is_recent")


@q("label_encode")
def _(spark, d):
    s = ST.stage_quarterly(FX.quarterly_panel_table(spark, d))
    s = C.label_encode(C.label_encode(s, "geo", "geo_encoded"), "naics", "naics_encoded")
    return s.select(*QK, T, "geo_encoded", "naics_encoded")


@q("next_period")
def _(spark, d):
    return C.next_period(FX.quarterly_stage(spark, d), QK, T, spec.FORECAST_STEP_MONTHS)


# ------------------------------------------------------------------ 2.3 joins
def _monthly_yoy_mom(spark, d):
    s = ST.stage_monthly(FX.monthly_panel_table(spark, d))
    yoy = W.lag_prev_period(s, ["geo"], T, VPK, 12, "prev_year_vacancies_per_1000")
    yoy = C.pct_change(yoy, VPK, "prev_year_vacancies_per_1000", "yoy_change_pct")
    mom = W.lag_prev_period(s, ["geo"], T, VPK, 1, "prev_month_vacancies_per_1000")
    mom = C.pct_change(mom, VPK, "prev_month_vacancies_per_1000", "mom_change_pct")
    return yoy, mom


@q("join_left_keys")
def _(spark, d):
    yoy, mom = _monthly_yoy_mom(spark, d)
    return J.join_left_keys(yoy, mom.select("geo", T, "mom_change_pct"), ["geo", T])


@q("join_group_stats")
def _(spark, d):
    s = ST.stage_monthly(FX.monthly_panel_table(spark, d))
    stats = A.period_averages(s, ["geo", "year"], [
        ("avg_vacancies_per_1000", "avg", VPK, 2), ("avg_job_vacancy_rate", "avg", "job_vacancy_rate", 2),
        ("total_job_vacancies", "sum", "job_vacancies", None)])
    return J.join_group_stats(s, stats, ["geo", "year"])


@q("lookup_dimension")
def _(spark, d):
    panel = FX.quarterly_panel_table(spark, d)
    th = P.thresholds(spark, d, panel).select("geo", "lmia_high_wage_threshold")
    return J.lookup_dimension(ST.stage_quarterly(panel), th, "geo")


@q("drop_series")
def _(spark, d):
    panel = FE.materialized(_excluded(spark, d, False))
    bad = A.unreliable_series(A.series_gap_profile(panel, QK, T, VPK), QK)
    return J.drop_series(panel, bad, QK)


@q("missing_periods")
def _(spark, d):
    return G.missing_periods(FX.quarterly_mart_holed_table(spark, d, T), T, spec.FIXTURE_PANEL_START, 3)


@q("complete_panel")
def _(spark, d):
    return G.complete_panel(FX.quarterly_mart_holed_table(spark, d), QK, T, spec.FIXTURE_PANEL_START, 3)


# ------------------------------------------------------------ 2.4 aggregates
@q("row_count")
def _(spark, d):
    return A.row_count(FX.quarterly_clean(spark, d))


@q("null_counts")
def _(spark, d):
    return A.null_counts(FX.quarterly_curated(spark, d))


@q("distinct_counts")
def _(spark, d):
    return A.distinct_counts(FX.quarterly_clean(spark, d), ["GEO", "Year", "Statistics", "NAICS"])


@q("distinct_values")
def _(spark, d):
    return A.distinct_values(FX.quarterly_clean(spark, d), ["Date"], 200)


@q("duplicate_groups")
def _(spark, d):
    return A.duplicate_groups(FX.monthly_clean(spark, d), ["GEO", "Year", "Statistics"])


@q("pivot_statistics")
def _(spark, d):
    c = C.parse_period(FX.monthly_clean(spark, d), "Date", "Date_parsed")
    return A.pivot_statistics(c, ["Year", "Date_parsed", "GEO"], "Statistics", "VALUE", spec.MONTHLY_STATISTICS)


@q("period_averages")
def _(spark, d):
    return A.period_averages(FX.monthly_stage(spark, d), ["geo", "year"], [
        ("avg_vacancies_per_1000", "avg", VPK, 2), ("avg_job_vacancy_rate", "avg", "job_vacancy_rate", 2),
        ("total_job_vacancies", "sum", "job_vacancies", None)])


def _digital_sums(spark, d):
    return A.conditional_sums(FX.employment_stage(spark, d), [T, "geo", "year"], "naics", "total_employment", {
        "total_data_digital_employment": spec.FIXTURE_DIGITAL,
        "total_provincial_employment": [spec.FIXTURE_AGGREGATE]})


@q("conditional_sums")
def _(spark, d):
    return _digital_sums(spark, d)


@q("concentration_pct")
def _(spark, d):
    return A.concentration_pct(_digital_sums(spark, d), "total_data_digital_employment",
                               "total_provincial_employment", "data_digital_employment_concentration_pct")


@q("group_percentiles")
def _(spark, d):
    return A.group_percentiles(FX.quarterly_stage(spark, d), ["geo", "year"], "job_vacancy_rate",
                               {"p50_vacancy_rate": 0.5, "p75_vacancy_rate": 0.75})


@q("missing_share")
def _(spark, d):
    return A.missing_share(FX.quarterly_mart(spark, d), ["geo"], VPK, 10.0)


@q("missing_by_year")
def _(spark, d):
    return A.missing_by_year(FX.quarterly_mart(spark, d), "geo", "naics", T, "year", VPK)


@q("anomaly_rows")
def _(spark, d):
    return A.anomaly_rows(FX.quarterly_series_table(spark, d), QK, T, VPK, spec.ANOMALY_Z, spec.ANOMALY_MIN_ROWS)


@q("anomaly_years")
def _(spark, d):
    a = A.anomaly_rows(FX.quarterly_series_table(spark, d), QK, T, VPK, spec.ANOMALY_Z, spec.ANOMALY_MIN_ROWS)
    return A.anomaly_years(a, QK, T)


# the same diagnostics over the wage measure
@q("missing_share_wage")
def _(spark, d):
    return A.missing_share(FX.quarterly_mart(spark, d), ["geo"], WAGE, 10.0)


@q("missing_by_year_wage")
def _(spark, d):
    return A.missing_by_year(FX.quarterly_mart(spark, d), "geo", "naics", T, "year", WAGE, lo=0.1)


@q("anomaly_rows_wage")
def _(spark, d):
    return A.anomaly_rows(FX.quarterly_series_table(spark, d, WAGE), QK, T, WAGE, 2.0, spec.ANOMALY_MIN_ROWS)


@q("anomaly_years_wage")
def _(spark, d):
    a = A.anomaly_rows(FX.quarterly_series_table(spark, d, WAGE), QK, T, WAGE, 2.0, spec.ANOMALY_MIN_ROWS)
    return A.anomaly_years(a, QK, T)


def _excluded(spark, d, narrow=True):
    columns = (*QK, T, "year", VPK) if narrow else ()
    full = G.complete_panel(FX.quarterly_mart_holed_table(spark, d, *columns), QK, T, spec.FIXTURE_PANEL_START, 3)
    return C.exclude_members(full, "geo", spec.FIXTURE_EXCLUDE_GEOS)


@q("series_gap_profile")
def _(spark, d):
    return A.series_gap_profile(_excluded(spark, d), QK, T, VPK)


@q("unreliable_series")
def _(spark, d):
    return A.unreliable_series(A.series_gap_profile(_excluded(spark, d), QK, T, VPK), QK)


@q("period_bounds")
def _(spark, d):
    return A.period_bounds(FX.quarterly_stage(spark, d), QK, T)


# --------------------------------------------------------------- 2.5 windows
@q("lag_prev_period")
def _(spark, d):
    return W.lag_prev_period(FX.monthly_stage(spark, d), ["geo"], T, VPK, 1, "prev_month_vacancies_per_1000")


@q("lag_year_monthly")
def _(spark, d):
    return W.lag_prev_period(FX.employment_stage(spark, d), QK, T, "total_employment", 12, "prev_year_employment")


@q("lag_year_quarterly")
def _(spark, d):
    return W.lag_columns(FX.quarterly_stage(spark, d), QK, T, [
        (VPK, 4, "prev_year_vacancies_per_1000"), ("job_vacancy_rate", 4, "prev_year_vacancy_rate"),
        (WAGE, 4, "prev_year_wage")])


@q("rank_masked")
def _(spark, d):
    return W.rank_masked(FX.quarterly_stage(spark, d), ["geo", T], "job_vacancy_rate", "demand_rank")


@q("sustained_demand_pct")
def _(spark, d):
    s = ST.stage_quarterly(FX.quarterly_panel_table(spark, d))
    p = A.group_percentiles(s, ["geo", "year"], "job_vacancy_rate", {"p75_vacancy_rate": 0.75})
    s = J.join_group_stats(s, p, ["geo", "year"])
    return W.sustained_demand_pct(s, QK, T, "job_vacancy_rate", "p75_vacancy_rate", spec.FIXTURE_AS_OF) \
            .select(*QK, T, "pct_quarters_above_threshold_2yr")


def _interpolated(spark, d, measures=(VPK, WAGE)):
    df = FX.gap_cleaned(spark, d)
    for v in measures:
        df = W.interpolate_limited(df, QK, T, v, spec.INTERPOLATION_LIMIT)
    return df


@q("interpolate_limited")
def _(spark, d):
    return _interpolated(spark, d).select(*QK, T, VPK, WAGE)


@q("lag_features")
def _(spark, d):
    f = W.lag_features(_interpolated(spark, d).select(*QK, T, VPK), QK, T, VPK, spec.LAGS)
    return f


@q("rolling_features")
def _(spark, d):
    return W.rolling_features(_interpolated(spark, d).select(*QK, T, VPK), QK, T, VPK, spec.ROLLS)


def _display_series(spark, d):
    return W.fill_both_ends(FX.quarterly_mart(spark, d).select(*QK, T, VPK), QK, T, VPK)


@q("fill_both_ends")
def _(spark, d):
    return _display_series(spark, d)


@q("series_tail")
def _(spark, d):
    return W.series_tail(_interpolated(spark, d), QK, T, VPK, 6)


@q("autocorrelation")
def _(spark, d):
    return W.autocorrelation(_display_series(spark, d), QK, T, VPK, spec.ACF_LAGS)


@q("seasonal_decompose")
def _(spark, d):
    return W.seasonal_decompose(_display_series(spark, d), QK, T, VPK, spec.QUARTER_PERIOD)


@q("robust_decompose")
def _(spark, d):
    return D.robust_decompose(_display_series(spark, d), QK, T, VPK, spec.QUARTER_PERIOD)


# ---------------------------------------------------------- 2.6 sorts, top-k
@q("sort_limit")
def _(spark, d):
    return O.sort_limit(FX.quarterly_curated(spark, d), ["NAICS", "Date_parsed", "GEO"], 20)


@q("topk_per_group")
def _(spark, d):
    m = FX.quarterly_series_table(spark, d)
    share = A.missing_share(m, ["geo"], VPK, 10.0).filter("over_threshold").select("geo")
    periods = m.groupBy("geo").agg(F.count_distinct(T).alias("n_periods"))
    per = (m.join(share, "geo", "left_semi").groupBy("geo", "naics")
             .agg(F.count_if(F.col(VPK).isNull()).alias("n_missing"))
             .join(periods, "geo")
             .withColumn("pct_of_periods", F.col("n_missing") / F.col("n_periods") * F.lit(100)))
    return O.topk_per_group(per, ["geo"], "naics", "n_missing", 5)


# -------------------------------------------------------------- 2.7 set ops
def _seasonal_naive(spark, d):
    from strata.forecasting.recursive import seasonal_naive_forecast
    return seasonal_naive_forecast(_interpolated(spark, d), QK, T, VPK, spec.FORECAST_HORIZON)


@q("append_rows")
def _(spark, d):
    actual = FX.quarterly_stage(spark, d).select(*QK, T, VPK)
    return G.append_rows(actual, _seasonal_naive(spark, d))


@q("seasonal_naive_forecast")
def _(spark, d):
    return _seasonal_naive(spark, d)


@q("period_difference")
def _(spark, d):
    m = FX.quarterly_mart_holed_table(spark, d, T)
    expected = m.agg(F.max(T).alias("__last")).select(F.explode(F.sequence(
        F.lit(spec.FIXTURE_PANEL_START).cast("date"), F.col("__last"),
        F.make_ym_interval(F.lit(0), F.lit(3)))).alias(T))
    return G.period_difference(expected, m.select(T))


# ---------------------------------------------------------- 2.8 quality gates
@q("check_not_null")
def _(spark, d):
    return Q.check_not_null(FX.quarterly_mart(spark, d), [T, "geo", "naics", "year", "foreign_accessibility_tier"])


@q("check_unique_key")
def _(spark, d):
    return Q.check_unique_key(FX.quarterly_curated(spark, d), CU.QUARTERLY_KEYS)


@q("check_accepted_range")
def _(spark, d):
    return Q.check_accepted_range(FX.monthly_mart(spark, d), VPK, 0, None, True)


@q("check_accepted_values")
def _(spark, d):
    return Q.check_accepted_values(FX.quarterly_mart(spark, d), "foreign_accessibility_tier", spec.TIER_LABELS)


# the same gates where the tables do break the rule, so that rows come back
@q("check_unique_key_violations")
def _(spark, d):
    return Q.check_unique_key(FX.quarterly_clean(spark, d), ["Date", "GEO"])


@q("check_accepted_range_violations")
def _(spark, d):
    return Q.check_accepted_range(FX.monthly_mart(spark, d), "yoy_change_pct", -5, 5, True)


@q("check_accepted_values_violations")
def _(spark, d):
    return Q.check_accepted_values(FX.quarterly_mart(spark, d), "foreign_accessibility_tier", spec.TIER_LABELS[:5])


@q("check_row_reconciliation")
def _(spark, d):
    clean = FE.materialized(FX.quarterly_clean(spark, d))
    return Q.check_row_reconciliation(clean, CU.curate_quarterly(clean), 4)


@q("quality_report")
def _(spark, d):
    from strata.plans.rules import with_unique_key
    return Q.quality_report(FX.quarterly_mart(spark, d), with_unique_key("mart_quarterly"))


# -------------------------------------------------- 2.9 composed pipelines
QUERIES["clean_employment"] = FX.employment_clean
QUERIES["clean_monthly"] = FX.monthly_clean
QUERIES["clean_quarterly"] = FX.quarterly_clean
QUERIES["curate_monthly"] = FX.monthly_curated
QUERIES["curate_quarterly"] = FX.quarterly_curated
QUERIES["curate_employment"] = FX.employment_curated
QUERIES["stage_monthly"] = FX.monthly_stage
QUERIES["stage_quarterly"] = FX.quarterly_stage
QUERIES["stage_employment"] = FX.employment_stage
QUERIES["mart_monthly"] = FX.monthly_mart
QUERIES["mart_quarterly"] = FX.quarterly_mart
QUERIES["mart_employment"] = FX.employment_mart
QUERIES["ml_features"] = FX.ml_features


# ------------------------------------------------------- 2.10 forecasting
from strata.forecasting import evaluate as EV  # noqa: E402
from strata.forecasting import models as MD  # noqa: E402
from strata.forecasting.recursive import recursive_forecast  # noqa: E402


def _split(spark, d, target=VPK):
    return EV.temporal_split(FX.ml_features(spark, d), T, target, spec.FIXTURE_SPLIT_CUTOFF,
                             spec.FIXTURE_VAL_CUTOFF)


def _lagged(spark, d, measures=(VPK, WAGE), lags=(1, 4)):
    """The interpolated panel with the few lags that the naive predictors need, not the whole feature table."""
    df = _interpolated(spark, d, measures).select(*QK, T, *measures)
    for m in measures:
        df = W.lag_features(df, QK, T, m, lags)
    return df


@q("temporal_split")
def _(spark, d):
    s = _interpolated(spark, d, [VPK]).select(*QK, T, VPK)
    return EV.temporal_split(s, T, VPK, spec.FIXTURE_SPLIT_CUTOFF, spec.FIXTURE_VAL_CUTOFF)


@q("run_log")
def _(spark, d):
    from strata.forecasting.runlog import append_run_log, run_log
    scores = EV.naive_baseline(_lagged(spark, d), T, [VPK, WAGE], spec.FIXTURE_SPLIT_CUTOFF).collect()  # one row per target and lag
    name = _fresh_table(spark, "run_log")
    for s in scores:
        append_run_log(run_log(spark, s.predictor, {"cutoff": spec.FIXTURE_SPLIT_CUTOFF}, {f"{s.target}.{m}": s[m] for m in ("n", "rmse", "mae")}, {"target": s.target}), name)
    return spark.table(name)


@q("save_predictions")
def _(spark, d):
    from strata.forecasting.runlog import save_predictions
    return save_predictions(_seasonal_naive(spark, d), _fresh_table(spark, "predictions_vacancies"))


@q("forecast_metrics")
def _(spark, d):
    s = EV.temporal_split(_lagged(spark, d, [VPK], [4]), T, VPK, spec.FIXTURE_SPLIT_CUTOFF, spec.FIXTURE_VAL_CUTOFF)
    return EV.forecast_metrics(s, VPK, f"{VPK}_lag4", ["split"])


@q("naive_baseline")
def _(spark, d):
    return EV.naive_baseline(_lagged(spark, d), T, [VPK, WAGE], spec.FIXTURE_SPLIT_CUTOFF)


def _fitted(spark, d, target=VPK):
    """(model, train rows, test rows) with the published parameters."""
    s = _split(spark, d, target)
    train = s.filter(F.col("split") == "train")
    model = EV.fit(EV.training_frame(train, EV.feature_set(target), target), spec.PUBLISHED_PARAMS[target])
    return model, train, s.filter(F.col("split") == "test")


@q("fit_boosted_trees")
def _(spark, d):
    model, _, _ = _fitted(spark, d)
    return spark.createDataFrame(MD.tree_summary(model), "tree int, weight double, nodes int, depth int")


@q("predict")
def _(spark, d):
    model, _, test = _fitted(spark, d)
    return MD.predict(model, test).select(*QK, T, VPK, "prediction")


def _importance(spark, d):
    model, _, _ = _fitted(spark, d)
    return spark.createDataFrame(MD.feature_importance(model), "feature string, importance double")


@q("feature_importance")
def _(spark, d):
    return _importance(spark, d)


@q("feature_attributions")
def _(spark, d):
    model, train, _ = _fitted(spark, d)
    return MD.attributions(model, train, [*QK, T])


@q("rank_importance")
def _(spark, d):
    return O.rank_importance(_importance(spark, d), "importance")


@q("ablation")
def _(spark, d):
    s = _split(spark, d)
    return EV.ablation(s.filter(F.col("tuning") == "fit"), s.filter(F.col("tuning") == "validate"),
                       EV.feature_set(VPK), VPK, spec.PUBLISHED_PARAMS[VPK])


@q("permutation_importance")
def _(spark, d):
    model, _, test = _fitted(spark, d)
    return EV.permutation_importance(model, test, EV.feature_set(VPK), VPK, spec.PERMUTATION_REPEATS)


@q("random_search")
def _(spark, d):
    s = _split(spark, d)
    return EV.random_search(s.filter(F.col("tuning") == "fit"), s.filter(F.col("tuning") == "validate"), EV.feature_set(VPK), VPK)


@q("recursive_forecast")
def _(spark, d):
    model, _, _ = _fitted(spark, d)
    return recursive_forecast(model, FX.ml_features(spark, d), QK, T, VPK)
