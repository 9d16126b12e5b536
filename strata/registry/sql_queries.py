"""DuckDB oracle SQL, one statement per ``queries()`` key (same column names)."""

from __future__ import annotations

from strata import spec
from strata.registry.ctes import EXCLUDE, NAICS_COL, RECENT_FROM, START, _interp, _neighbour_cols, cte, with_

TIERS = ("'Insufficient Data', 'High Demand and Sustained, No Wage Data', "
         "'Above Average Demand, No Wage Data', 'Wage Eligible, No Vacancy Data', "
         "'HIGH, Wage Eligible, High Demand and Sustain', 'Wage Eligible, High Demand', "
         "'Wage Eligible', 'High Demand and Sustained, Below Wage Threshold', "
         "'Above Average Demand, Below Wage Threshold', 'Low'")

VPK = "vacancies_per_1000"
K = "geo, naics, date_parsed"
SQL: dict[str, str] = {}

# ------------------------------------------------------------ helper CTEs
cte("filled", ("mart_quarterly",), f"""
SELECT geo, naics, date_parsed, {_interp(VPK, None)} AS {VPK}
FROM (SELECT *, {_neighbour_cols(VPK)}
      FROM (SELECT geo, naics, date_parsed, {VPK},
                   row_number() OVER (PARTITION BY geo, naics ORDER BY date_parsed) AS rn
            FROM mart_quarterly) r) n""")

cte("anomalies", ("mart_quarterly",), f"""
SELECT geo, naics, date_parsed, {VPK}
FROM (SELECT *, count(*) OVER (PARTITION BY geo, naics) AS n,
             avg({VPK}) OVER (PARTITION BY geo, naics) AS m,
             stddev_samp({VPK}) OVER (PARTITION BY geo, naics) AS sd
      FROM mart_quarterly) a
WHERE n >= 12 AND sd > 0 AND abs({VPK} - m) > 3.5 * sd""")

cte("seasonal_naive", ("interpolated",), f"""
SELECT CAST(last_date + to_months(CAST(3 * h AS INTEGER)) AS DATE) AS date_parsed, geo, naics,
       CASE h WHEN 1 THEN y4 WHEN 2 THEN y3 WHEN 3 THEN y2 ELSE y1 END AS predicted_{VPK},
       'seasonal_naive' AS model, CAST(h AS INTEGER) AS forecast_horizon_quarters
FROM (SELECT geo, naics, max(date_parsed) AS last_date,
             max(CASE WHEN pos = 1 THEN v END) AS y1, max(CASE WHEN pos = 2 THEN v END) AS y2,
             max(CASE WHEN pos = 3 THEN v END) AS y3, max(CASE WHEN pos = 4 THEN v END) AS y4
      FROM (SELECT geo, naics, date_parsed, {VPK} AS v,
                   row_number() OVER (PARTITION BY geo, naics ORDER BY date_parsed DESC) AS pos
            FROM interpolated) t WHERE pos <= 4 GROUP BY geo, naics) tail,
     (SELECT unnest([1, 2, 3, 4]) AS h) hs""")

# ------------------------------------------------------------ 2.2
SQL["select_columns"] = with_(f"SELECT REF_DATE, GEO, {NAICS_COL}, VALUE FROM employment_long", "employment_long")
SQL["rename_columns"] = with_("""
SELECT Year AS year, Date_parsed AS date_parsed, GEO AS geo, NAICS AS naics,
       "Average offered hourly wage" AS avg_offered_hourly_wage, "Job vacancies" AS job_vacancies,
       "Job vacancy rate" AS job_vacancy_rate, "Payroll employees" AS payroll_employees
FROM quarterly_curated""", "quarterly_curated")
SQL["trim_strings"] = with_("SELECT trim(REF_DATE) AS REF_DATE, trim(GEO) AS GEO, trim(Statistics) AS Statistics, VALUE FROM monthly_long", "monthly_long")
SQL["cast_measure"] = with_("SELECT REF_DATE, GEO, Statistics, TRY_CAST(VALUE AS DOUBLE) AS VALUE FROM monthly_long", "monthly_long")
SQL["parse_period"] = with_("SELECT *, CAST(strptime(Date, '%Y-%m') AS DATE) AS Date_parsed FROM monthly_clean", "monthly_clean")
SQL["period_year"] = with_("SELECT *, CAST(year(CAST(strptime(REF_DATE, '%Y-%m') AS DATE)) AS INTEGER) AS Year FROM monthly_long", "monthly_long")
SQL["filter_category"] = with_("""SELECT * FROM employment_long WHERE "Type of employee" = 'All employees'""", "employment_long")
SQL["filter_since"] = with_("SELECT * FROM employment_long WHERE REF_DATE >= '1996-01'", "employment_long")
SQL["filter_not_null"] = with_("SELECT * FROM stage_quarterly WHERE job_vacancy_rate IS NOT NULL AND avg_offered_hourly_wage IS NOT NULL", "stage_quarterly")
SQL["exclude_members"] = with_(f"SELECT * FROM stage_quarterly WHERE geo IS NULL OR geo NOT IN {EXCLUDE}", "stage_quarterly")
SQL["rate_per_1000"] = with_(f"SELECT *, job_vacancies / nullif(payroll_employees, 0) * 1000 AS {VPK} FROM quarterly", "quarterly")
SQL["pct_change"] = with_(f"""
SELECT geo, naics, date_parsed, {VPK}, prev, round(({VPK} - prev) / nullif(prev, 0) * 100, 2) AS yoy_pct
FROM (SELECT *, lag({VPK}, 4) OVER (PARTITION BY geo, naics ORDER BY date_parsed) AS prev FROM stage_quarterly) l""",
                          "stage_quarterly")
SQL["classify_tier"] = with_(f"SELECT {K}, foreign_accessibility_tier FROM mart_quarterly", "mart_quarterly")
SQL["date_window_flags"] = with_(f"""
SELECT {K}, CASE WHEN date_parsed BETWEEN DATE '1997-04-01' AND DATE '1998-07-01' THEN 1 ELSE 0 END AS is_covid,
       CASE WHEN date_parsed BETWEEN DATE '1998-10-01' AND DATE '2000-01-01' THEN 1 ELSE 0 END AS is_post_covid_boom
FROM stage_quarterly""", "stage_quarterly")
SQL["calendar_cycle"] = with_(f"""
SELECT {K}, CAST(month(date_parsed) AS INTEGER) AS quarter,
       round(sin(2 * pi() * month(date_parsed) / 4), 9) AS quarter_sin,
       round(cos(2 * pi() * month(date_parsed) / 4), 9) AS quarter_cos
FROM stage_quarterly""", "stage_quarterly")
SQL["recent_window_flag"] = with_(f"SELECT {K}, date_parsed >= {RECENT_FROM} AS is_recent FROM stage_quarterly", "stage_quarterly")
SQL["label_encode"] = with_(f"""
SELECT {K}, CAST(ge.code AS INTEGER) AS geo_encoded, CAST(ne.code AS INTEGER) AS naics_encoded
FROM stage_quarterly s
LEFT JOIN (SELECT g, row_number() OVER (ORDER BY g) - 1 AS code FROM (SELECT DISTINCT geo AS g FROM stage_quarterly WHERE geo IS NOT NULL)) ge ON s.geo = ge.g
LEFT JOIN (SELECT n, row_number() OVER (ORDER BY n) - 1 AS code FROM (SELECT DISTINCT naics AS n FROM stage_quarterly WHERE naics IS NOT NULL)) ne ON s.naics = ne.n""",
                             "stage_quarterly")
SQL["next_period"] = with_("SELECT geo, naics, CAST(max(date_parsed) + INTERVAL 3 MONTH AS DATE) AS next_date FROM stage_quarterly GROUP BY geo, naics", "stage_quarterly")

# ------------------------------------------------------------ 2.3
SQL["join_left_keys"] = with_("SELECT * FROM monthly_changes", "monthly_changes")
SQL["join_group_stats"] = with_("""
SELECT s.*, a.avg_vacancies_per_1000, a.avg_job_vacancy_rate, a.total_job_vacancies
FROM stage_monthly s LEFT JOIN geo_years a ON s.geo = a.geo AND s.year = a.year""", "stage_monthly", "geo_years")
SQL["lookup_dimension"] = with_("""
SELECT s.*, t.lmia_high_wage_threshold FROM stage_quarterly s LEFT JOIN thresholds t ON s.geo = t.geo""",
                               "stage_quarterly", "thresholds")
SQL["drop_series"] = with_("SELECT * FROM gap_cleaned", "gap_cleaned")
SQL["missing_periods"] = with_("SELECT * FROM missing_q", "missing_q")
SQL["complete_panel"] = with_("SELECT * FROM completed", "completed")

# ------------------------------------------------------------ 2.4
SQL["row_count"] = with_("SELECT count(*) AS row_count FROM quarterly_clean", "quarterly_clean")
SQL["null_counts"] = with_("""
SELECT CAST(count_if(Year IS NULL) AS BIGINT) AS Year, CAST(count_if(Date_parsed IS NULL) AS BIGINT) AS Date_parsed,
       CAST(count_if(GEO IS NULL) AS BIGINT) AS GEO, CAST(count_if(NAICS IS NULL) AS BIGINT) AS NAICS,
       CAST(count_if("Average offered hourly wage" IS NULL) AS BIGINT) AS "Average offered hourly wage",
       CAST(count_if("Job vacancies" IS NULL) AS BIGINT) AS "Job vacancies",
       CAST(count_if("Job vacancy rate" IS NULL) AS BIGINT) AS "Job vacancy rate",
       CAST(count_if("Payroll employees" IS NULL) AS BIGINT) AS "Payroll employees"
FROM quarterly_curated""", "quarterly_curated")
SQL["distinct_counts"] = with_(", ".join(
    [f"SELECT " + ", ".join(
        f"CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}"
        for c in ("GEO", "Year", "Statistics", "NAICS"))]) + " FROM quarterly_clean", "quarterly_clean")
SQL["distinct_values"] = with_("SELECT DISTINCT Date FROM quarterly_clean ORDER BY Date LIMIT 200", "quarterly_clean")
SQL["duplicate_groups"] = with_("""
SELECT GEO, Year, Statistics, count(*) AS count FROM monthly_clean
GROUP BY GEO, Year, Statistics HAVING count(*) > 1""", "monthly_clean")
SQL["pivot_statistics"] = with_("SELECT * FROM monthly_curated", "monthly_curated")
SQL["period_averages"] = with_("SELECT * FROM geo_years", "geo_years")
SQL["conditional_sums"] = with_("SELECT * FROM digital_sums", "digital_sums")
SQL["concentration_pct"] = with_("SELECT * FROM digital_shares", "digital_shares")
SQL["group_percentiles"] = with_("SELECT * FROM rate_quantiles", "rate_quantiles")

def _missing_share(v: str) -> str:
    return with_(f"""
SELECT geo, n_missing, n_rows, n_missing / n_rows * 100 AS pct_missing, n_missing / n_rows * 100 > 10 AS over_threshold
FROM (SELECT geo, CAST(count_if({v} IS NULL) AS BIGINT) AS n_missing, count(*) AS n_rows FROM mart_quarterly GROUP BY geo) g""",
                 "mart_quarterly")


def _missing_by_year(v: str, lo: float) -> str:
    return with_(f"""
, periods AS (SELECT count(DISTINCT date_parsed) AS n_periods FROM mart_quarterly),
grp AS (SELECT geo FROM mart_quarterly GROUP BY geo HAVING CAST(count_if({v} IS NULL) AS BIGINT) / count(*) * 100 > 10),
series AS (SELECT geo, naics, CAST(count_if({v} IS NULL) AS BIGINT) AS series_missing FROM mart_quarterly
           WHERE geo IN (SELECT geo FROM grp) GROUP BY geo, naics),
yearly AS (SELECT geo, naics, year, CAST(count_if({v} IS NULL) AS BIGINT) AS year_missing FROM mart_quarterly
           WHERE geo IN (SELECT geo FROM grp) GROUP BY geo, naics, year)
SELECT s.geo, s.naics, s.series_missing, p.n_periods, y.year, y.year_missing
FROM series s CROSS JOIN periods p JOIN yearly y ON y.geo = s.geo AND y.naics = s.naics
WHERE s.series_missing >= CAST({lo} AS DOUBLE) * p.n_periods AND s.series_missing <= CAST(0.5 AS DOUBLE) * p.n_periods
UNION ALL
SELECT s.geo, s.naics, s.series_missing, p.n_periods, CAST(NULL AS INTEGER), CAST(NULL AS BIGINT)
FROM series s CROSS JOIN periods p WHERE s.series_missing > CAST(0.5 AS DOUBLE) * p.n_periods""", "mart_quarterly")


SQL["missing_share"] = _missing_share(VPK)
SQL["missing_share_wage"] = _missing_share("avg_offered_hourly_wage")
SQL["missing_by_year"] = _missing_by_year(VPK, 0.3)
SQL["missing_by_year_wage"] = _missing_by_year("avg_offered_hourly_wage", 0.1)
SQL["anomaly_rows_wage"] = with_("""
SELECT geo, naics, date_parsed, avg_offered_hourly_wage
FROM mart_quarterly
JOIN (SELECT geo, naics, avg(avg_offered_hourly_wage) AS m, stddev_samp(avg_offered_hourly_wage) AS sd
      FROM mart_quarterly GROUP BY geo, naics HAVING count(*) >= 12) s USING (geo, naics)
WHERE sd > 0 AND abs(avg_offered_hourly_wage - m) > 2 * sd""", "mart_quarterly")
SQL["anomaly_years_wage"] = with_("""
SELECT DISTINCT geo, naics, CAST(extract(year FROM date_parsed) AS INTEGER) AS year
FROM mart_quarterly
JOIN (SELECT geo, naics, avg(avg_offered_hourly_wage) AS m, stddev_samp(avg_offered_hourly_wage) AS sd
      FROM mart_quarterly GROUP BY geo, naics HAVING count(*) >= 12) s USING (geo, naics)
WHERE sd > 0 AND abs(avg_offered_hourly_wage - m) > 2 * sd""", "mart_quarterly")
SQL["anomaly_rows"] = with_("SELECT * FROM anomalies", "anomalies")
SQL["anomaly_years"] = with_("SELECT DISTINCT geo, naics, CAST(year(date_parsed) AS INTEGER) AS year FROM anomalies", "anomalies")
SQL["series_gap_profile"] = with_("SELECT * FROM gap_profile", "gap_profile")
SQL["unreliable_series"] = with_("SELECT * FROM unreliable", "unreliable")
SQL["period_bounds"] = with_("SELECT geo, naics, min(date_parsed) AS min_date, max(date_parsed) AS max_date FROM stage_quarterly GROUP BY geo, naics", "stage_quarterly")

# ------------------------------------------------------------ 2.5
SQL["lag_prev_period"] = with_(f"SELECT *, lag({VPK}, 1) OVER (PARTITION BY geo ORDER BY date_parsed) AS prev_month_vacancies_per_1000 FROM stage_monthly", "stage_monthly")
SQL["lag_year_monthly"] = with_("SELECT *, lag(total_employment, 12) OVER (PARTITION BY geo, naics ORDER BY date_parsed) AS prev_year_employment FROM stage_employment", "stage_employment")
SQL["lag_year_quarterly"] = with_(f"""
SELECT *, lag({VPK}, 4) OVER w AS prev_year_vacancies_per_1000, lag(job_vacancy_rate, 4) OVER w AS prev_year_vacancy_rate,
       lag(avg_offered_hourly_wage, 4) OVER w AS prev_year_wage
FROM stage_quarterly WINDOW w AS (PARTITION BY geo, naics ORDER BY date_parsed)""", "stage_quarterly")
SQL["rank_masked"] = with_("""
SELECT *, CASE WHEN job_vacancy_rate IS NOT NULL THEN CAST(rank() OVER (PARTITION BY geo, date_parsed ORDER BY job_vacancy_rate DESC NULLS LAST) AS INTEGER) END AS demand_rank
FROM stage_quarterly""", "stage_quarterly")
SQL["sustained_demand_pct"] = with_(f"SELECT {K}, pct_quarters_above_threshold_2yr FROM stage_quarterly LEFT JOIN recent_shares USING (geo, naics)",
                                   "stage_quarterly", "recent_shares")
SQL["interpolate_limited"] = with_(f"SELECT {K}, {VPK}, avg_offered_hourly_wage FROM interpolated", "interpolated")
_W = "OVER (PARTITION BY geo, naics ORDER BY date_parsed)"
SQL["lag_features"] = with_(f"SELECT {K}, {VPK}, " + ", ".join(
    f"lag({VPK}, {k}) {_W} AS {VPK}_lag{k}" for k in range(1, 7)) + " FROM interpolated", "interpolated")
SQL["rolling_features"] = with_(f"SELECT {K}, {VPK}, " + ", ".join(
    "(" + " + ".join(f"lag({VPK}, {k}) {_W}" for k in range(1, n + 1)) + f") / CAST({n} AS DOUBLE) AS {VPK}_roll{n}"
    for n in (2, 3, 6)) + " FROM interpolated", "interpolated")
SQL["fill_both_ends"] = with_("SELECT * FROM filled", "filled")
SQL["series_tail"] = with_(f"""
SELECT geo, naics, last_date, l1 AS {VPK}_lag1, l2 AS {VPK}_lag2, l3 AS {VPK}_lag3, l4 AS {VPK}_lag4,
       l5 AS {VPK}_lag5, l6 AS {VPK}_lag6, (l1 + l2) / CAST(2 AS DOUBLE) AS {VPK}_roll2,
       (l1 + l2 + l3) / CAST(3 AS DOUBLE) AS {VPK}_roll3,
       (l1 + l2 + l3 + l4 + l5 + l6) / CAST(6 AS DOUBLE) AS {VPK}_roll6
FROM (SELECT geo, naics, max(date_parsed) AS last_date,
             max(CASE WHEN pos = 1 THEN v END) AS l1, max(CASE WHEN pos = 2 THEN v END) AS l2,
             max(CASE WHEN pos = 3 THEN v END) AS l3, max(CASE WHEN pos = 4 THEN v END) AS l4,
             max(CASE WHEN pos = 5 THEN v END) AS l5, max(CASE WHEN pos = 6 THEN v END) AS l6
      FROM (SELECT geo, naics, date_parsed, {VPK} AS v,
                   row_number() OVER (PARTITION BY geo, naics ORDER BY date_parsed DESC) AS pos
            FROM interpolated) t WHERE pos <= 6 GROUP BY geo, naics) g""", "interpolated")
SQL["autocorrelation"] = with_(f"""
, d AS (SELECT geo, naics, row_number() OVER (PARTITION BY geo, naics ORDER BY date_parsed) AS pos,
               {VPK} - avg({VPK}) OVER (PARTITION BY geo, naics) AS dv, count(*) OVER (PARTITION BY geo, naics) AS n
        FROM filled WHERE {VPK} IS NOT NULL),
lags AS (SELECT unnest(range(0, 37)) AS k),
num AS (SELECT a.geo, a.naics, k, sum(a.dv * b.dv) AS s FROM d a CROSS JOIN lags
        JOIN d b ON a.geo = b.geo AND a.naics = b.naics AND b.pos = a.pos + k GROUP BY a.geo, a.naics, k),
den AS (SELECT geo, naics, sum(dv * dv) AS s, max(n) AS n FROM d GROUP BY geo, naics)
SELECT num.geo, num.naics, CAST(k AS INTEGER) AS lag,
       round(CASE WHEN k = 0 THEN 1.0 ELSE num.s / den.s END, 9) AS acf
FROM num JOIN den ON num.geo = den.geo AND num.naics = den.naics WHERE k < den.n AND den.s > 0""", "filled")
SQL["seasonal_decompose"] = with_(f"""
, s AS (SELECT geo, naics, date_parsed, {VPK},
               (row_number() OVER w - 1) % 4 AS phase,
               (lag({VPK}, 2) OVER w * CAST(0.5 AS DOUBLE) + lag({VPK}, 1) OVER w + {VPK} + lead({VPK}, 1) OVER w
                + lead({VPK}, 2) OVER w * CAST(0.5 AS DOUBLE)) / CAST(4 AS DOUBLE) AS trend
        FROM filled WINDOW w AS (PARTITION BY geo, naics ORDER BY date_parsed)),
pm AS (SELECT geo, naics, phase, avg({VPK} - trend) AS m FROM s GROUP BY geo, naics, phase),
sea AS (SELECT geo, naics, phase, m - avg(m) OVER (PARTITION BY geo, naics) AS seasonal FROM pm)
SELECT s.geo, s.naics, s.date_parsed, s.{VPK}, round(s.trend, 9) AS trend, round(sea.seasonal, 9) AS seasonal,
       round(s.{VPK} - s.trend - sea.seasonal, 9) AS resid
FROM s LEFT JOIN sea ON s.geo = sea.geo AND s.naics = sea.naics AND s.phase = sea.phase""", "filled")

# ------------------------------------------------------------ 2.6
SQL["sort_limit"] = with_("SELECT * FROM quarterly_curated ORDER BY NAICS, Date_parsed, GEO LIMIT 20", "quarterly_curated")
SQL["topk_per_group"] = with_(f"""
, g AS (SELECT geo FROM mart_quarterly GROUP BY geo HAVING CAST(count_if({VPK} IS NULL) AS BIGINT) / count(*) * 100 > 10),
per AS (SELECT geo, naics, CAST(count_if({VPK} IS NULL) AS BIGINT) AS n_missing FROM mart_quarterly
        WHERE geo IN (SELECT geo FROM g) GROUP BY geo, naics),
periods AS (SELECT geo AS pg, count(DISTINCT date_parsed) AS n_periods FROM mart_quarterly GROUP BY geo)
SELECT geo, naics, n_missing, n_periods, n_missing / n_periods * 100 AS pct_of_periods, rank
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY geo ORDER BY n_missing DESC, naics ASC) AS INTEGER) AS rank
      FROM per) r JOIN periods ON r.geo = periods.pg
WHERE rank <= 5""", "mart_quarterly")

# ------------------------------------------------------------ 2.7
SQL["append_rows"] = with_(f"""
SELECT {K}, {VPK} FROM stage_quarterly
UNION ALL BY NAME SELECT * FROM seasonal_naive""", "stage_quarterly", "seasonal_naive")
SQL["period_difference"] = with_(f"""
SELECT CAST(unnest(generate_series({START}, (SELECT max(date_parsed) FROM mq_holed), INTERVAL 3 MONTH)) AS DATE) AS date_parsed
EXCEPT SELECT date_parsed FROM mq_holed""", "mq_holed")

# ------------------------------------------------------------ 2.8
SQL["check_not_null"] = with_("""
SELECT CAST(count_if(date_parsed IS NULL) AS BIGINT) AS date_parsed, CAST(count_if(geo IS NULL) AS BIGINT) AS geo, CAST(count_if(naics IS NULL) AS BIGINT) AS naics,
       CAST(count_if(year IS NULL) AS BIGINT) AS year, CAST(count_if(foreign_accessibility_tier IS NULL) AS BIGINT) AS foreign_accessibility_tier
FROM mart_quarterly""", "mart_quarterly")
SQL["check_unique_key"] = with_("""
SELECT Year, Date_parsed, GEO, NAICS, count(*) AS count FROM quarterly_curated
GROUP BY Year, Date_parsed, GEO, NAICS HAVING count(*) > 1""", "quarterly_curated")
SQL["check_accepted_range"] = with_(f"SELECT * FROM mart_monthly WHERE {VPK} IS NOT NULL AND NOT ({VPK} >= 0)", "mart_monthly")
SQL["check_accepted_values"] = with_(f"""
SELECT * FROM mart_quarterly WHERE foreign_accessibility_tier IS NOT NULL AND foreign_accessibility_tier NOT IN ({TIERS})""",
                                    "mart_quarterly")
SQL["check_row_reconciliation"] = with_("""
SELECT b.rows_before, a.rows_after, b.rows_before / CAST(4 AS DOUBLE) AS expected_after,
       a.rows_after = b.rows_before / CAST(4 AS DOUBLE) AS ok
FROM (SELECT count(*) AS rows_before FROM quarterly_clean) b, (SELECT count(*) AS rows_after FROM quarterly_curated) a""",
                                       "quarterly_clean", "quarterly_curated")
_NN = ["date_parsed", "geo", "naics", "year", "foreign_accessibility_tier"]
SQL["quality_report"] = with_("SELECT *, failures = 0 AS passed FROM (" + " UNION ALL ".join(
    [f"SELECT 'not_null' AS \"check\", '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS failures FROM mart_quarterly" for c in _NN]
    + [f"SELECT 'accepted_values', 'foreign_accessibility_tier', CAST(count_if(foreign_accessibility_tier IS NOT NULL "
       f"AND foreign_accessibility_tier NOT IN ({TIERS})) AS BIGINT) FROM mart_quarterly",
       "SELECT 'unique_key', 'geo,naics,date_parsed', count(*) FROM (SELECT geo, naics, date_parsed FROM mart_quarterly "
       "GROUP BY geo, naics, date_parsed HAVING count(*) > 1) d"]) + ") r", "mart_quarterly")

# ------------------------------------------------------------ 2.9
for _k, _c in {"clean_employment": "employment_clean", "clean_monthly": "monthly_clean",
               "clean_quarterly": "quarterly_clean", "curate_monthly": "monthly_curated",
               "curate_quarterly": "quarterly_curated", "curate_employment": "employment_curated",
               "stage_monthly": "stage_monthly", "stage_quarterly": "stage_quarterly",
               "stage_employment": "stage_employment", "mart_monthly": "mart_monthly",
               "mart_quarterly": "mart_quarterly", "mart_employment": "mart_employment",
               "ml_features": "features"}.items():
    SQL[_k] = with_(f"SELECT * FROM {_c}", _c)

# ------------------------------------------------------------ 2.10
SQL["seasonal_naive_forecast"] = with_("SELECT * FROM seasonal_naive", "seasonal_naive")

SQL["temporal_split"] = with_(f"""
SELECT {K}, {VPK},
       CASE WHEN date_parsed < DATE '2000-04-01' THEN 'train' ELSE 'test' END AS split,
       CASE WHEN date_parsed < DATE '1999-01-01' THEN 'fit'
            WHEN date_parsed < DATE '2000-04-01' THEN 'validate' END AS tuning
FROM features WHERE {VPK} IS NOT NULL""", "features")


def _metrics(y: str, yhat: str) -> str:
    e = f"({y} - {yhat})"
    return (f"count(*) AS n, round(sqrt(avg({e} * {e})), 9) AS rmse, round(avg(abs({e})), 9) AS mae, "
            f"round(avg(abs({e} / nullif({y}, 0))) * 100, 9) AS mape, "
            f"round(1 - sum({e} * {e}) / (count(*) * var_pop({y})), 9) AS r2")


SQL["forecast_metrics"] = with_(f"""
SELECT split, {_metrics('y', 'yhat')}
FROM (SELECT CASE WHEN date_parsed < DATE '2000-04-01' THEN 'train' ELSE 'test' END AS split,
             {VPK} AS y, {VPK}_lag4 AS yhat FROM features WHERE {VPK} IS NOT NULL) s
WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY split""", "features")


def _naive(target: str) -> str:
    src = " UNION ALL ".join(
        f"SELECT 'naive_lag{k}' AS predictor, {target} AS y, {target}_lag{k} AS yhat FROM features "
        f"WHERE date_parsed >= DATE '2000-04-01' AND {target} IS NOT NULL" for k in (1, 4))
    return (f"SELECT predictor, {_metrics('y', 'yhat')}, '{target}' AS target FROM ({src}) s "
            f"WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY predictor")


SQL["naive_baseline"] = with_(f"{_naive(VPK)} UNION ALL {_naive('avg_offered_hourly_wage')}", "features")

SQL["save_predictions"] = SQL["seasonal_naive_forecast"]
SQL["run_log"] = with_(f"""
, scores AS ({_naive(VPK)} UNION ALL {_naive('avg_offered_hourly_wage')})
SELECT predictor AS run, 'param' AS kind, 'cutoff' AS name, '2000-04-01' AS value FROM scores
UNION ALL SELECT predictor, 'tag', 'target', target FROM scores
UNION ALL SELECT predictor, 'metric', target || '.n', CAST(n AS VARCHAR) FROM scores
UNION ALL SELECT predictor, 'metric', target || '.rmse', CAST(rmse AS VARCHAR) FROM scores
UNION ALL SELECT predictor, 'metric', target || '.mae', CAST(mae AS VARCHAR) FROM scores""", "features")

# ------------------------------------------------------------ 2.1 (round trips)
SQL["save_table"] = SQL["rename_columns"]
SQL["read_raw_csv"] = with_("SELECT * FROM quarterly_clean", "quarterly_clean")
SQL["read_raw_csv_rejects"] = with_("""
SELECT Statistics, count(*) AS n FROM quarterly_long GROUP BY Statistics
UNION ALL
SELECT '1997-01,' || GEO || ',' || count(*) AS Statistics, 1 AS n FROM quarterly_long GROUP BY GEO""", "quarterly_long")
SQL["write_partitioned"] = with_("SELECT * FROM monthly_curated", "monthly_curated")
SQL["read_partitioned_parquet"] = with_("SELECT * FROM quarterly_curated", "quarterly_curated")
SQL["load_threshold_seed"] = with_("""
SELECT geo, lmia_high_wage_threshold, '1/10/2001' AS effective_date, DATE '2001-10-01' AS effective_on,
       'derived' AS source FROM thresholds""", "thresholds")
SQL["materialize"] = with_("SELECT * FROM stage_monthly", "stage_monthly")

# gates on rules that the tables break
SQL["check_unique_key_violations"] = with_("""
SELECT Date, GEO, count(*) AS count FROM quarterly_clean GROUP BY Date, GEO HAVING count(*) > 1""", "quarterly_clean")
SQL["check_accepted_range_violations"] = with_("SELECT * FROM mart_monthly WHERE yoy_change_pct NOT BETWEEN -5 AND 5",
                                               "mart_monthly")
SQL["check_accepted_values_violations"] = with_("""
SELECT * FROM mart_quarterly
WHERE foreign_accessibility_tier NOT IN (SELECT unnest(['"""
    + "', '".join(spec.TIER_LABELS[:5]) + """']))""", "mart_quarterly")
