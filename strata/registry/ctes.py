"""DuckDB oracle building blocks: named CTEs over the driver tables.

Written from the stated semantics of each output column and by other means
than the Spark code (positional self-joins, counted ranks, a tier table), so
the oracle checks semantics rather than echoing the Spark plan.
"""

from __future__ import annotations

AS_OF = "DATE '2001-10-01'"
RECENT_FROM = f"CAST({AS_OF} - INTERVAL 24 MONTH AS DATE)"
START = "DATE '1995-01-01'"
DROP_Q = "DATE '1998-04-01'"
EXCLUDE = "('NATION_8', 'NATION_18', 'NATION_24')"
NAICS_COL = '"North American Industry Classification System (NAICS)"'


def pct_interp(p: float, v: str = "v", i: str = "i", n: str = "n") -> str:
    """Continuous percentile of a ranked group (0-based rank ``i``, size ``n``):
    linear interpolation between the closest ranks, written out."""
    pos = f"(({n} - 1) * CAST({p} AS DOUBLE))"
    lo = f"max(CASE WHEN {i} = floor({pos}) THEN {v} END)"
    hi = f"max(CASE WHEN {i} = ceil({pos}) THEN {v} END)"
    return (f"CASE WHEN max(floor({pos})) = max(ceil({pos})) OR {lo} = {hi} THEN {lo} "
            f"ELSE (max(ceil({pos})) - max({pos})) * {lo} + (max({pos}) - max(floor({pos}))) * {hi} END")


CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTES[name] = (deps, sql)


def with_(body: str, *names: str) -> str:
    """``WITH`` clause holding ``names`` and their dependencies, then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order) + "\n" + body


# ------------------------------------------------------------------ panels
cte("monthly", (), """
SELECT date_parsed, geo, CAST(year(date_parsed) AS INTEGER) AS year, job_vacancies,
       100 * job_vacancies / payroll_employees AS job_vacancy_rate, payroll_employees
FROM (SELECT n_name AS geo, CAST(date_trunc('month', o_orderdate) AS DATE) AS date_parsed,
             CAST(count(*) AS DOUBLE) AS payroll_employees,
             CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS job_vacancies
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      GROUP BY n_name, CAST(date_trunc('month', o_orderdate) AS DATE)) m""")

cte("quarterly", (), """
SELECT date_parsed, geo, CAST(year(date_parsed) AS INTEGER) AS year, naics,
       CASE WHEN NOT (n % 10 < nk % 5) THEN CAST(vac AS DOUBLE) END AS job_vacancies,
       CASE WHEN NOT (n % 10 < nk % 5) THEN 100 * CAST(vac AS DOUBLE) / n END AS job_vacancy_rate,
       CAST(n AS DOUBLE) AS payroll_employees,
       CASE WHEN n % 7 <> 0 THEN CAST(sp AS DOUBLE) / CAST(sq AS DOUBLE) END AS avg_offered_hourly_wage
FROM (SELECT n_name AS geo, n_nationkey AS nk, p_type AS naics,
             CAST(date_trunc('quarter', l_shipdate) AS DATE) AS date_parsed,
             count(*) AS n,
             count(*) FILTER (WHERE l_returnflag = 'R' OR (p_type = 'PROMO' AND l_returnflag = 'N')) AS vac,
             sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS sp,
             sum(CAST(l_quantity AS DECIMAL(18,2))) AS sq
      FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
           JOIN nation ON s_nationkey = n_nationkey
      GROUP BY n_name, n_nationkey, p_type, CAST(date_trunc('quarter', l_shipdate) AS DATE)) q""")

cte("employment_all", (), """
SELECT date_parsed, geo, CAST(year(date_parsed) AS INTEGER) AS year,
       CASE WHEN GROUPING(naics) = 1 THEN 'ALL' ELSE naics END AS naics,
       CAST(sum(qty) AS DOUBLE) AS total_employment,
       CAST(sum(CASE WHEN l_returnflag = 'A' THEN qty END) AS DOUBLE) AS salaried_employment
FROM (SELECT n_name AS geo, CAST(date_trunc('month', o_orderdate) AS DATE) AS date_parsed,
             p_type AS naics, l_returnflag, CAST(l_quantity AS DECIMAL(18,2)) AS qty
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
           JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey) j
GROUP BY GROUPING SETS ((geo, date_parsed, naics), (geo, date_parsed))""")

cte("employment", ("employment_all",), """
SELECT date_parsed, geo, year, naics, total_employment FROM employment_all""")

cte("thresholds", ("quarterly",), f"""
SELECT geo, {pct_interp(0.5)} * CAST(1.05 AS DOUBLE) AS lmia_high_wage_threshold
FROM (SELECT geo, avg_offered_hourly_wage AS v,
             row_number() OVER (PARTITION BY geo ORDER BY avg_offered_hourly_wage) - 1 AS i,
             count(*) OVER (PARTITION BY geo) AS n
      FROM quarterly WHERE avg_offered_hourly_wage IS NOT NULL) r
GROUP BY geo""")

# ------------------------------------------------------------ raw long forms
cte("monthly_long", ("monthly",), """
SELECT strftime(date_parsed, '%Y-%m') AS REF_DATE, geo AS GEO, 'Job vacancies' AS Statistics,
       coalesce(CAST(job_vacancies AS VARCHAR), '') AS VALUE FROM monthly
UNION ALL SELECT strftime(date_parsed, '%Y-%m'), geo, 'Job vacancy rate',
       coalesce(CAST(job_vacancy_rate AS VARCHAR), '') FROM monthly
UNION ALL SELECT strftime(date_parsed, '%Y-%m'), geo, 'Payroll employees',
       coalesce(CAST(payroll_employees AS VARCHAR), '') FROM monthly""")

cte("quarterly_long", ("quarterly",), f"""
SELECT strftime(date_parsed, '%Y-%m') AS REF_DATE, geo AS GEO, naics AS {NAICS_COL},
       'Average offered hourly wage' AS Statistics,
       coalesce(CAST(avg_offered_hourly_wage AS VARCHAR), '') AS VALUE FROM quarterly
UNION ALL SELECT strftime(date_parsed, '%Y-%m'), geo, naics, 'Job vacancies',
       coalesce(CAST(job_vacancies AS VARCHAR), '') FROM quarterly
UNION ALL SELECT strftime(date_parsed, '%Y-%m'), geo, naics, 'Job vacancy rate',
       coalesce(CAST(job_vacancy_rate AS VARCHAR), '') FROM quarterly
UNION ALL SELECT strftime(date_parsed, '%Y-%m'), geo, naics, 'Payroll employees',
       coalesce(CAST(payroll_employees AS VARCHAR), '') FROM quarterly""")

cte("employment_long", ("employment_all",), f"""
SELECT strftime(date_parsed, '%Y-%m') AS REF_DATE, geo AS GEO, naics AS {NAICS_COL},
       'All employees' AS "Type of employee",
       coalesce(CAST(total_employment AS VARCHAR), '') AS VALUE FROM employment_all
UNION ALL SELECT strftime(date_parsed, '%Y-%m'), geo, naics, 'Salaried employees',
       coalesce(CAST(salaried_employment AS VARCHAR), '') FROM employment_all""")

# ------------------------------------------------------------------ cleaning
cte("monthly_clean", ("monthly_long",), """
SELECT trim(REF_DATE) AS Date, trim(GEO) AS GEO, trim(Statistics) AS Statistics,
       TRY_CAST(VALUE AS DOUBLE) AS VALUE,
       CAST(year(CAST(strptime(trim(REF_DATE), '%Y-%m') AS DATE)) AS INTEGER) AS Year
FROM monthly_long""")

cte("quarterly_clean", ("quarterly_long",), f"""
SELECT trim(REF_DATE) AS Date, trim(GEO) AS GEO, trim({NAICS_COL}) AS NAICS,
       trim(Statistics) AS Statistics, TRY_CAST(VALUE AS DOUBLE) AS VALUE,
       CAST(year(CAST(strptime(trim(REF_DATE), '%Y-%m') AS DATE)) AS INTEGER) AS Year
FROM quarterly_long""")

cte("employment_clean", ("employment_long",), f"""
SELECT trim(REF_DATE) AS Date, trim(GEO) AS GEO, trim({NAICS_COL}) AS NAICS,
       TRY_CAST(VALUE AS DOUBLE) AS VALUE,
       CAST(year(CAST(strptime(trim(REF_DATE), '%Y-%m') AS DATE)) AS INTEGER) AS Year
FROM employment_long
WHERE "Type of employee" = 'All employees' AND trim(REF_DATE) >= '1996-01'""")

cte("monthly_curated", ("monthly_clean",), """
SELECT Year, CAST(strptime(Date, '%Y-%m') AS DATE) AS Date_parsed, GEO,
       sum(VALUE) FILTER (WHERE Statistics = 'Job vacancies') AS "Job vacancies",
       sum(VALUE) FILTER (WHERE Statistics = 'Job vacancy rate') AS "Job vacancy rate",
       sum(VALUE) FILTER (WHERE Statistics = 'Payroll employees') AS "Payroll employees"
FROM monthly_clean GROUP BY Year, CAST(strptime(Date, '%Y-%m') AS DATE), GEO""")

cte("quarterly_curated", ("quarterly_clean",), """
SELECT Year, CAST(strptime(Date, '%Y-%m') AS DATE) AS Date_parsed, GEO, NAICS,
       sum(VALUE) FILTER (WHERE Statistics = 'Average offered hourly wage') AS "Average offered hourly wage",
       sum(VALUE) FILTER (WHERE Statistics = 'Job vacancies') AS "Job vacancies",
       sum(VALUE) FILTER (WHERE Statistics = 'Job vacancy rate') AS "Job vacancy rate",
       sum(VALUE) FILTER (WHERE Statistics = 'Payroll employees') AS "Payroll employees"
FROM quarterly_clean GROUP BY Year, CAST(strptime(Date, '%Y-%m') AS DATE), GEO, NAICS""")

cte("employment_curated", ("employment_clean",), """
SELECT Year, CAST(strptime(Date, '%Y-%m') AS DATE) AS Date_parsed, NAICS, GEO,
       VALUE AS "Total Employment" FROM employment_clean""")

# ------------------------------------------------------------------- staging
cte("stage_monthly", ("monthly",), """
SELECT date_parsed, geo, year, job_vacancies, job_vacancy_rate, payroll_employees,
       (job_vacancies / nullif(payroll_employees, 0)) * 1000 AS vacancies_per_1000
FROM monthly WHERE date_parsed IS NOT NULL""")

cte("stage_quarterly", ("quarterly",), """
SELECT date_parsed, geo, year, naics, job_vacancies, job_vacancy_rate, payroll_employees,
       avg_offered_hourly_wage,
       (job_vacancies / nullif(payroll_employees, 0)) * 1000 AS vacancies_per_1000
FROM quarterly WHERE date_parsed IS NOT NULL""")

cte("stage_employment", ("employment",), """
SELECT date_parsed, geo, year, naics, total_employment FROM employment WHERE date_parsed IS NOT NULL""")

# --------------------------------------------------------------------- marts
# Written from the stated semantics: a prior value is the row a fixed number of
# positions earlier in its series, a rank is one more than the number of larger
# values, a sustained share is a count over the recent rows alone, and the tier
# is a table of two states. No window function besides the row position.
def prior(table: str, keys: tuple[str, ...], back: int, columns: dict[str, str]) -> str:
    """``table`` (with ``pos``) beside the row ``back`` positions earlier: ``{new name: column}``."""
    same = " AND ".join(f"earlier.{k} = now.{k}" for k in keys)
    picked = ", ".join(f"earlier.{c} AS {name}" for name, c in columns.items())
    return (f"SELECT now.*, {picked} FROM {table} now "
            f"LEFT JOIN {table} earlier ON {same} AND earlier.pos + {back} = now.pos")


def percent(part: str, whole: str, digits: int = 2) -> str:
    return f"CASE WHEN {whole} <> 0 THEN round({part} / {whole} * 100, {digits}) END"


def larger_in_group(table: str, group: tuple[str, ...], value: str, out: str) -> str:
    """Rank of every known ``value``: one more than the larger ones of its group."""
    same = " AND ".join(f"other.{g} = own.{g}" for g in group)
    return (f"SELECT own.geo, own.naics, own.date_parsed, CAST(1 + count(other.{value}) AS INTEGER) AS {out} "
            f"FROM {table} own LEFT JOIN {table} other ON {same} AND other.{value} > own.{value} "
            f"WHERE own.{value} IS NOT NULL GROUP BY ALL")


for _name, _keys in (("monthly", "geo"), ("quarterly", "geo, naics"), ("employment", "geo, naics")):
    cte(f"{_name}_positions", (f"stage_{_name}",), f"""
SELECT *, row_number() OVER (PARTITION BY {_keys} ORDER BY date_parsed) AS pos FROM stage_{_name}""")

cte("monthly_year_ago", ("monthly_positions",),
    prior("monthly_positions", ("geo",), 12, {"prev_year_vacancies_per_1000": "vacancies_per_1000"}))

cte("monthly_changes", ("monthly_year_ago",), f"""
SELECT * EXCLUDE (pos, month_ago),
       {percent('(vacancies_per_1000 - prev_year_vacancies_per_1000)', 'prev_year_vacancies_per_1000')} AS yoy_change_pct,
       {percent('(vacancies_per_1000 - month_ago)', 'month_ago')} AS mom_change_pct
FROM ({prior("monthly_year_ago", ("geo",), 1, {"month_ago": "vacancies_per_1000"})}) both_priors""")

cte("geo_years", ("stage_monthly",), """
SELECT geo, year, round(avg(CAST(vacancies_per_1000 AS DECIMAL(30,12))), 2) AS avg_vacancies_per_1000,
       round(avg(CAST(job_vacancy_rate AS DECIMAL(30,12))), 2) AS avg_job_vacancy_rate,
       sum(job_vacancies) AS total_job_vacancies
FROM stage_monthly GROUP BY geo, year""")

cte("mart_monthly", ("monthly_changes", "geo_years"),
    "SELECT * FROM monthly_changes LEFT JOIN geo_years USING (geo, year)")

cte("rate_quantiles", ("stage_quarterly",), f"""
SELECT geo, year, {pct_interp(0.5)} AS p50_vacancy_rate, {pct_interp(0.75)} AS p75_vacancy_rate
FROM (SELECT geo, year, job_vacancy_rate AS v,
             row_number() OVER (PARTITION BY geo, year ORDER BY job_vacancy_rate) - 1 AS i,
             count(*) OVER (PARTITION BY geo, year) AS n
      FROM stage_quarterly WHERE job_vacancy_rate IS NOT NULL) r
GROUP BY geo, year""")

cte("quarterly_year_ago", ("quarterly_positions",),
    prior("quarterly_positions", ("geo", "naics"), 4, {
        "prev_year_vacancies_per_1000": "vacancies_per_1000",
        "prev_year_vacancy_rate": "job_vacancy_rate",
        "prev_year_wage": "avg_offered_hourly_wage"}))

cte("demand_places", ("stage_quarterly",),
    larger_in_group("stage_quarterly", ("geo", "date_parsed"), "job_vacancy_rate", "demand_rank"))

cte("recent_shares", ("stage_quarterly", "rate_quantiles"), f"""
SELECT geo, naics,
       round(count_if(job_vacancy_rate >= p75_vacancy_rate) / count(*) * 100, 1) AS pct_quarters_above_threshold_2yr
FROM stage_quarterly LEFT JOIN rate_quantiles USING (geo, year)
WHERE date_parsed >= {RECENT_FROM}
GROUP BY geo, naics""")

# wage against the threshold × demand against the year's quantiles → tier
TIER_TABLE = {
    ("unknown", "unknown"): "Insufficient Data",
    ("unknown", "sustained"): "High Demand and Sustained, No Wage Data",
    ("unknown", "upper half"): "Above Average Demand, No Wage Data",
    ("unknown", "lower half"): "Low",
    ("reached", "unknown"): "Wage Eligible, No Vacancy Data",
    ("reached", "sustained"): "HIGH, Wage Eligible, High Demand and Sustain",
    ("reached", "upper half"): "Wage Eligible, High Demand",
    ("reached", "lower half"): "Wage Eligible",
    ("below", "unknown"): "Low",
    ("below", "sustained"): "High Demand and Sustained, Below Wage Threshold",
    ("below", "upper half"): "Above Average Demand, Below Wage Threshold",
    ("below", "lower half"): "Low",
}

cte("tier_table", (), "SELECT * FROM (VALUES "
    + ", ".join(f"('{w}', '{d}', '{label}')" for (w, d), label in TIER_TABLE.items())
    + ") t(wage_state, demand_state, foreign_accessibility_tier)")

cte("quarterly_states", ("quarterly_year_ago", "demand_places", "rate_quantiles", "recent_shares", "thresholds"), f"""
SELECT * EXCLUDE (pos),
       {percent('(vacancies_per_1000 - prev_year_vacancies_per_1000)', 'prev_year_vacancies_per_1000')}
         AS vacancy_rate_yoy_change_pct,
       {percent('(avg_offered_hourly_wage - prev_year_wage)', 'prev_year_wage')} AS wage_yoy_change_pct,
       CASE avg_offered_hourly_wage >= lmia_high_wage_threshold WHEN TRUE THEN 'reached'
            ELSE if(avg_offered_hourly_wage IS NULL, 'unknown', 'below') END AS wage_state,
       if(job_vacancy_rate IS NULL, 'unknown',
          if(job_vacancy_rate >= p75_vacancy_rate AND pct_quarters_above_threshold_2yr >= 75, 'sustained',
             if(job_vacancy_rate >= p50_vacancy_rate, 'upper half', 'lower half'))) AS demand_state
FROM quarterly_year_ago
LEFT JOIN demand_places USING (geo, naics, date_parsed)
LEFT JOIN rate_quantiles USING (geo, year)
LEFT JOIN recent_shares USING (geo, naics)
LEFT JOIN thresholds USING (geo)""")

cte("mart_quarterly", ("quarterly_states", "tier_table"), """
SELECT * EXCLUDE (wage_state, demand_state)
FROM quarterly_states JOIN tier_table USING (wage_state, demand_state)""")

cte("digital_sums", ("stage_employment",), """
SELECT date_parsed, geo, year,
       coalesce(sum(total_employment) FILTER (naics IN ('ECONOMY', 'PROMO')), 0) AS total_data_digital_employment,
       coalesce(sum(total_employment) FILTER (naics = 'ALL'), 0) AS total_provincial_employment
FROM stage_employment GROUP BY date_parsed, geo, year""")

cte("digital_shares", ("digital_sums",), f"""
SELECT *, {percent('total_data_digital_employment', 'total_provincial_employment')}
          AS data_digital_employment_concentration_pct FROM digital_sums""")

cte("employment_growth", ("employment_positions",), f"""
SELECT * EXCLUDE (pos),
       {percent('(total_employment - prev_year_employment)', 'prev_year_employment')} AS employment_yoy_growth_pct
FROM ({prior("employment_positions", ("geo", "naics"), 12, {"prev_year_employment": "total_employment"})}) year_ago""")

cte("growth_places", ("employment_growth",),
    larger_in_group("employment_growth", ("geo", "year"), "employment_yoy_growth_pct", "growth_rank"))

cte("mart_employment", ("employment_growth", "growth_places", "digital_shares"), """
SELECT * FROM employment_growth
LEFT JOIN growth_places USING (geo, naics, date_parsed)
LEFT JOIN digital_shares USING (geo, year, date_parsed)""")

# -------------------------------------------------------------- gaps / ML
cte("mq_holed", ("mart_quarterly",), f"""
SELECT * FROM mart_quarterly WHERE date_parsed <> {DROP_Q}""")

cte("missing_q", ("mq_holed",), f"""
SELECT CAST(unnest(generate_series({START}, (SELECT max(date_parsed) FROM mq_holed), INTERVAL 3 MONTH)) AS DATE) AS date_parsed
EXCEPT SELECT date_parsed FROM mq_holed""")

cte("completed", ("mq_holed", "missing_q"), """
SELECT * FROM mq_holed
UNION ALL BY NAME
SELECT g.geo, n.naics, m.date_parsed, CAST(year(m.date_parsed) AS INTEGER) AS year
FROM (SELECT DISTINCT geo FROM mq_holed) g, (SELECT DISTINCT naics FROM mq_holed) n, missing_q m""")

cte("excluded", ("completed",), f"""
SELECT * FROM completed WHERE geo IS NULL OR geo NOT IN {EXCLUDE}""")

cte("gap_profile", ("excluded",), """
WITH flagged AS (
  SELECT geo, naics, date_parsed, vacancies_per_1000 IS NULL AS is_null,
         row_number() OVER (PARTITION BY geo, naics ORDER BY date_parsed)
         - row_number() OVER (PARTITION BY geo, naics, vacancies_per_1000 IS NULL ORDER BY date_parsed) AS grp
  FROM excluded),
runs AS (SELECT geo, naics, count(*) AS run_len FROM flagged WHERE is_null GROUP BY geo, naics, grp)
SELECT s.geo, s.naics, s.n_rows, s.n_null, coalesce(r.max_run, 0) AS max_null_run,
       s.n_null / s.n_rows AS null_share
FROM (SELECT geo, naics, count(*) AS n_rows, count(*) FILTER (WHERE is_null) AS n_null
      FROM flagged GROUP BY geo, naics) s
LEFT JOIN (SELECT geo, naics, max(run_len) AS max_run FROM runs GROUP BY geo, naics) r
  ON s.geo = r.geo AND s.naics = r.naics""")

cte("unreliable", ("gap_profile",), """
SELECT geo, naics FROM gap_profile WHERE null_share > 0.5 OR max_null_run >= 4""")

cte("gap_cleaned", ("excluded", "unreliable"), """
SELECT e.* FROM excluded e
WHERE NOT EXISTS (SELECT 1 FROM unreliable u WHERE u.geo = e.geo AND u.naics = e.naics)""")

_NB = ("PARTITION BY geo, naics ORDER BY date_parsed ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW",
       "PARTITION BY geo, naics ORDER BY date_parsed ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING")


def _interp(v: str, limit: int | None) -> str:
    k = f"least(rn - pr_{v}, {limit})" if limit is not None else f"(rn - pr_{v})"
    tail = f"pv_{v}" if limit is not None else f"pv_{v}"
    return (f"CASE WHEN {v} IS NOT NULL THEN {v} WHEN pv_{v} IS NULL THEN "
            + ("NULL" if limit is not None else f"nv_{v}")
            + f" WHEN nv_{v} IS NULL THEN {tail} "
            f"ELSE pv_{v} + (nv_{v} - pv_{v}) * {k} / (nr_{v} - pr_{v}) END")


def _neighbour_cols(v: str) -> str:
    return (f"last_value({v} IGNORE NULLS) OVER ({_NB[0]}) AS pv_{v}, "
            f"last_value(CASE WHEN {v} IS NOT NULL THEN rn END IGNORE NULLS) OVER ({_NB[0]}) AS pr_{v}, "
            f"first_value({v} IGNORE NULLS) OVER ({_NB[1]}) AS nv_{v}, "
            f"first_value(CASE WHEN {v} IS NOT NULL THEN rn END IGNORE NULLS) OVER ({_NB[1]}) AS nr_{v}")


cte("interpolated", ("gap_cleaned",), f"""
SELECT * EXCLUDE (rn, pv_vacancies_per_1000, pr_vacancies_per_1000, nv_vacancies_per_1000, nr_vacancies_per_1000,
                  pv_avg_offered_hourly_wage, pr_avg_offered_hourly_wage, nv_avg_offered_hourly_wage,
                  nr_avg_offered_hourly_wage)
       REPLACE ({_interp('vacancies_per_1000', 3)} AS vacancies_per_1000,
                {_interp('avg_offered_hourly_wage', 3)} AS avg_offered_hourly_wage)
FROM (SELECT *, {_neighbour_cols('vacancies_per_1000')}, {_neighbour_cols('avg_offered_hourly_wage')}
      FROM (SELECT *, row_number() OVER (PARTITION BY geo, naics ORDER BY date_parsed) AS rn
            FROM gap_cleaned) r) n""")


def _lags(v: str) -> str:
    w = "OVER (PARTITION BY geo, naics ORDER BY date_parsed)"
    lags = [f"lag({v}, {k}) {w} AS {v}_lag{k}" for k in range(1, 7)]
    rolls = []
    for n in (2, 3, 6):
        s = " + ".join(f"lag({v}, {k}) {w}" for k in range(1, n + 1))
        rolls.append(f"({s}) / CAST({n} AS DOUBLE) AS {v}_roll{n}")
    return ", ".join(lags + rolls)


cte("features", ("interpolated",), f"""
SELECT f.*, CAST(month(date_parsed) AS INTEGER) AS quarter,
       sin(2 * pi() * month(date_parsed) / 4) AS quarter_sin,
       cos(2 * pi() * month(date_parsed) / 4) AS quarter_cos,
       CASE WHEN date_parsed BETWEEN DATE '1997-04-01' AND DATE '1998-07-01' THEN 1 ELSE 0 END AS is_covid,
       CASE WHEN date_parsed BETWEEN DATE '1998-10-01' AND DATE '2000-01-01' THEN 1 ELSE 0 END AS is_post_covid_boom,
       CAST(ge.code AS INTEGER) AS geo_encoded, CAST(ne.code AS INTEGER) AS naics_encoded
FROM (SELECT *, {_lags('vacancies_per_1000')}, {_lags('avg_offered_hourly_wage')} FROM interpolated) f
LEFT JOIN (SELECT geo AS g, row_number() OVER (ORDER BY geo) - 1 AS code
           FROM (SELECT DISTINCT geo FROM interpolated WHERE geo IS NOT NULL)) ge ON f.geo = ge.g
LEFT JOIN (SELECT naics AS nn, row_number() OVER (ORDER BY naics) - 1 AS code
           FROM (SELECT DISTINCT naics FROM interpolated WHERE naics IS NOT NULL)) ne ON f.naics = ne.nn""")
