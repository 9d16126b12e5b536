"""Names, label lists and parameters of the labour-panel pipeline.

Operators elsewhere take column names as arguments; the domain vocabulary
lives here (and in ``plans``) only.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values that must equal the source data's vocabulary and the original
# pipeline's choices (labels, statistic names, rename targets, feature lists,
# published hyper-parameters). Stated plainly, in natural order.
# --------------------------------------------------------------------------

NAICS_LABEL_COL = "North American Industry Classification System (NAICS)"
EMPLOYEE_TYPE_COL = "Type of employee"
ALL_EMPLOYEES = "All employees"

STAT_VACANCIES = "Job vacancies"
STAT_RATE = "Job vacancy rate"
STAT_PAYROLL = "Payroll employees"
STAT_WAGE = "Average offered hourly wage"
STAT_EMPLOYMENT = "Total Employment"

MONTHLY_STATISTICS = [STAT_VACANCIES, STAT_RATE, STAT_PAYROLL]
QUARTERLY_STATISTICS = [STAT_WAGE, STAT_VACANCIES, STAT_RATE, STAT_PAYROLL]

# curated (label) names -> catalog (snake_case) names
CURATED_RENAME = {
    STAT_WAGE: "avg_offered_hourly_wage",
    STAT_VACANCIES: "job_vacancies",
    STAT_RATE: "job_vacancy_rate",
    STAT_PAYROLL: "payroll_employees",
    STAT_EMPLOYMENT: "total_employment",
    "GEO": "geo",
    "Year": "year",
    "NAICS": "naics",
    "Date_parsed": "date_parsed",
}

# raw CSV headers (every column read as string)
RAW_MONTHLY_COLUMNS = [
    "REF_DATE", "GEO", "DGUID", "Statistics", "UOM", "UOM_ID", "SCALAR_FACTOR",
    "SCALAR_ID", "VECTOR", "COORDINATE", "VALUE", "STATUS", "SYMBOL",
    "TERMINATED", "DECIMALS",
]
RAW_QUARTERLY_COLUMNS = [
    "REF_DATE", "GEO", "DGUID", NAICS_LABEL_COL, "Statistics", "UOM", "UOM_ID",
    "SCALAR_FACTOR", "SCALAR_ID", "VECTOR", "COORDINATE", "VALUE", "STATUS",
    "SYMBOL", "TERMINATED", "DECIMALS",
]
RAW_EMPLOYMENT_COLUMNS = [
    "REF_DATE", "GEO", "DGUID", EMPLOYEE_TYPE_COL, NAICS_LABEL_COL, "UOM",
    "UOM_ID", "SCALAR_FACTOR", "SCALAR_ID", "VECTOR", "COORDINATE", "VALUE",
    "STATUS", "SYMBOL", "TERMINATED", "DECIMALS",
]

# foreign-accessibility tier labels, in ladder order (last = default)
TIER_LABELS = [
    "Insufficient Data",
    "High Demand and Sustained, No Wage Data",
    "Above Average Demand, No Wage Data",
    "Wage Eligible, No Vacancy Data",
    "HIGH, Wage Eligible, High Demand and Sustain",
    "Wage Eligible, High Demand",
    "Wage Eligible",
    "High Demand and Sustained, Below Wage Threshold",
    "Above Average Demand, Below Wage Threshold",
    "Low",
]
SUSTAINED_PCT_MIN = 75

# data/digital sub-sectors and the all-industry aggregate of the source data
DIGITAL_NAICS = [
    "Computer systems design and related services [5415]",
    "Scientific research and development services [5417]",
    "Data processing, hosting, and related services [5182]",
    "Software publishers [5112]",
]
AGGREGATE_NAICS = "Industrial aggregate including unclassified businesses [00-91N]"

EXCLUDE_GEOS = ["Northwest Territories", "Yukon", "Nunavut"]

# gap rules for dropping series (vacancies)
UNRELIABLE_NULL_PCT = 0.5
UNRELIABLE_NULL_RUN = 4
INTERPOLATION_LIMIT = 3
ANOMALY_Z = 3.5
ANOMALY_MIN_ROWS = 12

VAC = "vacancies_per_1000"
WAGE = "avg_offered_hourly_wage"
LAGS = [1, 2, 3, 4, 5, 6]
ROLLS = [2, 3, 6]

# chosen feature sets per target, after the original ablation study
FEATURES = {
    VAC: [
        "vacancies_per_1000_lag3", "vacancies_per_1000_lag4",
        "vacancies_per_1000_lag5", "vacancies_per_1000_lag6",
        "avg_offered_hourly_wage_lag4",
        "vacancies_per_1000_roll2", "vacancies_per_1000_roll3",
        "quarter_cos", "is_covid", "is_post_covid_boom", "naics_encoded",
    ],
    WAGE: [
        "avg_offered_hourly_wage_lag1", "avg_offered_hourly_wage_lag2",
        "avg_offered_hourly_wage_lag3", "avg_offered_hourly_wage_lag4",
        "avg_offered_hourly_wage_lag6", "quarter_cos",
    ],
}

# published tuned parameters of the original boosted-tree models
PUBLISHED_PARAMS = {
    VAC: {"eta": 0.08954145715868994, "max_depth": 4, "subsample": 0.5539515265231724,
          "colsample_bytree": 0.8506922606263637, "reg_alpha": 7.567731365052209e-05,
          "reg_lambda": 1.8828372741926294, "n_estimators": 427},
    WAGE: {"eta": 0.014328208515775934, "max_depth": 3, "subsample": 0.528896845567887,
           "colsample_bytree": 0.5829240994697549, "reg_alpha": 13.268668727149025,
           "reg_lambda": 0.20524685212400157, "n_estimators": 500},
}

PUBLISHED_SEARCH_TRIALS = 350
PERMUTATION_REPEATS = 30

# hyper-parameter search ranges of the original tuning
SEARCH_SPACE = {
    "eta": (0.005, 0.3),
    "max_depth": (3, 6),
    "subsample": (0.5, 1.0),
    "colsample_bytree": (0.5, 1.0),
    "reg_alpha": (1e-8, 20.0, "log"),
    "reg_lambda": (1e-8, 10.0, "log"),
    "n_estimators": (100, 500),
}

FORECAST_HORIZON = 4
FORECAST_STEP_MONTHS = 3
QUARTER_PERIOD = 4
RECENT_MONTHS = 24
ACF_LAGS = 36

# The event windows that flag quarters of the published models.
EVENT_WINDOWS = {
    "is_covid": ("2020-04-01", "2021-07-01"),
    "is_post_covid_boom": ("2021-10-01", "2023-01-01"),
}

# --------------------------------------------------------------------------
# Fixture parameters for panels derived from the driver tables (FIXTURES.md)
# --------------------------------------------------------------------------
FIXTURE_AS_OF = "2001-10-01"
FIXTURE_PANEL_START = "1995-01-01"
FIXTURE_SPLIT_CUTOFF = "2000-04-01"
FIXTURE_VAL_CUTOFF = "1999-01-01"
FIXTURE_FLAG_WINDOWS = {
    "is_covid": ("1997-04-01", "1998-07-01"),
    "is_post_covid_boom": ("1998-10-01", "2000-01-01"),
}
FIXTURE_DROP_QUARTER = "1998-04-01"
FIXTURE_SINCE = "1996-01"
FIXTURE_DIGITAL = ["ECONOMY", "PROMO"]
FIXTURE_AGGREGATE = "ALL"
FIXTURE_EXCLUDE_GEOS = ["NATION_8", "NATION_18", "NATION_24"]
FIXTURE_THRESHOLD_FACTOR = 1.05
FIXTURE_SECOND_EMPLOYEE_TYPE = "Salaried employees"


def string_schema(columns: list[str]) -> T.StructType:
    """All-string schema for a raw CSV header (no inference)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


RAW_MONTHLY_SCHEMA = string_schema(RAW_MONTHLY_COLUMNS)
RAW_QUARTERLY_SCHEMA = string_schema(RAW_QUARTERLY_COLUMNS)
RAW_EMPLOYMENT_SCHEMA = string_schema(RAW_EMPLOYMENT_COLUMNS)

THRESHOLD_SCHEMA = T.StructType([
    T.StructField("geo", T.StringType(), True),
    T.StructField("lmia_high_wage_threshold", T.DoubleType(), True),
    T.StructField("effective_date", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
])
