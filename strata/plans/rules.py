"""Declared data tests of the staging and mart models, as quality rules.

The 36 declarations (not-null, accepted range ≥ 0 inclusive, accepted
values) per model, plus the unique critical keys the export gates assert.
``quality_report(df, declared(model))`` evaluates a model's rules in one pass.
"""

from __future__ import annotations

from strata import spec
from strata.operators.quality import AcceptedRange, AcceptedValues, NotNull, UniqueKey

NOT_NULL = {
    "stage_monthly": ["date_parsed", "geo", "year"],
    "stage_quarterly": ["date_parsed", "geo", "naics", "year"],
    "stage_employment": ["date_parsed", "geo", "naics", "year"],
    "mart_monthly": ["date_parsed", "geo", "year"],
    "mart_quarterly": ["date_parsed", "geo", "naics", "year", "foreign_accessibility_tier"],
    "mart_employment": ["date_parsed", "geo", "naics", "year"],
}
NON_NEGATIVE = {
    "stage_monthly": ["job_vacancies", "job_vacancy_rate", "payroll_employees"],
    "stage_quarterly": ["job_vacancies", "job_vacancy_rate", "avg_offered_hourly_wage", "payroll_employees"],
    "stage_employment": ["total_employment"],
    "mart_monthly": ["vacancies_per_1000", "total_job_vacancies"],
    "mart_quarterly": [],
    "mart_employment": ["total_employment", "data_digital_employment_concentration_pct"],
}
ACCEPTED = {"mart_quarterly": {"foreign_accessibility_tier": tuple(spec.TIER_LABELS)}}
UNIQUE = {
    "stage_monthly": ("geo", "date_parsed"), "mart_monthly": ("geo", "date_parsed"),
    "stage_quarterly": ("geo", "naics", "date_parsed"), "mart_quarterly": ("geo", "naics", "date_parsed"),
    "stage_employment": ("geo", "naics", "date_parsed"), "mart_employment": ("geo", "naics", "date_parsed"),
}


def declared(model: str) -> list:
    """The declared tests of one model."""
    return ([NotNull(c) for c in NOT_NULL[model]]
            + [AcceptedRange(c, 0, None, True) for c in NON_NEGATIVE[model]]
            + [AcceptedValues(c, v) for c, v in ACCEPTED.get(model, {}).items()])


def with_unique_key(model: str) -> list:
    """Declared tests plus the model's unique critical key."""
    return declared(model) + [UniqueKey(UNIQUE[model])]
