"""Staging models: projection, null-date filter, rate per 1,000."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.expressions import rate_per


def stage_monthly(cat: DataFrame) -> DataFrame:
    return (cat.filter(F.col("date_parsed").isNotNull())
               .select("date_parsed", "geo", "year", "job_vacancies", "job_vacancy_rate",
                       "payroll_employees",
                       rate_per("job_vacancies", "payroll_employees").alias("vacancies_per_1000")))


def stage_quarterly(cat: DataFrame) -> DataFrame:
    return (cat.filter(F.col("date_parsed").isNotNull())
               .select("date_parsed", "geo", "year", "naics", "job_vacancies", "job_vacancy_rate",
                       "payroll_employees", "avg_offered_hourly_wage",
                       rate_per("job_vacancies", "payroll_employees").alias("vacancies_per_1000")))


def stage_employment(cat: DataFrame) -> DataFrame:
    return (cat.filter(F.col("date_parsed").isNotNull())
               .select("date_parsed", "geo", "year", "naics", "total_employment"))
