"""Mart tables: monthly labour metrics, quarterly sector
metrics with the accessibility tier, sector employment trends.

Plan shape. Group statistics that the original SQL computed in a separate
aggregate and joined back (yearly averages, yearly percentiles, concentration)
are window aggregates over the group here: same values, no join. Windows are
declared so that those sharing a partitioning are adjacent — each mart costs
one exchange per distinct partitioning. The quarterly and employment windows
partition by a full group key (never a lone ``geo``), so a geo holding a third
of all rows is still spread over many tasks; the monthly panel has one row per
geo and month, so there ``geo`` is the series key.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata import spec
from strata.functions import expressions as X
from strata.operators.joins import lookup_dimension
from strata.operators.windows import sustained_demand_pct


def mart_monthly(stage: DataFrame) -> DataFrame:
    """MoM % and YoY % of vacancies per 1,000 plus yearly averages per geo.

    Both lags share one window (the original computed them in two CTEs and
    re-joined on geo + date). Output keeps the prior-year level but not the
    prior-month level.
    """
    w = Window.partitionBy("geo").orderBy("date_parsed")
    wy = Window.partitionBy("geo", "year")
    v = F.col("vacancies_per_1000")
    d = stage.withColumns({
        "prev_year_vacancies_per_1000": F.lag(v, 12).over(w),
        "__prev_month": F.lag(v, 1).over(w),
    })
    return d.select(
        "date_parsed", "geo", "year", "job_vacancies", "job_vacancy_rate", "payroll_employees",
        "vacancies_per_1000", "prev_year_vacancies_per_1000",
        X.pct_change(v, "prev_year_vacancies_per_1000").alias("yoy_change_pct"),
        X.pct_change(v, "__prev_month").alias("mom_change_pct"),
        X.rounded_mean(v, 2, wy).alias("avg_vacancies_per_1000"),
        X.rounded_mean("job_vacancy_rate", 2, wy).alias("avg_job_vacancy_rate"),
        F.sum("job_vacancies").over(wy).alias("total_job_vacancies"))


def tier_rules() -> list[tuple[str, object]]:
    """The accessibility ladder as ordered (label, condition) pairs."""
    wage, rate = F.col("avg_offered_hourly_wage"), F.col("job_vacancy_rate")
    p50, p75 = F.col("p50_vacancy_rate"), F.col("p75_vacancy_rate")
    sus = F.col("pct_quarters_above_threshold_2yr") >= F.lit(spec.SUSTAINED_PCT_MIN)
    thr = F.col("lmia_high_wage_threshold")
    L = spec.TIER_LABELS
    return [
        (L[0], wage.isNull() & rate.isNull()),
        (L[1], wage.isNull() & (rate >= p75) & sus),
        (L[2], wage.isNull() & (rate >= p50)),
        (L[3], rate.isNull() & (wage >= thr)),
        (L[4], (wage >= thr) & (rate >= p75) & sus),
        (L[5], (wage >= thr) & (rate >= p50)),
        (L[6], wage >= thr),
        (L[7], (rate >= p75) & sus),
        (L[8], rate >= p50),
    ]


def mart_quarterly(stage: DataFrame, thresholds: DataFrame | None, as_of: str,
                   recent_months: int = spec.RECENT_MONTHS,
                   threshold_max_rows: int | None = None) -> DataFrame:
    """YoY %, demand rank, yearly p50/p75, sustained-demand %, threshold, tier.

    ``as_of`` replaces ``current_date()`` so results are reproducible.
    ``thresholds`` is the per-geo wage-threshold dimension; pass ``None`` when
    ``stage`` already carries ``lmia_high_wage_threshold``.
    """
    series = Window.partitionBy("geo", "naics").orderBy("date_parsed")
    geo_year = Window.partitionBy("geo", "year")
    geo_date = Window.partitionBy("geo", "date_parsed").orderBy(F.col("job_vacancy_rate").desc_nulls_last())
    rate = F.col("job_vacancy_rate")
    # (geo, year): yearly percentiles; NULL rates are ignored by percentile
    d = stage.withColumns({
        "p75_vacancy_rate": F.percentile(rate, F.lit(0.75)).over(geo_year),
        "p50_vacancy_rate": F.percentile(rate, F.lit(0.5)).over(geo_year),
    })
    # (geo, naics): yearly lags and the sustained-demand share
    d = d.withColumns({
        "prev_year_vacancies_per_1000": F.lag("vacancies_per_1000", 4).over(series),
        "prev_year_vacancy_rate": F.lag(rate, 4).over(series),
        "prev_year_wage": F.lag("avg_offered_hourly_wage", 4).over(series),
    })
    d = sustained_demand_pct(d, ["geo", "naics"], "date_parsed", "job_vacancy_rate",
                             "p75_vacancy_rate", as_of, recent_months)
    # (geo, date): demand rank
    d = d.withColumn("demand_rank", F.when(rate.isNotNull(), F.rank().over(geo_date)))
    if thresholds is not None:
        th = thresholds.select("geo", "lmia_high_wage_threshold")
        d = lookup_dimension(d, th, "geo", threshold_max_rows)
    d = d.withColumn("foreign_accessibility_tier", X.classify_tier(tier_rules(), spec.TIER_LABELS[-1]))
    return d.select(
        "date_parsed", "geo", "year", "naics", "job_vacancies", "job_vacancy_rate",
        "avg_offered_hourly_wage", "payroll_employees", "vacancies_per_1000",
        "prev_year_vacancies_per_1000", "prev_year_vacancy_rate", "prev_year_wage",
        X.pct_change("vacancies_per_1000", "prev_year_vacancies_per_1000").alias("vacancy_rate_yoy_change_pct"),
        X.pct_change("avg_offered_hourly_wage", "prev_year_wage").alias("wage_yoy_change_pct"),
        "demand_rank", "p75_vacancy_rate", "p50_vacancy_rate", "pct_quarters_above_threshold_2yr",
        "lmia_high_wage_threshold", "foreign_accessibility_tier")


def mart_employment(stage: DataFrame, digital: Sequence[str] = spec.DIGITAL_NAICS,
                    aggregate: str = spec.AGGREGATE_NAICS) -> DataFrame:
    """YoY growth %, growth rank per geo × year, digital concentration %.

    The rank is per geo and *year*, so a sector appears up to 12 times in
    one ranking (kept from the original).
    """
    series = Window.partitionBy("geo", "naics").orderBy("date_parsed")
    geo_date = Window.partitionBy("geo", "date_parsed")
    te = F.col("total_employment")
    d = stage.withColumns({
        "total_data_digital_employment": F.sum(
            F.when(F.col("naics").isin(list(digital)), te).otherwise(F.lit(0))).over(geo_date),
        "total_provincial_employment": F.sum(
            F.when(F.col("naics") == F.lit(aggregate), te).otherwise(F.lit(0))).over(geo_date),
    })
    d = d.withColumn("prev_year_employment", F.lag(te, 12).over(series))
    d = d.withColumn("employment_yoy_growth_pct", X.pct_change(te, "prev_year_employment"))
    g = F.col("employment_yoy_growth_pct")
    geo_year = Window.partitionBy("geo", "year").orderBy(g.desc_nulls_last())
    d = d.withColumn("growth_rank", F.when(g.isNotNull(), F.rank().over(geo_year)))
    return d.select(
        "date_parsed", "geo", "year", "naics", "total_employment", "prev_year_employment",
        "employment_yoy_growth_pct", "growth_rank", "total_data_digital_employment",
        "total_provincial_employment",
        X.share_pct("total_data_digital_employment", "total_provincial_employment")
         .alias("data_digital_employment_concentration_pct"))
