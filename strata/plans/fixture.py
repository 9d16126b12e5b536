"""The whole pipeline wired to panels derived from the driver tables.

Every function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
work grows with the driver tables; parameters are the fixture values of
FIXTURES.md (``as_of``, cut-offs, flag windows, excluded geos …).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import spec
from strata.plans import clean as CL
from strata.plans import curate as CU
from strata.plans import features as FE
from strata.plans import marts as M
from strata.plans import stage as ST
from strata.sources import panels as P


def monthly_clean(spark: SparkSession, d: str) -> DataFrame:
    return CL.clean_monthly(P.monthly_long(spark, d))


def quarterly_clean(spark: SparkSession, d: str) -> DataFrame:
    return CL.clean_quarterly(P.quarterly_long(spark, d))


def employment_clean(spark: SparkSession, d: str) -> DataFrame:
    return CL.clean_employment(P.employment_long(spark, d), since=spec.FIXTURE_SINCE)


def monthly_curated(spark, d):
    return CU.curate_monthly(monthly_clean(spark, d))


def quarterly_curated(spark, d):
    return CU.curate_quarterly(quarterly_clean(spark, d))


def employment_curated(spark, d):
    return CU.curate_employment(employment_clean(spark, d))


def monthly_stage(spark, d):
    return ST.stage_monthly(P.monthly(spark, d))


def quarterly_stage(spark, d):
    return ST.stage_quarterly(P.quarterly(spark, d))


def employment_stage(spark, d):
    return ST.stage_employment(P.employment(spark, d))


def monthly_mart(spark, d):
    return M.mart_monthly(monthly_stage(spark, d))


def monthly_panel_table(spark, d):
    """The monthly panel written once to the shared checkpoint folder, for
    plans that read it more than once: the fact tables are scanned once."""
    return FE.materialized(P.monthly(spark, d))


def quarterly_panel_table(spark, d):
    """The quarterly panel, likewise written once."""
    return FE.materialized(P.quarterly(spark, d))


def quarterly_mart(spark, d):
    """Quarterly mart; the fixture threshold is a dimension aggregated from
    the stored panel, so the fact tables are scanned once and no window runs
    on a lone ``geo`` key."""
    panel = quarterly_panel_table(spark, d)
    return M.mart_quarterly(ST.stage_quarterly(panel), P.thresholds(spark, d, panel), spec.FIXTURE_AS_OF)


def employment_mart(spark, d):
    return M.mart_employment(employment_stage(spark, d), spec.FIXTURE_DIGITAL, spec.FIXTURE_AGGREGATE)


def quarterly_mart_holed(spark, d):
    """The quarterly mart with one quarter removed everywhere."""
    return quarterly_mart(spark, d).filter(
        F.col("date_parsed") != F.lit(spec.FIXTURE_DROP_QUARTER).cast("date"))


def quarterly_mart_holed_table(spark, d, *columns: str):
    """The holed mart, or ``columns`` of it, written once to the shared
    checkpoint folder: panel completion reads its input twice
    (calendar/labels, then rows)."""
    holed = quarterly_mart_holed(spark, d)
    return FE.materialized(holed.select(*columns) if columns else holed)


def quarterly_series_table(spark, d, value: str = spec.VAC):
    """One measure of every series of the quarterly mart, written once: the
    diagnostics read it several times and need no other column."""
    return FE.materialized(quarterly_mart(spark, d).select("geo", "naics", "date_parsed", "year", value))


def gap_cleaned(spark, d):
    return FE.gap_cleaned(quarterly_mart_holed_table(spark, d), spec.FIXTURE_PANEL_START,
                          spec.FIXTURE_EXCLUDE_GEOS)


def ml_features(spark, d):
    return FE.ml_features(quarterly_mart_holed_table(spark, d), spec.FIXTURE_PANEL_START,
                          spec.FIXTURE_EXCLUDE_GEOS, spec.FIXTURE_FLAG_WINDOWS)
