"""Cleaned long form → curated wide tables, export gates, catalog names
(SURVEY §2.9 curate_*, §2.8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import spec
from strata.operators import aggregates as A
from strata.operators import columns as C
from strata.operators import quality as Q

MONTHLY_KEYS = ["Year", "Date_parsed", "GEO"]
QUARTERLY_KEYS = ["Year", "Date_parsed", "GEO", "NAICS"]
EMPLOYMENT_KEYS = ["Year", "GEO", "NAICS", "Date_parsed"]


def curate_monthly(clean: DataFrame) -> DataFrame:
    """Parse the period and pivot the three statistics to columns."""
    df = C.parse_period(clean, "Date", "Date_parsed")
    return A.pivot_statistics(df, MONTHLY_KEYS, "Statistics", "VALUE", spec.MONTHLY_STATISTICS)


def curate_quarterly(clean: DataFrame) -> DataFrame:
    """Parse the period and pivot the four statistics to columns."""
    df = C.parse_period(clean, "Date", "Date_parsed")
    return A.pivot_statistics(df, QUARTERLY_KEYS, "Statistics", "VALUE", spec.QUARTERLY_STATISTICS)


def curate_employment(clean: DataFrame) -> DataFrame:
    """Parse the period; VALUE becomes ``Total Employment``."""
    df = C.parse_period(clean, "Date", "Date_parsed")
    return df.select("Year", "Date_parsed", "NAICS", "GEO",
                     F.col("VALUE").alias(spec.STAT_EMPLOYMENT))


def export_gate(curated: DataFrame, required: list[str], critical: list[str],
                strict: bool = True) -> DataFrame:
    """Schema check (no job) + one fused not-null pass + one unique-key pass."""
    cols = Q.check_columns(curated, required, strict)
    if not cols["ok"]:
        raise AssertionError(f"column check failed: {cols}")
    rules = [Q.NotNull(c) for c in critical] + [Q.UniqueKey(tuple(critical))]
    return Q.quality_report(curated, rules)


def to_catalog(curated: DataFrame) -> DataFrame:
    """Rename curated labels to catalog snake_case names."""
    return C.rename_columns(curated, spec.CURATED_RENAME)
