"""Raw long-form feeds → cleaned long form.

Each function is a pure projection/filter chain — one scan stage, filters
pushed into the scan, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import spec
from strata.operators import columns as C


def clean_employment(raw: DataFrame, since: str = "2015-01",
                     employee_type: str = spec.ALL_EMPLOYEES) -> DataFrame:
    """Keep one employee type, prune, cast VALUE, trim, keep periods ≥ ``since``,
    add Year, rename to ``Date, GEO, NAICS, VALUE, Year``."""
    n = spec.NAICS_LABEL_COL
    df = C.filter_category(raw, spec.EMPLOYEE_TYPE_COL, employee_type)
    df = C.select_columns(df, ["REF_DATE", "GEO", n, "VALUE"])
    df = C.cast_measure(df, "VALUE")
    df = C.trim_strings(df, ["REF_DATE", "GEO", n])
    df = C.filter_since(df, "REF_DATE", since)
    df = C.period_year(df, "REF_DATE", "Year")
    return df.select(F.col("REF_DATE").alias("Date"), "GEO", F.col(f"`{n}`").alias("NAICS"),
                     "VALUE", "Year")


def clean_monthly(raw: DataFrame) -> DataFrame:
    """Prune, trim, cast VALUE, rename → ``Date, GEO, Statistics, VALUE, Year``."""
    df = C.select_columns(raw, ["REF_DATE", "GEO", "Statistics", "VALUE"])
    df = C.trim_strings(df, ["REF_DATE", "GEO", "Statistics"])
    df = C.cast_measure(df, "VALUE")
    df = df.withColumnRenamed("REF_DATE", "Date")
    return C.period_year(df, "Date", "Year")


def clean_quarterly(raw: DataFrame) -> DataFrame:
    """As ``clean_monthly`` with the NAICS label →
    ``Date, GEO, NAICS, Statistics, VALUE, Year``."""
    n = spec.NAICS_LABEL_COL
    df = C.select_columns(raw, ["REF_DATE", "GEO", n, "Statistics", "VALUE"])
    df = C.trim_strings(df, ["REF_DATE", "GEO", n, "Statistics"])
    df = C.cast_measure(df, "VALUE")
    df = df.select(F.col("REF_DATE").alias("Date"), "GEO", F.col(f"`{n}`").alias("NAICS"),
                   "Statistics", "VALUE")
    return C.period_year(df, "Date", "Year")
