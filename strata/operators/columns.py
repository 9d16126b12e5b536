"""Projections, filters and derived columns.

Each operator is one ``select``/``withColumns``/``filter`` so Catalyst can
push filters and column pruning into the scan and fuse everything into one
whole-stage-codegen span.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import expressions as X
from strata.operators.ordering import numbered


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Prune to a named list (in that order)."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns by map; names absent from ``df`` are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def trim_strings(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Trim leading/trailing spaces of the listed string columns."""
    return df.withColumns({c: F.trim(F.col(f"`{c}`")) for c in cols})


def cast_measure(df: DataFrame, col: str, to: str = "double") -> DataFrame:
    """Text → number; unparsable or empty text becomes NULL (``try_cast``).

    A ``NaN`` text becomes NULL too (once, at ingest): Spark sorts NaN as the
    largest value and ``avg``/``sum`` propagate it, while NULLs are skipped.
    """
    c = F.col(f"`{col}`").try_cast(to)
    if to in ("double", "float"):
        c = X.nan_to_null(c)
    return df.withColumn(col, c)


def parse_period(df: DataFrame, src: str, dst: str, fmt: str = "yyyy-MM") -> DataFrame:
    """``yyyy-MM`` text → first-of-month date; NULL for text that is no period."""
    return df.withColumn(dst, F.try_to_date(F.col(f"`{src}`"), fmt))


def period_year(df: DataFrame, src: str, dst: str, fmt: str = "yyyy-MM") -> DataFrame:
    """Calendar year of a ``yyyy-MM`` text or of a date column (int)."""
    field = df.schema[src].dataType.typeName()
    base = F.col(f"`{src}`") if field in ("date", "timestamp", "timestamp_ntz") \
        else F.try_to_date(F.col(f"`{src}`"), fmt)
    return df.withColumn(dst, F.year(base))


def filter_category(df: DataFrame, col: str, value) -> DataFrame:
    """Keep rows whose ``col`` equals ``value``."""
    return df.filter(F.col(f"`{col}`") == F.lit(value))


def filter_since(df: DataFrame, col: str, bound: str) -> DataFrame:
    """Keep periods ``>= bound``; ISO ``yyyy-MM`` text compares in date order."""
    return df.filter(F.col(f"`{col}`") >= F.lit(bound))


def filter_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any listed column."""
    return df.dropna(subset=list(cols))


def exclude_members(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Drop rows whose ``col`` is in ``values`` (NULL members are kept)."""
    c = F.col(f"`{col}`")
    return df.filter(c.isNull() | ~c.isin(list(values)))


def rate_per_1000(df: DataFrame, num: str, den: str, out: str) -> DataFrame:
    """``num / nullif(den, 0) * 1000``."""
    return df.withColumn(out, X.rate_per(num, den, 1000.0))


def pct_change(df: DataFrame, cur: str, prev: str, out: str, digits: int = 2) -> DataFrame:
    """``round((cur − prev) / nullif(prev, 0) × 100, digits)``."""
    return df.withColumn(out, X.pct_change(cur, prev, digits))


def classify_tier(df: DataFrame, rules, default: str, out: str) -> DataFrame:
    """First-match rule ladder → label column (see ``expressions.classify_tier``)."""
    return df.withColumn(out, X.classify_tier(rules, default))


def date_window_flags(df: DataFrame, t: str, windows: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One 0/1 column per named inclusive date window."""
    return df.withColumns({name: X.between_flag(t, lo, hi) for name, (lo, hi) in windows.items()})


def calendar_cycle(df: DataFrame, t: str, period: int = 4, digits: int | None = None) -> DataFrame:
    """``quarter`` (month number), ``quarter_sin`` and ``quarter_cos``."""
    return df.withColumns(X.cycle_features(t, period, digits))


def recent_window_flag(df: DataFrame, t: str, as_of: str, months: int = 24,
                       out: str = "is_recent") -> DataFrame:
    """``t >= add_months(as_of, -months)`` as a boolean column."""
    return df.withColumn(out, X.recent_flag(t, as_of, months))


def label_encode(df: DataFrame, col: str, out: str) -> DataFrame:
    """0-based code of each label in sorted label order (NULL stays NULL).

    The distinct labels are numbered by a distributed sort and joined back;
    AQE broadcasts the codes when they measure small. ``df`` is read twice, so
    store it first where it is costly.
    """
    c = F.col(f"`{col}`")
    labels = df.select(c.alias("__label")).filter(F.col("__label").isNotNull()).distinct()
    codes = numbered(labels, ["__label"], out).withColumn(out, F.col(out).cast("int"))
    return df.join(codes, c == F.col("__label"), "left").drop("__label")


def next_period(df: DataFrame, keys: Sequence[str], t: str, months: int = 3,
                out: str = "next_date") -> DataFrame:
    """Per series: the last date plus ``months`` months."""
    return df.groupBy(*keys).agg(F.add_months(F.max(t), months).alias(out))
