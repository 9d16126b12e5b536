"""ML feature table.

complete panel → exclude geos → drop unreliable series → limited
interpolation → lags, rolling means, calendar cycle, window flags, label
codes. Every step is a DataFrame operator over all series at once; the
series windows all partition by (geo, naics).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame

from strata import spec
from strata.operators import aggregates as A
from strata.operators import columns as C
from strata.operators import gaps as G
from strata.operators import windows as W

KEYS = ["geo", "naics"]
T = "date_parsed"


def materialized(mart: DataFrame) -> DataFrame:
    """Write the mart to the shared checkpoint folder and read it back.

    The feature stage reads its input several times (panel completion needs
    the calendar and label sets of the whole input); materialising computes
    the mart once, cuts the lineage and survives executor loss.
    """
    from strata.session import cut_lineage
    return cut_lineage(mart, "mart")


def gap_cleaned(mart: DataFrame, start: str, exclude_geos: Sequence[str],
                null_share: float = spec.UNRELIABLE_NULL_PCT,
                null_run: int = spec.UNRELIABLE_NULL_RUN) -> DataFrame:
    """Complete the panel, drop excluded geos and unreliable vacancy series."""
    full = G.complete_panel(mart, KEYS, T, start, spec.FORECAST_STEP_MONTHS)
    kept = C.exclude_members(full, "geo", exclude_geos)
    # same rule as series_gap_profile → unreliable_series → drop_series,
    # evaluated as windows so the panel is read once
    return A.drop_unreliable(kept, KEYS, T, spec.VAC, null_share, null_run)


def add_target_features(df: DataFrame, target: str) -> DataFrame:
    df = W.lag_features(df, KEYS, T, target, spec.LAGS)
    return W.rolling_features(df, KEYS, T, target, spec.ROLLS)


def add_shared_features(df: DataFrame, flag_windows: Mapping[str, tuple[str, str]]) -> DataFrame:
    df = C.calendar_cycle(df, T, spec.QUARTER_PERIOD)
    df = C.date_window_flags(df, T, flag_windows)
    df = C.label_encode(df, "geo", "geo_encoded")
    return C.label_encode(df, "naics", "naics_encoded")


def feature_columns() -> list[str]:
    """Every feature that ``ml_features`` offers to a model, in the order of its columns."""
    targets = [f"{t}_{kind}{n}" for t in (spec.VAC, spec.WAGE) for kind, many in (("lag", spec.LAGS), ("roll", spec.ROLLS)) for n in many]
    return [*targets, "quarter", "quarter_sin", "quarter_cos", *spec.EVENT_WINDOWS, "geo_encoded", "naics_encoded"]


def ml_features(mart: DataFrame, start: str, exclude_geos: Sequence[str],
                flag_windows: Mapping[str, tuple[str, str]],
                limit: int = spec.INTERPOLATION_LIMIT) -> DataFrame:
    df = gap_cleaned(mart, start, exclude_geos)
    for target in (spec.VAC, spec.WAGE):
        df = W.interpolate_limited(df, KEYS, T, target, limit)
    # the label vocabularies are fitted on this table: materialise it once so
    # they (and the size checks) read it instead of re-running the stage
    from strata.session import cut_lineage
    df = cut_lineage(df, "interpolated")
    for target in (spec.VAC, spec.WAGE):
        df = add_target_features(df, target)
    return add_shared_features(df, flag_windows)
