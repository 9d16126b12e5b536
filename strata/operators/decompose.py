"""Robust seasonal-trend decomposition of every series by local regression.

The method is the published one (Cleveland et al., 1990): an inner loop smooths
the cycle-subseries, takes their low-pass part away and smooths the
deseasonalised series; an outer loop lowers the weight of points with large
remainders (bisquare of six median absolute remainders). Spark groups the rows
into series and deals the series over tasks; inside a task all series of equal
length are smoothed together, each local line as five weighted sums.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values held per smoothing step: bounds a task's memory, not the result.
STEP_VALUES = 1 << 21
PARTS = "trend array<double>, seasonal array<double>, resid array<double>"


def _odd_above(x: float) -> int:
    n = math.ceil(x)
    return n if n % 2 else n + 1


def _local_lines(y: np.ndarray, weight: np.ndarray, span: int, at: np.ndarray) -> np.ndarray:
    """Tricube-weighted local lines through the rows of ``y`` (at 1…n), read at the places ``at``.

    A place without any weight takes the nearest value of ``y``.
    """
    n = y.shape[1]
    q = min(span, n)
    left = np.clip(at - (span + 1) // 2 + 1, 1, n - q + 1)
    near = left[:, None] + np.arange(q)
    d = (near - at[:, None]).astype(float)
    h = np.maximum(at - left, left + q - 1 - at) + max(span - n, 0) // 2
    r = np.abs(d) / np.maximum(h, 1)[:, None]
    cube = np.where(r <= 0.001, 1.0, (1 - np.minimum(r, 1.0) ** 3) ** 3) * (r <= 0.999)
    w, ys = cube * weight[:, near - 1], y[:, near - 1]
    total = w.sum(2)
    safe = np.where(total > 0, total, 1.0)
    d1, y0 = (w * d).sum(2) / safe, (w * ys).sum(2) / safe
    spread = (w * (d - d1[:, :, None]) ** 2).sum(2) / safe
    slope = (w * (d - d1[:, :, None]) * ys).sum(2) / safe / np.where(spread > 0, spread, 1.0)
    line = y0 - np.where(np.sqrt(spread) > 0.001 * (n - 1), slope * d1, 0.0)
    return np.where(total > 0, line, y[:, np.clip(at, 1, n) - 1])


def _moving_mean(x: np.ndarray, k: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(x, k, axis=1).mean(2)


def _cycles(y: np.ndarray, weight: np.ndarray, period: int, span: int) -> np.ndarray:
    """Each cycle-subseries smoothed and carried one cycle beyond both ends: ``n + 2 * period`` columns."""
    out = np.empty((y.shape[0], y.shape[1] + 2 * period))
    for j in range(period):
        part, w = y[:, j::period], weight[:, j::period]
        k = part.shape[1]
        smooth = _local_lines(part, w, span, np.arange(k + 2))
        # an end without weight repeats its smoothed neighbour
        reach = min(span, k)
        smooth[:, 0] = np.where(w[:, :reach].any(1), smooth[:, 0], smooth[:, 1])
        smooth[:, -1] = np.where(w[:, k - reach:].any(1), smooth[:, -1], smooth[:, -2])
        out[:, j::period] = smooth
    return out


def _decomposed(y: np.ndarray, period: int, spans: tuple[int, int, int], inner: int, outer: int) -> tuple[np.ndarray, np.ndarray]:
    """Trend and seasonal part of the rows of ``y``, all of one length."""
    (of_season, of_trend, of_low), n = spans, y.shape[1]
    at, ones = np.arange(1, n + 1), np.ones_like(y)
    trend, seasonal, weight = np.zeros_like(y), np.zeros_like(y), ones
    for turn in range(outer + 1):
        for _ in range(inner):
            cycles = _cycles(y - trend, weight, period, of_season)
            low = _moving_mean(_moving_mean(_moving_mean(cycles, period), period), 3)
            seasonal = cycles[:, period:period + n] - _local_lines(low, ones, of_low, at)
            trend = _local_lines(y - seasonal, weight, of_trend, at)
        if turn < outer:
            off = np.abs(y - trend - seasonal)
            far = 6 * np.median(off, axis=1, keepdims=True)
            u = off / np.where(far > 0, far, 1.0)
            weight = np.where(off <= 0.001 * far, 1.0, np.where(off <= 0.999 * far, (1 - np.minimum(u, 1.0) ** 2) ** 2, 0.0))
    return trend, seasonal


def robust_decompose(df: DataFrame, keys: Sequence[str], t: str, value: str, period: int = 4, seasonal_span: int = 7,
                     trend_span: int | None = None, low_pass_span: int | None = None, inner: int = 2, outer: int = 15,
                     digits: int | None = 9) -> DataFrame:
    """Robust additive decomposition of every series: ``trend`` + ``seasonal`` + ``resid``.

    ``trend_span`` is the least odd number of at least ``1.5 * period / (1 - 1.5 / seasonal_span)``, ``low_pass_span``
    the least odd number above ``period`` unless given. ``outer=0`` leaves robustness out.

    Rows whose value is null or not finite take no place in their series and get null parts; so do all rows of a
    series of fewer than two periods. Rows of equal ``t`` follow each other by value, so the result is the same for
    every row order. Series are grouped whole (a series is as long as its number of periods) on one exchange by key.
    Columns beside ``keys``, ``t`` and ``value`` are left out.
    """
    if period < 2 or seasonal_span < 3 or seasonal_span % 2 == 0:
        raise ValueError("period must be at least 2, seasonal_span odd and at least 3")
    spans = (seasonal_span, trend_span or _odd_above(1.5 * period / (1 - 1.5 / seasonal_span)), low_pass_span or _odd_above(period + 1))
    widest = max(spans)

    @F.pandas_udf(PARTS)
    def parts(series: pd.Series) -> pd.DataFrame:
        known = [np.asarray(s, float) for s in series]
        out: list[tuple] = [(None, None, None)] * len(known)
        sizes = np.array([len(s) for s in known])
        for n in np.unique(sizes[sizes >= 2 * period]).tolist():
            members = np.flatnonzero(sizes == n)
            step = max(1, STEP_VALUES // (n * min(widest, n)))
            for a in range(0, len(members), step):
                some = members[a:a + step]
                y = np.stack([known[i] for i in some])
                trend, seasonal = _decomposed(y, period, spans, inner, outer)
                for i, row in zip(some, zip(trend, seasonal, y - trend - seasonal, strict=True), strict=True):
                    out[i] = row
        return pd.DataFrame(out, columns=["trend", "seasonal", "resid"])

    v, names = F.col(f"`{value}`"), [f"`{k}`" for k in keys]
    real = v.isNotNull() & ~v.cast("double").isin(float("nan"), float("inf"), float("-inf"))
    at = F.struct(F.col(f"`{t}`").alias("t"), v.alias("v"))
    grouped = df.groupBy(*names).agg(F.sort_array(F.collect_list(F.when(real, at))).alias("known"),
                                     F.collect_list(F.when(~real, at)).alias("other"))
    solved = grouped.withColumn("parts", parts(F.transform("known", lambda s: s["v"].cast("double"))))

    def part(name: str, i) -> Column:
        c = F.get(F.col(f"parts.{name}"), i)
        return (F.round(c, digits) if digits is not None else c).alias(name)

    rows = F.concat(
        F.transform("known", lambda s, i: F.struct(s["t"].alias("t"), s["v"].alias("v"), *[part(p, i) for p in ("trend", "seasonal", "resid")])),
        F.transform("other", lambda s: F.struct(s["t"].alias("t"), s["v"].alias("v"),
                                                *[F.lit(None).cast("double").alias(p) for p in ("trend", "seasonal", "resid")])))
    return (solved.select(*names, F.explode(rows).alias("row"))
            .select(*names, F.col("row.t").alias(t), F.col("row.v").alias(value), "row.trend", "row.seasonal", "row.resid"))
