"""Window operators over series.

Every window is partitioned by the series key, so at scale each series is
one in-memory sorted run on one task and many series fill a partition. Lags
are *positional* (previous row of the series), not calendar offsets: a
missing period shifts the comparison, as in the original SQL.
Operators that need several values of one series declare one ``WindowSpec``
so Catalyst plans a single sort for all of them.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from strata.functions import expressions as X


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def series_window(keys: Sequence[str], t: str, descending: bool = False) -> WindowSpec:
    order = _q(t).desc() if descending else _q(t).asc()
    return Window.partitionBy(*[_q(k) for k in keys]).orderBy(order)


def lag_prev_period(df: DataFrame, keys: Sequence[str], t: str, value: str,
                    n: int = 1, out: str | None = None) -> DataFrame:
    """``lag(value, n)`` over the series ordered by ``t`` (positional)."""
    out = out or f"{value}_lag{n}"
    return df.withColumn(out, F.lag(_q(value), n).over(series_window(keys, t)))


def lag_columns(df: DataFrame, keys: Sequence[str], t: str,
                specs: Sequence[tuple[str, int, str]]) -> DataFrame:
    """Several lags ``(value, n, out)`` sharing one window (one sort)."""
    w = series_window(keys, t)
    return df.withColumns({out: F.lag(_q(v), n).over(w) for v, n, out in specs})


def rank_masked(df: DataFrame, by: Sequence[str], value: str, out: str,
                method: str = "window") -> DataFrame:
    """``rank()`` by ``value`` descending within ``by``; NULL for NULL values.

    NULL rows still occupy the last positions of the ordering (so they do
    not shift the ranks of non-NULL rows) and get a NULL rank.

    ``method="window"`` sorts each group in one task — right when groups are
    bounded (sectors of one geo and date). ``method="histogram"`` is exact
    for groups of any size: rank = 1 + rows of the group with a larger
    value, computed over the partial-aggregated (group, value) counts and
    joined back, so a hot group costs its number of *distinct* values, and
    its rows are spread by the join.
    """
    v = _q(value)
    if method == "window":
        w = Window.partitionBy(*[_q(b) for b in by]).orderBy(v.desc_nulls_last())
        return df.withColumn(out, F.when(v.isNotNull(), F.rank().over(w)))
    if method != "histogram":
        raise ValueError(f"unknown rank method {method!r}")
    hist = df.filter(v.isNotNull()).groupBy(*[_q(b) for b in by], v).agg(F.count(F.lit(1)).alias("__c"))
    above = (Window.partitionBy(*[_q(b) for b in by]).orderBy(v.desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    hist = hist.withColumn(out, (F.coalesce(F.sum("__c").over(above), F.lit(0)) + 1).cast("int")).drop("__c")
    return df.join(hist, [*by, value], "left")


def sustained_demand_pct(df: DataFrame, keys: Sequence[str], t: str, value: str,
                         threshold: str, as_of: str, months: int = 24, digits: int = 1,
                         out: str = "pct_quarters_above_threshold_2yr") -> DataFrame:
    """Share (%) of a series' recent rows whose value reaches its threshold.

    Recent = ``t >= add_months(as_of, -months)``. The numerator counts recent
    rows with ``value >= threshold``; the denominator counts all recent rows,
    NULL values included; a series without recent rows gets NULL. Both are
    whole-partition window sums (no ordering, no frame sort work).
    """
    w = Window.partitionBy(*[_q(k) for k in keys])
    recent = X.recent_flag(t, as_of, months)
    hit = F.when((_q(value) >= _q(threshold)) & recent, F.lit(1)).otherwise(F.lit(0))
    num = F.sum(hit).over(w)
    den = F.count(F.when(recent, F.lit(1))).over(w)
    return df.withColumn(out, F.round(num / X.nullif_zero(den) * F.lit(100), digits))


def lag_features(df: DataFrame, keys: Sequence[str], t: str, value: str,
                 lags: Sequence[int] = (1, 2, 3, 4, 5, 6)) -> DataFrame:
    """``{value}_lag{k}`` for each k, all on one window."""
    return lag_columns(df, keys, t, [(value, k, f"{value}_lag{k}") for k in lags])


def _mean_of(cols: Sequence[Column]) -> Column:
    """Mean that is NULL when any part is NULL (sum in list order, then /n)."""
    total = cols[0]
    for c in cols[1:]:
        total = total + c
    return total / F.lit(float(len(cols)))


def rolling_features(df: DataFrame, keys: Sequence[str], t: str, value: str,
                     sizes: Sequence[int] = (2, 3, 6)) -> DataFrame:
    """``{value}_roll{n}``: mean of the previous n rows, NULL unless all n exist
    and are non-NULL.

    Written as the mean of lags 1…n on one shared window: one sort, no
    per-row frame re-aggregation, and a fixed summation order.
    """
    w = series_window(keys, t)
    top = max(sizes)
    lagged = {k: F.lag(_q(value), k).over(w) for k in range(1, top + 1)}
    return df.withColumns({f"{value}_roll{n}": _mean_of([lagged[k] for k in range(1, n + 1)])
                           for n in sizes})


def _neighbours(df: DataFrame, keys: Sequence[str], t: str, value: str) -> DataFrame:
    """Row position plus previous/next known value and their positions.

    Both directions are running frames (the "next" side uses the descending
    order), so each costs O(n) per series rather than a per-row re-scan of
    the remaining rows.
    """
    v = _q(value)
    fwd = series_window(keys, t).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bwd = series_window(keys, t, descending=True).rowsBetween(Window.unboundedPreceding,
                                                              Window.currentRow)
    rn = F.row_number().over(series_window(keys, t))
    d = df.withColumn("__rn", rn)
    known_rn = F.when(v.isNotNull(), F.col("__rn"))
    return d.withColumns({
        "__pv": F.last(v, ignorenulls=True).over(fwd),
        "__pr": F.last(known_rn, ignorenulls=True).over(fwd),
        "__nv": F.last(v, ignorenulls=True).over(bwd),
        "__nr": F.last(known_rn, ignorenulls=True).over(bwd),
    })


_TMP = ["__rn", "__pv", "__pr", "__nv", "__nr"]


def interpolate_limited(df: DataFrame, keys: Sequence[str], t: str, value: str,
                        limit: int = 3, out: str | None = None) -> DataFrame:
    """Linear fill by row position, at most ``limit`` steps into a gap, then
    forward fill; leading NULLs stay NULL.

    Closed form per row: known → v; no earlier known value → NULL; no later
    known value → previous value; else
    ``pv + (nv − pv) · least(rn − pr, limit) / (nr − pr)``.
    """
    out = out or value
    d = _neighbours(df, keys, t, value)
    v = _q(value)
    step = F.least(F.col("__rn") - F.col("__pr"), F.lit(limit))
    filled = (F.when(v.isNotNull(), v)
               .when(F.col("__pv").isNull(), F.lit(None).cast("double"))
               .when(F.col("__nv").isNull(), F.col("__pv"))
               .otherwise(F.col("__pv") + (F.col("__nv") - F.col("__pv")) * step
                          / (F.col("__nr") - F.col("__pr"))))
    return d.withColumn(out, filled).drop(*_TMP)


def fill_both_ends(df: DataFrame, keys: Sequence[str], t: str, value: str,
                   out: str | None = None) -> DataFrame:
    """Unlimited linear fill, then forward fill, then backward fill."""
    out = out or value
    d = _neighbours(df, keys, t, value)
    v = _q(value)
    filled = (F.when(v.isNotNull(), v)
               .when(F.col("__pv").isNotNull() & F.col("__nv").isNotNull(),
                     F.col("__pv") + (F.col("__nv") - F.col("__pv")) * (F.col("__rn") - F.col("__pr"))
                     / (F.col("__nr") - F.col("__pr")))
               .otherwise(F.coalesce(F.col("__pv"), F.col("__nv"))))
    return d.withColumn(out, filled).drop(*_TMP)


def series_tail(df: DataFrame, keys: Sequence[str], t: str, value: str, k: int = 6,
                rolls: Sequence[int] = (2, 3, 6), prefix: str | None = None) -> DataFrame:
    """The last ``k`` values of each series as ``{prefix}_lag1..k`` (lag1 =
    latest), their means ``{prefix}_roll{n}`` (NULL if any part is NULL or
    missing) and the series' last date ``last_date``.

    Only the top-k rows per series survive the window filter, then one
    grouped aggregate pivots them to columns.
    """
    prefix = prefix or value
    rn = F.row_number().over(series_window(keys, t, descending=True))
    top = df.select(*keys, t, value, rn.alias("__pos")).filter(F.col("__pos") <= k)
    g = top.groupBy(*keys).agg(
        F.max(_q(t)).alias("last_date"),
        *[F.max(F.when(F.col("__pos") == i, _q(value))).alias(f"{prefix}_lag{i}")
          for i in range(1, k + 1)])
    return g.withColumns({f"{prefix}_roll{n}": _mean_of([F.col(f"{prefix}_lag{i}") for i in range(1, n + 1)])
                          for n in rolls if n <= k})


def autocorrelation(df: DataFrame, keys: Sequence[str], t: str, value: str,
                    nlags: int = 36, digits: int | None = 9) -> DataFrame:
    """Sample ACF of every series for lags 0…nlags (statsmodels' estimator):

    ``acf(k) = Σ_t (x_t − m)(x_{t+k} − m) / Σ_t (x_t − m)²``

    One window pass provides the series mean and lags 1…nlags of the
    demeaned value; one grouped aggregate sums the products per lag. Lags at
    or beyond the series length are omitted. Output: keys, ``lag``, ``acf``.
    """
    v = _q(value)
    w_all = Window.partitionBy(*[_q(k) for k in keys])
    w = series_window(keys, t)
    d = df.filter(v.isNotNull()).select(*keys, t, (v - F.avg(v).over(w_all)).alias("__d"))
    d = d.select(*keys, "__d", *[(F.col("__d") * F.lag("__d", k).over(w)).alias(f"__p{k}")
                                 for k in range(1, nlags + 1)])
    g = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        F.sum(F.col("__d") * F.col("__d")).alias("__den"),
        *[F.sum(f"__p{k}").alias(f"__s{k}") for k in range(1, nlags + 1)])
    pairs = [F.struct(F.lit(0).alias("lag"), F.lit(1.0).alias("num"))] + \
            [F.struct(F.lit(k).alias("lag"), (F.col(f"__s{k}") / F.col("__den")).alias("num"))
             for k in range(1, nlags + 1)]
    long = g.select(*keys, "__n", "__den", F.explode(F.array(*pairs)).alias("__e"))
    acf = F.col("__e.num")
    if digits is not None:
        acf = F.round(acf, digits)
    return (long.filter((F.col("__e.lag") < F.col("__n")) & (F.col("__den") > 0))
                .select(*keys, F.col("__e.lag").alias("lag"), acf.alias("acf")))


def seasonal_decompose(df: DataFrame, keys: Sequence[str], t: str, value: str,
                       period: int = 4, digits: int | None = 9) -> DataFrame:
    """Classical additive decomposition of every series: trend + seasonal + resid.

    * trend: centred moving average — for an even period the 2×p average
      (half weights on the two ends), NULL where the window leaves the series;
    * seasonal: mean detrended value per phase (row position mod period),
      centred to sum to zero over the phases;
    * resid = value − trend − seasonal.

    One windowed pass over all series; ``decompose.robust_decompose`` is the
    robust decomposition by local regression.
    """
    v = _q(value)
    w = series_window(keys, t)
    half = period // 2
    if period % 2 == 0:
        parts = [F.lag(v, half).over(w) * F.lit(0.5)] + \
                [F.lag(v, i).over(w) for i in range(half - 1, 0, -1)] + [v] + \
                [F.lead(v, i).over(w) for i in range(1, half)] + [F.lead(v, half).over(w) * F.lit(0.5)]
    else:
        parts = [F.lag(v, i).over(w) for i in range(half, 0, -1)] + [v] + \
                [F.lead(v, i).over(w) for i in range(1, half + 1)]
    trend = parts[0]
    for p in parts[1:]:
        trend = trend + p
    trend = trend / F.lit(float(period))
    d = df.select(*keys, t, value,
                  ((F.row_number().over(w) - 1) % period).alias("__phase"),
                  trend.alias("trend"))
    d = d.withColumn("__detr", v - F.col("trend"))
    # phase means as windows over the series key, on the partitioning of ``w``: the input is read once
    w_all = Window.partitionBy(*[_q(k) for k in keys])
    means = [f"__m{p}" for p in range(period)]
    d = d.withColumns({m: F.avg(F.when(F.col("__phase") == p, F.col("__detr"))).over(w_all)
                       for p, m in enumerate(means)})
    total, known = F.lit(0.0), F.lit(0)
    for m in means:
        total = total + F.coalesce(F.col(m), F.lit(0.0))
        known = known + F.col(m).isNotNull().cast("int")
    own = F.coalesce(*[F.when(F.col("__phase") == p, F.col(m)) for p, m in enumerate(means)])
    out = (d.withColumn("seasonal", own - total / X.nullif_zero(known))
             .withColumn("resid", v - F.col("trend") - F.col("seasonal")))
    cols = {"trend": F.col("trend"), "seasonal": F.col("seasonal"), "resid": F.col("resid")}
    if digits is not None:
        cols = {k: F.round(c, digits) for k, c in cols.items()}
    return out.select(*keys, t, value, *[c.alias(k) for k, c in cols.items()])

