"""Aggregations, profiling and series diagnostics.

All of these are grouped aggregates or windows partitioned by the series
key, planned as two-phase hash aggregates: partial results are combined on
the map side before the shuffle, so a hot key never ships its raw rows.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.ordering import running_sums


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def row_count(df: DataFrame, out: str = "row_count") -> DataFrame:
    """Number of rows as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(out))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column in one pass; one row, one column per input column."""
    cols = list(cols) if cols is not None else df.columns
    return df.agg(*[F.count_if(_q(c).isNull()).alias(c) for c in cols])


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """Distinct values per column in one pass, NULL counted as a value.

    ``count(DISTINCT c)`` skips NULL while ``select(c).distinct().count()``
    counts it, hence the ``max(c IS NULL)`` term. ``approx=True`` uses
    HyperLogLog++ (bounded memory per group) for very wide cardinalities.
    """
    aggs = []
    for c in cols:
        d = F.approx_count_distinct(_q(c), rsd) if approx else F.count_distinct(_q(c))
        aggs.append((d + F.max(_q(c).isNull().cast("int"))).cast("long").alias(c))
    return df.agg(*aggs)


def distinct_values(df: DataFrame, cols: Sequence[str], n: int) -> DataFrame:
    """First ``n`` distinct value combinations in ascending order (a preview)."""
    cols = list(cols)
    return df.select(*[_q(c) for c in cols]).distinct().orderBy(*cols).limit(n)


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations occurring more than once, fewest repeats first."""
    return (df.groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias("count"))
              .filter(F.col("count") > 1).orderBy("count", *keys))


def pivot_statistics(df: DataFrame, keys: Sequence[str], name: str, value: str,
                     values: Sequence[str]) -> DataFrame:
    """Long → wide: one column per statistic holding ``sum(value)``.

    The value list is explicit (no job to discover it, fixed schema) and the
    pivot is written as conditional sums in one grouped aggregate — a single
    exchange, where ``groupBy().pivot()`` plans two aggregation levels. A cell
    whose inputs are all NULL, or that has no input row, stays NULL.
    """
    n, v = _q(name), _q(value)
    return df.groupBy(*[_q(k) for k in keys]).agg(
        *[F.sum(F.when(n == F.lit(s), v)).alias(s) for s in values])


def period_averages(df: DataFrame, by: Sequence[str],
                    specs: Sequence[tuple[str, str, str, int | None]]) -> DataFrame:
    """Grouped ``avg``/``sum``/``min``/``max``; ``(out, func, col, digits)``.

    ``avg`` is accumulated in decimal so a rounded mean is the same however
    the rows are partitioned.
    """
    from strata.functions.expressions import decimal_mean
    funcs = {"avg": decimal_mean, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
    aggs = []
    for out, fn, col, digits in specs:
        e = funcs[fn](_q(col))
        if digits is not None:
            e = F.round(e, digits)
        if fn == "avg":
            e = e.cast("double")
        aggs.append(e.alias(out))
    return df.groupBy(*[_q(b) for b in by]).agg(*aggs)


def conditional_sums(df: DataFrame, by: Sequence[str], member: str, value: str,
                     sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """``sum(CASE WHEN member IN set THEN value ELSE 0 END)`` per output."""
    aggs = [F.sum(F.when(_q(member).isin(list(s)), _q(value)).otherwise(F.lit(0))).alias(out)
            for out, s in sets.items()]
    return df.groupBy(*[_q(b) for b in by]).agg(*aggs)


def concentration_pct(df: DataFrame, part: str, total: str, out: str, digits: int = 2) -> DataFrame:
    """``round(part / nullif(total, 0) × 100, digits)``."""
    from strata.functions.expressions import share_pct
    return df.withColumn(out, share_pct(part, total, digits))


def group_percentiles(df: DataFrame, by: Sequence[str], value: str,
                      percentiles: Mapping[str, float], approx: bool = False,
                      accuracy: int = 10000) -> DataFrame:
    """Continuous (interpolated) percentiles per group, NULLs excluded.

    Exact order statistics by counting: rows become counts per (group, value), running sums over a range-partitioned
    sort say which ranks a value holds, and each percentile lies between the two values that hold its neighbouring
    ranks. No task or buffer sees a whole group, so a group may hold any share of the rows.
    Groups whose values are all NULL produce no row. ``approx=True`` uses ``percentile_approx`` (bounded sketch per group).
    """
    v, keys = _q(value), [_q(b) for b in by]
    known = df.filter(v.isNotNull())
    if approx:
        return known.groupBy(*keys).agg(*[F.percentile_approx(v, p, accuracy).alias(o) for o, p in percentiles.items()])
    names = [f"__g{i}" for i in range(len(by))]
    counts = known.groupBy(*[k.alias(n) for k, n in zip(keys, names, strict=True)], v.alias("__v")).agg(F.count(F.lit(1)).alias("n"))
    ranks = running_sums(counts, names, ["__v"], ["n"])

    def holding(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("before_n")) & (rank < F.col("before_n") + F.col("n")), F.col("__v").cast("double")))

    picked, results = [], []
    for i, (out, p) in enumerate(percentiles.items()):
        place = F.lit(float(p)) * (F.col("all_n") - 1)
        picked += [holding(F.floor(place)).alias(f"__low{i}"), holding(F.ceil(place)).alias(f"__high{i}"), F.max(place).alias(f"__at{i}")]
        low, high, at = F.col(f"__low{i}"), F.col(f"__high{i}"), F.col(f"__at{i}")
        results.append(F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high).alias(out))
    return ranks.groupBy(*names).agg(*picked).select(*[F.col(n).alias(b) for n, b in zip(names, by, strict=True)], *results)


def missing_share(df: DataFrame, by: Sequence[str], value: str, threshold_pct: float = 10.0) -> DataFrame:
    """NULLs, rows and NULL % per group, flagged when over ``threshold_pct``."""
    g = df.groupBy(*[_q(b) for b in by]).agg(
        F.count_if(_q(value).isNull()).alias("n_missing"),
        F.count(F.lit(1)).alias("n_rows"))
    pct = F.col("n_missing") / F.col("n_rows") * F.lit(100)
    return g.withColumns({"pct_missing": pct, "over_threshold": pct > F.lit(threshold_pct)})


def missing_by_year(df: DataFrame, group: str, member: str, t: str, year: str, value: str,
                    lo: float = 0.3, hi: float = 0.5, group_threshold_pct: float = 10.0,
                    min_year_missing: int = 0) -> DataFrame:
    """Series with many NULLs in groups with many NULLs, with a yearly breakdown.

    For groups (geo) whose NULL share exceeds ``group_threshold_pct``, every
    member series (geo × naics) with at least ``lo × P`` NULLs is reported,
    where P is the number of distinct periods in the table. Series with at
    most ``hi × P`` NULLs get one row per year (years with fewer than
    ``min_year_missing`` NULLs skipped); others one row with NULL year.

    ``df`` is read once: one (group, member, year) aggregate is stored, and
    series totals, group totals and the number of periods come from it.
    """
    from strata.session import cut_lineage
    v = _q(value)
    base = cut_lineage(df.groupBy(group, member, year).agg(
        F.count_if(v.isNull()).alias("year_missing"),
        F.count(F.lit(1)).alias("__rows"),
        F.collect_set(_q(t)).alias("__periods")), "yearly")      # at most a year's periods each
    n_periods = base.select(F.explode("__periods").alias("__t")).agg(F.count_distinct("__t")).scalar()
    totals = base.groupBy(group).agg(F.sum("year_missing").alias("__m"), F.sum("__rows").alias("__n"))
    grp = totals.filter(F.col("__m") / F.col("__n") * F.lit(100) > F.lit(group_threshold_pct)).select(group)
    series = Window.partitionBy(group, member)
    d = (base.join(grp, group, "left_semi")
             .withColumns({"series_missing": F.sum("year_missing").over(series),
                           "__first": F.row_number().over(series.orderBy(year))})
             .withColumn("n_periods", n_periods)
             .filter(F.col("series_missing") >= F.lit(lo) * F.col("n_periods")))
    yearly = F.col("series_missing") <= F.lit(hi) * F.col("n_periods")
    d = d.filter(F.when(yearly, F.col("year_missing") >= F.lit(min_year_missing)).otherwise(F.col("__first") == 1))
    return d.select(group, member, "series_missing", "n_periods",
                    F.when(yearly, _q(year)).cast("int").alias(year),
                    F.when(yearly, F.col("year_missing")).alias("year_missing"))


def anomaly_rows(df: DataFrame, keys: Sequence[str], t: str, value: str,
                 z: float = 3.5, min_rows: int = 12) -> DataFrame:
    """Rows more than ``z`` sample standard deviations from the series mean.

    Only series with at least ``min_rows`` rows (NULL or not) and a positive
    deviation are tested; mean and deviation skip NULLs. The series
    statistics are a two-phase aggregate joined back on the key (AQE
    broadcasts them when small, or splits a hot key in a sort-merge join),
    so no task has to buffer a whole series.
    """
    v = _q(value)
    stats = (df.groupBy(*[_q(k) for k in keys])
               .agg(F.count(F.lit(1)).alias("__n"), F.avg(v).alias("__mean"),
                    F.stddev_samp(v).alias("__sd"))
               .filter((F.col("__n") >= min_rows) & (F.col("__sd") > 0)))
    return (df.select(*keys, t, value).join(stats, list(keys))
              .filter(F.abs(v - F.col("__mean")) > F.lit(z) * F.col("__sd"))
              .select(*keys, t, value))


def anomaly_years(anomalies: DataFrame, keys: Sequence[str], t: str, out: str = "year") -> DataFrame:
    """Distinct years of the anomalous rows of each series (one row per year)."""
    return anomalies.select(*keys, F.year(t).alias(out)).distinct()


def series_gap_profile(df: DataFrame, keys: Sequence[str], t: str, value: str) -> DataFrame:
    """Per series: rows, NULLs, NULL share and the longest run of NULLs.

    Gaps-and-islands in one window pass: the running count of non-NULL
    values labels each NULL run; runs are counted per label, then per series.
    Both aggregates reuse the window's partitioning on the series key, so
    the whole profile costs one shuffle.
    """
    w = (Window.partitionBy(*[_q(k) for k in keys]).orderBy(_q(t))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    v = _q(value)
    runs = (df.select(*keys, t, value, F.count(v).over(w).alias("__island"))
              .groupBy(*keys, "__island")
              .agg(F.count(F.lit(1)).alias("__rows"), F.count_if(v.isNull()).alias("__nulls")))
    prof = runs.groupBy(*keys).agg(
        F.sum("__rows").alias("n_rows"),
        F.sum("__nulls").alias("n_null"),
        F.max("__nulls").alias("max_null_run"))
    return prof.withColumn("null_share", F.col("n_null") / F.col("n_rows"))


def unreliable_series(profile: DataFrame, keys: Sequence[str], max_share: float = 0.5,
                      max_run: int = 4) -> DataFrame:
    """Series keys whose NULL share exceeds ``max_share`` or whose longest
    NULL run reaches ``max_run``."""
    return (profile.filter((F.col("null_share") > F.lit(max_share)) | (F.col("max_null_run") >= max_run))
                   .select(*keys))


def drop_unreliable(df: DataFrame, keys: Sequence[str], t: str, value: str,
                    max_share: float = 0.5, max_run: int = 4) -> DataFrame:
    """Keep only series whose NULL share is at most ``max_share`` and whose
    longest NULL run is below ``max_run`` — the profile and the filter in
    one pass of window aggregates over the series key (no anti-join, the
    input is read once, all windows share one exchange)."""
    v = _q(value)
    kk = [_q(k) for k in keys]
    w_run = (Window.partitionBy(*kk).orderBy(_q(t))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = df.withColumn("__island", F.count(v).over(w_run))
    d = d.withColumn("__run", F.count_if(v.isNull()).over(Window.partitionBy(*kk, F.col("__island"))))
    ws = Window.partitionBy(*kk)
    keep = ((F.count_if(v.isNull()).over(ws) / F.count(F.lit(1)).over(ws) <= F.lit(max_share))
            & (F.max("__run").over(ws) < F.lit(max_run)))
    return d.withColumn("__keep", keep).filter("__keep").drop("__island", "__run", "__keep")


def period_bounds(df: DataFrame, keys: Sequence[str], t: str) -> DataFrame:
    """First and last date per series (or overall when ``keys`` is empty)."""
    return df.groupBy(*[_q(k) for k in keys]).agg(F.min(_q(t)).alias("min_date"),
                                                  F.max(_q(t)).alias("max_date"))
