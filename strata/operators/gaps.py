"""Calendar gaps and panel completion.

The grid of new rows is a range of numbers, decoded into labels and periods
by equi-joins with their numbered distinct values — no cartesian join, and
no task that gathers a vocabulary.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.ordering import numbered
from strata.session import cut_lineage


def _calendar(start: str, end: Column, step_months: int) -> Column:
    return F.sequence(F.lit(start).cast("date"), end, F.make_ym_interval(F.lit(0), F.lit(step_months)))


def missing_periods(df: DataFrame, t: str, start: str, step_months: int = 3,
                    out: str | None = None) -> DataFrame:
    """Periods of the regular calendar ``start, start+step, … ≤ max(t)`` that
    occur in no row (EXCEPT of observed from expected)."""
    out = out or t
    expected = (df.agg(F.max(t).alias("__last"))
                  .select(F.explode(_calendar(start, F.col("__last"), step_months)).alias(out)))
    observed = df.select(F.col(t).alias(out)).distinct()
    return expected.join(observed, out, "left_anti")


def complete_panel(df: DataFrame, keys: Sequence[str], t: str, start: str,
                   step_months: int = 3, year_col: str | None = "year") -> DataFrame:
    """Append one row per (every first key) × (every second key) × (period
    missing everywhere), measures NULL.

    Periods missing for only some series are *not* filled (holes stay).
    ``keys`` are the series key columns, e.g. ``["geo", "naics"]``; the grid
    is the product of their distinct values. The distinct labels of all keys
    are made by one aggregate and numbered by a range-partitioned sort, the
    missing periods likewise; the grid is a range of numbers whose digits are
    the numbers of the labels and of the period, joined back to their values.
    No task gathers labels or rows.
    """
    keys, types = list(keys), dict(df.dtypes)
    labels = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), F.col(f"`{k}`").cast("string").alias("label")) for i, k in enumerate(keys)])).alias("e"))
    labels = labels.select("e.*").where("kind = 0 or label is not null").distinct()
    labels = cut_lineage(numbered(labels, ["kind", "label"], "no"), "panel-labels")
    gaps = cut_lineage(numbered(missing_periods(df, t, start, step_months), [t], "no"), "panel-gaps")
    spans = {r["kind"]: (r["first"], r["n"]) for r in labels.groupBy("kind").agg(F.min("no").alias("first"), F.count("*").alias("n")).collect()}  # one row per key
    sizes = [spans[i][1] if i in spans else 0 for i in range(len(keys))]
    step = gaps.count()
    grid = df.sparkSession.range(math.prod(sizes) * step).select((F.col("id") % max(1, step)).alias("__gap"), F.expr(f"id div {max(1, step)}").alias("__rest"))
    for i in reversed(range(len(keys))):
        first, n = spans.get(i, (0, 1))
        mine = labels.where(F.col("kind") == i).select((F.col("no") - first).alias("__no"), F.col("label").cast(types[keys[i]]).alias(keys[i]))
        grid = grid.withColumn("__no", F.col("__rest") % n).withColumn("__rest", F.expr(f"__rest div {n}")).join(mine, "__no").drop("__no")
    grid = grid.join(gaps.withColumnRenamed("no", "__gap"), "__gap").select(*keys, t)
    if year_col:
        grid = grid.withColumn(year_col, F.year(t))
    return df.unionByName(grid, allowMissingColumns=True)


def append_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by column name; columns absent on one side are NULL."""
    return a.unionByName(b, allowMissingColumns=True)


def period_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Set difference (EXCEPT DISTINCT) of two single-column period sets."""
    return a.subtract(b)
