"""Sorts, limits and top-k."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import cut_lineage


def _order(spec) -> Column:
    if isinstance(spec, Column):
        return spec
    if isinstance(spec, tuple):
        name, direction = spec
        c = F.col(f"`{name}`")
        return c.desc_nulls_last() if direction == "desc" else c.asc_nulls_first()
    return F.col(f"`{spec}`").asc_nulls_first()


def sort_limit(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """First ``n`` rows in the given order.

    Planned as TakeOrderedAndProject: each task keeps its own top n, so only
    ``n × tasks`` rows meet on one task, never the whole table.
    """
    return df.orderBy(*[_order(o) for o in order]).limit(n)


def topk_per_group(df: DataFrame, group: Sequence[str], member: str, score: str,
                   k: int = 5, out: str = "rank", salt_buckets: int = 16) -> DataFrame:
    """The ``k`` members with the highest score in each group (exact).

    Two phases so that a group holding a large share of the rows is never
    sorted in one task: rows are first spread over ``salt_buckets`` buckets
    per group (hash of the member) and each bucket keeps its own top k; the
    global top k of a group is contained in the union of the bucket winners,
    so the final per-group ranking sees at most ``k × salt_buckets`` rows.
    Ties are broken by member ascending so the result is reproducible.
    """
    gcols = [F.col(f"`{g}`") for g in group]
    order = [F.col(f"`{score}`").desc_nulls_last(), F.col(f"`{member}`").asc()]
    cand = df
    if salt_buckets > 1:
        salt = F.pmod(F.xxhash64(F.col(f"`{member}`")), F.lit(salt_buckets))
        w1 = Window.partitionBy(*gcols, salt).orderBy(*order)
        cand = df.withColumn("__r", F.row_number().over(w1)).filter(F.col("__r") <= k).drop("__r")
    w = Window.partitionBy(*gcols).orderBy(*order)
    return cand.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)


def rank_importance(df: DataFrame, score: str, out: str = "rank") -> DataFrame:
    """Order features by importance (descending), with a 1-based rank.

    Feature tables have one row per model feature, so the single ordering
    window is over a bounded set.
    """
    w = Window.orderBy(F.col(f"`{score}`").desc_nulls_last(), F.col("feature"))
    return df.withColumn(out, F.row_number().over(w)).orderBy(out)


def numbered(df: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    """Rows with their 0-based place in the order of ``by``: a range-partitioned
    sort, stored once, then one offset per partition. No task sees all rows."""
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = cut_lineage(df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
                    .withColumns({"__part": F.spark_partition_id(), "__place": place}), "numbered")
    sizes = d.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))  # one row per partition
    offsets = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__offset"))
    return (d.join(offsets, "__part").withColumn(out, F.col("__offset") + F.col("__place"))
             .drop("__part", "__place", "__offset"))


def running_sums(df: DataFrame, within: Sequence[str], by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Add ``before_<c>``, the sum of ``c`` over the earlier rows of the same group in the order of ``by``, and
    ``all_<c>``, its sum over the whole group.

    Rows are range-partitioned by (group, order) and stored once, so a group may fill many partitions. Sums run inside
    a partition's share of a group, then over the shares of a group: one row per partition and group.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*within, *by]
    d = cut_lineage(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumns(
        {"__row": F.monotonically_increasing_id(), "__part": F.spark_partition_id()}), "running")
    inside = Window.partitionBy("__part", *within).orderBy("__row").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*within)
    ahead = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shares = d.groupBy("__part", *within).agg(*[F.sum(c).alias(c) for c in sums])
    starts = shares.select(F.col("__part").alias("__p"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(within)],
                           *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"__s{i}") for i, c in enumerate(sums)],
                           *[F.sum(c).over(whole).alias(f"all_{c}") for c in sums])
    same = F.col("__part") == F.col("__p")
    for i, k in enumerate(within):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    out = d.withColumns({f"before_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums}).join(starts, same)
    out = out.withColumns({f"before_{c}": F.col(f"before_{c}") + F.col(f"__s{i}") for i, c in enumerate(sums)})
    return out.drop("__row", "__part", "__p", *[f"__k{i}" for i in range(len(within))], *[f"__s{i}" for i in range(len(sums))])
