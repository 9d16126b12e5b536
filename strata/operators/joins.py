"""Joins."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only within both bounds (checked, not assumed).
DEFAULT_BROADCAST_MAX_ROWS = 1_000_000
DEFAULT_BROADCAST_MAX_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: 8 a fixed-width one, text and binary by length, nested ones by their JSON."""
    total = F.lit(0).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType, T.BinaryType)):
            size = F.octet_length(c)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.octet_length(F.to_json(F.struct(c)))
        else:
            size = F.lit(16 if isinstance(f.dataType, T.DecimalType) else 8)
        total = total + F.coalesce(size, F.lit(0))
    return total


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only when it provably has ``<= max_rows`` rows of ``<= max_bytes`` in all.

    The check is one job over ``limit(max_rows + 1)``, which stops reading
    as soon as the row bound is exceeded, so it is cheap for small sides and
    bounded for large ones. Beyond either bound the plain DataFrame is
    returned and Spark plans a shuffle join (AQE may still convert it at run
    time from measured sizes).
    """
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df


def join_left_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left equi-join on a composite key; right-only columns may be NULL."""
    return left.join(right, list(on), "left")


def join_group_stats(df: DataFrame, stats: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left-join each row to its group's aggregate row.

    The statistics side is derived (an aggregate), so no hint is given: with
    AQE the join is re-planned from the *measured* size of the aggregate's
    shuffle output and becomes a broadcast join when it is small, a
    sort-merge join (with skew splitting) when it is not.
    """
    return df.join(stats, list(on), "left")


def lookup_dimension(df: DataFrame, dim: DataFrame, on: str | Sequence[str],
                     broadcast_max_rows: int | None = None,
                     broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> DataFrame:
    """Left equi-join to a small dimension.

    For a stored dimension (a seed file, a catalog table) pass
    ``broadcast_max_rows`` to broadcast it behind a cheap check of its rows and bytes.
    For a derived dimension leave it ``None``: checking would recompute its
    lineage, and AQE already broadcasts it when its measured size is small.
    """
    on = [on] if isinstance(on, str) else list(on)
    if broadcast_max_rows is not None:
        dim = bounded_broadcast(dim, broadcast_max_rows, broadcast_max_bytes)
    return df.join(dim, on, "left")


def drop_series(df: DataFrame, bad_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove every row whose series key appears in ``bad_keys`` (anti-join)."""
    keys = list(keys)
    return df.join(bad_keys.select(*keys).distinct(), keys, "left_anti")
