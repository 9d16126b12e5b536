"""Data-quality gates.

Each check returns a small violations/report DataFrame; ``enforce`` turns a
report into an exception. ``quality_report`` evaluates every rule of a
table in **one** pass (row rules ride along in the unique-key grouping),
instead of one job per declaration.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.aggregates import duplicate_groups


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


# ----------------------------------------------------------------- rules
@dataclass(frozen=True)
class NotNull:
    column: str
    name: str = "not_null"

    def violation(self) -> Column:
        return _q(self.column).isNull()


@dataclass(frozen=True)
class AcceptedRange:
    column: str
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True
    name: str = "accepted_range"

    def violation(self) -> Column:
        c = _q(self.column)
        ok = F.lit(True)
        if self.min_value is not None:
            ok = ok & ((c >= self.min_value) if self.inclusive else (c > self.min_value))
        if self.max_value is not None:
            ok = ok & ((c <= self.max_value) if self.inclusive else (c < self.max_value))
        # NULLs pass a range test
        return c.isNotNull() & ~ok


@dataclass(frozen=True)
class AcceptedValues:
    column: str
    values: tuple = field(default_factory=tuple)
    name: str = "accepted_values"

    def violation(self) -> Column:
        c = _q(self.column)
        return c.isNotNull() & ~c.isin(list(self.values))


@dataclass(frozen=True)
class UniqueKey:
    columns: tuple
    name: str = "unique_key"


# ----------------------------------------------------------------- checks
def check_nonempty(df: DataFrame) -> bool:
    """True when the table has at least one row (reads at most one row)."""
    return len(df.limit(1).take(1)) == 1


def check_columns(df: DataFrame, required: Sequence[str], strict: bool = False) -> dict:
    """Missing required columns and (strict) unexpected extras; no job runs."""
    return check_names(df.columns, required, strict)


def check_names(actual: Sequence[str], required: Sequence[str], strict: bool = False) -> dict:
    """The same for a list of names, such as the header of a file."""
    missing = [c for c in required if c not in actual]
    extra = [c for c in actual if c not in required] if strict else []
    return {"missing": missing, "extra": extra, "ok": not missing and not extra}


def schema_summary(df: DataFrame) -> DataFrame:
    """Column names, types and nullability as rows (from metadata, no scan)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([T.StructField("position", T.IntegerType()),
                           T.StructField("column", T.StringType()),
                           T.StructField("type", T.StringType()),
                           T.StructField("nullable", T.BooleanType())])
    return df.sparkSession.createDataFrame(rows, schema)


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: NULL count per critical column (all zero when clean)."""
    return df.agg(*[F.count_if(_q(c).isNull()).alias(c) for c in cols])


def check_unique_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Duplicate key groups (empty when the key is unique)."""
    return duplicate_groups(df, keys)


def check_accepted_range(df: DataFrame, col: str, lo=None, hi=None, inclusive: bool = True) -> DataFrame:
    """Rows violating the range (NULLs pass)."""
    return df.filter(AcceptedRange(col, lo, hi, inclusive).violation())


def check_accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is outside the closed list (NULLs pass)."""
    return df.filter(AcceptedValues(col, tuple(values)).violation())


def check_row_reconciliation(before: DataFrame, after: DataFrame, factor: float = 1.0) -> DataFrame:
    """One row: rows before, rows after, expected = before / factor, ok."""
    b = before.agg(F.count(F.lit(1)).alias("rows_before"))
    out = b.select("rows_before", after.agg(F.count(F.lit(1))).scalar().alias("rows_after"))
    expected = F.col("rows_before") / F.lit(float(factor))
    return out.withColumns({"expected_after": expected,
                            "ok": F.col("rows_after") == expected})


def quality_report(df: DataFrame, rules: Sequence) -> DataFrame:
    """All rules of one table → rows ``(check, column, failures, passed)``.

    One pass over the input: row-level rules (not-null, range, values) are
    ``count_if(violation)`` aggregates; when the table declares a unique key
    they ride along in the grouping by that key (per-group partial counts,
    then a global sum plus ``count_if(rows > 1)`` for duplicates), so the
    key check and the row checks share one scan and one exchange. Further
    unique keys add one grouped pass each.
    """
    row_rules = [r for r in rules if not isinstance(r, UniqueKey)]
    key_rules = [r for r in rules if isinstance(r, UniqueKey)]

    def entries(names_cols):
        return [F.struct(F.lit(n).alias("check"), F.lit(c).alias("column"),
                         F.col(a).cast("long").alias("failures")) for n, c, a in names_cols]

    items = []
    if key_rules:
        first = key_rules[0]
        per_key = df.groupBy(*[_q(k) for k in first.columns]).agg(
            F.count(F.lit(1)).alias("__rows"),
            *[F.count_if(r.violation()).alias(f"__r{i}") for i, r in enumerate(row_rules)])
        agg = per_key.agg(F.count_if(F.col("__rows") > 1).alias("__dup"),
                          *[F.sum(f"__r{i}").alias(f"r{i}") for i in range(len(row_rules))])
        items = [(r.name, r.column, f"r{i}") for i, r in enumerate(row_rules)] + \
                [(first.name, ",".join(first.columns), "__dup")]
        parts = [agg.select(F.explode(F.array(*entries(items))).alias("e")).select("e.*")]
        rest = key_rules[1:]
    else:
        agg = df.agg(*[F.count_if(r.violation()).alias(f"r{i}") for i, r in enumerate(row_rules)])
        items = [(r.name, r.column, f"r{i}") for i, r in enumerate(row_rules)]
        parts = [agg.select(F.explode(F.array(*entries(items))).alias("e")).select("e.*")] if items else []
        rest = []
    for r in rest:
        dup = duplicate_groups(df, list(r.columns)).agg(F.count(F.lit(1)).alias("failures"))
        parts.append(dup.select(F.lit(r.name).alias("check"), F.lit(",".join(r.columns)).alias("column"),
                                F.col("failures").cast("long")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failures") == 0)


def enforce(report: DataFrame, what: str = "table") -> None:
    """Raise ``AssertionError`` listing every failed check of a report.

    The report has one row per declared rule, so collecting it is bounded.
    """
    failed = [r.asDict() for r in report.filter(~F.col("passed")).collect()]
    if failed:
        raise AssertionError(f"{what}: failed checks {failed}")
