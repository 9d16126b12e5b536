"""Write, audit, publish: a table is replaced only by one that has passed its gates.

The new data is written beside the old, and the row rules are counted by observed metrics while it is written, so the
plan that makes the data runs once. Unique keys are counted on the written files, from the key columns alone. If all
gates pass, the staged data takes the old one's place; if not, it is deleted and the old data stays as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.operators.aggregates import duplicate_groups
from strata.sources import io


@dataclass(frozen=True)
class Audit:
    """What a gate found: the rows written, and per rule (check, column, failures)."""

    rows: int
    checks: list[tuple[str, str, int]]

    @property
    def failed(self) -> list[tuple[str, str, int]]:
        return [c for c in self.checks if c[2]]


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` and a count of its rows that is known once a job has run over it."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _audit(df: DataFrame, rules: Sequence, write: Callable[[DataFrame], None], staged: Callable[[], DataFrame]) -> Audit:
    """Write ``df`` once under observation, then count the duplicates of its keys on what was written."""
    row_rules = [r for r in rules if not isinstance(r, Q.UniqueKey)]
    keys = [r for r in rules if isinstance(r, Q.UniqueKey)]
    seen = Observation(f"audit-{uuid.uuid4().hex}")
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(r.violation()).alias(f"r{i}") for i, r in enumerate(row_rules)]))
    found = seen.get
    checks = [(r.name, r.column, int(found[f"r{i}"])) for i, r in enumerate(row_rules)]
    checks += [(k.name, ",".join(k.columns), duplicate_groups(staged(), list(k.columns)).count()) for k in keys]
    return Audit(int(found["rows"]), checks)


def _gate(audit: Audit, rules: Sequence, staged: Callable[[], DataFrame], expected: Callable[[], float] | None, recount: Callable[[], float] | None, what: str) -> Audit:
    """Raise if a check failed. Metrics of a stage that ran twice count twice, so a failure is counted again on the
    staged data before it is believed; a rule without a single violation cannot have been counted too low."""
    rows, checks = audit.rows, audit.checks
    wanted = expected() if expected else None
    if audit.failed or (wanted is not None and rows != wanted):
        rows = staged().count()
        checks = [(r["check"], r["column"], r["failures"]) for r in Q.quality_report(staged(), rules).collect()] if rules else []
        wanted = recount() if recount else wanted
    if wanted is not None:
        checks = [*checks, ("row_reconciliation", "*", int(rows != wanted))]
    audit = Audit(rows, checks)
    if audit.failed:
        raise AssertionError(f"{what}: failed checks {audit.failed}")
    return audit


def _paths(spark: SparkSession, *names: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(n) for n in names]
    return paths[0].getFileSystem(conf), paths


def _swap(spark: SparkSession, staged: str, target: str) -> None:
    """Put the folder ``staged`` in the place of ``target``; the old folder is deleted last."""
    old = f"{target}.old-{uuid.uuid4().hex}"
    fs, (new, place, aside) = _paths(spark, staged, target, old)
    had = fs.exists(place)
    if had and not fs.rename(place, aside):
        raise OSError(f"cannot set {target} aside")
    if not fs.rename(new, place):
        if had:
            fs.rename(aside, place)
        raise OSError(f"cannot publish {target}")
    if had:
        fs.delete(aside, True)


def publish_partitioned(df: DataFrame, path: str, rules: Sequence = (), by: Sequence[str] = ("Year", "GEO"),
                        before: tuple[DataFrame, Observation] | None = None, factor: float = 1.0) -> Audit:
    """Replace the partitioned Parquet folder ``path`` by ``df`` if it passes ``rules``.

    ``before`` is the input that ``df`` derives from, as given by :func:`counted`: its rows divided by ``factor`` must
    be the rows of ``df``; they are counted by the same job. The folders lie side by side, so that publishing is two
    renames; a reader between them finds no folder, never a half-written one.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    stage = f"{path}.stage-{uuid.uuid4().hex}"
    staged = lambda: io.read_partitioned_parquet(spark, stage)
    try:
        audit = _audit(df, rules, lambda d: io.write_partitioned(d, stage, by), staged)
        expected = (lambda: before[1].get["rows"] / factor) if before else None
        recount = (lambda: before[0].count() / factor) if before else None
        audit = _gate(audit, rules, staged, expected, recount, path)
        _swap(spark, stage, path)
        return audit
    finally:
        fs, (left,) = _paths(spark, stage)
        fs.delete(left, True)


def publish_table(df: DataFrame, name: str, rules: Sequence = ()) -> Audit:
    """Replace the catalog table ``name`` by ``df`` if it passes ``rules``; the staged table is renamed into place."""
    spark = df.sparkSession
    stage = f"{name}__stage_{uuid.uuid4().hex}"
    staged = lambda: spark.table(stage)
    try:
        audit = _gate(_audit(df, rules, lambda d: io.save_table(d, stage), staged), rules, staged, None, None, name)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {stage} RENAME TO {name}")
        return audit
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {stage}")
