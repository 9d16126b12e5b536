"""Run log and prediction tables (re-aimed from an experiment-tracking server)."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession

from strata.sources.io import save_table

RUN_LOG_SCHEMA = "run string, kind string, name string, value string"


def run_log(spark: SparkSession, run: str, params: Mapping | None = None,
            metrics: Mapping | None = None, tags: Mapping | None = None) -> DataFrame:
    """Parameters, metrics and tags of one run as ``(run, kind, name, value)`` rows."""
    rows = []
    for kind, d in (("param", params), ("metric", metrics), ("tag", tags)):
        for k, v in (d or {}).items():
            rows.append((run, kind, str(k), None if v is None else str(v)))
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def append_run_log(df: DataFrame, table: str) -> None:
    """Append run rows to a catalog table."""
    df.write.mode("append").saveAsTable(table)


def save_predictions(df: DataFrame, name: str) -> DataFrame:
    """Persist prediction rows (date, keys, predicted value, model, horizon)."""
    cols = [c for c in df.columns]
    save_table(df.select(*cols), name)
    return df.sparkSession.table(name)
