"""Sources and sinks."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import spec
from strata.operators.quality import check_names


#: Column that holds the text of a line that does not fit its file's header.
_BROKEN = "__broken"


def csv_layouts(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """The different headers of the CSV files under ``path`` and the files that have each.

    One pass over the first block of each file finds its first line; per distinct header a list of file names (which
    Spark's own listing holds as well) reaches the driver. Files without a line have no header and no rows.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    lines = lines.where("start = 0").withColumn("at", F.monotonically_increasing_id())
    heads = lines.groupBy("file").agg(F.min_by("value", "at").alias("head"))
    found = heads.groupBy("head").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("head").collect()
    return [([name.strip() for name in next(csv.reader([r["head"].removeprefix("\ufeff")]), [])], list(r["files"])) for r in found]


def read_raw_csv_with_rejects(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of the CSV files (one file or a folder) under ``path``.

    Each file's columns are bound by the names in its own header, whatever their order; columns that ``schema`` does
    not name are left out, and a missing column is an error that names the files. Files with the same header are
    one scan. ``rows`` has the columns of ``schema``; ``rejects`` has ``file`` and ``record``, the text of each line
    with more or fewer fields than its header. Every line after a header is in exactly one of the two.
    """
    wanted = schema.fieldNames()
    layouts = csv_layouts(spark, path)
    for names, files in layouts:
        gate = check_names(names, wanted)
        if gate["missing"]:
            raise ValueError(f"columns {gate['missing']} are missing in {files[:5]}")
    rows = rejects = None
    for names, files in layouts:
        first = {n: i for i, n in reversed(list(enumerate(names)))}
        own = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))] + [T.StructField(_BROKEN, T.StringType())])
        lines = (spark.read.schema(own).option("header", True).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", _BROKEN).option("columnPruning", False).csv(files))
        # Spark refuses plans that read nothing but the record of a broken line: the first field is always read with it
        lines = lines.where(F.length(F.coalesce("c0", F.lit(""))) >= 0)
        good = lines.where(F.col(_BROKEN).isNull()).select(*[F.col(f"c{first[f.name]}").cast(f.dataType).alias(f.name) for f in schema.fields])
        bad = lines.where(F.col(_BROKEN).isNotNull()).select(F.col("_metadata.file_path").alias("file"), F.col(_BROKEN).alias("record"))
        rows, rejects = (good, bad) if rows is None else (rows.unionByName(good), rejects.unionByName(bad))
    if rows is None:
        return spark.createDataFrame([], schema), spark.createDataFrame([], "file string, record string")
    return rows, rejects


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of :func:`read_raw_csv_with_rejects`, without the lines that do not fit their header."""
    return read_raw_csv_with_rejects(spark, path, schema)[0]


def read_partitioned_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read Hive-style partitioned Parquet; partition columns come from paths.

    Filters on partition columns prune directories at planning time.
    """
    return spark.read.option("basePath", path).parquet(path)


def read_table(spark: SparkSession, name: str, names: dict[str, str] | None = None) -> DataFrame:
    """Read a catalog table; ``names`` maps logical source names to tables."""
    return spark.table((names or {}).get(name, name))


def load_threshold_seed(spark: SparkSession, path: str) -> DataFrame:
    """Small wage-threshold dimension: typed columns plus the parsed date."""
    df = read_raw_csv(spark, path, T.StructType(
        [T.StructField(f.name, T.StringType(), True) for f in spec.THRESHOLD_SCHEMA.fields]))
    return df.select(
        F.trim("geo").alias("geo"),
        F.col("lmia_high_wage_threshold").try_cast("double").alias("lmia_high_wage_threshold"),
        F.trim("effective_date").alias("effective_date"),
        F.try_to_date(F.trim("effective_date"), "d/M/yyyy").alias("effective_on"),
        F.trim("source").alias("source"),
    )


def write_partitioned(df: DataFrame, path: str, by=("Year", "GEO"), mode: str = "overwrite") -> None:
    """Overwrite Parquet partitioned by ``by``.

    Rows are first clustered on the partition columns by a rebalance: small
    partition values share a task and a value that holds much of the rows is
    split over several tasks, and so over several files.
    """
    by = list(by)
    (df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path))


def save_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Overwrite a managed catalog table."""
    df.write.mode(mode).format(fmt).saveAsTable(name)


def create_schema(spark: SparkSession, name: str) -> None:
    """Idempotent namespace creation."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def materialize(df: DataFrame, name: str, kind: str = "view") -> DataFrame:
    """Stage models become temp views, marts become tables."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if kind == "table":
        save_table(df, name)
        return df.sparkSession.table(name)
    raise ValueError(f"unknown materialisation {kind!r}")


_SOURCES: dict[tuple, DataFrame] = {}


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (``{sf_dir}/{name}.parquet``).

    The source DataFrame (schema and file listing) is reused per session
    while the file is unchanged, so building a query does not re-read
    footers; every query still scans the data.
    """
    import os
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    try:
        stamp = os.path.getmtime(path)
    except OSError:
        return spark.read.parquet(path)
    key = (spark.sparkContext.applicationId, id(spark), path, stamp)
    df = _SOURCES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _SOURCES[key] = spark.read.parquet(path)
    return df
