"""strata — panel-of-time-series analytics as Spark DataFrame operators.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` (or a
``Column`` for scalar helpers) and is built from Spark SQL functions,
windows, joins and Spark ML, so one call processes every series of a panel
at once and nothing is collected to the driver.

Sub-packages
------------
``sources``     readers/writers and the panels derived from the driver tables
``functions``   Column-level expressions (percent change, rates, tier ladder …)
``operators``   DataFrame → DataFrame building blocks (aggregates, windows,
                joins, gaps, quality gates …)
``plans``       composed pipelines: clean → curate → stage → marts → features
``forecasting`` temporal split, boosted trees, metrics, recursive forecast
``streaming``   file-stream ingest of raw CSV drops into the partitioned layout
"""

from strata.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
