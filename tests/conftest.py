import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    ckpt = tempfile.mkdtemp(prefix="strata-test-ckpt-")
    wh = tempfile.mkdtemp(prefix="strata-test-wh-")
    s = (SparkSession.builder.master("local[4]")
         .appName("strata-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", ckpt)
         .config("spark.sql.warehouse.dir", wh)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="strata-test-")


@pytest.fixture(autouse=True, scope="module")
def no_views_left(spark):
    """Temporary views belong to the session and are listed with every schema: they end with the module that made them."""
    yield
    for t in spark.catalog.listTables():
        if t.isTemporary:
            spark.catalog.dropTempView(t.name)
