"""File-stream ingest: new drops are cleaned once and appended, partitioned."""

import os

from strata.streaming.ingest import ingest_stream
from tests import fixtures as fx


def test_ingest_stream_is_incremental(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    out = os.path.join(tmp_dir, "processed")
    ckpt = os.path.join(tmp_dir, "ckpt")
    fx.write(landing, "a.csv", fx.RAW_QUARTERLY_A)
    q = ingest_stream(spark, "quarterly", landing, out, ckpt)
    q.awaitTermination(120)
    first = spark.read.parquet(out)
    assert first.count() == 4
    assert os.path.isdir(os.path.join(out, "Year=2015", "GEO=Alberta"))
    fx.write(landing, "b.csv", fx.RAW_QUARTERLY_B)          # a new drop
    q = ingest_stream(spark, "quarterly", landing, out, ckpt)
    q.awaitTermination(120)
    both = spark.read.parquet(out)
    assert both.count() == 8                                # a.csv not re-ingested
    assert sorted(both.columns) == ["Date", "GEO", "NAICS", "Statistics", "VALUE", "Year"]
