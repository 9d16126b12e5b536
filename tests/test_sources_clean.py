"""Sources/sinks, cleaning, curation and export gates on source-shaped files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata import spec
from strata.operators import quality as Q
from strata.plans import clean as CL
from strata.plans import curate as CU
from strata.sources import io
from tests import fixtures as fx


def test_read_raw_csv_bom_and_all_strings(spark, tmp_dir):
    p = fx.write(tmp_dir, "monthly/m.csv", fx.RAW_MONTHLY)
    df = io.read_raw_csv(spark, p, spec.RAW_MONTHLY_SCHEMA)
    assert df.columns[0] == "REF_DATE"          # BOM stripped from the first header
    assert all(t == "string" for _, t in df.dtypes)
    assert df.count() == 6


def test_read_raw_csv_folder_and_quoted_commas(spark, tmp_dir):
    fx.write(tmp_dir, "q/a.csv", fx.RAW_QUARTERLY_A)
    fx.write(tmp_dir, "q/b.csv", fx.RAW_QUARTERLY_B)
    df = io.read_raw_csv(spark, os.path.join(tmp_dir, "q"), spec.RAW_QUARTERLY_SCHEMA)
    assert df.count() == 8
    labels = {r[0] for r in df.select(spec.NAICS_LABEL_COL).distinct().collect()}
    assert labels == {"Total, all industries", "Warehousing and storage [493,4931]"}


def test_raw_csv_is_bound_by_header_names(spark, tmp_dir):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("A", "B", "C, x")])
    fx.write(tmp_dir, "h/a.csv", '\ufeffA,B,"C, x"\n1,2,3\n4,5\n"q,1",6,7\n,,\n\n8,9,10,11\n')
    fx.write(tmp_dir, "h/b.csv", 'B,extra,"C, x",A\n20,e,30,10\nA,B\n1,2,3,"x""y"\n')
    fx.write(tmp_dir, "h/none.csv", "")
    fx.write(tmp_dir, "h/head.csv", 'A,B,"C, x"\n')
    rows, rejects = io.read_raw_csv_with_rejects(spark, os.path.join(tmp_dir, "h"), schema)
    assert sorted(map(tuple, rows.na.fill("-").collect())) == [("-", "-", "-"), ("1", "2", "3"), ("10", "20", "30"), ("q,1", "6", "7"), ('x"y', "1", "3")]
    assert sorted((os.path.basename(r.file), r.record) for r in rejects.collect()) == [("a.csv", "4,5"), ("a.csv", "8,9,10,11"), ("b.csv", "A,B")]
    assert rows.count() == 5 and rejects.count() == 3 and rows.select("B").count() == 5


def test_raw_csv_without_a_column_names_the_file(spark, tmp_dir):
    p = fx.write(tmp_dir, "missing.csv", "REF_DATE,GEO\n2015-01,Canada\n")
    with pytest.raises(ValueError, match="VALUE.*missing.csv"):
        io.read_raw_csv(spark, p, spec.RAW_MONTHLY_SCHEMA)


def test_clean_monthly_trims_casts_and_years(spark, tmp_dir):
    p = fx.write(tmp_dir, "m.csv", fx.RAW_MONTHLY)
    c = CL.clean_monthly(io.read_raw_csv(spark, p, spec.RAW_MONTHLY_SCHEMA))
    assert c.columns == ["Date", "GEO", "Statistics", "VALUE", "Year"]
    rows = c.collect()
    assert {r.GEO for r in rows} == {"Canada"}
    assert {r.Statistics for r in rows} == set(spec.MONTHLY_STATISTICS)
    assert sum(r.VALUE is None for r in rows) == 1     # empty VALUE -> NULL, not an error
    assert {r.Year for r in rows} == {2015}


def test_clean_employment_filters_type_and_period(spark, tmp_dir):
    p = fx.write(tmp_dir, "e.csv", fx.RAW_EMPLOYMENT)
    c = CL.clean_employment(io.read_raw_csv(spark, p, spec.RAW_EMPLOYMENT_SCHEMA))
    rows = c.collect()
    assert c.columns == ["Date", "GEO", "NAICS", "VALUE", "Year"]
    assert len(rows) == 4                                # 2001 row and salaried row removed
    assert all(r.Date >= "2015-01" for r in rows)
    assert sum(r.VALUE is None for r in rows) == 2       # statuses x and .. keep NULL
    assert {r.GEO for r in rows} == {"Canada"}


def test_curate_quarterly_pivot_and_gate(spark, tmp_dir):
    fx.write(tmp_dir, "q/a.csv", fx.RAW_QUARTERLY_A)
    fx.write(tmp_dir, "q/b.csv", fx.RAW_QUARTERLY_B)
    clean = CL.clean_quarterly(io.read_raw_csv(spark, os.path.join(tmp_dir, "q"), spec.RAW_QUARTERLY_SCHEMA))
    cur = CU.curate_quarterly(clean)
    assert cur.count() == 2
    required = CU.QUARTERLY_KEYS + spec.QUARTERLY_STATISTICS
    rep = CU.export_gate(cur, required, CU.QUARTERLY_KEYS)
    Q.enforce(rep)
    rec = Q.check_row_reconciliation(clean, cur, 4).first()
    assert rec.ok and rec.rows_before == 8 and rec.rows_after == 2
    row = cur.filter(F.col("GEO") == "Ontario").first()
    assert row["Job vacancy rate"] is None and row["Job vacancies"] == 1200.0


def test_strict_gate_rejects_stale_column(spark):
    df = spark.createDataFrame([(2016, dt.date(2016, 8, 1), "Canada", 1.0, 2.6, 3.0, 9.0)],
                               ["Year", "Date_parsed", "GEO", "Job vacancies", "Job vacancy rate",
                                "Payroll employees", "Total Employment"])
    res = Q.check_columns(df, CU.MONTHLY_KEYS + spec.MONTHLY_STATISTICS, strict=True)
    assert res["extra"] == ["Total Employment"] and not res["ok"]
    with pytest.raises(AssertionError):
        CU.export_gate(df, CU.MONTHLY_KEYS + spec.MONTHLY_STATISTICS, CU.MONTHLY_KEYS)


def test_threshold_seed(spark, tmp_dir):
    p = fx.write(tmp_dir, "seed.csv", fx.THRESHOLDS)
    s = io.load_threshold_seed(spark, p)
    r = s.filter("geo = 'Alberta'").first()
    assert r.lmia_high_wage_threshold == 36.0 and r.effective_on == dt.date(2025, 6, 27)


def test_partitioned_roundtrip_and_tables(spark, tmp_dir):
    df = spark.createDataFrame([(2015, "Canada", 1.0), (2016, "Alberta", 2.0)], ["Year", "GEO", "v"])
    out = os.path.join(tmp_dir, "curated")
    io.write_partitioned(df, out)
    assert os.path.isdir(os.path.join(out, "Year=2015", "GEO=Canada"))
    back = io.read_partitioned_parquet(spark, out)
    assert sorted(back.columns) == ["GEO", "Year", "v"]
    assert back.filter("Year = 2016").first().GEO == "Alberta"
    io.create_schema(spark, "labour_test")
    io.create_schema(spark, "labour_test")      # idempotent
    io.save_table(df, "labour_test.t1")
    assert io.read_table(spark, "t", {"t": "labour_test.t1"}).count() == 2
    v = io.materialize(df, "stage_view", "view")
    assert v.count() == 2


def test_schema_summary_and_nonempty(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    s = Q.schema_summary(df).collect()
    assert [(r.column, r.type) for r in s] == [("x", "int"), ("y", "string")]
    assert Q.check_nonempty(df) and not Q.check_nonempty(df.limit(0))


def test_cast_measure_text_edge_cases(spark):
    from strata.operators.columns import cast_measure
    df = spark.createDataFrame([("1.5",), ("",), ("x",), ("NaN",), ("nan",), (None,), (" 2 ",)], "VALUE string")
    got = [r.VALUE for r in cast_measure(df, "VALUE").collect()]
    assert got[0] == 1.5 and got[1:6] == [None] * 5


def test_bad_period_becomes_null(spark):
    from strata.operators.columns import parse_period, period_year
    df = spark.createDataFrame([("2020-03",), ("n/a",), (None,)], "p string")
    got = period_year(parse_period(df, "p", "d"), "p", "y").collect()
    assert [str(r["d"]) for r in got] == ["2020-03-01", "None", "None"] and [r["y"] for r in got] == [2020, None, None]


def test_hot_partition_is_written_as_several_files(spark, tmp_dir):
    import glob
    from pyspark.sql import functions as F
    from strata.sources.io import write_partitioned
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        df = spark.range(200_000, numPartitions=8).select(F.when(F.col("id") % 50 == 0, F.col("id") % 3).otherwise(0).alias("Year"),
                                                          F.lit("x").alias("GEO"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        write_partitioned(df, f"{tmp_dir}/hot")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(glob.glob(f"{tmp_dir}/hot/Year=0/GEO=x/*.parquet")) > 1
    assert spark.read.parquet(f"{tmp_dir}/hot").count() == 200_000
