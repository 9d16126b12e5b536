"""Write, audit, publish: one evaluation, and a failing gate leaves the old data as it was."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.plans import jobs as J
from strata.sources import io
from strata.sources import publish as PB
from tests import fixtures as fx

RULES = [Q.NotNull("v"), Q.AcceptedRange("v", 0, None), Q.UniqueKey(("Year", "GEO", "k"))]


def rows(spark, values, n=3):
    return spark.createDataFrame([(2000 + i % 2, f"G{i % n}", i, v) for i, v in enumerate(values)], "Year int, GEO string, k int, v double")


def evaluated(spark, df):
    """``df`` with an accumulator that counts how often its rows are made."""
    count = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(k):
        count.add(1)
        return k

    return df.withColumn("k", seen("k")), count


def test_folder_is_written_once_and_swapped(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    PB.publish_partitioned(rows(spark, [1.0] * 7), path, RULES)
    df, count = evaluated(spark, rows(spark, [2.0] * 9))
    watched, seen = PB.counted(df)
    audit = PB.publish_partitioned(watched.filter("k % 3 = 0"), path, RULES, before=(df, seen), factor=3)
    assert audit.rows == 3 and not audit.failed and {c[0] for c in audit.checks} == {"not_null", "accepted_range", "unique_key", "row_reconciliation"}
    assert {r.v for r in io.read_partitioned_parquet(spark, path).collect()} == {2.0}
    assert count.value == 9 and os.listdir(tmp_dir) == ["t"]


@pytest.mark.parametrize("values,check", [([1.0, None], "not_null"), ([1.0, -1.0], "accepted_range")])
def test_failing_row_rules_keep_the_old_folder(spark, tmp_dir, values, check):
    path = os.path.join(tmp_dir, "t")
    PB.publish_partitioned(rows(spark, [1.0] * 7), path, RULES)
    with pytest.raises(AssertionError, match=check):
        PB.publish_partitioned(rows(spark, values), path, RULES)
    assert io.read_partitioned_parquet(spark, path).count() == 7 and os.listdir(tmp_dir) == ["t"]


def test_failing_keys_and_counts_keep_the_old_folder(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    PB.publish_partitioned(rows(spark, [1.0] * 7), path, RULES)
    with pytest.raises(AssertionError, match="unique_key"):
        PB.publish_partitioned(rows(spark, [1.0] * 4).withColumn("k", F.lit(1)), path, [Q.UniqueKey(("k",))])
    watched, seen = PB.counted(rows(spark, [1.0] * 4))
    with pytest.raises(AssertionError, match="row_reconciliation"):
        PB.publish_partitioned(watched, path, RULES, before=(rows(spark, [1.0] * 4), seen), factor=2)
    assert io.read_partitioned_parquet(spark, path).count() == 7 and os.listdir(tmp_dir) == ["t"]


def test_tables(spark):
    io.create_schema(spark, "wap")
    PB.publish_table(rows(spark, [1.0] * 7), "wap.t", RULES)
    df, count = evaluated(spark, rows(spark, [3.0] * 5))
    assert PB.publish_table(df, "wap.t", RULES).rows == 5 and count.value == 5
    with pytest.raises(AssertionError, match="not_null"):
        PB.publish_table(rows(spark, [None]), "wap.t", RULES)
    assert spark.table("wap.t").count() == 5 and [t.name for t in spark.catalog.listTables("wap")] == ["t"]
    assert PB.publish_table(rows(spark, []), "wap.t", RULES).rows == 0 and spark.table("wap.t").count() == 0


def test_marts_job_keeps_the_old_mart_when_its_gate_fails(spark, tmp_dir, monkeypatch):
    stage = spark.createDataFrame([(2016, "2016-01-01", "Canada", "N", 1.0, 2.0, 3.0, 9.0)],
                                  "year int, date_parsed string, geo string, naics string, job_vacancies double, job_vacancy_rate double, payroll_employees double, "
                                  "avg_offered_hourly_wage double").withColumn("date_parsed", F.to_date("date_parsed"))
    io.create_schema(spark, "wapm")
    io.save_table(stage.drop("naics", "avg_offered_hourly_wage"), "wapm.m")
    io.save_table(stage, "wapm.q")
    io.save_table(stage.select("year", "date_parsed", "geo", "naics", F.lit(5.0).alias("total_employment")), "wapm.e")
    tables = {"monthly": "wapm.m", "quarterly": "wapm.q", "employment": "wapm.e"}
    seed = io.load_threshold_seed(spark, fx.write(tmp_dir, "seed.csv", fx.THRESHOLDS))
    marts = J.marts_job(spark, tables, seed, "2016-01-01", "wapm")
    old = spark.table(marts["mart_monthly_labour_metrics"]).collect()
    monkeypatch.setattr(J, "with_unique_key", lambda model: [Q.AcceptedRange("year", 3000, None)])
    with pytest.raises(AssertionError, match="accepted_range"):
        J.marts_job(spark, tables, seed, "2016-01-01", "wapm")
    assert spark.table(marts["mart_monthly_labour_metrics"]).collect() == old
