"""Labour-shaped panels derived from the driver's star-schema tables.

See FIXTURES.md §2. Each panel is one aggregate over a join of fact and
dimension tables, so its cost grows with the fact tables:

* measures that must not depend on row order are rounded to
  ``decimal(18,2)`` per row and summed exactly as whole cents (a long),
  then turned into doubles;
* the nation dimension (fixed 25 rows in the schema, still size-checked) is
  broadcast; ``part``/``supplier``/``customer`` are joined without hints so
  Spark chooses broadcast or sort-merge from their statistics and AQE can
  re-plan and split skewed keys at run time;
* aggregation is two-phase (partial on the map side), so a key that holds a
  third of the rows is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import spec
from strata.operators.joins import bounded_broadcast
from strata.sources.io import read_driver_table

NATION_MAX_ROWS = 10_000


def _cents(c: str) -> Column:
    """The value rounded to ``decimal(18,2)`` as an exact count of cents.

    Summing the unscaled long is exact and order-independent like a decimal
    sum, without the arbitrary-precision accumulator of ``decimal(28,2)``.
    """
    return (F.col(c).cast("decimal(18,2)") * F.lit(100)).cast("long")


def _from_cents(c: Column) -> Column:
    return c.cast("double") / F.lit(100.0)


def _period(ts: str, unit: str) -> Column:
    return F.to_date(F.date_trunc(unit, F.col(ts)))


def _nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation dimension, broadcast after a check of its rows and bytes."""
    return bounded_broadcast(read_driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), NATION_MAX_ROWS)


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """geo × month: payroll = orders, vacancies = open orders, rate in %."""
    o = read_driver_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", _period("o_orderdate", "month").alias("date_parsed"))
    c = read_driver_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(_nation(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")))
    g = j.groupBy(F.col("n_name").alias("geo"), "date_parsed").agg(
        F.count(F.lit(1)).cast("double").alias("payroll_employees"),
        F.count_if(F.col("o_orderstatus") == "O").cast("double").alias("job_vacancies"))
    return g.select(
        "date_parsed", "geo", F.year("date_parsed").alias("year"), "job_vacancies",
        (F.lit(100.0) * F.col("job_vacancies") / F.col("payroll_employees")).alias("job_vacancy_rate"),
        "payroll_employees")


def quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """geo × sector (p_type) × quarter with suppression-style NULLs."""
    li = read_driver_table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_returnflag",
        _cents("l_extendedprice").alias("price"), _cents("l_quantity").alias("qty"),
        _period("l_shipdate", "quarter").alias("date_parsed"))
    p = read_driver_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    s = read_driver_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = (li.join(p, li.l_partkey == p.p_partkey)
           .join(s, F.col("l_suppkey") == s.s_suppkey)
           .join(_nation(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")))
    vacancy = (F.col("l_returnflag") == "R") | ((F.col("p_type") == "PROMO") & (F.col("l_returnflag") == "N"))
    g = j.groupBy(F.col("n_name").alias("geo"), "n_nationkey", F.col("p_type").alias("naics"),
                  "date_parsed").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(vacancy).alias("vac"),
        F.sum("price").alias("sum_price"),
        F.sum("qty").alias("sum_qty"))
    suppressed = (F.col("n") % 10) < (F.col("n_nationkey") % 5)
    return g.select(
        "date_parsed", "geo", F.year("date_parsed").alias("year"), "naics",
        F.when(~suppressed, F.col("vac").cast("double")).alias("job_vacancies"),
        F.when(~suppressed, F.lit(100.0) * F.col("vac") / F.col("n")).alias("job_vacancy_rate"),
        F.col("n").cast("double").alias("payroll_employees"),
        F.when((F.col("n") % 7) != 0,
               _from_cents(F.col("sum_price")) / _from_cents(F.col("sum_qty")))
         .alias("avg_offered_hourly_wage"))


def _employment_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Σ quantity per geo × month × type, plus the all-type aggregate row.

    One ``rollup`` pass produces both grains; the aggregate row is labelled
    ``ALL``. A second measure (lines with return flag 'A') feeds the second
    employee type of the raw long form.
    """
    li = read_driver_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_returnflag", _cents("l_quantity").alias("qty"))
    o = read_driver_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", _period("o_orderdate", "month").alias("date_parsed"))
    c = read_driver_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    p = read_driver_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(c, F.col("o_custkey") == c.c_custkey)
           .join(_nation(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
           .join(p, F.col("l_partkey") == p.p_partkey))
    g = (j.rollup(F.col("n_name").alias("geo"), "date_parsed", F.col("p_type").alias("naics"))
          .agg(F.sum("qty").alias("total"),
               F.sum(F.when(F.col("l_returnflag") == "A", F.col("qty"))).alias("salaried"),
               F.grouping_id().alias("gid")))
    # gid 0 = (geo, date, type); gid 1 = (geo, date) → the aggregate sector
    g = g.filter(F.col("gid") <= 1)
    return g.select(
        "date_parsed", "geo", F.year("date_parsed").alias("year"),
        F.when(F.col("gid") == 0, F.col("naics")).otherwise(F.lit(spec.FIXTURE_AGGREGATE)).alias("naics"),
        _from_cents(F.col("total")).alias("total_employment"),
        _from_cents(F.col("salaried")).alias("salaried_employment"))


def employment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """geo × sector × month total employment, with the ``ALL`` sector row."""
    return _employment_agg(spark, sf_dir).drop("salaried_employment")


def thresholds(spark: SparkSession, sf_dir: str, quarterly_df: DataFrame | None = None) -> DataFrame:
    """Per-geo wage threshold: 1.05 × the geo's median offered wage."""
    q = quarterly_df if quarterly_df is not None else quarterly(spark, sf_dir)
    return (q.groupBy("geo")
             .agg(F.percentile(F.col("avg_offered_hourly_wage"), F.lit(0.5)).alias("median_wage"))
             .select("geo",
                     (F.col("median_wage") * F.lit(spec.FIXTURE_THRESHOLD_FACTOR)).alias("lmia_high_wage_threshold"),
                     F.date_format(F.lit(spec.FIXTURE_AS_OF).cast("date"), "d/M/yyyy").alias("effective_date"),
                     F.lit("derived").alias("source")))


def _as_text(c: str) -> Column:
    # raw files carry suppressed values as empty strings
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def monthly_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-shaped long form of ``monthly``: REF_DATE yyyy-MM, VALUE as text."""
    m = monthly(spark, sf_dir)
    wide = m.select(
        F.date_format("date_parsed", "yyyy-MM").alias("REF_DATE"), F.col("geo").alias("GEO"),
        _as_text("job_vacancies").alias(spec.STAT_VACANCIES),
        _as_text("job_vacancy_rate").alias(spec.STAT_RATE),
        _as_text("payroll_employees").alias(spec.STAT_PAYROLL))
    return wide.unpivot(["REF_DATE", "GEO"], spec.MONTHLY_STATISTICS, "Statistics", "VALUE")


def quarterly_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-shaped long form of ``quarterly`` with the NAICS label column."""
    q = quarterly(spark, sf_dir)
    wide = q.select(
        F.date_format("date_parsed", "yyyy-MM").alias("REF_DATE"), F.col("geo").alias("GEO"),
        F.col("naics").alias(spec.NAICS_LABEL_COL),
        _as_text("avg_offered_hourly_wage").alias(spec.STAT_WAGE),
        _as_text("job_vacancies").alias(spec.STAT_VACANCIES),
        _as_text("job_vacancy_rate").alias(spec.STAT_RATE),
        _as_text("payroll_employees").alias(spec.STAT_PAYROLL))
    return wide.unpivot(["REF_DATE", "GEO", spec.NAICS_LABEL_COL], spec.QUARTERLY_STATISTICS,
                        "Statistics", "VALUE")


def employment_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-shaped long form of ``employment`` with two employee types."""
    e = _employment_agg(spark, sf_dir)
    wide = e.select(
        F.date_format("date_parsed", "yyyy-MM").alias("REF_DATE"), F.col("geo").alias("GEO"),
        F.col("naics").alias(spec.NAICS_LABEL_COL),
        _as_text("total_employment").alias(spec.ALL_EMPLOYEES),
        _as_text("salaried_employment").alias(spec.FIXTURE_SECOND_EMPLOYEE_TYPE))
    return wide.unpivot(["REF_DATE", "GEO", spec.NAICS_LABEL_COL],
                        [spec.ALL_EMPLOYEES, spec.FIXTURE_SECOND_EMPLOYEE_TYPE],
                        spec.EMPLOYEE_TYPE_COL, "VALUE")
