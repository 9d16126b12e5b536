"""End-to-end jobs on source-shaped files and catalog tables."""

import math
import os
import random

from strata import spec
from strata.plans import jobs as J
from strata.sources import io
from tests import fixtures as fx


def test_ingest_curate_register_marts(spark, tmp_dir):
    raw = {"monthly": os.path.dirname(fx.write(tmp_dir, "raw/monthly/m.csv", fx.RAW_MONTHLY)),
           "quarterly": os.path.dirname(fx.write(tmp_dir, "raw/quarterly/a.csv", fx.RAW_QUARTERLY_A)),
           "employment": os.path.dirname(fx.write(tmp_dir, "raw/employment/e.csv", fx.RAW_EMPLOYMENT))}
    fx.write(tmp_dir, "raw/quarterly/b.csv", fx.RAW_QUARTERLY_B)
    processed = J.ingest_job(spark, raw, os.path.join(tmp_dir, "processed"))
    curated = J.curate_job(spark, processed, os.path.join(tmp_dir, "curated"))
    tables = J.register_job(spark, curated, "e2e")
    assert spark.table(tables["quarterly"]).count() == 2
    assert set(spark.table(tables["monthly"]).columns) >= {"date_parsed", "geo", "year", "job_vacancies"}
    seed = io.load_threshold_seed(spark, fx.write(tmp_dir, "seed.csv", fx.THRESHOLDS))
    marts = J.marts_job(spark, tables, seed, "2016-01-01", "e2e")
    q = spark.table(marts["mart_quarterly_sector_metrics"]).collect()
    assert len(q) == 2 and all(r.foreign_accessibility_tier in spec.TIER_LABELS for r in q)
    assert spark.table(marts["mart_naics_employment_trends"]).count() == 4
    assert spark.table("stg_monthly_vacancies").count() == 2


def test_forecast_job(spark, tmp_dir):
    rnd = random.Random(5)
    rows = []
    for g in ("G1", "G2"):
        for n in ("N1", "N2"):
            for i, d in enumerate(fx.quarters(2000, 16)):
                rows.append((d, g, d.year, n, 20 + 3 * math.sin(i) + rnd.uniform(-1, 1), 20 + 0.2 * i))
    mart = spark.createDataFrame(rows, "date_parsed date, geo string, year int, naics string, "
                                       "vacancies_per_1000 double, avg_offered_hourly_wage double")
    io.create_schema(spark, "e2e_fc")
    io.save_table(mart, "e2e_fc.mart")
    small = {t: {"eta": 0.3, "max_depth": 2, "n_estimators": 3} for t in (spec.VAC, spec.WAGE)}
    out = J.forecast_job(spark, "e2e_fc.mart", "e2e_fc", "2000-01-01", "2003-01-01", [],
                         {"is_covid": ("2001-01-01", "2001-04-01"),
                          "is_post_covid_boom": ("2002-01-01", "2002-04-01")}, small)
    assert spark.table(out[spec.VAC]).count() == 4 * 4
    log = {(r.kind, r.name) for r in spark.table(out["run_log"]).collect()}
    assert log >= {("metric", f"{s}_{m}") for s in ("train", "test") for m in ("rmse", "mae", "mape", "r2")}
    assert log >= {("metric", "naive_lag4_rmse"), ("metric", "val_rmse"), ("tag", "train_cutoff"), ("tag", "val_cutoff"),
                   ("tag", "features_dropped"), ("tag", "n_search_trials")}


def test_forecast_job_with_search_and_diagnostics(spark, monkeypatch):
    rnd = random.Random(8)
    rows = [(d, g, d.year, n, 20 + 3 * math.sin(i) + rnd.uniform(-1, 1), 20 + 0.2 * i)
            for g in ("G1", "G2") for n in ("N1", "N2") for i, d in enumerate(fx.quarters(2000, 20))]
    mart = spark.createDataFrame(rows, "date_parsed date, geo string, year int, naics string, "
                                       "vacancies_per_1000 double, avg_offered_hourly_wage double")
    io.create_schema(spark, "e2e_fs")
    io.save_table(mart, "e2e_fs.mart")
    monkeypatch.setitem(spec.SEARCH_SPACE, "n_estimators", (2, 4))
    monkeypatch.setattr(spec, "PERMUTATION_REPEATS", 2)
    out = J.forecast_job(spark, "e2e_fs.mart", "e2e_fs", "2000-01-01", "2004-01-01", [], val_cutoff="2003-01-01", search_trials=3, diagnostics=True)
    trials = spark.table(out[f"search_{spec.VAC}"]).collect()
    assert len(trials) == 3 and set(spec.SEARCH_SPACE) <= set(trials[0].asDict())
    log = {(r.run.split("_gbt")[0], r.name): r.value for r in spark.table(out["run_log"]).collect()}
    assert float(log[spec.VAC, "val_rmse"]) == min(t.val_rmse for t in trials if not t.pruned) and log[spec.VAC, "n_search_trials"] == "3"
    assert spark.table(out[f"ablation_{spec.WAGE}"]).count() == 6
    assert spark.table(out[f"permutation_{spec.VAC}"]).count() == 11
    n = spark.table(out["features"]).filter(f"{spec.VAC} is not null").count()
    assert spark.table(out[f"attributions_{spec.VAC}"]).count() == 11 * n


def test_forecast_job_with_defaults_keeps_its_log(spark, tmp_dir):
    rnd = random.Random(6)
    rows = [(d, g, d.year, "N1", 20 + 3 * math.sin(i) + rnd.uniform(-1, 1), 20 + 0.2 * i)
            for g in ("G1", "G2") for i, d in enumerate(fx.quarters(2018, 20))]
    mart = spark.createDataFrame(rows, "date_parsed date, geo string, year int, naics string, "
                                       "vacancies_per_1000 double, avg_offered_hourly_wage double")
    io.create_schema(spark, "e2e_fd")
    io.save_table(mart, "e2e_fd.mart")
    small = {t: {"eta": 0.3, "max_depth": 2, "n_estimators": 2} for t in (spec.VAC, spec.WAGE)}
    for _ in range(2):
        out = J.forecast_job(spark, "e2e_fd.mart", "e2e_fd", "2018-01-01", "2021-10-01", [], params=small, model_dir=tmp_dir)
    log = spark.table(out["run_log"])
    assert log.select("run").distinct().count() == 4
    assert {r["name"] for r in log.collect()} >= {"train_rmse", "test_rmse", "cutoff", "target", "model"}
    from strata.forecasting.boosting import Model
    assert len(Model.load(spark, out[f"model_{spec.VAC}"]).forest) == 2
