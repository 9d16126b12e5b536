"""End-to-end jobs over files and catalog tables (the three entry points).

* ``ingest_job``   raw CSV folders → cleaned long Parquet, partitioned by Year/GEO
* ``curate_job``   cleaned long → curated wide Parquet, export gates enforced
* ``register_job`` curated Parquet → catalog tables with snake_case names, gates enforced
* ``marts_job``    catalog tables → staging views and the three mart tables
* ``forecast_job`` quarterly mart → feature table, models, predictions, run log

Every step is lazy DataFrame work ending in a write; gates are counted while
a table is written, and it replaces the old one only if they pass. Only gate
reports (one row per rule) and model metrics reach the driver.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import spec
from strata.operators import quality as Q
from strata.plans import clean as CL
from strata.plans import curate as CU
from strata.plans import features as FE
from strata.plans import marts as M
from strata.plans import stage as ST
from strata.plans.rules import UNIQUE, with_unique_key
from strata.sources import io
from strata.sources import publish as PB

FEEDS = ("monthly", "quarterly", "employment")


def ingest_job(spark: SparkSession, raw: Mapping[str, str], out: str,
               since: str = "2015-01") -> dict[str, str]:
    """Clean the three raw feeds and write them partitioned by Year/GEO."""
    schemas = {"monthly": spec.RAW_MONTHLY_SCHEMA, "quarterly": spec.RAW_QUARTERLY_SCHEMA,
               "employment": spec.RAW_EMPLOYMENT_SCHEMA}
    cleaners = {"monthly": CL.clean_monthly, "quarterly": CL.clean_quarterly,
                "employment": lambda df: CL.clean_employment(df, since=since)}
    paths = {}
    for feed in FEEDS:
        df = cleaners[feed](io.read_raw_csv(spark, raw[feed], schemas[feed]))
        paths[feed] = f"{out.rstrip('/')}/{feed}_processed"
        io.write_partitioned(df, paths[feed])
    return paths


def curate_job(spark: SparkSession, processed: Mapping[str, str], out: str) -> dict[str, str]:
    """Pivot the vacancy feeds, rename employment, enforce the export gates
    (strict columns, critical not-null, unique keys, row reconciliation)."""
    specs = {
        "monthly": (CU.curate_monthly, CU.MONTHLY_KEYS, spec.MONTHLY_STATISTICS, 3),
        "quarterly": (CU.curate_quarterly, CU.QUARTERLY_KEYS, spec.QUARTERLY_STATISTICS, 4),
        "employment": (CU.curate_employment, CU.EMPLOYMENT_KEYS, [spec.STAT_EMPLOYMENT], 1),
    }
    paths = {}
    for feed, (fn, keys, stats, factor) in specs.items():
        clean = io.read_partitioned_parquet(spark, processed[feed])
        if not Q.check_nonempty(clean):
            raise AssertionError(f"{feed}: no rows in {processed[feed]}")
        watched, seen = PB.counted(clean, feed)
        cur = fn(watched)
        gate = Q.check_columns(cur, keys + list(stats), strict=True)
        if not gate["ok"]:
            raise AssertionError(f"{feed}: column check failed: {gate}")
        paths[feed] = f"{out.rstrip('/')}/{feed}_curated"
        PB.publish_partitioned(cur, paths[feed], [*[Q.NotNull(c) for c in keys], Q.UniqueKey(tuple(keys))], before=(clean, seen), factor=factor)
    return paths


def register_job(spark: SparkSession, curated: Mapping[str, str], schema: str) -> dict[str, str]:
    """Rename to catalog names, gate, and save as tables in ``schema``."""
    io.create_schema(spark, schema)
    tables = {}
    for feed in FEEDS:
        df = CU.to_catalog(io.read_partitioned_parquet(spark, curated[feed]))
        key = UNIQUE[f"stage_{feed}"]          # critical columns: not null, unique together
        name = f"{schema}.{feed}_curated"
        PB.publish_table(df, name, [Q.NotNull(c) for c in key] + [Q.UniqueKey(key)])
        tables[feed] = name
    return tables


def marts_job(spark: SparkSession, tables: Mapping[str, str], thresholds: DataFrame, as_of: str,
              schema: str, digital=spec.DIGITAL_NAICS, aggregate: str = spec.AGGREGATE_NAICS) -> dict[str, str]:
    """Staging views and the three mart tables, each gated by its declared tests."""
    stages = {
        "stg_monthly_vacancies": ST.stage_monthly(spark.table(tables["monthly"])),
        "stg_quarterly_vacancies": ST.stage_quarterly(spark.table(tables["quarterly"])),
        "stg_naics_employed": ST.stage_employment(spark.table(tables["employment"])),
    }
    for name, df in stages.items():
        io.materialize(df, name, "view")
    marts = {
        "mart_monthly_labour_metrics": ("mart_monthly", M.mart_monthly(stages["stg_monthly_vacancies"])),
        "mart_quarterly_sector_metrics": ("mart_quarterly", M.mart_quarterly(
            stages["stg_quarterly_vacancies"], thresholds, as_of, threshold_max_rows=10_000)),
        "mart_naics_employment_trends": ("mart_employment", M.mart_employment(
            stages["stg_naics_employed"], digital, aggregate)),
    }
    out = {}
    for name, (model, df) in marts.items():
        table = f"{schema}.{name}"
        PB.publish_table(df, table, with_unique_key(model))
        out[name] = table
    return out


def forecast_job(spark: SparkSession, mart_table: str, schema: str, start: str, cutoff: str,
                 exclude_geos=spec.EXCLUDE_GEOS, flag_windows: Mapping | None = None,
                 params: Mapping | None = None, model_dir: str | None = None, val_cutoff: str | None = None,
                 search_trials: int = 0, diagnostics: bool = False) -> dict[str, str]:
    """Feature table, one model per target (evaluated on the temporal test
    slice against the naive baselines, refitted on all rows), recursive
    predictions and the run log, all saved as tables.

    ``flag_windows`` defaults to the published event windows. Runs are appended to the log.
    With ``search_trials`` the parameters are searched on the rows between ``val_cutoff`` and ``cutoff``
    (trials saved as a table) instead of taken from ``params``; ``diagnostics`` adds tables of the ablation on the same
    slice, the permutation importance on the test rows, and each row's feature attributions.
    The fitted models are saved under ``model_dir`` (a shared folder) where one is given."""
    import uuid

    from strata.forecasting import boosting as B
    from strata.forecasting import evaluate as EV
    from strata.forecasting import models as MD
    from strata.forecasting.recursive import recursive_forecast
    from strata.forecasting.runlog import append_run_log, run_log, save_predictions

    if (search_trials or diagnostics) and val_cutoff is None:
        raise ValueError("search_trials and diagnostics need val_cutoff")
    feats = FE.ml_features(FE.materialized(spark.table(mart_table)), start, exclude_geos,
                           spec.EVENT_WINDOWS if flag_windows is None else flag_windows)
    ftable = f"{schema}.ml_quarterly_features"
    io.save_table(feats, ftable)
    feats = spark.table(ftable)
    out = {"features": ftable}
    logs = None
    for target in (spec.VAC, spec.WAGE):
        short = "vacancies" if target == spec.VAC else "wage"
        fs = EV.feature_set(target)
        split = EV.temporal_split(feats, "date_parsed", target, cutoff, val_cutoff or cutoff)
        train, test = split.filter("split = 'train'"), split.filter("split = 'test'")
        fitting, validating = train.filter("tuning = 'fit'"), train.filter("tuning = 'validate'")
        val_rmse = None
        if search_trials:
            out[f"search_{target}"] = f"{schema}.search_{short}"
            io.save_table(EV.random_search(fitting, validating, fs, target, n_trials=search_trials), out[f"search_{target}"])
            best = spark.table(out[f"search_{target}"]).orderBy("pruned", "val_rmse", "trial").first().asDict()
            p, val_rmse = {k: int(best[k]) if isinstance(spec.SEARCH_SPACE[k][0], int) else best[k] for k in spec.SEARCH_SPACE}, best["val_rmse"]
        else:
            p = (params or spec.PUBLISHED_PARAMS)[target]
            if val_cutoff:
                frame = EV.training_frame(fitting, fs, target)
                job = B.Job(p, list(range(len(fs))))
                curve = B.fit_many(frame, [job], B.like(frame, validating, target), max(1, int(job.params["n_estimators"])), forests=False)[0][1]
                val_rmse = curve[-1] if curve else None
        model = EV.fit(EV.training_frame(train, fs, target), p)
        scores = {name: EV.forecast_metrics(MD.predict(model, rows), target, "prediction", (), None).first().asDict()
                  for name, rows in (("train", train), ("test", test))}
        naive = {r.predictor: r.rmse for r in
                 EV.naive_baseline(feats, "date_parsed", target, cutoff).collect()}
        final = EV.fit(EV.training_frame(split, fs, target), p)
        pred = recursive_forecast(final, feats, ["geo", "naics"], "date_parsed", target)
        ptable = f"{schema}.predictions_{short}"
        save_predictions(pred, ptable)
        out[target] = ptable
        if diagnostics:
            tables = {"ablation": EV.ablation(fitting, validating, fs, target, p),
                      "permutation": EV.permutation_importance(model, test, fs, target, spec.PERMUTATION_REPEATS),
                      "attributions": MD.attributions(final, split, ["geo", "naics", "date_parsed"])}
            for name, df in tables.items():
                out[f"{name}_{target}"] = f"{schema}.{name}_{short}"
                io.save_table(df, out[f"{name}_{target}"])
        test_rmse = scores["test"]["rmse"]
        metrics = {**{f"{s}_{k}": m[k] for s, m in scores.items() for k in ("rmse", "mae", "mape", "r2")}, **{f"{k}_rmse": v for k, v in naive.items()},
                   **{f"rmse_vs_{k}_pct": EV.rmse_reduction_pct(test_rmse, v) for k, v in naive.items() if v and test_rmse is not None},
                   "val_rmse": val_rmse}
        known = set(spec.FEATURES[target])
        dropped = sorted(c for c in FE.feature_columns() if c not in known)
        tags = {"trees": len(final.forest), "target": target, "start": start, "cutoff": cutoff, "train_cutoff": cutoff, "val_cutoff": val_cutoff,
                "features": ",".join(fs), "features_dropped": ",".join(dropped), "n_search_trials": search_trials}
        run = f"{target}_gbt-{uuid.uuid4().hex[:12]}"
        if model_dir:
            tags["model"] = f"{model_dir.rstrip('/')}/{run}"
            final.save(spark, tags["model"])
            out[f"model_{target}"] = tags["model"]
        log = run_log(spark, run, p, metrics, tags)
        logs = log if logs is None else logs.unionByName(log)
    append_run_log(logs, f"{schema}.run_log")
    out["run_log"] = f"{schema}.run_log"
    return out
