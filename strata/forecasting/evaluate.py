"""Temporal split, metrics, baselines and model diagnostics on Spark.

All metrics are one grouped aggregate over (actual, prediction) rows — no
rows travel to the driver. Only per-feature/per-trial scalars (a bounded
handful) are collected, to build result tables.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import spec
from strata.forecasting import boosting as B
from strata.forecasting import models as MD
from strata.forecasting.search import search
from strata.functions.expressions import nullif_zero
from strata.operators.ordering import numbered
from strata.session import cut_lineage

def feature_set(target: str) -> list[str]:
    """The chosen feature list of a target (11 for vacancies, 6 for wage)."""
    return list(spec.FEATURES[target])


def temporal_split(df: DataFrame, t: str, target: str, cutoff: str, val_cutoff: str) -> DataFrame:
    """Label rows with a known target: ``split`` = train (t < cutoff) / test,
    and within train ``tuning`` = fit (t < val_cutoff) / validate. Never random."""
    c, v = F.lit(cutoff).cast("date"), F.lit(val_cutoff).cast("date")
    return (df.filter(F.col(target).isNotNull())
              .withColumns({
                  "split": F.when(F.col(t) < c, F.lit("train")).otherwise(F.lit("test")),
                  "tuning": F.when(F.col(t) < v, F.lit("fit"))
                             .when(F.col(t) < c, F.lit("validate"))}))


def _metric_aggs(y: Column, yhat: Column, digits: int | None) -> list[Column]:
    err = y - yhat
    n = F.count(F.lit(1))
    aggs = {
        "n": n,
        "rmse": F.sqrt(F.avg(err * err)),
        "mae": F.avg(F.abs(err)),
        "mape": F.avg(F.abs(err / nullif_zero(y))) * F.lit(100),
        "r2": F.lit(1) - F.sum(err * err) / (n * F.var_pop(y)),
    }
    out = []
    for k, e in aggs.items():
        if digits is not None and k != "n":
            e = F.round(e, digits)
        out.append(e.alias(k))
    return out


def forecast_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = (),
                     digits: int | None = 9) -> DataFrame:
    """RMSE, MAE, MAPE (%), R² per group over rows where both values exist.

    R² = 1 − Σ(y−ŷ)² / (n·var_pop(y)); MAPE divides by y and skips y = 0.
    Rounded to ``digits`` decimals so that results do not depend on the
    summation order of partial aggregates.
    """
    rows = df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    return rows.groupBy(*by).agg(*_metric_aggs(F.col(y), F.col(yhat), digits))


def naive_baseline(df: DataFrame, t: str, targets: str | Sequence[str], cutoff: str,
                   lags: Sequence[int] = (1, 4), digits: int | None = 9) -> DataFrame:
    """Metrics of the lag-k predictors (``{target}_lag{k}`` columns of the
    feature table) on the test rows (t ≥ cutoff, target known), for every
    target and lag in one scan: rows are exploded to (target, predictor,
    y, ŷ) and the metrics are one grouped aggregate."""
    targets = [targets] if isinstance(targets, str) else list(targets)
    test = df.filter(F.col(t) >= F.lit(cutoff).cast("date"))
    pairs = F.array(*[F.struct(F.lit(tg).alias("target"), F.lit(f"naive_lag{k}").alias("predictor"),
                               F.col(tg).cast("double").alias("y"),
                               F.col(f"{tg}_lag{k}").cast("double").alias("yhat"))
                      for tg in targets for k in lags])
    long = test.select(F.explode(pairs).alias("p")).select("p.*")
    return forecast_metrics(long, "y", "yhat", ["target", "predictor"], digits)


def rmse_reduction_pct(model_rmse: float, baseline_rmse: float) -> float:
    """(model − baseline) / baseline × 100 (negative = model better)."""
    return (model_rmse - baseline_rmse) / baseline_rmse * 100.0


# ------------------------------------------------------------- training data
def training_frame(df: DataFrame, features: Sequence[str], target: str, max_bins: int = B.MAX_BINS) -> B.Frame:
    """The rows with a known target, binned and stored once; every fit on them reads only bin numbers."""
    return B.prepare(df, features, target, max_bins)


def fit(train: B.Frame, params: Mapping | None = None, seed: int = 0) -> B.Model:
    """Fit one model on an already prepared frame."""
    return B.fit_one(train, params, seed)


def rmse_of(model: B.Model, df: DataFrame, target: str) -> float:
    scored = MD.predict(model, df)
    r = forecast_metrics(scored, target, "prediction", (), None).select("rmse").first()
    return float(r["rmse"]) if r and r["rmse"] is not None else float("nan")


def ablation(train: DataFrame, valid: DataFrame, features: Sequence[str], target: str,
             params: Mapping | None = None, seed: int = 0, frame_bytes: int = B.FRAME_BYTES) -> DataFrame:
    """Drop one feature, refit, ΔRMSE = baseline − ablated on ``valid``.

    Negative ΔRMSE means removing the feature hurt (the feature helped). The model with all features and those
    without one are grown side by side on the same bins, each with the whole number of trees.
    """
    feats = list(features)
    frame = training_frame(train, feats, target)
    p = B.full_params(params)
    columns = range(len(feats))
    jobs = [B.Job(p, list(columns), seed)] + [B.Job(p, [c for c in columns if c != d], seed) for d in columns]
    fits = B.fit_many(frame, jobs, B.like(frame, valid, target), every=max(1, p["n_estimators"]), forests=False, frame_bytes=frame_bytes)
    base, *rest = [curve[-1] if curve else float("nan") for _, curve, _ in fits]
    rows = [(f, base, r, base - r, trees) for f, r, (_, _, trees) in zip(feats, rest, fits[1:], strict=True)]
    return train.sparkSession.createDataFrame(rows, "feature string, baseline_rmse double, ablated_rmse double, rmse_diff double, trees int")


def permutation_importance(model, test: DataFrame, features: Sequence[str], target: str,
                           n_repeats: int = 30, seed: int = 0) -> DataFrame:
    """Mean and deviation of the RMSE increase when one feature is shuffled.

    Each (feature, repeat) is one permutation of the whole test set, whatever its size or
    partitioning: rows are numbered once, all copies of (row, value) are numbered in the order of
    a seeded hash, and a copy's place within its (feature, repeat) names the row that gets the
    value. Only row number and value are sorted; full rows move once, to meet the values.
    """
    feats = list(features)
    spark = test.sparkSession
    base_rows = cut_lineage(test.filter(F.col(target).isNotNull()), "perm-test")
    base_rmse = rmse_of(model, base_rows, target)
    n = base_rows.count()
    content = sorted(base_rows.columns)
    rid = F.xxhash64(*[F.col(c).cast("string") for c in content])
    rows = cut_lineage(numbered(base_rows.withColumn("__rid", rid), ["__rid", *content], "__pos"), "perm-rows").drop("__rid")
    copies = rows.select("__pos", F.posexplode(F.array(*[F.col(f).cast("double") for f in feats])).alias("__feat_no", "__pval"))
    copies = copies.withColumn("__rep", F.explode(F.sequence(F.lit(0), F.lit(n_repeats - 1))))
    copies = copies.withColumn("__order", F.xxhash64("__pos", "__feat_no", "__rep", F.lit(seed)))
    shuffled = numbered(copies, ["__feat_no", "__rep", "__order", "__pos"], "__nth")
    name = F.element_at(F.array(*[F.lit(f) for f in feats]), F.col("__feat_no") + 1)
    donors = shuffled.select(name.alias("__feat"), "__rep", F.expr(f"__nth % {max(n, 1)}").alias("__pos"), "__pval")
    permuted = rows.join(donors, "__pos")
    permuted = permuted.withColumns({f: F.when(F.col("__feat") == f, F.col("__pval")).otherwise(F.col(f))
                                     for f in feats})
    scored = MD.predict(model, permuted.drop("__pval", "__pos"))
    per_copy = forecast_metrics(scored, target, "prediction", ["__feat", "__rep"], None)
    inc = per_copy.withColumn("increase", F.col("rmse") - F.lit(base_rmse))
    return (inc.groupBy(F.col("__feat").alias("feature"))
               .agg(F.avg("increase").alias("importance_mean"),
                    F.stddev_samp("increase").alias("importance_std"),
                    F.count(F.lit(1)).alias("repeats"))
               .withColumn("baseline_rmse", F.lit(base_rmse)))


def random_search(train: DataFrame, valid: DataFrame, features: Sequence[str], target: str,
                  space: Mapping[str, tuple] = spec.SEARCH_SPACE, n_trials: int = spec.PUBLISHED_SEARCH_TRIALS, seed: int = 0,
                  round_size: int = 25, every: int = 25, frame_bytes: int = B.FRAME_BYTES) -> DataFrame:
    """Search for the parameters with the smallest RMSE on the *temporal* validation slice.

    Draws are guided by earlier trials and bad trials are stopped early (see ``search``). One row per trial, finished
    ones first: its parameters, validation RMSE (where it stopped), number of trees and whether it was pruned.
    """
    feats = list(features)
    frame = training_frame(train, feats, target)
    held = B.like(frame, valid, target)

    def run(trials):
        jobs = [B.Job(p, list(range(len(feats))), seed, limits) for p, limits in trials]
        return [(curve, trees) for _, curve, trees in B.fit_many(frame, jobs, held, every, forests=False, frame_bytes=frame_bytes)]

    trials = search(run, space, n_trials, seed, round_size, uniform=round_size)
    keys = sorted(space)
    rows = [(t.number, *[float(t.params[k]) for k in keys], t.rmse, t.trees, t.pruned) for t in trials]
    schema = T.StructType([T.StructField("trial", T.IntegerType())] + [T.StructField(k, T.DoubleType()) for k in keys] +
                          [T.StructField("val_rmse", T.DoubleType()), T.StructField("trees", T.IntegerType()), T.StructField("pruned", T.BooleanType())])
    return train.sparkSession.createDataFrame(rows, schema).orderBy("pruned", "val_rmse", "trial")
