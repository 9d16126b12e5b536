"""Multi-step forecasts for every series at once."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import spec
from strata.forecasting.boosting import Model, _matrix, codes_of
from strata.functions.expressions import cycle_features
from strata.operators.windows import series_tail


def seasonal_naive_forecast(df: DataFrame, keys: Sequence[str], t: str, value: str,
                            horizon: int = 4, season: int = 4,
                            step_months: int = spec.FORECAST_STEP_MONTHS,
                            model: str = "seasonal_naive") -> DataFrame:
    """Recursive forecast with ŷ(T+h) = y(T+h−season), predictions feeding
    later steps: step h takes lag ``season − ((h−1) mod season)`` of the
    series tail. One window pass (tail) and one ``explode``; rows
    ``date_parsed, keys…, predicted_<value>, model, forecast_horizon_quarters``.
    """
    tail = series_tail(df, keys, t, value, k=season, rolls=(), prefix="__y")
    steps = [F.struct(F.lit(h).alias("h"),
                      F.col(f"__y_lag{season - ((h - 1) % season)}").alias("yhat"))
             for h in range(1, horizon + 1)]
    out = tail.select(*keys, "last_date", F.explode(F.array(*steps)).alias("__s"))
    return out.select(
        F.add_months("last_date", F.col("__s.h") * step_months).alias(t),
        *keys,
        F.col("__s.yhat").alias(f"predicted_{value}"),
        F.lit(model).alias("model"),
        F.col("__s.h").cast("int").alias("forecast_horizon_quarters"))


def recursive_forecast(model: Model, features_df: DataFrame, keys: Sequence[str], t: str, target: str,
                       horizon: int = spec.FORECAST_HORIZON, measures: Sequence[str] = (spec.VAC, spec.WAGE),
                       flag_names: Sequence[str] = ("is_covid", "is_post_covid_boom"),
                       carry: Sequence[str] = ("geo_encoded", "naics_encoded"),
                       model_name: str = "gbt_regressor", depth: int = max(spec.LAGS)) -> DataFrame:
    """``horizon`` steps ahead for every series; each prediction becomes the
    newest value of the target for the next step (the other measure is
    unknown there, so its newest lags turn NULL as the horizon grows).

    A series becomes one row with the last ``depth`` values of each measure;
    all its steps run in one stage: the task keeps the values as arrays,
    makes the features of a step for all its series at once, scores them and
    puts the prediction in front. Nothing is written between the steps.
    Calendar-event dummies are unknown for the future and fixed to 0.
    """
    keys = list(keys)
    state = None
    for i, m in enumerate(measures):
        tail = series_tail(features_df, keys, t, m, k=depth, rolls=())
        tail = tail.select(*keys, *([F.col("last_date")] if i == 0 else []), F.array(*[F.col(f"{m}_lag{k}").cast("double") for k in range(1, depth + 1)]).alias(f"__m{i}"))
        state = tail if state is None else state.join(tail, keys)
    consts = features_df.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).cast("double").alias(f"__c{i}") for i, c in enumerate(carry)])
    state = state.join(consts, keys)
    dates = [F.add_months("last_date", spec.FORECAST_STEP_MONTHS * h) for h in range(1, horizon + 1)]
    names = list(cycle_features(t, spec.QUARTER_PERIOD))
    state = state.withColumn("__dates", F.array(*dates)).withColumns(
        {f"__q{i}": F.array(*[cycle_features(d, spec.QUARTER_PERIOD)[n].cast("double") for d in dates]) for i, n in enumerate(names)})
    wanted = list(model.features)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tails = {m: _matrix(b.column(f"__m{i}"), depth) for i, m in enumerate(measures)}
            fixed = {c: b.column(f"__c{i}").cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False) for i, c in enumerate(carry)}
            fixed |= {f: np.zeros(b.num_rows) for f in flag_names}
            calendar = {n: _matrix(b.column(f"__q{i}"), horizon) for i, n in enumerate(names)}
            out = np.empty((b.num_rows, horizon))
            for h in range(horizon):
                known = fixed | {n: c[:, h] for n, c in calendar.items()}
                for m, values in tails.items():
                    known |= {f"{m}_lag{k}": values[:, k - 1] for k in range(1, depth + 1)}
                    known |= {f"{m}_roll{n}": values[:, :n].mean(axis=1) for n in spec.ROLLS if n <= depth}
                x = np.column_stack([known[f] for f in wanted]) if wanted else np.zeros((b.num_rows, 0))
                out[:, h] = model.margins(codes_of(x, model.cuts, model.missing))
                for m, values in tails.items():
                    newest = out[:, h] if m == target else np.full(b.num_rows, np.nan)
                    tails[m] = np.column_stack([newest, values[:, :-1]])
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keys], b.column("__dates"), pa.array(list(out), pa.list_(pa.float64()))], [*keys, "__dates", "__yhat"])

    schema = T.StructType([state.schema[k] for k in keys] + [T.StructField("__dates", T.ArrayType(T.DateType())), T.StructField("__yhat", T.ArrayType(T.DoubleType()))])
    done = state.select(*keys, "__dates", *[f"__m{i}" for i in range(len(measures))], *[f"__c{i}" for i in range(len(carry))], *[f"__q{i}" for i in range(len(names))])
    long = done.mapInArrow(steps, schema).select(*keys, F.posexplode(F.arrays_zip(F.col("__dates").alias("d"), F.col("__yhat").alias("y"))).alias("__h", "__s"))
    return long.select(F.col("__s.d").alias(t), *keys, F.when(~F.isnan("__s.y"), F.col("__s.y")).alias(f"predicted_{target}"), F.lit(model_name).alias("model"),
                       (F.col("__h") + 1).alias("forecast_horizon_quarters"))
