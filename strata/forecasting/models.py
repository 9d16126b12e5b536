"""Boosted regression trees with the published parameters (see ``boosting``), their summaries and attributions."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.forecasting import boosting as B
from strata.forecasting.boosting import Model


def fit_boosted_trees(train: DataFrame, features: Sequence[str], target: str, params: Mapping | None = None, seed: int = 0,
                      max_bins: int = B.MAX_BINS, frame_bytes: int = B.FRAME_BYTES) -> Model:
    """Fit on the rows with a known target. NULL and NaN features go to the side of each split that the split chose."""
    return B.fit_one(B.prepare(train, features, target, max_bins), params, seed, frame_bytes=frame_bytes)


def predict(model: Model, df: DataFrame, features: Sequence[str] | None = None, out: str = "prediction") -> DataFrame:
    """Score every row. The columns that the model needs are the ones it was fitted on."""
    return model.predict(df, out)


def feature_importance(model: Model, features: Sequence[str] | None = None) -> list[tuple[str, float]]:
    """Share of each feature in the gain of all splits."""
    gain = np.bincount(model.forest.feature[model.forest.feature >= 0], weights=model.forest.gain[model.forest.feature >= 0],
                       minlength=len(model.features))
    total = gain.sum()
    return [(f, float(g / total) if total else 0.0) for f, g in zip(model.features, gain, strict=True)]


def tree_summary(model: Model) -> list[tuple[int, float, int, int]]:
    """(tree, weight, nodes, depth) of every tree; leaves carry the learning rate, so each weight is 1."""
    f = model.forest.feature
    level = np.floor(np.log2(np.arange(f.shape[1]) + 1)).astype(int)
    return [(t, 1.0, 1 + 2 * int((f[t] >= 0).sum()), int((level[f[t] >= 0] + 1).max(initial=0))) for t in range(len(f))]


# ------------------------------------------------------------ attributions
def leaf_paths(model: Model) -> list[tuple[float, list[tuple[int, float, list[tuple[int, int, bool, bool]]]]]]:
    """For each leaf: its value and, per feature on its path, the share of rows that the feature's splits let through
    when the feature is unknown, and those splits as (feature, cut, missing_left, goes_left)."""
    f, out = model.forest, []
    for t in range(len(f)):
        stack = [(0, [])]
        while stack:
            i, path = stack.pop()
            j = int(f.feature[t, i])
            if j >= 0:
                for child, left in ((2 * i + 1, True), (2 * i + 2, False)):
                    share = f.cover[t, child] / f.cover[t, i] if f.cover[t, i] else 0.0
                    stack.append((child, [*path, (j, int(f.cut[t, i]), bool(f.missing_left[t, i]), left, share)]))
                continue
            merged: dict[int, tuple[float, list]] = {}
            for j, cut, none_left, left, share in path:
                z, splits = merged.get(j, (1.0, []))
                merged[j] = (z * share, [*splits, (j, cut, none_left, left)])
            out.append((float(f.value[t, i]), [(j, z, s) for j, (z, s) in merged.items()]))
    return out


def base_value(model: Model) -> float:
    """The mean prediction over the training rows as each tree drew them."""
    return model.base + sum(v * math.prod(z for _, z, _ in parts) for v, parts in leaf_paths(model))


def shares_of(model: Model, codes: np.ndarray) -> np.ndarray:
    """Exact Shapley value of every feature for binned rows: which part of the prediction each feature adds to the mean.

    Along a leaf's path a known feature lets a row through or not, an unknown one passes its share of the rows. The
    subsets of the other features on the path are summed by size through the coefficients of the product of
    (unknown + known * x), so a path with m features costs m * m steps for all rows.
    """
    out = np.zeros((len(codes), len(model.features)))
    for value, parts in leaf_paths(model):
        m = len(parts)
        if not m or not value:
            continue
        passes = np.empty((m, len(codes)))
        for k, (_, _, splits) in enumerate(parts):
            ok = np.ones(len(codes), bool)
            for j, cut, none_left, goes_left in splits:
                c = codes[:, j]
                ok &= np.where(c == model.missing, none_left, c < cut) == goes_left
            passes[k] = ok
        weights = [math.factorial(s) * math.factorial(m - 1 - s) / math.factorial(m) for s in range(m)]
        for k, (j, z, _) in enumerate(parts):
            poly = [np.ones(len(codes))] + [np.zeros(len(codes))] * (m - 1)
            for other, (_, zo, _) in enumerate(parts):
                if other != k:
                    poly = [poly[0] * zo] + [poly[s] * zo + poly[s - 1] * passes[other] for s in range(1, m)]
            out[:, j] += value * (passes[k] - z) * sum(w * p for w, p in zip(weights, poly, strict=True))
    return out


def attributions(model: Model, df: DataFrame, keys: Sequence[str], out: str = "contribution") -> DataFrame:
    """One row per input row and feature: keys, feature, contribution, base, prediction.

    Contributions of a row and the base add up to its prediction. Rows are taken where they lie; the leaf paths
    (leaves times depth) travel with the task.
    """
    values = F.array(*[F.col(f"`{f}`").cast("double") for f in model.features]) if model.features else F.array().cast("array<double>")
    base, width = base_value(model), len(model.features)
    rows = df.select(*[F.col(f"`{k}`") for k in keys], values.alias("__x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                part = b.slice(i, 2048)
                codes = B.codes_of(B._matrix(part.column("__x"), width), model.cuts, model.missing)
                shares = shares_of(model, codes)
                yield pa.RecordBatch.from_arrays([*[part.column(k) for k in keys], pa.array(list(shares), pa.list_(pa.float64())),
                                                  pa.array(model.margins(codes))], [*keys, "__c", "prediction"])

    schema = T.StructType([rows.schema[k] for k in keys] + [T.StructField("__c", T.ArrayType(T.DoubleType())), T.StructField("prediction", T.DoubleType())])
    named = F.array(*[F.lit(f) for f in model.features]) if model.features else F.array().cast("array<string>")
    long = rows.mapInArrow(run, schema).withColumn("__p", F.explode(F.arrays_zip(named.alias("feature"), F.col("__c"))))
    return long.select(*[F.col(f"`{k}`") for k in keys], F.col("__p.feature").alias("feature"), F.col("__p.__c").alias(out), F.lit(base).alias("base"), "prediction")
