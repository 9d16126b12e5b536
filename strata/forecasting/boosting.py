"""Gradient-boosted regression trees on Spark: histograms, many models at once.

Features are cut into quantile bins (exact order statistics by counting), a missing value has a bin of its own. A
model grows its trees level by level: per node, feature and bin the gradients and rows are summed, every cut is tried
with the missing values on either side, and the best one is kept. Leaves have L1 and L2 penalties (``reg_alpha``,
``reg_lambda``), rows and columns are drawn anew for each tree.

Two ways grow the same trees:

* ``by level``: one Spark job per tree level for *all* models together. Tasks sum their rows into (model, node,
  feature, bin) cells, the cells are added by key, and each node's best split is found in its group; only splits
  reach the driver. Works at any number of rows.
* ``by model``: where the binned frame is small (``frame_bytes``, counted before it is broadcast), each task grows
  whole models on the broadcast frame, so a search or an ablation runs its fits side by side.

Gradients are rounded to a unit so small that sums stay exact integers in doubles: the sums, and so the trees, are
the same for every partitioning and on both ways. Draws are hashes of (seed, tree, row or column).
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.ordering import numbered, running_sums
from strata.session import cut_lineage

DEFAULT_PARAMS = {"eta": 0.3, "max_depth": 6, "subsample": 1.0, "colsample_bytree": 1.0, "n_estimators": 100,
                  "reg_alpha": 0.0, "reg_lambda": 1.0, "min_child_weight": 1.0, "gamma": 0.0}
MAX_BINS = 256
#: Largest binned frame that is broadcast to grow whole models in tasks.
FRAME_BYTES = 64 << 20
#: A split must gain more than this.
LEAST_GAIN = 1e-6
U64 = np.uint64


def full_params(params: Mapping | None) -> dict:
    return {**DEFAULT_PARAMS, **(params or {})}


# ------------------------------------------------------------------ draws
def _hash(*parts) -> np.ndarray:
    """Uniform numbers in [0, 1) from integers (arrays or scalars)."""
    with np.errstate(over="ignore"):
        h = U64(0x243F6A8885A308D3)
        for p in parts:
            h = (h ^ np.asarray(p).astype(U64)) * U64(0x9E3779B97F4A7C15)
            h = h ^ (h >> U64(29))
            h = h * U64(0xBF58476D1CE4E5B9)
            h = h ^ (h >> U64(32))
    return (h >> U64(11)).astype(np.float64) / float(1 << 53)


def drawn_rows(pos: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    return np.ones(len(pos), bool) if share >= 1 else _hash(seed, tree, 1, pos) < share


def drawn_columns(columns: Sequence[int], tree: int, seed: int, share: float) -> list[int]:
    n = max(1, int(share * len(columns)))
    order = np.argsort(_hash(seed, tree, 2, np.asarray(columns)), kind="stable")
    return sorted(columns[i] for i in order[:n])


# ------------------------------------------------------------------- trees
class Forest:
    """Trees as arrays over (tree, node); node i has the children 2i+1 and 2i+2, a leaf the feature -1."""

    FIELDS = {"feature": np.int32, "cut": np.int32, "missing_left": bool, "value": np.float64, "gain": np.float64, "cover": np.float64}

    def __init__(self, trees: int, depth: int):
        self.depth = depth
        nodes = (1 << (depth + 1)) - 1
        for name, kind in self.FIELDS.items():
            setattr(self, name, np.full((trees, nodes), -1 if name == "feature" else 0, kind))

    def __len__(self) -> int:
        return len(self.feature)

    def keep(self, trees: int) -> "Forest":
        out = Forest(0, self.depth)
        for name in self.FIELDS:
            setattr(out, name, getattr(self, name)[:trees])
        return out

    def step(self, tree: int, node: np.ndarray, codes: np.ndarray, missing: int) -> np.ndarray:
        """Send rows one level down; rows in leaves stay."""
        f = self.feature[tree, node]
        inner = np.flatnonzero(f >= 0)
        at = node[inner]
        code = codes[inner, f[inner]]
        left = np.where(code == missing, self.missing_left[tree, at], code < self.cut[tree, at])
        out = node.copy()
        out[inner] = 2 * at + 2 - left
        return out

    def add(self, tree: int, codes: np.ndarray, missing: int, margin: np.ndarray) -> None:
        node = np.zeros(len(codes), np.int64)
        for _ in range(self.depth):
            node = self.step(tree, node, codes, missing)
        margin += self.value[tree, node]

    def split(self, tree: int, node: int, best: dict, p: Mapping) -> None:
        """Turn a leaf into an inner node with the leaves ``best`` gives it."""
        self.feature[tree, node], self.cut[tree, node] = best["feature"], best["cut"]
        self.missing_left[tree, node], self.gain[tree, node] = best["missing_left"], best["gain"]
        for child, g, h in ((2 * node + 1, best["gl"], best["hl"]), (2 * node + 2, best["gr"], best["hr"])):
            self.leaf(tree, child, g, h, p)

    def leaf(self, tree: int, node: int, g: float, h: float, p: Mapping) -> None:
        self.value[tree, node] = p["eta"] * leaf_weight(g, h, p)
        self.cover[tree, node] = h


def _shrunk(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def leaf_weight(g: float, h: float, p: Mapping) -> float:
    return float(-_shrunk(g, p["reg_alpha"]) / (h + p["reg_lambda"])) if h + p["reg_lambda"] > 0 else 0.0


def best_splits(g: np.ndarray, h: np.ndarray, columns: Sequence[int], p: Mapping) -> list[dict | None]:
    """The best split of each node, or None. ``g`` and ``h``: (node, column, bin) sums, the last bin being the missing values.

    Among equal gains the first column, the smallest cut and missing values on the right win.
    """
    total_g, total_h = g[:, 0].sum(axis=1)[:, None, None], h[:, 0].sum(axis=1)[:, None, None]

    def score(a, b):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(b + p["reg_lambda"] > 0, _shrunk(a, p["reg_alpha"]) ** 2 / (b + p["reg_lambda"]), 0.0)

    left_g, left_h = g[:, :, :-1].cumsum(axis=2), h[:, :, :-1].cumsum(axis=2)
    none_g, none_h = g[:, :, -1:], h[:, :, -1:]
    gains = np.empty((*left_g.shape, 2))
    for side, (a, b) in enumerate(((left_g, left_h), (left_g + none_g, left_h + none_h))):
        gain = score(a, b) + score(total_g - a, total_h - b) - score(total_g, total_h)
        least = max(p["min_child_weight"], np.finfo(float).tiny)
        gains[..., side] = np.where((b >= least) & (total_h - b >= least), gain, -np.inf)
    out: list[dict | None] = []
    best = gains.reshape(len(g), -1).argmax(axis=1)
    for i, at in enumerate(best):
        column, rest = divmod(int(at), gains.shape[2] * 2)
        cut, side = divmod(rest, 2)
        gain = gains[i, column, cut, side]
        if not gain > max(LEAST_GAIN, p["gamma"]):
            out.append(None)
            continue
        gl = left_g[i, column, cut] + (none_g[i, column, 0] if side else 0.0)
        hl = left_h[i, column, cut] + (none_h[i, column, 0] if side else 0.0)
        out.append({"feature": columns[column], "cut": cut + 1, "missing_left": bool(side), "gain": float(gain), "gl": float(gl), "hl": float(hl),
                    "gr": float(total_g[i, 0, 0] - gl), "hr": float(total_h[i, 0, 0] - hl)})
    return out


# ------------------------------------------------------------------- frames
@dataclass
class Frame:
    """Binned training rows: ``rows`` (pos, y, codes), their number, cut points per feature, mean and gradient unit."""

    rows: DataFrame
    n: int
    features: list[str]
    cuts: list[np.ndarray]
    base: float
    unit: float

    @property
    def bins(self) -> int:
        return max((len(c) for c in self.cuts), default=0) + 1

    @property
    def bytes(self) -> int:
        return self.n * (16 + 2 * len(self.features))


def _doubles(df: DataFrame, features: Sequence[str], target: str | None) -> DataFrame:
    clean = lambda c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))
    cols = [F.array(*[clean(f) for f in features]).alias("x")] if features else [F.array().cast("array<double>").alias("x")]
    if target is not None:
        cols.append(clean(target).alias("y"))
    out = df.select(*cols)
    return out.where("y is not null") if target is not None else out


def quantile_cuts(rows: DataFrame, n_features: int, max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Ascending cut points of each entry of ``x``: between all distinct values where there are at most ``max_bins``,
    else at values whose ranks are evenly spaced. Exact, from counted values; only cuts reach the driver."""
    values = rows.select(F.posexplode("x").alias("f", "v")).where("v is not null")
    counts = values.groupBy("f", "v").agg(F.count("*").alias("n")).withColumn("one", F.lit(1).cast("long"))
    sums = running_sums(counts, ["f"], ["v"], ["n", "one"])
    totals = counts.groupBy(F.col("f").alias("g")).agg(F.sum("n").alias("total"), F.count("*").alias("distinct"))
    rank = F.when(F.col("distinct") <= max_bins, F.col("before_one")).otherwise(F.expr(f"before_n * {max_bins} div total"))
    firsts = sums.join(totals, F.col("f") == F.col("g")).groupBy("f", rank.alias("bin")).agg(F.min("v").alias("v")).collect()
    return [np.array(sorted(r["v"] for r in firsts if r["f"] == i)[1:]) for i in range(n_features)]


def codes_of(x: np.ndarray, cuts: Sequence[np.ndarray], missing: int) -> np.ndarray:
    """Bin numbers of a (row, feature) matrix; NaN gets the bin ``missing``."""
    out = np.empty(x.shape, np.int16)
    for j, c in enumerate(cuts):
        out[:, j] = np.where(np.isnan(x[:, j]), missing, np.searchsorted(c, x[:, j], side="right"))
    return out


def _matrix(column: pa.Array, width: int, kind=np.float64) -> np.ndarray:
    flat = column.flatten()
    if kind is np.float64:
        flat = flat.cast(pa.float64()).fill_null(np.nan)
    return flat.to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), width)


def _coded(rows: DataFrame, cuts: list[np.ndarray], columns: Sequence[str], schema: str) -> DataFrame:
    missing, width = max((len(c) for c in cuts), default=0) + 1, len(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = codes_of(_matrix(b.column("x"), width), cuts, missing)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), width).cast(pa.list_(pa.int16())) if width else pa.array([[]] * b.num_rows, pa.list_(pa.int16()))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in columns], lists], [*columns, "codes"])

    return rows.select(*columns, "x").mapInArrow(run, schema)


def prepare(df: DataFrame, features: Sequence[str], target: str, max_bins: int = MAX_BINS) -> Frame:
    """Bin the rows with a known target. Rows are numbered by their content, so draws do not depend on partitions."""
    features = list(features)
    rows = _doubles(df, features, target)
    rows = rows.withColumns({"h": F.xxhash64("y", "x"), "tie": F.monotonically_increasing_id()})
    rows = cut_lineage(numbered(rows, ["h", "y", "tie"], "pos").select("pos", "y", "x"), "boost-rows")
    size = rows.agg(F.count("*").alias("n"), F.max(F.abs("y")).alias("most")).first()
    n, cuts = size["n"], quantile_cuts(rows, len(features), max_bins)
    grain = 2.0 ** (math.frexp(size["most"] or 1.0)[1] - 52)  # y in whole grains: an exact, order-free mean
    grains = rows.agg(F.sum(F.round(F.col("y") / grain).cast("decimal(20,0)"))).first()[0] if n else 0
    base = float(int(grains or 0)) * grain / n if n else 0.0
    spread = 2.0 ** math.frexp(2 * (size["most"] or 1.0) or 1.0)[1]
    unit = spread * 2.0 ** -(50 - max(1, n).bit_length())
    coded = cut_lineage(_coded(rows, cuts, ["pos", "y"], "pos long, y double, codes array<short>"), "boost-codes")
    return Frame(coded, n, features, cuts, base, unit)


def like(frame: Frame, df: DataFrame, target: str) -> Frame:
    """Other rows (a validation slice) in the bins of ``frame``."""
    rows = _doubles(df, frame.features, target).withColumn("pos", F.monotonically_increasing_id())
    coded = cut_lineage(_coded(rows, frame.cuts, ["pos", "y"], "pos long, y double, codes array<short>"), "boost-valid")
    return Frame(coded, coded.count(), frame.features, frame.cuts, frame.base, frame.unit)


# ------------------------------------------------------------------- models
@dataclass
class Model:
    """A fitted ensemble with the cuts of its features. ``curve``: validation RMSE after every so many trees."""

    features: list[str]
    cuts: list[np.ndarray]
    base: float
    forest: Forest
    curve: list[float] = field(default_factory=list)

    @property
    def missing(self) -> int:
        return max((len(c) for c in self.cuts), default=0) + 1

    def margins(self, codes: np.ndarray, step: int = 512) -> np.ndarray:
        """Predictions of binned rows, all trees side by side."""
        f, out = self.forest, np.empty(len(codes))
        trees = np.arange(len(f))[None, :]
        for i in range(0, len(codes), step):
            part = codes[i:i + step]
            node = np.zeros((len(part), len(f)), np.int64)
            rows = np.arange(len(part))[:, None]
            for _ in range(f.depth):
                feature = f.feature[trees, node]
                code = part[rows, np.maximum(feature, 0)] if part.shape[1] else np.zeros(node.shape, int)
                left = np.where(code == self.missing, f.missing_left[trees, node], code < f.cut[trees, node])
                node = np.where(feature >= 0, 2 * node + 2 - left, node)
            out[i:i + step] = self.base + f.value[trees, node].sum(axis=1)
        return out

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Score every row; the model (trees times nodes) goes along with the task."""
        if not self.features:
            return df.withColumn(out, F.lit(float(self.margins(np.zeros((1, 0), np.int16))[0])))

        def score(*columns: pd.Series) -> pd.Series:
            values = np.column_stack([c.to_numpy(np.float64) for c in columns])
            return pd.Series(self.margins(codes_of(values, self.cuts, self.missing)))

        return df.withColumn(out, F.pandas_udf(score, "double")(*[F.col(f"`{f}`").cast("double") for f in self.features]))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The ensemble as rows: tree, node, feature, below (its cut point), missing_left, value, gain, cover."""
        f, rows = self.forest, []
        for t in range(len(f)):
            live = [0]
            while live:
                i = live.pop()
                j = int(f.feature[t, i])
                below = None
                if j >= 0:
                    live += [2 * i + 2, 2 * i + 1]
                    cut = int(f.cut[t, i])
                    below = float(self.cuts[j][cut - 1]) if cut <= len(self.cuts[j]) else float("inf")
                rows.append((t, i, self.features[j] if j >= 0 else None, below, bool(f.missing_left[t, i]) if j >= 0 else None,
                             float(f.value[t, i]) if j < 0 else None, float(f.gain[t, i]) if j >= 0 else None, float(f.cover[t, i])))
        return spark.createDataFrame(rows, "tree int, node int, feature string, below double, missing_left boolean, value double, gain double, cover double")

    def save(self, spark: SparkSession, path: str) -> None:
        """Store the nodes and one row of the rest as Parquet under ``path``."""
        self.nodes(spark).write.mode("overwrite").parquet(f"{path.rstrip('/')}/nodes")
        spark.createDataFrame([(self.features, [c.tolist() for c in self.cuts], self.base, self.forest.depth, len(self.forest))],
                              "features array<string>, cuts array<array<double>>, base double, depth int, trees int").write.mode("overwrite").parquet(f"{path.rstrip('/')}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Model":
        m = spark.read.parquet(f"{path.rstrip('/')}/model").first()
        cuts, forest = [np.array(c) for c in m["cuts"]], Forest(m["trees"], m["depth"])
        for r in spark.read.parquet(f"{path.rstrip('/')}/nodes").toLocalIterator():
            at = r["tree"], r["node"]
            forest.cover[at] = r["cover"]
            if r["feature"] is None:
                forest.value[at] = r["value"]
                continue
            j = m["features"].index(r["feature"])
            forest.feature[at], forest.missing_left[at], forest.gain[at] = j, r["missing_left"], r["gain"]
            forest.cut[at] = len(cuts[j]) + 1 if math.isinf(r["below"]) else int(np.searchsorted(cuts[j], r["below"])) + 1
        return Model(list(m["features"]), cuts, m["base"], forest)


@dataclass
class Job:
    """One model to fit: parameters, the features it may use, its seed, and the medians that prune it."""

    params: Mapping
    columns: list[int]
    seed: int = 0
    #: RMSE after 1, 2, ... times ``every`` trees above which the model stops growing; None: never.
    limits: list[float | None] = field(default_factory=list)

    def __post_init__(self):
        self.params = full_params(self.params)


def _rmse(margin: np.ndarray, y: np.ndarray) -> float:
    return round(float(np.sqrt(np.mean((margin - y) ** 2))), 9) if len(y) else float("nan")


def _pruned(job: Job, curve: list[float]) -> bool:
    limit = job.limits[len(curve) - 1] if len(curve) <= len(job.limits) else None
    return limit is not None and curve[-1] > limit


# ------------------------------------------------------- by model: whole fits in tasks
def grow(codes: np.ndarray, y: np.ndarray, pos: np.ndarray, bins: int, base: float, unit: float, job: Job,
         valid: tuple[np.ndarray, np.ndarray] | None = None, every: int = 25) -> tuple[Forest, list[float]]:
    """Fit one model on binned rows in memory; returns its trees and validation curve."""
    p, missing = job.params, bins
    trees, depth = int(p["n_estimators"]), int(p["max_depth"])
    forest, curve = Forest(trees, depth), []
    margin = np.full(len(y), base)
    outside = np.full(len(valid[1]), base) if valid else None
    wide = codes.astype(np.int64)
    for tree in range(trees):
        columns = drawn_columns(job.columns, tree, job.seed, p["colsample_bytree"]) if job.columns else []
        use = np.flatnonzero(drawn_rows(pos, tree, job.seed, p["subsample"]))
        gradient = np.rint((margin[use] - y[use]) / unit)
        cells = wide[np.ix_(use, columns)] + np.arange(len(columns)) * (bins + 1)
        weights = np.repeat(gradient, len(columns))
        node = np.zeros(len(use), np.int64)
        if columns:
            forest.leaf(tree, 0, float(gradient.sum()) * unit, float(len(use)), p)
        live = np.array([0])
        for level in range(depth):
            if not len(live) or not columns:
                break
            place = np.full((1 << (level + 1)) - 1, -1)
            place[live] = np.arange(len(live))
            slot = place[node]
            inside = slot >= 0
            size = len(columns) * (bins + 1)
            key = (cells[inside] + slot[inside, None] * size).ravel()
            shape = (len(live), len(columns), bins + 1)
            g = np.bincount(key, weights=weights.reshape(-1, len(columns))[inside].ravel(), minlength=len(live) * size).reshape(shape) * unit
            h = np.bincount(key, minlength=len(live) * size).reshape(shape).astype(np.float64)
            children = []
            for i, best in zip(live.tolist(), best_splits(g, h, columns, p), strict=True):
                if best:
                    forest.split(tree, i, best, p)
                    children += [2 * i + 1, 2 * i + 2]
            live = np.array(children, np.int64)
            node = forest.step(tree, node, codes[use], missing)
        forest.add(tree, codes, missing, margin)
        if valid:
            forest.add(tree, valid[0], missing, outside)
            if (tree + 1) % every == 0 or tree + 1 == trees:
                curve.append(_rmse(outside, valid[1]))
                if tree + 1 < trees and _pruned(job, curve):
                    return forest.keep(tree + 1), curve
    return forest, curve


def _collected(frame: Frame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A small frame's rows in the order of their numbers (its bytes are checked before)."""
    t = frame.rows.toArrow()
    pos, y = t["pos"].to_numpy(), t["y"].to_numpy()
    codes = _matrix(t["codes"].combine_chunks(), len(frame.features), np.int16) if len(frame.features) else np.zeros((len(y), 0), np.int16)
    order = np.argsort(pos)
    return codes[order], y[order], pos[order]


def _fit_by_model(frame: Frame, jobs: Sequence[Job], valid: Frame | None, every: int, forests: bool) -> list[tuple[Forest | None, list[float], int]]:
    """One task per model, on the broadcast frame."""
    spark = frame.rows.sparkSession
    sent = spark.sparkContext.broadcast((_collected(frame), _collected(valid)[:2] if valid else None, list(jobs)))
    bins, base, unit = frame.bins, frame.base, frame.unit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (codes, y, pos), held, specs = sent.value
        for b in batches:
            for i in b.column("id").to_pylist():
                forest, curve = grow(codes, y, pos, bins, base, unit, specs[i], held, every)
                yield pa.RecordBatch.from_pydict({"id": pa.array([i], pa.int64()), "curve": pa.array([curve], pa.list_(pa.float64())), "trees": pa.array([len(forest)], pa.int32()),
                                                  "forest": pa.array([pickle.dumps(forest) if forests else b""], pa.binary())})

    got = spark.range(0, len(jobs), 1, max(1, len(jobs))).mapInArrow(run, "id long, curve array<double>, trees int, forest binary").collect()
    sent.unpersist()
    return [(pickle.loads(r["forest"]) if forests else None, list(r["curve"]), r["trees"]) for r in sorted(got, key=lambda r: r["id"])]


# ------------------------------------------------- by level: keyed sums for all models
def _fit_by_level(frame: Frame, jobs: Sequence[Job], valid: Frame | None, every: int, store_every: int = 20) -> list[tuple[Forest, list[float], int]]:
    """All models together, one job per tree level; margins are stored every ``store_every`` trees."""
    spark, bins, unit, base, width = frame.rows.sparkSession, frame.bins, frame.unit, frame.base, len(frame.features)
    missing = bins
    forests = [Forest(int(j.params["n_estimators"]), int(j.params["max_depth"])) for j in jobs]
    curves: list[list[float]] = [[] for _ in jobs]
    live = [i for i in range(len(jobs)) if len(forests[i])]
    stored = frame.rows.withColumn("margin", F.array_repeat(F.lit(base), len(jobs)))
    held = valid.rows.withColumn("margin", F.array_repeat(F.lit(base), len(jobs))) if valid else None
    since = 0  # first tree that the stored margins lack

    def advanced(batch: pa.RecordBatch, trees: dict[int, Forest], upto: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = _matrix(batch.column("codes"), width, np.int16) if width else np.zeros((batch.num_rows, 0), np.int16)
        margin = _matrix(batch.column("margin"), len(jobs)).copy()
        for m, forest in trees.items():
            for t in range(min(upto, len(forest))):
                column = margin[:, m]
                forest.add(t, codes, missing, column)
        return codes, batch.column("y").to_numpy(), margin

    def recent(upto: int) -> dict[int, Forest]:
        out = {}
        for m in range(len(jobs)):
            part = forests[m].keep(min(upto, len(forests[m])))
            for name in Forest.FIELDS:
                setattr(part, name, getattr(part, name)[since:])
            out[m] = part
        return out

    def store(df: DataFrame, upto: int, name: str) -> DataFrame:
        trees = recent(upto)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                _, _, margin = advanced(b, trees, upto - since)
                yield pa.RecordBatch.from_arrays([b.column("pos"), b.column("y"), b.column("codes"), pa.array(list(margin), pa.list_(pa.float64()))], ["pos", "y", "codes", "margin"])

        return cut_lineage(df.mapInArrow(run, "pos long, y double, codes array<short>, margin array<double>"), name)

    def cells(tree: int, open_: dict[int, list[int]], columns: dict[int, list[int]], level: int):
        trees = recent(tree)
        growing = {m: (forests[m].keep(tree + 1), jobs[m]) for m in open_}
        first = since

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, list[np.ndarray]] = {}
            for b in batches:
                codes, y, margin = advanced(b, trees, tree - first)
                pos = b.column("pos").to_numpy()
                for m, (forest, job) in growing.items():
                    use = np.flatnonzero(drawn_rows(pos, tree, job.seed, job.params["subsample"]))
                    node = np.zeros(len(use), np.int64)
                    for _ in range(level):
                        node = forest.step(tree, node, codes[use], missing)
                    place = np.full((1 << (level + 1)) - 1, -1)
                    place[open_[m]] = np.arange(len(open_[m]))
                    slot = place[node]
                    inside = slot >= 0
                    size = len(columns[m]) * (bins + 1)
                    key = (codes[np.ix_(use[inside], columns[m])].astype(np.int64) + np.arange(len(columns[m])) * (bins + 1) + slot[inside, None] * size).ravel()
                    gradient = np.rint((margin[use[inside], m] - y[use[inside]]) / unit)
                    g = np.bincount(key, weights=np.repeat(gradient, len(columns[m])), minlength=len(open_[m]) * size)
                    h = np.bincount(key, minlength=len(open_[m]) * size).astype(np.float64)
                    have = sums.setdefault(m, [np.zeros(len(g)), np.zeros(len(g))])
                    have[0] += g
                    have[1] += h
            for m, (g, h) in sums.items():
                at = np.flatnonzero(h)
                node, rest = np.divmod(at, len(columns[m]) * (bins + 1))
                yield pa.RecordBatch.from_pydict({"model": pa.array(np.full(len(at), m), pa.int32()), "node": pa.array(np.asarray(open_[m])[node], pa.int32()),
                                                  "cell": pa.array(rest, pa.int32()), "g": g[at], "h": h[at]})

        return run

    def search(columns: dict[int, list[int]]):
        specs = {m: jobs[m].params for m in columns}

        def run(key: tuple, rows: pa.Table) -> pa.Table:
            m, node = key[0].as_py(), key[1].as_py()
            shape = (1, len(columns[m]), bins + 1)
            g, h = np.zeros(shape[1] * shape[2]), np.zeros(shape[1] * shape[2])
            g[rows["cell"].to_numpy()], h[rows["cell"].to_numpy()] = rows["g"].to_numpy() * unit, rows["h"].to_numpy()
            best = best_splits(g.reshape(shape), h.reshape(shape), columns[m], specs[m])[0]
            total = (float(g.reshape(shape)[0, 0].sum()), float(h.reshape(shape)[0, 0].sum()))
            b = best or {"feature": -1, "cut": 0, "missing_left": False, "gain": 0.0, "gl": 0.0, "hl": 0.0, "gr": 0.0, "hr": 0.0}
            return pa.Table.from_pylist([{"model": m, "node": node, "g": total[0], "h": total[1], **b}], schema=pa.schema([
                ("model", pa.int32()), ("node", pa.int32()), ("g", pa.float64()), ("h", pa.float64()), ("feature", pa.int32()), ("cut", pa.int32()),
                ("missing_left", pa.bool_()), ("gain", pa.float64()), ("gl", pa.float64()), ("hl", pa.float64()), ("gr", pa.float64()), ("hr", pa.float64())]))

        return run

    out_schema = "model int, node int, g double, h double, feature int, cut int, missing_left boolean, gain double, gl double, hl double, gr double, hr double"
    tree = 0
    while live:
        columns = {m: drawn_columns(jobs[m].columns, tree, jobs[m].seed, jobs[m].params["colsample_bytree"]) for m in live if jobs[m].columns}
        open_ = {m: [0] for m in columns}
        level = 0
        while open_:
            partial = stored.mapInArrow(cells(tree, open_, columns, level), "model int, node int, cell int, g double, h double")
            added = partial.groupBy("model", "node", "cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            splits = added.groupBy("model", "node").applyInArrow(search({m: columns[m] for m in open_}), out_schema).collect()
            following: dict[int, list[int]] = {}
            for r in sorted(splits, key=lambda r: (r["model"], r["node"])):
                m, p = r["model"], jobs[r["model"]].params
                if r["node"] == 0:
                    forests[m].leaf(tree, 0, r["g"], r["h"], p)
                if r["feature"] >= 0:
                    forests[m].split(tree, r["node"], r.asDict(), p)
                    if level + 1 < forests[m].depth:
                        following.setdefault(m, []).extend([2 * r["node"] + 1, 2 * r["node"] + 2])
            open_, level = following, level + 1
        tree += 1
        if held is not None and (tree % every == 0 or any(tree == len(forests[m]) for m in live)):
            trees, upto = recent(tree), tree - since

            def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    _, y, margin = advanced(b, trees, upto)
                    yield pa.RecordBatch.from_pydict({"model": pa.array(np.arange(len(jobs)), pa.int32()), "s": ((margin - y[:, None]) ** 2).sum(axis=0), "n": np.full(len(jobs), len(y))})

            rows = held.mapInArrow(errors, "model int, s double, n long").groupBy("model").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
            rmse = {r["model"]: round(math.sqrt(r["s"] / r["n"]), 9) for r in rows if r["n"]}
            for m in list(live):
                if tree % every == 0 or tree == len(forests[m]):
                    curves[m].append(rmse.get(m, float("nan")))
                    if tree < len(forests[m]) and _pruned(jobs[m], curves[m]):
                        forests[m] = forests[m].keep(tree)
        live = [m for m in live if tree < len(forests[m])]
        if live and tree - since >= store_every:
            stored = store(stored, tree, "boost-margins")
            held = store(held, tree, "boost-held") if held is not None else None
            since = tree
    return [(f, c, len(f)) for f, c in zip(forests, curves, strict=True)]


def fit_many(frame: Frame, jobs: Sequence[Job], valid: Frame | None = None, every: int = 25, forests: bool = True,
             frame_bytes: int = FRAME_BYTES) -> list[tuple[Forest | None, list[float], int]]:
    """(trees, validation curve, number of trees) of every model; both ways give the same."""
    if not jobs:
        return []
    if frame.bytes + (valid.bytes if valid else 0) <= frame_bytes:
        return _fit_by_model(frame, jobs, valid, every, forests)
    return _fit_by_level(frame, jobs, valid, every)


def fit_one(frame: Frame, params: Mapping | None = None, seed: int = 0, **options) -> Model:
    forest, curve, _ = fit_many(frame, [Job(full_params(params), list(range(len(frame.features))), seed)], **options)[0]
    return Model(frame.features, frame.cuts, frame.base, forest, curve)
