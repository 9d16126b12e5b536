"""The booster against a brute-force split search, and both of its ways against each other."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.forecasting import boosting as B

FEATURES = ["a", "b", "c", "flag"]
PARAMS = {"eta": 0.2, "max_depth": 3, "n_estimators": 7, "subsample": 0.7, "colsample_bytree": 0.8, "reg_alpha": 0.3, "reg_lambda": 1.5}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for i in range(220):
        a, b = rng.uniform(-2, 2), float(rng.randrange(9))
        c = None if rng.random() < 0.3 else rng.gauss(0, 1)
        y = 3 * math.sin(a) + 0.5 * b + (2 if c is None else c) + rng.gauss(0, 0.1)
        out.append((a, b, c, rng.random() < 0.5, y, "x"))
    out += [out[0]] * 5 + [(None, None, None, None, 1.0, None), (1.0, 2.0, float("nan"), True, 2.5, None), (1.0, 2.0, 3.0, True, None, None)]
    return out


@pytest.fixture(scope="module")
def panel(spark, rows):
    return spark.createDataFrame(rows, "a double, b double, c double, flag boolean, y double, codes string").withColumn("flag", F.col("flag").cast("int")).cache()


def same(one, two):
    return all((getattr(one, f) == getattr(two, f)).all() for f in B.Forest.FIELDS)


def test_cuts_are_exact_quantiles(spark):
    values = [1.0, 2.0, 3.5] * 20 + [None] * 5
    many = [float(i * 7 % 1000) for i in range(1000)]
    df = spark.createDataFrame([([v, m],) for v, m in itertools.zip_longest(values, many)], "x array<double>").repartition(5)
    few, ranks = B.quantile_cuts(df, 2, 10)
    assert few.tolist() == [2.0, 3.5] and ranks.tolist() == [float(100 * i) for i in range(1, 10)]


def brute_tree(x, y, p, depth):
    """Root to leaf by trying every cut and both sides for missing values."""
    def weight(g, h):
        return -math.copysign(max(abs(g) - p["reg_alpha"], 0), g) / (h + p["reg_lambda"])

    def score(g, h):
        return max(abs(g) - p["reg_alpha"], 0) ** 2 / (h + p["reg_lambda"])

    def grow(rows, level):
        g, h = sum(r[1] for r in rows), len(rows)
        best = None
        if level < depth:
            for f in range(len(x[0])):
                for cut in sorted({r[0][f] for r in rows if r[0][f] is not None})[1:] + [math.inf]:
                    for none_left in (False, True):
                        left = [r for r in rows if (none_left if r[0][f] is None else r[0][f] < cut)]
                        gl, hl = sum(r[1] for r in left), len(left)
                        if 1 <= hl < h:
                            gain = score(gl, hl) + score(g - gl, h - hl) - score(g, h)
                            if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                                best = (gain, f, cut, none_left)
        if best is None:
            return p["eta"] * weight(g, h)
        _, f, cut, none_left = best
        goes = lambda r: none_left if r[0][f] is None else r[0][f] < cut
        return (f, cut, none_left, grow([r for r in rows if goes(r)], level + 1), grow([r for r in rows if not goes(r)], level + 1))

    base = sum(y) / len(y)
    return base, grow([(r, base - t) for r, t in zip(x, y, strict=True)], 0)


def walk(tree, r):
    while isinstance(tree, tuple):
        f, cut, none_left, left, right = tree
        tree = left if (none_left if r[f] is None else r[f] < cut) else right
    return tree


@pytest.mark.parametrize("alpha,lam", [(0.0, 1.0), (2.0, 0.1)])
def test_a_tree_equals_brute_force(panel, rows, alpha, lam):
    p = {**B.DEFAULT_PARAMS, "n_estimators": 1, "max_depth": 3, "reg_alpha": alpha, "reg_lambda": lam}
    model = B.fit_one(B.prepare(panel, FEATURES, "y"), p)
    known = [r for r in rows if r[4] is not None]
    x = [tuple(None if v is None or v != v else float(v) for v in r[:4]) for r in known]
    base, tree = brute_tree(x, [r[4] for r in known], p, 3)
    got = sorted(r.prediction for r in model.predict(panel.where("y is not null")).collect())
    assert np.allclose(got, sorted(base + walk(tree, r) for r in x), atol=1e-9)


def test_both_ways_and_all_partitionings_agree(panel):
    jobs = [B.Job(PARAMS, [0, 1, 2, 3]), B.Job({**PARAMS, "max_depth": 2, "n_estimators": 4}, [0, 2], 5), B.Job({**PARAMS, "reg_alpha": 5.0}, [1], 1)]
    frames = [B.prepare(panel.repartition(n), FEATURES, "y") for n in (1, 7)]
    valid = B.like(frames[0], panel.limit(60), "y")
    one = B.fit_many(frames[0], jobs, valid, every=2)
    two = B.fit_many(frames[1], jobs, valid, every=2)
    level = B.fit_many(frames[1], jobs, valid, every=2, frame_bytes=0)
    alone = [B.fit_many(frames[0], [j], valid, every=2)[0] for j in jobs]
    for a, b, c, d in zip(one, two, level, alone, strict=True):
        assert same(a[0], b[0]) and same(a[0], c[0]) and same(a[0], d[0]) and a[1:] == b[1:] == c[1:] == d[1:]
    assert len(one[0][1]) == 4 and one[0][1][-1] < one[0][1][0]


def test_margins_are_stored_on_the_way(panel):
    frame = B.prepare(panel, FEATURES, "y")
    job = B.Job({**PARAMS, "max_depth": 2}, [0, 1, 2, 3])
    forest = B._fit_by_level(frame, [job], None, 25, store_every=3)[0][0]
    assert same(forest, B.fit_many(frame, [job])[0][0])


def test_limits_prune(panel):
    frame = B.prepare(panel, FEATURES, "y")
    valid = B.like(frame, panel.limit(60), "y")
    free, cut = B.Job(PARAMS, [0, 1, 2, 3]), B.Job(PARAMS, [0, 1, 2, 3], limits=[None, 0.0])
    for size in (B.FRAME_BYTES, 0):
        a, b = B.fit_many(frame, [free, cut], valid, every=2, frame_bytes=size)
        assert (a[2], b[2]) == (7, 4) and b[1] == a[1][:2] and same(b[0], a[0].keep(4))


def test_models_are_saved_and_read(spark, panel, tmp_dir):
    model = B.fit_one(B.prepare(panel, FEATURES, "y"), PARAMS)
    model.save(spark, tmp_dir + "/m")
    again = B.Model.load(spark, tmp_dir + "/m")
    one, two = ([r.prediction for r in m.predict(panel).collect()] for m in (model, again))
    assert one == two
    nodes = model.nodes(spark).where("node = 0").collect()
    assert len(nodes) == 7 and all(n.cover > 0 for n in nodes)


def test_nothing_to_learn_from(spark, panel):
    none = B.fit_one(B.prepare(panel.where("y > 1e9"), FEATURES, "y"), PARAMS)
    assert {r.prediction for r in none.predict(panel).collect()} == {0.0}
    constant = spark.createDataFrame([(1.0, 4.0)] * 9, "a double, y double")
    assert {round(r.prediction, 9) for r in B.fit_one(B.prepare(constant, ["a"], "y"), PARAMS).predict(constant).collect()} == {4.0}
