"""Forecasting operators on a small synthetic panel built in the test."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata import spec
from strata.forecasting import boosting as B
from strata.forecasting import evaluate as EV
from strata.forecasting import models as MD
from strata.forecasting import search
from strata.forecasting.recursive import recursive_forecast
from strata.forecasting.runlog import run_log
from strata.plans import features as FE
from tests import fixtures as fx


@pytest.fixture(scope="module")
def feats(spark):
    rnd = random.Random(7)
    rows = []
    for g in ("G1", "G2"):
        for n in ("N1", "N2", "N3"):
            base = rnd.uniform(10, 50)
            for i, d in enumerate(fx.quarters(2000, 16)):
                vac = base + 3 * math.sin(i) + rnd.uniform(-1, 1)
                wage = 20 + 0.2 * i + rnd.uniform(-0.1, 0.1)
                rows.append((d, g, d.year, n, vac if i != 5 else None, wage))
    mart = spark.createDataFrame(rows, "date_parsed date, geo string, year int, naics string, "
                                       "vacancies_per_1000 double, avg_offered_hourly_wage double")
    return FE.ml_features(mart, "2000-01-01", [], {"is_covid": ("2001-01-01", "2001-07-01"),
                                                   "is_post_covid_boom": ("2002-01-01", "2002-04-01")}).cache()


def test_feature_sets():
    assert len(EV.feature_set(spec.VAC)) == 11 and len(EV.feature_set(spec.WAGE)) == 6


def test_temporal_split_never_random(feats):
    s = EV.temporal_split(feats, "date_parsed", spec.VAC, "2003-01-01", "2002-01-01")
    rows = s.collect()
    assert all((r.split == "train") == (str(r.date_parsed) < "2003-01-01") for r in rows)
    assert all(r.tuning is None for r in rows if r.split == "test")
    assert all(r[spec.VAC] is not None for r in rows)


def test_metrics_match_numpy(spark):
    y = [1.0, 2.0, 3.0, 5.0]
    yh = [1.5, 2.0, 2.0, 6.0]
    df = spark.createDataFrame(list(zip(y, yh)), "y double, yhat double")
    m = EV.forecast_metrics(df, "y", "yhat", (), None).first()
    ya, ha = np.array(y), np.array(yh)
    assert m.rmse == pytest.approx(np.sqrt(np.mean((ya - ha) ** 2)))
    assert m.mae == pytest.approx(np.mean(np.abs(ya - ha)))
    assert m.mape == pytest.approx(np.mean(np.abs((ya - ha) / ya)) * 100)
    assert m.r2 == pytest.approx(1 - np.sum((ya - ha) ** 2) / np.sum((ya - ya.mean()) ** 2))


PARAMS = {"eta": 0.3, "max_depth": 3, "n_estimators": 5}


@pytest.fixture(scope="module")
def fitted(feats):
    fs = EV.feature_set(spec.VAC)
    return EV.fit(EV.training_frame(feats.filter(F.col("date_parsed") < "2003-01-01"), fs, spec.VAC), PARAMS)


def test_fit_predict_and_importance(feats, fitted):
    fs = EV.feature_set(spec.VAC)
    assert len(MD.tree_summary(fitted)) == 5
    imp = dict(MD.feature_importance(fitted))
    assert set(imp) == set(fs) and abs(sum(imp.values()) - 1) < 1e-6
    assert MD.predict(fitted, feats).filter(F.col("prediction").isNull()).count() == 0


def test_recursive_forecast_equals_a_stepwise_loop(feats, fitted):
    fc = recursive_forecast(fitted, feats, ["geo", "naics"], "date_parsed", spec.VAC, 4).collect()
    assert {str(r.date_parsed) for r in fc if r.forecast_horizon_quarters == 1} == {"2004-01-01"}
    rows = feats.orderBy("date_parsed").collect()
    want = {}
    for key in {(r.geo, r.naics) for r in rows}:
        own = [r for r in rows if (r.geo, r.naics) == key]
        tails = {m: [r[m] for r in own][-6:][::-1] for m in (spec.VAC, spec.WAGE)}
        month = own[-1].date_parsed.month
        for h in range(1, 5):
            month = (month + 2) % 12 + 1
            known = {"quarter_cos": math.cos(2 * math.pi * month / 4), "is_covid": 0, "is_post_covid_boom": 0, "naics_encoded": own[0].naics_encoded}
            for m, values in tails.items():
                known |= {f"{m}_lag{k}": v for k, v in enumerate(values, 1)}
                known |= {f"{m}_roll{n}": None if None in values[:n] else sum(values[:n]) / n for n in spec.ROLLS}
            x = np.array([[math.nan if known[f] is None else known[f] for f in fitted.features]])
            y = float(fitted.margins(B.codes_of(x, fitted.cuts, fitted.missing))[0])
            want[(*key, h)] = y
            tails = {m: [y if m == spec.VAC else None, *v[:-1]] for m, v in tails.items()}
    got = {(r.geo, r.naics, r.forecast_horizon_quarters): r[f"predicted_{spec.VAC}"] for r in fc}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_contributions_add_up_and_equal_brute_force_subsets(spark):
    rng = random.Random(2)
    rows = [(i, rng.uniform(-2, 2), float(rng.randrange(4)), None if i % 5 == 0 else rng.random(), rng.random()) for i in range(150)]
    rows = [(*r, math.sin(r[1]) * (1 + r[2]) + (r[3] or 2) * r[4]) for r in rows]
    fs = ["a", "b", "c", "d"]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double, y double").repartition(3)
    model = EV.fit(EV.training_frame(df, fs, "y"), {"eta": 0.4, "max_depth": 4, "n_estimators": 3, "subsample": 0.8})
    got = MD.attributions(model, df, ["id"]).collect()
    per_row = {}
    for r in got:
        per_row.setdefault(r.id, {})[r.feature] = r.contribution
        assert r.base == got[0].base
    assert len(got) == 4 * len(rows)
    pred = {r.id: r.prediction for r in MD.predict(model, df).collect()}
    assert all(sum(c.values()) + got[0].base == pytest.approx(pred[i]) for i, c in per_row.items())

    def expected(codes, known, t, i=0):
        f = model.forest
        j = int(f.feature[t, i])
        if j < 0:
            return float(f.value[t, i])
        if j in known:
            left = f.missing_left[t, i] if codes[j] == model.missing else codes[j] < f.cut[t, i]
            return expected(codes, known, t, 2 * i + 1 if left else 2 * i + 2)
        share = f.cover[t, 2 * i + 1] / f.cover[t, i]
        return share * expected(codes, known, t, 2 * i + 1) + (1 - share) * expected(codes, known, t, 2 * i + 2)

    for r in rows[:12]:
        codes = B.codes_of(np.array([[math.nan if v is None else v for v in r[1:5]]]), model.cuts, model.missing)[0]
        worth = {s: sum(expected(codes, s, t) for t in range(3)) for n in range(5) for s in map(frozenset, itertools.combinations(range(4), n))}
        for j in range(4):
            rest = [s for s in worth if j not in s]
            want = sum(math.factorial(len(s)) * math.factorial(3 - len(s)) / 24 * (worth[s | {j}] - worth[s]) for s in rest)
            assert per_row[r[0]][fs[j]] == pytest.approx(want, abs=1e-9)


def test_permutation_and_ablation_shapes(feats):
    target, fs = spec.WAGE, EV.feature_set(spec.WAGE)
    params = {"eta": 0.3, "max_depth": 2, "n_estimators": 3}
    tr = feats.filter(F.col("date_parsed") < "2002-07-01")
    va = feats.filter(F.col("date_parsed") >= "2002-07-01")
    model = EV.fit(EV.training_frame(tr, fs, target), params)
    perm = EV.permutation_importance(model, va, fs, target, n_repeats=3).collect()
    assert {r.feature for r in perm} == set(fs) and all(r.repeats == 3 for r in perm)


def test_ablation_equals_fits_one_by_one(feats):
    fs = EV.feature_set(spec.WAGE)[:3]
    tr = feats.filter(F.col("date_parsed") < "2002-07-01")
    va = feats.filter(F.col("date_parsed") >= "2002-07-01")
    abl = {r.feature: r for r in EV.ablation(tr, va, fs, spec.WAGE, PARAMS).collect()}
    assert set(abl) == set(fs) and all(math.isclose(r.rmse_diff, r.baseline_rmse - r.ablated_rmse) and r.trees == 5 for r in abl.values())
    for f in fs:
        alone = EV.fit(EV.training_frame(tr, [k for k in fs if k != f], spec.WAGE), PARAMS)
        assert EV.rmse_of(alone, va, spec.WAGE) == pytest.approx(abl[f].ablated_rmse, abs=1e-8)


SPACE = {"eta": (0.05, 0.5), "max_depth": (2, 3), "reg_lambda": (1e-3, 5.0, "log"), "n_estimators": (2, 6)}


def test_search_is_seeded_and_lists_pruned_trials(feats):
    fs = EV.feature_set(spec.WAGE)
    tr = feats.filter(F.col("date_parsed") < "2002-07-01")
    va = feats.filter(F.col("date_parsed") >= "2002-07-01")
    runs = [EV.random_search(tr.repartition(n), va, fs, spec.WAGE, SPACE, 18, round_size=6, every=1).collect() for n in (1, 5)]
    assert runs[0] == runs[1] and sorted(r.trial for r in runs[0]) == list(range(18))
    assert any(r.pruned for r in runs[0]) and not runs[0][0].pruned
    done = [r.val_rmse for r in runs[0] if not r.pruned]
    assert done == sorted(done) and all(r.trees < r.n_estimators for r in runs[0] if r.pruned)
    assert runs[0] != EV.random_search(tr, va, fs, spec.WAGE, SPACE, 18, seed=1, round_size=6, every=1).collect()


def test_guided_draws_approach_the_optimum():
    def run(trials):
        return [([abs(math.log10(p["x"]) + 3) + abs(p["k"] - 7)], 1) for p, _ in trials]

    space = {"x": (1e-8, 10.0, "log"), "k": (1, 20)}
    trials = search.search(run, space, 120, seed=3, round_size=10, uniform=20)
    first, last = ([t.rmse for t in part] for part in (trials[:20], trials[-20:]))
    assert np.median(last) < 0.5 * np.median(first) and min(last) < 1
    assert all(1e-8 <= t.params["x"] <= 10 and isinstance(t.params["k"], int) and 1 <= t.params["k"] <= 20 for t in trials)


def test_medians_wait_for_enough_trials():
    trials = [search.Trial(i, {}, 1.0, 3, False, [float(i), i + 0.5]) for i in range(5)] + [search.Trial(9, {}, 9.0, 1, True, [9.0])]
    assert search.medians(trials, warmup=0) == [2.0, 2.5] and search.medians(trials, warmup=1) == [None, 2.5]
    assert search.medians(trials[:4], warmup=0) == [None, None]


def test_uniform_draws_are_seeded():
    a = search.draw_uniform(spec.SEARCH_SPACE, 3, 0)
    assert a == search.draw_uniform(spec.SEARCH_SPACE, 3, 0) and a[1:] == search.draw_uniform(spec.SEARCH_SPACE, 2, 0, 1)
    assert all(isinstance(p["max_depth"], int) and 3 <= p["max_depth"] <= 6 and 1e-8 <= p["reg_alpha"] <= 20 for p in a)


def test_run_log_rows(spark):
    df = run_log(spark, "r1", {"eta": 0.1}, {"rmse": 2.0}, {"model": "gbt"})
    assert sorted((r.kind, r.name) for r in df.collect()) == [("metric", "rmse"), ("param", "eta"), ("tag", "model")]


def test_numbering_and_permutation_do_not_depend_on_partitioning(spark):
    from pyspark.sql import functions as F
    from strata.forecasting import evaluate as EV
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("k"))
    got = {r["k"]: r["p"] for r in EV.numbered(df.repartition(5), ["k"], "p").collect()}
    assert got == {k: k for k in range(500)}

    rows = [(i, float(i % 13), float(i % 7), float(i % 13) * 2) for i in range(120)]
    data = spark.createDataFrame(rows, "id int, a double, b double, y double")
    model = EV.fit(EV.training_frame(data, ["a", "b"], "y"), {"n_estimators": 3, "max_depth": 3})
    one, many = ({r["feature"]: tuple(r) for r in EV.permutation_importance(model, data.repartition(k), ["a", "b"], "y", 3).collect()} for k in (1, 7))
    assert set(one) == {"a", "b"}
    for f in one:
        assert all(x == y or abs(x - y) < 1e-9 for x, y in zip(one[f], many[f], strict=True) if not isinstance(x, str))
