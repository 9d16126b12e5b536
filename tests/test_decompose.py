"""Robust decomposition against a plain loop over points that solves each local line by least squares."""

import numpy as np
import pytest

from strata.operators.decompose import robust_decompose


def line_at(y, weight, span, x):
    """Weighted least squares through the span nearest to ``x`` (points at 1…n), or None without weight."""
    n = len(y)
    first = 1 if x <= (span + 1) // 2 else x - (span + 1) // 2 + 1
    first = max(1, min(first, n - span + 1))
    points = [j for j in range(first, first + span) if j <= n]
    h = max(x - points[0], points[-1] - x) + (max(span - n, 0) // 2)
    w = []
    for j in points:
        r = abs(j - x)
        w.append(0.0 if r > 0.999 * h else (1.0 if r <= 0.001 * h else (1 - (r / h) ** 3) ** 3) * weight[j - 1])
    if sum(w) <= 0:
        return None
    used = [(j, a, y[j - 1]) for j, a in zip(points, w) if a > 0]
    mean = sum(j * a for j, a, _ in used) / sum(w)
    if np.sqrt(sum(a * (j - mean) ** 2 for j, a, _ in used) / sum(w)) <= 0.001 * (n - 1):
        return sum(a * v for _, a, v in used) / sum(w)
    root = np.sqrt([a for _, a, _ in used])
    design = np.array([[1.0, j - x] for j, _, _ in used]) * root[:, None]
    return np.linalg.lstsq(design, np.array([v for _, _, v in used]) * root, rcond=None)[0][0]


def smooth(y, weight, span):
    fits = [line_at(y, weight, span, i + 1) for i in range(len(y))]
    return [v if f is None else f for f, v in zip(fits, y)]


def plain(y, period, spans, inner, outer):
    n, ones = len(y), [1.0] * len(y)
    trend, weight = [0.0] * n, ones
    for turn in range(outer + 1):
        for _ in range(inner):
            longer = [0.0] * (n + 2 * period)
            for j in range(period):
                part = [y[i] - trend[i] for i in range(j, n, period)]
                w = [weight[i] for i in range(j, n, period)]
                middle = smooth(part, w, spans[0])
                before, after = line_at(part, w, spans[0], 0), line_at(part, w, spans[0], len(part) + 1)
                whole = [middle[0] if before is None else before, *middle, middle[-1] if after is None else after]
                for k, v in enumerate(whole):
                    longer[k * period + j] = v
            low = longer
            for k in (period, period, 3):
                low = [sum(low[i:i + k]) / k for i in range(len(low) - k + 1)]
            low = smooth(low, ones, spans[2])
            seasonal = [longer[period + i] - low[i] for i in range(n)]
            trend = smooth([y[i] - seasonal[i] for i in range(n)], weight, spans[1])
        if turn < outer:
            off = [abs(y[i] - trend[i] - seasonal[i]) for i in range(n)]
            far = 6 * float(np.median(off))
            weight = [1.0 if o <= 0.001 * far else (1 - (o / far) ** 2) ** 2 if o <= 0.999 * far else 0.0 for o in off]
    return trend, seasonal


def series(n, seed):
    rng = np.random.default_rng(seed)
    y = 20 + 0.3 * np.arange(n) + np.tile([3.0, -1.0, 0.5, -2.5], n // 4 + 1)[:n] + rng.normal(0, 0.4, n)
    y[n // 2] += 15
    return y.tolist()


@pytest.fixture(scope="module")
def panel(spark):
    data = {("A", n): series(n, n) for n in (8, 9, 13, 28, 29, 60)} | {("B", 28): series(28, 1), ("short", 7): series(7, 2), ("flat", 12): [5.0] * 12}
    rows = [(k, str(n), i, v, "x") for (k, n), ys in data.items() for i, v in enumerate(ys)]
    rows += [("A", "28", 100, None, "x"), ("A", "28", 5_000, float("nan"), "x"), ("gone", "0", 1, None, "x")]
    return data, spark.createDataFrame(rows, "geo string, `na ics` string, t int, v double, trend string")


@pytest.mark.parametrize("options, spans, inner, outer", [
    ({}, (7, 9, 5), 2, 15), ({"outer": 0, "inner": 3}, (7, 9, 5), 3, 0),
    ({"seasonal_span": 9, "trend_span": 11, "low_pass_span": 7, "outer": 3}, (9, 11, 7), 2, 3)])
def test_equals_a_plain_loop(panel, options, spans, inner, outer):
    data, df = panel
    rows = robust_decompose(df, ["geo", "na ics"], "t", "v", 4, digits=None, **options).collect()
    assert len(rows) == df.count() and rows[0].__fields__ == ["geo", "na ics", "t", "v", "trend", "seasonal", "resid"]
    got = {(r["geo"], int(r["na ics"]), r["t"]): r for r in rows}
    for (k, n), ys in data.items():
        if n < 8:
            assert all(got[k, n, i].trend is None and got[k, n, i].v is not None for i in range(n))
            continue
        trend, seasonal = plain(ys, 4, spans, inner, outer)
        assert np.allclose([got[k, n, i].trend for i in range(n)], trend, atol=1e-8)
        assert np.allclose([got[k, n, i].seasonal for i in range(n)], seasonal, atol=1e-8)
        assert np.allclose([got[k, n, i].resid for i in range(n)], np.array(ys) - trend - seasonal, atol=1e-8)
    assert all(got[k].trend is None and got[k].resid is None for k in [("A", 28, 100), ("A", 28, 5_000), ("gone", 0, 1)])


def test_an_outlier_stays_in_the_remainder(panel):
    data, df = panel
    robust, plainly = ({r.t: r.resid for r in robust_decompose(df.where("geo = 'B'"), ["geo"], "t", "v", outer=o).collect()} for o in (15, 0))
    assert robust[14] > 12 and robust[14] > plainly[14] + 3


def test_same_for_any_partitioning(panel):
    _, df = panel
    want = {tuple(r)[:3]: tuple(r)[4:] for r in robust_decompose(df, ["geo", "na ics"], "t", "v").collect()}
    assert want == {tuple(r)[:3]: tuple(r)[4:] for r in robust_decompose(df.repartition(7), ["geo", "na ics"], "t", "v").collect()}
    assert robust_decompose(df.limit(0), ["geo"], "t", "v").count() == 0
    with pytest.raises(ValueError):
        robust_decompose(df, ["geo"], "t", "v", seasonal_span=4)
