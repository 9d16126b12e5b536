"""Hyper-parameter search: draws guided by the densities of good and bad trials, with median pruning.

Trials run in rounds of a fixed size (an argument, not the cluster's width), all trials of a round side by side. The
first rounds draw uniformly. Later draws split the finished trials into a good share and the rest, model each
parameter's values in both as a mixture of normals around them, and keep of some candidates from the good mixture the
one whose density is highest against the bad one. A trial stops early when its validation RMSE after some number of
trees is above the median of the finished trials of earlier rounds at that point. Everything follows from the seed.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trial:
    number: int
    params: dict
    rmse: float | None = None
    trees: int = 0
    pruned: bool = False
    curve: list[float] = field(default_factory=list)


@dataclass(frozen=True)
class Range:
    """A parameter's range on the scale it is drawn on."""

    low: float
    high: float
    whole: bool
    log: bool

    @staticmethod
    def of(spec: Sequence) -> "Range":
        low, high = spec[:2]
        return Range(low, high, isinstance(low, int) and isinstance(high, int), "log" in spec[2:])

    @property
    def ends(self) -> tuple[float, float]:
        if self.log:
            return math.log(self.low), math.log(self.high)
        return (self.low - 0.5, self.high + 0.5) if self.whole else (self.low, self.high)

    def scaled(self, value: float) -> float:
        return math.log(value) if self.log else float(value)

    def value(self, x: float) -> float:
        if self.log:
            return float(min(max(math.exp(x), self.low), self.high))
        return int(min(max(round(x), self.low), self.high)) if self.whole else float(min(max(x, self.low), self.high))


def _phi(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.array([math.erf(v / math.sqrt(2)) for v in np.ravel(x)]).reshape(np.shape(x)))


class Mixture:
    """Normals around the observed values plus a wide one over the whole range, all cut at the range's ends.

    A normal is as wide as the larger gap to its neighbours, within bounds that follow the number of values.
    """

    def __init__(self, values: Sequence[float], low: float, high: float):
        centre = np.array([*values, (low + high) / 2])
        order = np.argsort(centre, kind="stable")
        at = np.r_[low, centre[order], high]
        width = np.empty(len(centre))
        width[order] = np.maximum(at[1:-1] - at[:-2], at[2:] - at[1:-1])
        width = np.clip(width, (high - low) / min(100, 1 + len(centre)), high - low)
        width[-1] = high - low
        self.low, self.high, self.centre, self.width = low, high, centre, width
        self.left, self.right = _phi((low - centre) / width), _phi((high - centre) / width)

    def draw(self, rng: np.random.RandomState, n: int) -> np.ndarray:
        which = rng.randint(0, len(self.centre), n)
        out = np.empty(n)
        for i, w in enumerate(which):
            while True:  # the part inside the range holds at least a third of each normal
                out[i] = rng.normal(self.centre[w], self.width[w])
                if self.low <= out[i] <= self.high:
                    break
        return out

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x[:, None] - self.centre) / self.width
        d = np.exp(-0.5 * z * z) / (self.width * math.sqrt(2 * math.pi) * (self.right - self.left))
        return np.log(d.mean(axis=1) + 1e-300)


def _order(t: Trial) -> tuple:
    """Finished trials by RMSE, then pruned ones: who got further first, then by the RMSE reached."""
    return (t.pruned, -len(t.curve) if t.pruned else 0, t.rmse if t.rmse is not None and not math.isnan(t.rmse) else math.inf, t.number)


def draw_uniform(space: Mapping[str, Sequence], n: int, seed: int = 0, first: int = 0) -> list[dict]:
    """Seeded draws, each from its own number: the same trial whatever was drawn before."""
    out = []
    for i in range(first, first + n):
        rng = np.random.RandomState((seed * 1_000_003 + i) % (1 << 32))
        out.append({k: Range.of(s).value(rng.uniform(*Range.of(s).ends)) for k, s in space.items()})
    return out


def draw_guided(space: Mapping[str, Sequence], trials: Sequence[Trial], n: int, seed: int, first: int, candidates: int = 24) -> list[dict]:
    """``n`` draws after the given trials; parameters are drawn one by one."""
    ranked = sorted(trials, key=_order)
    n_good = max(1, min(25, math.ceil(0.1 * len(ranked))))
    good, bad = ranked[:n_good], ranked[n_good:]
    out = []
    for i in range(first, first + n):
        rng = np.random.RandomState((seed * 1_000_003 + i) % (1 << 32))
        drawn = {}
        for k, s in space.items():
            r = Range.of(s)
            high, low = (Mixture([r.scaled(t.params[k]) for t in side], *r.ends) for side in (good, bad))
            x = high.draw(rng, candidates)
            drawn[k] = r.value(float(x[np.argmax(high.log_density(x) - low.log_density(x))]))
        out.append(drawn)
    return out


def medians(trials: Sequence[Trial], warmup: int, least: int = 5) -> list[float | None]:
    """The median RMSE of the finished trials after each stretch of trees; None in the warm-up and with too few of them."""
    curves = [t.curve for t in trials if not t.pruned]
    longest = max((len(c) for c in curves), default=0)
    out: list[float | None] = []
    for i in range(longest):
        at = [c[i] for c in curves if len(c) > i]
        out.append(float(np.median(at)) if i >= warmup and len(at) >= least else None)
    return out


def search(run, space: Mapping[str, Sequence], n_trials: int, seed: int = 0, round_size: int = 25, uniform: int = 25, warmup: int = 1) -> list[Trial]:
    """``run(list of (params, limits))`` gives (curve, trees) of each trial of a round; returns all trials by number."""
    trials: list[Trial] = []
    while len(trials) < n_trials:
        n, first = min(round_size, n_trials - len(trials)), len(trials)
        if first < uniform:
            n = min(n, uniform - first)
            draws = draw_uniform(space, n, seed, first)
        else:
            draws = draw_guided(space, trials, n, seed, first)
        limits = medians(trials, warmup)
        for i, (p, (curve, trees)) in enumerate(zip(draws, run([(p, limits) for p in draws]), strict=True)):
            trials.append(Trial(first + i, p, curve[-1] if curve else None, trees, trees < int(p.get("n_estimators", trees)), list(curve)))
    return trials
