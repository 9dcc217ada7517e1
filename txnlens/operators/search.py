"""Tree-structured Parzen search: two densities over past trials, of the good ones and of the rest, steer the next draw.

Every parameter has its own pair of densities: for numbers a mixture of truncated normals around the trials and a wide one
over the whole range, for choices their smoothed shares. Some draws are taken from the good density, and the one that is
likeliest under it compared with the other is tried next. Only parameters and scores are kept.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

#: Trials that are drawn at random first.
STARTUP = 10
#: Draws from the good density of which one is tried.
CANDIDATES = 24
_MOST_GOOD = 25
_PRIOR_WEIGHT = 1.0


def _phi(z: np.ndarray) -> np.ndarray:
    return np.array([0.5 * (1 + math.erf(v / math.sqrt(2))) for v in np.ravel(z)]).reshape(np.shape(z))


class _Mixture:
    """Truncated normals around some points of [low, high], and one over the range."""

    def __init__(self, points: np.ndarray, low: float, high: float):
        self.low, self.high = low, high
        order = np.argsort(points)
        centers = np.append(points[order], (low + high) / 2)
        edges = np.concatenate([[low], points[order], [high]])
        gaps = np.maximum(edges[1:-1] - edges[:-2], edges[2:] - edges[1:-1])
        floor = (high - low) / min(100.0, 1.0 + len(points))
        self.centers = centers
        self.widths = np.append(np.clip(gaps, floor, high - low), high - low)
        self.weights = np.append(np.ones(len(points)), _PRIOR_WEIGHT)
        self.weights /= self.weights.sum()
        self.inside = _phi((high - centers) / self.widths) - _phi((low - centers) / self.widths)

    def draw(self, rng: np.random.Generator) -> float:
        k = rng.choice(len(self.centers), p=self.weights)
        while True:
            v = rng.normal(self.centers[k], self.widths[k])
            if self.low <= v <= self.high:
                return float(v)

    def log_density(self, v: float) -> float:
        z = (v - self.centers) / self.widths
        return math.log(float((self.weights * np.exp(-z * z / 2) / (self.widths * self.inside)).sum()) / math.sqrt(2 * math.pi))


class _Shares:
    """Smoothed shares of the options of a choice."""

    def __init__(self, points: list, options: list):
        counts = np.array([sum(p == o for p in points) + _PRIOR_WEIGHT / len(options) for o in options], float)
        self.options, self.shares = options, counts / counts.sum()

    def draw(self, rng: np.random.Generator):
        return self.options[rng.choice(len(self.options), p=self.shares)]

    def log_density(self, v) -> float:
        return math.log(self.shares[self.options.index(v)])


@dataclass
class ParzenSearch:
    """Asks for parameter sets of a space (see ``SEARCH_SPACES``) and is told their scores, of which larger ones are better."""

    space: dict
    seed: int = 42
    startup: int = STARTUP
    candidates: int = CANDIDATES
    params: list[dict] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    asked: int = 0

    def _density(self, name: str, trials: list[dict]):
        kind, *rest = self.space[name]
        if kind == "choice":
            return _Shares([t[name] for t in trials], list(rest[0]))
        low, high = rest
        points = np.array([t[name] for t in trials], float)
        if kind == "log":
            return _Mixture(np.log(points), math.log(low), math.log(high))
        if kind == "int":
            return _Mixture(points, low - 0.5, high + 0.5)
        return _Mixture(points, low, high)

    def _value(self, name: str, v):
        kind, *rest = self.space[name]
        if kind == "choice":
            return v
        low, high = rest
        if kind == "int":
            return int(min(max(round(v), low), high))
        return float(min(max(math.exp(v) if kind == "log" else v, low), high))

    def ask(self) -> dict:
        rng = np.random.default_rng([self.seed, self.asked])
        self.asked += 1
        good, rest = [], []
        if len(self.scores) >= self.startup:
            order = sorted(range(len(self.scores)), key=lambda i: -self.scores[i])
            n = min(math.ceil(0.1 * len(order)) + 1, _MOST_GOOD)
            good, rest = [self.params[i] for i in order[:n]], [self.params[i] for i in order[n:]]
        out = {}
        for name in self.space:
            first, other = self._density(name, good), self._density(name, rest)
            if not good:  # as likely anywhere in the range
                kind, *bounds = self.space[name]
                drawn = first.draw(rng) if kind == "choice" else rng.uniform(first.low, first.high)
            else:
                draws = [first.draw(rng) for _ in range(self.candidates)]
                drawn = max(draws, key=lambda v: first.log_density(v) - other.log_density(v))
            out[name] = self._value(name, drawn)
        return out

    def tell(self, params: dict, score: float) -> None:
        """A score that isn't a number counts as the worst."""
        self.params.append(params)
        self.scores.append(-math.inf if math.isnan(score) else score)
