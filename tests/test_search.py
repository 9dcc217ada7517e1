"""Parzen search on known surfaces."""

import math

import numpy as np
import pytest

from txnlens.operators.search import ParzenSearch, _Mixture

SPACE = {"x": ("float", -5.0, 5.0), "n": ("int", 1, 40), "c": ("log", 0.001, 10.0), "k": ("choice", ["a", "b", "c"])}


def surface(p):
    return -((p["x"] - 2) ** 2) - ((p["n"] - 30) / 8) ** 2 - (math.log10(p["c"]) + 1) ** 2 + (p["k"] == "b")


def best(seed, startup, trials=60):
    search = ParzenSearch(SPACE, seed, startup=startup)
    for _ in range(trials):
        p = search.ask()
        search.tell(p, surface(p))
    return max(search.scores)


def test_beats_random_search():
    parzen = [best(s, 10) for s in range(8)]
    random = [best(s, 10**6) for s in range(8)]
    assert np.mean(parzen) > np.mean(random) + 0.2 and sum(a > b for a, b in zip(parzen, random)) >= 6
    assert best(3, 10) == best(3, 10)


def test_values_stay_in_their_ranges():
    search = ParzenSearch(SPACE, 1, startup=3)
    for i in range(30):
        p = search.ask()
        assert -5 <= p["x"] <= 5 and 1 <= p["n"] <= 40 and isinstance(p["n"], int) and 0.001 <= p["c"] <= 10 and p["k"] in "abc"
        search.tell(p, math.nan if i % 4 == 0 else 5.0 * (p["x"] == 5.0))


def test_mixture_is_a_density():
    m = _Mixture(np.array([0.0, 0.1, 3.0]), -1.0, 4.0)
    x = np.linspace(-1, 4, 4001)
    assert np.trapezoid([math.exp(m.log_density(v)) for v in x], x) == pytest.approx(1.0, abs=1e-3)
