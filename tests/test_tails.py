"""The exact test of the count model beside plain sums."""

import math

import numpy as np
import pytest

from peakloom.operators import dispersion


def plain_p(a, b, ra, rb):
    at = lambda x: math.lgamma(x + ra) - math.lgamma(x + 1) + math.lgamma(a + b - x + rb) - math.lgamma(a + b - x + 1)
    front = math.lgamma(a + b + 1) + math.lgamma(ra + rb) - math.lgamma(a + b + ra + rb) - math.lgamma(ra) - math.lgamma(rb)
    chance = [math.exp(front + at(x)) for x in range(a + b + 1)]
    return min(1.0, 2 * min(math.fsum(chance[: a + 1]), math.fsum(chance[a:])))


@pytest.mark.parametrize("step", [1 << 16, 50])
def test_tails_beside_plain_sums(monkeypatch, step):
    monkeypatch.setattr(dispersion, "STEP", step)
    rng = np.random.default_rng(1)
    n = 400
    first, second = (np.floor(rng.choice([0, 2, 30, 900], n) * rng.random(n) * 2).astype(np.int64) for _ in range(2))
    one = rng.choice([0.3, 0.999, 1, 1.5, 20, 1536], n)
    two = one * rng.choice([1, 1, 0.5, 4], n)
    got = dispersion.exact_p(first, second, one, two)
    for i in range(n):
        assert math.isclose(got[i], plain_p(int(first[i]), int(second[i]), one[i], two[i]), rel_tol=1e-8, abs_tol=1e-300)


def test_log_gamma():
    x = np.concatenate([[1e-3, 0.5, 1, 2, 8.999, 9, 10.5, 1e6], np.random.default_rng(2).random(300) * 30 + 0.01])
    assert np.allclose(dispersion.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-11, atol=1e-11)


def test_work_does_not_grow_with_the_totals(monkeypatch):
    """Gammas are for values that differ, and a tail is as long as its spread."""
    seen = []
    plain = dispersion.log_gamma
    monkeypatch.setattr(dispersion, "log_gamma", lambda x: seen.append(np.size(x)) or plain(x))
    counts = np.random.default_rng(3).integers(400, 420, (2000, 6)).astype(float)
    dispersion.conditional_curves(counts, [np.arange(3), np.arange(3, 6)])
    assert sum(seen) < 49 * 2000
    seen.clear()
    whole = np.full(2000, 1200)
    dispersion.exact_p(whole, whole + 20, np.full(2000, 1536.0), np.full(2000, 1536.0))
    assert sum(seen) < 20 * 2000
