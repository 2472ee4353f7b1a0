from __future__ import annotations

import math

import numpy as np
import pytest

from basketlens.operators import drift


def _frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "f double")


def _plain(values, points=100, cut=3.0):
    """The kernel sum over all values, point by point."""
    v = np.array([x for x in values if x is not None], dtype=float)
    h = v.std(ddof=1) * len(v) ** -0.2
    x = v.min() - cut * h + np.arange(points) * ((v.max() - v.min() + 2 * cut * h) / (points - 1))
    total = np.exp(-0.5 * ((x[:, None] - v[None, :]) / h) ** 2).sum(axis=1)
    return x, total / (len(v) * h * math.sqrt(2 * math.pi)), h


SETS = {
    "continuous": list(np.random.default_rng(1).normal(3, 2, 4000)) + [None, None],
    "few values": [float(i % 5) for i in range(1000)],
    "far outlier": list(np.random.default_rng(2).exponential(1, 3000)) + [1e7],
    "tiny unit": list(np.random.default_rng(3).normal(-5e-9, 1e-9, 500)),
    "two rows": [1.0, 2.0],
}


@pytest.mark.parametrize("name", sorted(SETS))
def test_density_equals_the_kernel_sum(spark, name):
    other = [float(i) for i in range(50)]
    rows = drift.drift_density(_frame(spark, SETS[name]), _frame(spark, other), ["f"]).orderBy("side", "point").collect()
    for side, values in (("reference", SETS[name]), ("current", other)):
        x, density, h = _plain(values)
        own = [r for r in rows if r["side"] == side]
        assert [r["point"] for r in own] == list(range(100))
        np.testing.assert_allclose([r["x"] for r in own], x, rtol=1e-9, atol=1e-9 * h)
        np.testing.assert_allclose([r["density"] * h for r in own], density * h, atol=1e-9)


def test_density_of_constant_empty_and_single(spark):
    for values in ([], [None], [4.0], [4.0] * 10):
        rows = drift.drift_density(_frame(spark, values), _frame(spark, [1.0, 3.0]), ["f"]).select("side").distinct().collect()
        assert [r["side"] for r in rows] == ["current"]


def test_hermite_polynomials():
    assert drift.hermite(4) == [[1], [0, 1], [-1, 0, 1], [0, -3, 0, 1], [3, 0, -6, 0, 1]]
