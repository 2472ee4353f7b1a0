from __future__ import annotations

import numpy as np
import pytest

from basketlens.operators import smote as smote_module
from basketlens.operators.neighbours import nearest_sites, sites_of

RNG = np.random.default_rng(7)


def _points(n: int) -> list[tuple]:
    """Clusters, an axis of few values, copies of one point and far outliers."""
    cloud = RNG.normal(size=(n, 3)) * [1.0, 50.0, 0.0]
    cloud[:, 2] = RNG.integers(0, 4, size=n)
    cloud[: n // 3] = cloud[0]
    cloud[-3:] += 10_000
    return [tuple(map(float, p)) for p in cloud]


def _brute(points: set[tuple], k: int) -> dict[tuple, list[float]]:
    array = np.array(sorted(points))
    out = {}
    for p in array:
        squared = np.zeros(len(array))
        for d in range(array.shape[1]):
            squared += (p[d] - array[:, d]) ** 2
        out[tuple(p)] = sorted(np.sqrt(squared))[1 : k + 1]
    return out


@pytest.mark.parametrize("cell_sites", [16, 10_000])
def test_nearest_sites_equal_brute_force(spark, cell_sites):
    points = _points(400)
    df = spark.createDataFrame([(list(p),) for p in points], "vec array<double>")
    found = nearest_sites(sites_of(df), 5, cell_sites=cell_sites).collect()
    got: dict[tuple, list[float]] = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(tuple(r["vec"]), []).append(r["distance"])
    expected = _brute(set(points), 5)
    assert got.keys() == expected.keys()
    for key, distances in expected.items():
        assert got[key] == pytest.approx(distances, rel=1e-12)


def test_a_busy_cell_is_copied_without_changing_the_answer(spark, monkeypatch):
    monkeypatch.setattr("basketlens.operators.neighbours.QUERIES_PER_TASK", 3)
    points = _points(200)
    df = spark.createDataFrame([(list(p),) for p in points], "vec array<double>")
    found = nearest_sites(sites_of(df), 3, cell_sites=16).collect()
    expected = _brute(set(points), 3)
    assert len(found) == 3 * len(expected)
    total = sum(r["distance"] for r in found)
    assert total == pytest.approx(sum(map(sum, expected.values())))


def test_copies_are_neighbours_of_each_other(spark):
    rows = [([0.0],)] * 3 + [([1.0],)] * 2 + [([5.0],)]
    sites = sites_of(spark.createDataFrame(rows, "vec array<double>"))
    vec_of = {r["site"]: r["vec"][0] for r in sites.collect()}
    slots: dict[float, list[float]] = {}
    for r in sorted(smote_module.neighbour_slots(sites, 3).collect(), key=lambda r: r["slot"]):
        slots.setdefault(vec_of[r["site"]], []).append(r["other_vec"][0])
    assert slots == {0.0: [0.0, 0.0, 1.0], 1.0: [1.0, 0.0, 0.0], 5.0: [1.0, 1.0, 0.0]}


def test_smote_reaches_parity_between_minority_rows(spark):
    rows = [(i, float(i), float(i % 3), 1) for i in range(60)] + [(100 + i, float(i), 10.0, 0) for i in range(12)]
    df = spark.createDataFrame(rows, "user_id long, a double, b double, y int")
    out = smote_module.smote(df, ["a", "b"], "y").collect()
    made = [r for r in out if r["synthetic"]]
    assert len(out) == 120 and len(made) == 48
    assert all(r["y"] == 0 and r["b"] == 10.0 and 0 <= r["a"] <= 11 for r in made)
    again = smote_module.smote(df, ["a", "b"], "y").collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_smote_needs_two_classes_and_enough_rows(spark):
    one = spark.createDataFrame([(1, 1.0, 1)], "user_id long, a double, y int")
    with pytest.raises(ValueError, match="two classes"):
        smote_module.smote(one, ["a"], "y")
    few = spark.createDataFrame([(i, 1.0, int(i > 0)) for i in range(9)], "user_id long, a double, y int")
    with pytest.raises(ValueError, match="too few"):
        smote_module.smote(few, ["a"], "y")
