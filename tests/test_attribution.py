"""Shares of boosted trees against sums over all feature subsets, and against the model's own margins."""

from __future__ import annotations

import itertools
import random
from math import factorial

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler

from basketlens.operators import attribution

NAMES = ["a", "b", "c", "d"]


def fitted(spark, trees, depth):
    rng = random.Random(depth)
    rows = []
    for i in range(300):
        x = [rng.random(), rng.choice([0.0, 1.0, 2.0]), rng.random(), rng.gauss(0, 1)]
        rows.append((i, *x, float(x[0] + x[1] * x[3] > 1 + rng.random()), rng.choice([1.0, 2.5])))
    df = spark.createDataFrame(rows, "user_id long, a double, b double, c double, d double, y double, w double").cache()
    gbt = GBTClassifier(labelCol="y", weightCol="w", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=4)
    return Pipeline(stages=[VectorAssembler(inputCols=NAMES, outputCol="features"), gbt]).fit(df), df


def by_subsets(tree, x, n):
    """Shapley values from the definition."""

    def worth(known):
        total = 0.0
        for leaf in range(len(tree.value)):
            p = tree.value[leaf]
            for f, low, high, share in zip(tree.feature[leaf], tree.low[leaf], tree.high[leaf], tree.share[leaf]):
                p *= float(low < x[f] <= high) if f in known else share
            total += p
        return total

    out = np.zeros(n)
    for i in range(n):
        others = [f for f in range(n) if f != i]
        for size in range(n):
            for some in itertools.combinations(others, size):
                weight = factorial(size) * factorial(n - size - 1) / factorial(n)
                out[i] += weight * (worth({*some, i}) - worth(set(some)))
    return out


@pytest.mark.parametrize(("trees", "depth"), [(1, 1), (3, 3), (2, 6)])
def test_shares_equal_sums_over_subsets(spark, trees, depth):
    model, df = fitted(spark, trees, depth)
    got = {r["user_id"]: r for r in attribution.attribute(model, df).collect()}
    stored = attribution.stored_paths(spark, model.stages[-1])
    for row in df.limit(12).collect():
        expected = sum(by_subsets(t, [row[n] for n in NAMES], 4) for t in stored)
        assert np.allclose([got[row["user_id"]][n] for n in NAMES], expected, atol=1e-12)


@pytest.mark.parametrize("table", [0, 1 << 22])
def test_shares_add_up_to_the_margin(spark, monkeypatch, table):
    monkeypatch.setattr(attribution, "TABLE", table)
    model, df = fitted(spark, 12, 5)
    margins = {r["user_id"]: r["rawPrediction"][1] for r in model.transform(df).collect()}
    stored = attribution.stored_paths(spark, model.stages[-1])
    mean = sum(t.expected for t in stored)
    x = np.array([[r[n] for n in NAMES] for r in df.collect()])
    direct = np.zeros(x.shape)
    for tree in stored:
        attribution.tree_shares(tree, x, direct)
    for r, own in zip(attribution.attribute(model, df).collect(), direct):
        assert abs(r[attribution.MARGIN] - margins[r["user_id"]]) < 1e-9
        assert abs(sum(own) - (r[attribution.MARGIN] - mean)) < 1e-9


def test_importance_ranks_the_features_that_decide(spark):
    model, df = fitted(spark, 10, 4)
    ranked = attribution.importance(attribution.attribute(model, df), NAMES).collect()
    assert {r["feature"] for r in ranked[:3]} == {"a", "b", "d"} and ranked[-1]["feature"] == "c"
    assert attribution.attribute(model, df.limit(0)).count() == 0
