from __future__ import annotations

import math
import statistics

import numpy as np
import pytest
from pyspark.ml import PipelineModel

from basketlens.functions import selection
from basketlens.functions.selection import exact_medians
from basketlens.operators.models import MedianFill
from basketlens.session import scratch_path

NAN, INF = float("nan"), math.inf
SETS = {
    "one": [3.5],
    "two": [1.0, 2.0],
    "ties in the middle": [1.0] * 5000 + [2.0] * 5000,
    "all alike": [7.25] * 3000,
    "gap in the middle": [0.0] * 4000 + [1e300] * 4000,
    "opposite ends": [-INF] * 3 + [INF] * 4,
    "negative zero": [-0.0, 0.0, 0.0, -0.0],
    "missing": [None, NAN, 4.0, None, 2.0, 9.0, NAN],
    "neighbouring doubles": [1.0 + i * 2**-52 for i in range(5001)],
}


def _frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(4)


@pytest.mark.parametrize("name", sorted(SETS))
def test_equals_the_sorted_middle(spark, name):
    own = [v for v in SETS[name] if v is not None and not math.isnan(v)]
    assert exact_medians(_frame(spark, SETS[name]), {"m": "x"}) == {"m": statistics.median(own)}


def test_many_columns_at_once_over_several_passes(spark, monkeypatch):
    monkeypatch.setattr(selection, "GRID", 100)
    rows = spark.range(0, 200_001, 1, 8).selectExpr(
        "id", "pmod(hash(id), 1000003) / 7D AS spread", "id % 3 AS few", "exp(pmod(hash(id, 5), 1400) - 700) AS wide",
        "CASE WHEN id < 0 THEN 1 END AS none", "CASE WHEN id % 2 = 0 THEN id END AS half",
    )
    found = exact_medians(rows, {c: c for c in rows.columns})
    exact = rows.selectExpr(*[f"percentile(CAST({c} AS DOUBLE), 0.5D) AS {c}" for c in rows.columns]).first().asDict()
    assert found == exact and found["none"] is None


def test_nothing(spark):
    assert exact_medians(_frame(spark, []), {"m": "x"}) == {"m": None}


def test_a_random_walk_of_sizes(spark):
    rng = np.random.default_rng(5)
    for size in (499, 500, 501, 1000, 1001, 4999):
        values = [float(v) for v in rng.integers(0, size, size)]
        assert exact_medians(_frame(spark, values), {"m": "x"})["m"] == statistics.median(values), size


def test_fitted_stage_is_saved_with_its_medians(spark):
    df = spark.createDataFrame([(1.0, None), (None, 1.0), (4.0, 0.1), (NAN, 0.2)], "num_a double, num_b double")
    stage = MedianFill(["a", "b"]).fit(df)
    path = scratch_path(spark, "fill")
    PipelineModel([stage]).write().save(path)
    rows = PipelineModel.load(path).transform(df).select("imp_a", "imp_b").collect()
    assert [tuple(r) for r in rows] == [(1.0, 0.2), (2.5, 1.0), (4.0, 0.1), (2.5, 0.2)]
    with pytest.raises(ValueError, match="num|median"):
        MedianFill(["a"]).fit(df.filter("num_a > 9 AND NOT isnan(num_a)"))
