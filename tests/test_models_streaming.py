from __future__ import annotations

import json
from dataclasses import asdict

import numpy as np
import pytest
from pyspark.ml import Pipeline

from basketlens.operators import actions, explain, models, prep
from basketlens.operators.churn import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from basketlens.operators.tuning import rungs_of, survivors, tune_boosted
from basketlens.plans import scoring, training
from basketlens.session import scratch_path
from basketlens.sources.layers import FolderLayer
from basketlens.sources.registry import ModelRegistry
from basketlens.streaming import requests as stream


@pytest.fixture(scope="module")
def train_set(spark):
    """Churn follows recency and country; the other columns are noise."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        recency, country = int(rng.integers(0, 60)), ["DE", "FR", "US"][int(rng.integers(0, 3))]
        z = 0.15 * (recency - 25) + (1.5 if country == "FR" else 0.0)
        y = int(rng.random() < 1 / (1 + np.exp(-z)))
        noise = [int(v) for v in rng.integers(0, 9, size=7)]
        rows.append((i, "2023-09-01", "Search" if i % 2 else "Email", country, "F" if i % 3 else None, recency, *noise[:7],
                     float(rng.random()), int(rng.integers(1, 9)), y))
    names = ["recency_days int"] + [f"{c} int" for c in ("frequency_60d", "frequency_30d", "tenure_days", "total_events",
             "view_count", "cart_count", "session_count")] + ["view_to_cart_rate double", "frequency_all_time int", "is_churned int"]
    schema = "user_id long, snapshot_date string, traffic_source string, country string, gender string, " + ", ".join(names)
    df = spark.createDataFrame(rows, schema)
    path = scratch_path(spark, "train")
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def baseline(train_set):
    return training.train_baseline(train_set)


def test_baseline_solves_the_penalized_problem(spark, train_set):
    """The gradient of the balanced, L2-penalized log-loss vanishes at the fit."""
    train = prep.with_balanced_weight(train_set, "is_churned")
    model = models.baseline_pipeline(400).fit(train)
    rows = model.transform(train).select("features", "is_churned", "weight").collect()
    x = np.array([r["features"].toArray() for r in rows])
    assert np.allclose(x[:, :10].std(axis=0), 1.0), "population deviation"
    y, w = np.array([r["is_churned"] for r in rows]), np.array([r["weight"] for r in rows])
    beta, b0 = model.stages[-1].coefficients.toArray(), model.stages[-1].intercept
    p = 1 / (1 + np.exp(-(x @ beta + b0)))
    assert np.abs(x.T @ (w * (p - y)) + beta).max() / 400 < 1e-3
    assert abs((w * (p - y)).sum()) / 400 < 1e-3


def test_unknown_category_gives_zeros(spark, train_set):
    train = prep.with_balanced_weight(train_set, "is_churned")
    model = models.baseline_pipeline(400).fit(train)
    odd = train_set.limit(1).selectExpr(*[f"'XX' AS {c}" if c == "country" else c for c in train_set.columns])
    row = model.transform(odd).first()
    assert row["hot_country"].numNonzeros() == 0 and row["hot_gender"].size == 2


def test_baseline_metrics_and_split(baseline, train_set):
    found = {r["metric"]: r["value"] for r in baseline.metrics.collect()}
    assert set(found) == {"accuracy", "precision", "recall", "f1_score", "prevalence", "roc_auc", "average_precision"}
    assert found["roc_auc"] > 0.7
    assert abs(baseline.test.count() - 80) <= 1


def test_permutation_finds_the_signal(baseline, train_set):
    rows = explain.permutation_importance(
        baseline.model, train_set, [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES], "is_churned").collect()
    assert len(rows) == 13 and rows[0]["feature"] == "recency_days" and rows[0]["importance"] > 0.1


def test_boosted_and_importance(spark, train_set):
    trained = training.train_boosted(train_set, models.BoostedParams(trees=5, depth=3, rate=0.3))
    found = {r["metric"]: r["value"] for r in trained.metrics.collect()}
    assert found["roc_auc"] > 0.6
    shares = explain.split_importance(trained.model, train_set).collect()
    assert shares[0]["feature"] == "imp_recency_days"
    assert sum(r["importance"] for r in shares) == pytest.approx(1.0)
    assert len(shares) == 10 + 1 + 2, "first level of each category is the base"


def test_tuning_stops_the_worse_part(train_set):
    tuned = tune_boosted(train_set, trials=6, trees=4, folds=2, rungs=2, keep=0.5)
    rows = tuned.trials.collect()
    assert [r["trial"] for r in rows] == list(range(6))
    first, last = ([r for r in rows if r["rung"] == n] for n in (0, 1))
    assert len(first) == len(last) == 3
    assert {(r["row_share"], r["trees"]) for r in first} == {(0.5, 2)} and {(r["row_share"], r["trees"]) for r in last} == {(1.0, 4)}
    assert all(r["stopped"] == "behind 3 of 6 in rung 0" for r in first)
    best = [r for r in last if r["stopped"] is None]
    assert len(best) == 1 and best[0]["mean_average_precision"] == tuned.best_score == max(r["mean_average_precision"] for r in last)
    assert all(abs(sum(r["fold_scores"]) / 2 - r["mean_average_precision"]) < 1e-12 for r in rows)
    assert (tuned.best.depth, tuned.best.rate, tuned.best.trees) == (best[0]["depth"], best[0]["rate"], 4)


def test_survivors_and_rungs():
    assert survivors({0: 0.1, 1: None, 2: 0.5, 3: 0.5, 4: 0.2}, 0.5) == [2, 3, 4]
    assert survivors({3: None, 1: None}, 0.5) == [1, 3]
    assert survivors({7: 0.3}, 0.0) == [7]
    assert [(r.share, r.trees) for r in rungs_of(3, 0.5, 12)] == [(0.25, 3), (0.5, 6), (1.0, 12)]


def test_medians_do_not_see_the_held_out_fold(train_set, monkeypatch):
    """The encoder is fitted once per rung and fold, on rows of the other folds only, and once on all at the end."""
    seen = []
    fit = Pipeline.fit

    def watched(self, rows, *args):
        if "fold" in rows.columns:
            seen.append({r["fold"] for r in rows.select("fold").distinct().collect()})
        return fit(self, rows, *args)

    monkeypatch.setattr(Pipeline, "fit", watched)
    tune_boosted(train_set, trials=1, trees=2, folds=3, rungs=1)
    assert sorted(map(sorted, seen)) == [[0, 1], [0, 1, 2], [0, 2], [1, 2]]


def test_tuning_ranks_trials(train_set):
    tuned = tune_boosted(train_set, trials=2, trees=2, folds=2, rungs=1)
    rows = tuned.trials.collect()
    assert len(rows) == 2
    assert tuned.best_score == max(r["mean_average_precision"] for r in rows)
    assert 0 < models.score(tuned.model, train_set).first()["churn_probability"] < 1
    registry = ModelRegistry(FolderLayer(train_set.sparkSession, scratch_path(train_set.sparkSession, "registry")))
    values = registry.run_values(tuned.log(registry, "tuning")).collect()
    assert {r["key"]: r["text"] for r in values if r["kind"] == "param"} == {k: str(v) for k, v in asdict(tuned.best).items()}
    assert [r["value"] for r in values if r["kind"] == "metric"] == [tuned.best_score]


def test_legacy_model_from_training_to_predictions(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        recency = int(rng.integers(1, 200))
        rows.append((i, recency, int(rng.integers(1, 9)), float(rng.random() * 100), float(rng.random() * 50), int(rng.integers(200, 900)),
                     int(rng.random() < (0.9 if recency > 100 else 0.2))))
    df = spark.createDataFrame(
        rows, "user_id long, recency_days int, frequency long, monetary double, avg_order_value double, tenure_days int, is_churned int"
    )
    trained = training.train_legacy(df, models.BoostedParams(trees=5, depth=3, rate=0.3))
    assert {r["metric"]: r["value"] for r in trained.metrics.collect()}["roc_auc"] > 0.7
    registry = ModelRegistry(FolderLayer(spark, scratch_path(spark, "registry")))
    trained.log(registry, training.LEGACY_EXPERIMENT, "legacy")
    out = scoring.legacy_predict(df.drop("is_churned"), registry)
    assert out.columns == ["user_id", "churn_probability", "prediction_ts"] and out.count() == 300
    assert out.filter("churn_probability NOT BETWEEN 0 AND 1").count() == 0


def test_batch_scoring_writes_tables(spark, baseline, train_set):
    registry = ModelRegistry(FolderLayer(spark, scratch_path(spark, "registry")))
    registry.register(training.REGISTERED_MODEL, baseline.model)
    baseline.log(registry, training.EXPERIMENT, "baseline")
    out = FolderLayer(spark, scratch_path(spark, "out"))
    features = train_set.withColumnRenamed("snapshot_date", "scoring_date").drop("is_churned")
    scoring.write_scores(scoring.batch_score(features, registry), out, top=20)
    assert out.read("churn_scores").columns == actions.SCORE_COLUMNS
    targets = out.read("retention_targets")
    best = out.read("churn_scores").agg({"expected_uplift_value": "max"}).first()[0]
    assert targets.count() == 20 and targets.agg({"expected_uplift_value": "max"}).first()[0] == best


def test_stream_answers_equal_batch(spark, baseline, train_set, tmp_path):
    path = scratch_path(spark, "features")
    train_set.write.parquet(path)
    features = spark.read.parquet(path)

    def scoring(df):
        return models.score(baseline.model, df)

    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()

    def put(name, ids):
        lines = [json.dumps({"request_id": 1000 + i, "user_id": i}) for i in ids]
        (folder / name).write_text("\n".join(lines))

    put("a.json", range(5))
    stream.serve(stream.read_requests(spark, str(folder)), features, scoring, out, state).awaitTermination(120)
    put("b.json", [7, 7, 9999])
    stream.serve(stream.read_requests(spark, str(folder), 1), features, scoring, out, state).awaitTermination(120)
    batch = spark.read.schema(stream.REQUEST_SCHEMA).json(str(folder))
    expected = sorted(map(str, actions.answer_requests(batch, scoring(features)).collect()))
    assert sorted(map(str, spark.read.parquet(out).drop("batch").collect())) == expected
    assert len(expected) == 8 and sum("not_found" in r for r in expected) == 1
    direct = stream.answers(batch, train_set, baseline.model)
    assert direct.count() == 8
    plan = direct._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan, "only users asked for are scored"
