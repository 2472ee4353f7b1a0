"""Metrics, preparation, actions, drift."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from basketlens.functions.ordering import hash_rank, running_totals
from basketlens.functions.sql import exact_sum
from basketlens.operators import actions, dashboards, drift, metrics, prep


def _labelled(spark, pairs):
    return spark.createDataFrame([(int(y), float(s)) for y, s in pairs], "label int, score double")


def _auc(pairs):
    pos = [s for y, s in pairs if y]
    neg = [s for y, s in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def _ap(pairs):
    steps = sorted({s for _, s in pairs}, reverse=True)
    positives, out, last = sum(y for y, _ in pairs), 0.0, 0
    for t in steps:
        above = [y for y, s in pairs if s >= t]
        out += (sum(above) - last) / positives * sum(above) / len(above)
        last = sum(above)
    return out


def test_ranking_metrics_with_ties(spark):
    rng = random.Random(1)
    pairs = [(int(rng.random() < 0.4), round(rng.random(), 1)) for _ in range(300)]
    pairs += [(int(rng.random() < 0.7), rng.random()) for _ in range(700)]
    row = metrics.ranking_metrics(_labelled(spark, pairs)).first()
    assert row["roc_auc"] == pytest.approx(_auc(pairs), abs=1e-12)
    assert row["average_precision"] == pytest.approx(_ap(pairs), abs=1e-12)
    squeezed = metrics.ranking_metrics(_labelled(spark, [(y, s**3 / 10) for y, s in pairs])).first()
    assert squeezed["roc_auc"] == row["roc_auc"]


def test_ranking_metrics_by_group(spark):
    pairs = {"a": [(1, 0.9), (0, 0.9), (0, 0.1)], "b": [(1, 0.2), (0, 0.8)]}
    df = spark.createDataFrame([(g, y, s) for g, v in pairs.items() for y, s in v], "g string, label int, score double")
    got = {r["g"]: r["roc_auc"] for r in metrics.ranking_metrics(df, by=["g"]).collect()}
    assert got == {"a": 0.75, "b": 0.0}


def test_one_class_and_empty_give_null(spark):
    row = metrics.ranking_metrics(_labelled(spark, [(1, 0.3), (1, 0.4)])).first()
    assert row["roc_auc"] is None and row["average_precision"] == 1.0
    row = metrics.ranking_metrics(_labelled(spark, [(0, 0.3)])).first()
    assert row["roc_auc"] is None and row["average_precision"] is None
    empty = metrics.ranking_metrics(_labelled(spark, [(0, 0.3)]).limit(0)).first()
    assert empty["roc_auc"] is None


def test_confusion_threshold_is_strict(spark):
    row = metrics.confusion(_labelled(spark, [(1, 0.5), (1, 0.51), (0, 0.5), (0, 0.9)]), "label", "score").first()
    assert (row["true_positives"], row["false_positives"], row["false_negatives"], row["true_negatives"]) == (1, 1, 1, 1)
    assert row["f1_score"] == 0.5
    none = metrics.confusion(_labelled(spark, [(0, 0.1)]), "label", "score").first()
    assert none["precision"] is None and none["recall"] is None


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_equal_a_plain_scan(spark, descending):
    values = [(float(i) ** 3, i % 7) for i in range(500)]
    df = spark.createDataFrame(values, "x double, n int").repartition(5)
    got = {r["x"]: r["t"] for r in running_totals(df, "x", {"t": "n"}, descending=descending, buckets=8).collect()}
    total = 0
    for x, n in sorted(values, reverse=descending):
        total += n
        assert got[x] == total


def test_hash_rank_is_a_permutation_per_group(spark):
    df = spark.range(1000).selectExpr("id", "if(id % 10 = 0, NULL, id % 3) AS g")
    rows = hash_rank(df, "id", 1, by=["g"], size="n").collect()
    for group in {r["g"] for r in rows}:
        ranks = sorted(r["rank"] for r in rows if r["g"] == group)
        assert ranks == list(range(1, len(ranks) + 1))
        assert {r["n"] for r in rows if r["g"] == group} == {len(ranks)}
    assert sorted(r["rank"] for r in hash_rank(df, "id", 1).collect()) == list(range(1, 1001))


def test_split_and_folds_keep_class_shares(spark):
    df = spark.range(500).selectExpr("id AS user_id", "CAST(id % 10 = 0 AS INT) AS y")
    split = prep.stratified_split(df, "y").collect()
    assert sum(r["is_test"] for r in split if r["y"] == 1) == 10
    assert sum(r["is_test"] for r in split if r["y"] == 0) == 90
    folds = prep.stratified_folds(df, "y").collect()
    for y in (0, 1):
        sizes = [sum(r["fold"] == f and r["y"] == y for r in folds) for f in range(3)]
        assert max(sizes) - min(sizes) <= 1
    assert sum(r["is_test"] for r in prep.plain_split(df).collect()) == 100


def test_impute_scale_encode(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 5.0, "b"), (2, None, 5.0, "a"), (3, 3.0, 5.0, None), (4, 8.0, 5.0, "c'd")], "user_id long, x double, k double, c string"
    )
    assert {r["x"] for r in prep.impute_median(df, ["x"], exact=True).collect()} == {1.0, 3.0, 8.0}
    scaled = prep.scale_standard(df.na.fill(0.0), ["x", "k"]).orderBy("user_id").collect()
    assert [r["k"] for r in scaled] == [0.0] * 4
    assert scaled[0]["x"] == pytest.approx((1 - 3) / (38 / 4) ** 0.5)
    levels = prep.category_levels(df, ["c"])
    assert levels == {"c": ["a", "b", "c'd"]}
    dummies = prep.encode_dummies(df, levels)
    assert dummies.columns == ["user_id", "x", "k", "c_b", "c_c'd"]
    assert [tuple(r)[3:] for r in dummies.orderBy("user_id").collect()] == [(1, 0), (0, 0), (0, 0), (0, 1)]
    aligned = prep.align_columns(dummies, ["c_z", "c_b"]).orderBy("c_b").collect()
    assert [tuple(r) for r in aligned] == [(0, 0), (0, 0), (0, 0), (0, 1)]
    assert [r["c"] for r in prep.impute_missing(df, ["c"]).filter("user_id = 3").collect()] == ["missing"]
    with pytest.raises(ValueError, match="more than 2"):
        prep.category_levels(df, ["c"], limit=2)


def test_weights(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (0,)], "y int")
    rows = {r["y"]: r for r in prep.class_weights(df, "y").collect()}
    assert rows[1]["balanced_weight"] == 4 / 6 and rows[0]["balanced_weight"] == 2.0
    assert rows[1]["scale_pos_weight"] == 1 / 3
    assert sum(r["weight"] for r in prep.with_balanced_weight(df, "y").collect()) == pytest.approx(4.0)


def _scored(spark, values):
    rows = [(i, "2024-01-17", p, "Search") for i, p in enumerate(values)]
    return spark.createDataFrame(rows, "user_id long, scoring_date string, churn_probability double, traffic_source string")


def test_action_limits(spark):
    got = actions.churn_scores(_scored(spark, [0.1, 2 / 9, 0.5, 0.7, 0.70001, 0.8])).orderBy("user_id").collect()
    email, call, none = actions.COUPON, actions.CALL, actions.NO_ACTION
    assert [r["recommended_action"] for r in got] == [none, none, email, email, call, call]
    requests = spark.range(7).selectExpr("id + 10 AS request_id", "id AS user_id")
    answers = actions.answer_requests(requests, _scored(spark, [0.1, 0.5, 0.7, 0.71, 0.8, 0.81])).orderBy("user_id").collect()
    assert [r["recommended_action"] for r in answers] == [
        "Retain", "Send Coupon", "Send Coupon", "Send Coupon", "Send Coupon", "Call Customer", None]
    assert [r["is_high_risk"] for r in answers] == [False, False, False, True, True, True, None]
    assert answers[6]["status"] == "not_found"


def test_targets_break_ties_by_user(spark):
    scores = actions.churn_scores(_scored(spark, [0.9] * 10 + [0.95, 0.1]))
    assert [r["user_id"] for r in actions.retention_targets(scores, 4).collect()] == [10, 0, 1, 2]
    assert dashboards.risk_kpis(scores).first()["high_risk_users"] == 11


def test_drift_zero_mean_and_nulls(spark):
    one = spark.createDataFrame([(0.0, 1.0), (0.0, None), (0.0, 3.0)], "a double, b double")
    two = spark.createDataFrame([(1.0, 2.1), (1.0, 2.1)], "a double, b double")
    rows = {r["feature"]: r for r in drift.drift_report(one, two, ["a", "b"]).collect()}
    assert rows["a"]["shift_percent"] is None and rows["a"]["retrain"] is False
    assert rows["b"]["reference_mean"] == 2.0 and rows["b"]["shift_percent"] == pytest.approx(5.0)
    assert rows["b"]["reference_rows"] == 3
    bins = drift.drift_histogram(one, two, ["a", "b"], bins=4).collect()
    assert sum(r["rows"] for r in bins if r["feature"] == "b") == 4
    assert drift.drift_density(one, two, ["a"]).count() == 0, "constant features have no density"
    density = drift.drift_density(one, one, ["b"], points=400, cut=8).filter("side = 'current'").orderBy("point").collect()
    step = density[1]["x"] - density[0]["x"]
    assert sum(r["density"] for r in density) * step == pytest.approx(1.0, abs=1e-6)


def test_exact_sum_of_what_is_no_money(spark):
    rows = [("a", 0.1), ("a", 0.2), ("b", float("nan")), ("b", 1.0), ("c", 1e19), ("c", 1.0), ("d", None), ("e", float("inf")), ("e", 2.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(F.expr(exact_sum("x")).alias("s")).collect()}
    assert got["a"] == 0.3 and math.isnan(got["b"]) and got["c"] == 1e19 and got["d"] is None and got["e"] == float("inf")
