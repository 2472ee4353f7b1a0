from __future__ import annotations

from datetime import datetime

import pytest

from basketlens.operators import churn

S = "2023-09-01"


def _orders(spark, rows):
    full = [(i, u, s, datetime.fromisoformat(t)) for i, u, s, t in rows]
    return spark.createDataFrame(full, "order_id long, user_id long, status string, created_at timestamp_ntz")


def _events(spark, rows):
    full = [(u, s, k, datetime.fromisoformat(t)) for u, s, k, t in rows]
    return spark.createDataFrame(full, "user_id long, session_id string, event_type string, created_at timestamp_ntz")


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(
        [(i, "Search", "FR", "F") for i in range(1, 8)], "user_id long, traffic_source string, country string, gender string"
    )


ORDERS = [
    (1, 1, "Complete", "2023-07-03"),            # exactly snapshot - 60 d: inside
    (2, 1, "Complete", "2023-08-02"),            # exactly snapshot - 30 d: inside the short window
    (2, 1, "Complete", "2023-08-02"),            # the same order again
    (3, 1, "Complete", "2023-09-01"),            # at the snapshot: future
    (4, 2, "Returned", "2023-08-20"),            # void
    (5, 3, None, "2023-08-20"),                  # unknown status: not a purchase
    (6, 4, "Shipped", "2023-07-02 23:59:59"),    # just before the window
    (7, 5, "Shipped", "2023-08-29 12:00:00"),    # 2.5 days before
    (8, 5, "Shipped", "2023-10-01"),             # at snapshot + 30 d: beyond the horizon
    (9, 6, "Cancelled", "2023-09-10"), (10, 6, "Shipped", "2023-08-30"),
    (11, None, "Complete", "2023-08-30"),
]
EVENTS = [
    (1, "a", "product", "2023-08-01"), (1, "a", "cart", "2023-08-01"), (1, "b", "product", "2023-08-31 23:59:59"),
    (1, "c", "product", "2023-09-01"), (5, "d", "cart", "2022-01-01"), (None, "e", "cart", "2022-01-01"),
]


def test_features_at_the_borders(spark, users):
    got = churn.churn_features(users, _orders(spark, ORDERS), _events(spark, EVENTS), S)
    rows = {r["user_id"]: r for r in got.collect()}
    assert set(rows) == {1, 4, 5, 6}
    one = rows[1]
    assert (one["frequency_all_time"], one["frequency_60d"], one["frequency_30d"]) == (2, 2, 1)
    assert (one["recency_days"], one["tenure_days"]) == (30, 60)
    assert (one["total_events"], one["view_count"], one["cart_count"], one["session_count"]) == (3, 2, 1, 2)
    assert one["view_to_cart_rate"] == 0.5
    assert rows[5]["recency_days"] == 3, "2.5 days round away from zero"
    assert rows[5]["view_to_cart_rate"] == 0.0 and rows[4]["frequency_60d"] == 0
    assert rows[4]["total_events"] == 0


def test_features_do_not_leak(spark, users):
    orders, events = _orders(spark, ORDERS), _events(spark, EVENTS)
    late = _orders(spark, [(100 + i, i, "Complete", "2023-09-01") for i in range(1, 8)])
    late_events = _events(spark, [(i, "z", "cart", "2023-09-02") for i in range(1, 8)])
    before = churn.churn_features(users, orders, events, S)
    after = churn.churn_features(users, orders.unionByName(late), events.unionByName(late_events), S)
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.collect()))


def test_scoring_is_the_same_function(spark, users):
    orders, events = _orders(spark, ORDERS), _events(spark, EVENTS)
    a = churn.churn_features(users, orders, events, S).withColumnRenamed("snapshot_date", "scoring_date")
    b = churn.churn_scoring(users, orders, events, S)
    assert a.columns == b.columns and sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_labels(spark):
    got = churn.churn_labels(_orders(spark, ORDERS), S).collect()
    assert {r["user_id"]: r["is_churned"] for r in got} == {1: 0, 5: 1, 6: 1, None: 1}


def test_active_users_and_windows_agree_with_features(spark):
    orders = _orders(spark, ORDERS)
    assert {r["user_id"] for r in churn.active_users(orders, S).collect()} == {1, 5, 6, None}
    windowed = {r["user_id"]: (r["frequency_60d"], r["frequency_30d"]) for r in churn.windowed_rfm(orders, S).collect()}
    assert windowed[1] == (2, 1)
    assert {r["user_id"]: r["total_orders"] for r in churn.rfm(orders, S).collect()}[1] == 3


def test_legacy_features(spark):
    items = spark.createDataFrame(
        [(1, 1, 10.1), (2, 1, 20.2), (2, 1, 0.3), (4, 2, 99.0), (3, 1, 1000.0)], "order_id long, user_id long, sale_price double"
    )
    orders = _orders(spark, ORDERS[:2] + ORDERS[3:])
    rows = {r["user_id"]: r for r in churn.mart_churn_features(orders, items, S).collect()}
    assert set(rows) == {1, 4, 5, 6}
    one = rows[1]
    assert (one["recency_days"], one["tenure_days"], one["frequency"], one["is_churned"]) == (30, 60, 2, 0)
    assert one["monetary"] == 30.6 and one["avg_order_value"] == 15.3
    assert rows[4]["monetary"] == 0.0 and rows[4]["is_churned"] == 1
    assert rows[5]["is_churned"] == 0, "the target is open-ended"
    assert {r["user_id"]: r["is_churned"] for r in churn.mart_churn_features(orders, items, S, 30).collect()}[5] == 1
    latest = {r["user_id"]: r for r in churn.mart_churn_inference(orders, items).collect()}
    assert latest[5]["recency_days"] == 0 and latest[1]["recency_days"] == 30
    assert "is_churned" not in churn.mart_churn_inference(orders, items).columns


def test_money_is_summed_as_stored(spark):
    from basketlens.functions.sql import exact_sum, named

    prices = spark.createDataFrame([(29.995,), (29.995,), (0.004,), (0.004,), (None,)], "price double")
    assert prices.agg(*named(total=exact_sum("price"))).first()["total"] == 59.998
