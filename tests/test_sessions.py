from __future__ import annotations

from collections import Counter
from datetime import date, datetime, timedelta

import pytest

from basketlens.operators import sessions, staging

EVENT = "session_id string, user_id long, created_at timestamp_ntz, event_type string, traffic_source string, browser string, city string, state string"


def _events(spark, rows):
    full = [(s, u, datetime.fromisoformat(t), k, src, "Chrome", "A", "B") for s, u, t, k, src in rows]
    return spark.createDataFrame(full, EVENT)


def test_session_facts(spark):
    facts = sessions.fct_sessions(
        _events(spark, [
            ("s1", 1, "2024-01-01 10:00:00.900", "product", "Search"),
            ("s1", 1, "2024-01-01 10:00:02", "cart", None),
            ("s1", 2, "2024-01-01 11:00:00", "purchase", "Email"),
            (None, None, "2024-01-01 12:00:00", None, None),
        ])
    ).collect()
    by_key = {(r["session_id"], r["user_id"]): r for r in facts}
    assert len(by_key) == 3, "a session shared by two users gives two rows"
    first = by_key[("s1", 1)]
    assert (first["total_events"], first["has_product_view"], first["has_add_to_cart"], first["has_purchase"]) == (2, 1, 1, 0)
    assert first["session_duration_seconds"] == 1, "whole elapsed seconds, not boundaries crossed"
    assert first["traffic_source"] == "Search"
    assert by_key[(None, None)]["has_purchase"] == 0


def test_funnel_counts_and_empty_bases(spark):
    funnel = {
        r["traffic_source"]: r
        for r in sessions.mart_funnel(
            sessions.fct_sessions(
                _events(spark, [
                    ("a", 1, "2024-01-01", "product", "Search"), ("b", 1, "2024-01-01", "cart", "Search"),
                    ("c", 1, "2024-01-01", "home", "Search"), ("d", 2, "2024-01-01", "purchase", "Email"),
                    ("e", 3, "2024-01-01", "home", None),
                ])
            )
        ).collect()
    }
    assert list(funnel) == ["Email", "Search", None], "unknown source last"
    assert funnel["Search"]["view_rate"] == 1 / 3 and funnel["Search"]["cart_add_rate"] == 1.0
    email = funnel["Email"]
    assert email["cart_add_rate"] is None and email["purchase_rate"] is None
    assert email["session_conversion_rate"] == 1.0, "a purchase without a view counts"


def test_retention_over_weeks(spark):
    facts = sessions.fct_sessions(
        _events(spark, [
            ("a", 1, "2024-01-07 23:59:00", "home", "Search"), ("b", 1, "2024-01-08 00:00:00", "home", "Search"),
            ("c", 1, "2024-01-08 05:00:00", "home", "Search"), ("d", 2, "2024-01-03", "home", "Search"),
            ("e", 3, "2024-01-09", "home", "Search"), ("f", 3, "2024-01-30", "home", "Search"),
            ("g", None, "2024-01-01", "home", "Search"),
        ])
    )
    rows = [tuple(r) for r in sessions.mart_retention(facts).collect()]
    assert rows == [
        (date(2024, 1, 1), 0, 2, 2, 1.0), (date(2024, 1, 1), 1, 2, 1, 0.5),
        (date(2024, 1, 8), 0, 1, 1, 1.0), (date(2024, 1, 8), 3, 1, 1, 1.0),
    ]
    assert sessions.user_cohorts(facts).count() == 3
    assert sessions.user_activities(facts).count() == 5


def test_full_name_with_gaps(spark):
    columns = "id long, first_name string, last_name string, email string, age int, gender string, state string, " \
        "street_address string, postal_code string, city string, country string, latitude double, longitude double, " \
        "traffic_source string, created_at string"
    rows = [(i, f, l, *([None] * 11), "2024-01-01 00:00:00 UTC") for i, f, l in
            [(1, "Ann", "Lee"), (2, "Bo", None), (3, None, None)]]
    got = staging.stg_users(spark.createDataFrame(rows, columns)).orderBy("user_id").collect()
    assert [r["full_name"] for r in got] == ["Ann Lee", "Bo ", " "]
    assert got[0]["created_at"] == datetime(2024, 1, 1)


def _weekly(spark, rows):
    return spark.createDataFrame(
        [(u, None if t is None else datetime.fromisoformat(t)) for u, t in rows], "user_id long, session_start_at timestamp_ntz"
    )


def _retained(df):
    return [tuple(r) for r in df.collect()]


def _by_hand(rows):
    weeks: dict[int, set[date]] = {}
    for user, t in rows:
        if user is not None and t is not None:
            day = datetime.fromisoformat(t).date()
            weeks.setdefault(user, set()).add(day - timedelta(days=day.weekday()))
    counts = Counter((min(own), (w - min(own)).days // 7) for own in weeks.values() for w in own)
    return [(c, p, counts[c, 0], n, n / counts[c, 0]) for (c, p), n in sorted(counts.items())]


def test_retention_over_many_words_of_weeks(spark):
    """Weeks at both ends of words, sessions of a year before another's, users and times missing."""
    start = datetime(2015, 1, 5)
    rows = [(u, (start + timedelta(weeks=(u * 61 + k * k * 31) % 500, days=k % 7)).isoformat()) for u in range(40) for k in range(9)]
    rows += [(99, (start + timedelta(weeks=w)).isoformat()) for w in (61, 62, 123, 124, 499)]
    rows += [(None, "2015-01-06"), (7, None), (98, "2014-12-31 23:59:59")]
    found = sessions.mart_retention(_weekly(spark, rows))
    assert _retained(found) == _by_hand(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_retention_over_a_wrong_date_and_over_nothing(spark):
    rows = [(1, "1970-01-01"), (1, "2024-01-03"), (2, "9998-05-05"), (2, "2024-01-10")]
    assert _retained(sessions.mart_retention(_weekly(spark, rows))) == _by_hand(rows)
    assert _retained(sessions.mart_retention(_weekly(spark, [(None, "2024-01-01"), (1, None)]))) == []


def test_retention_refuses_sessions_outside_the_given_days(spark):
    facts = _weekly(spark, [(1, "2024-01-03"), (1, "2026-01-03")])
    with pytest.raises(Exception, match="outside the given days"):
        sessions.mart_retention(facts, (date(2024, 1, 1), date(2024, 2, 1))).collect()
