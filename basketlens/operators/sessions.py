"""Session facts, the funnel by traffic source, and weekly cohort retention."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.sql import elapsed_seconds, flag, named, ratio, week_start

#: Weeks per long, leaving the sign alone, and longs per user.
WEEK_BITS, MOST_WORDS = 62, 32
EPOCH = date(1970, 1, 1)


def _any(condition: str) -> str:
    return f"max({flag(condition)})"


def fct_sessions(events: DataFrame) -> DataFrame:
    """One row per (session, user) of staged events.

    Every aggregate combines map-side, so a hot session costs one partial row per task.
    """
    return (
        events.groupBy("session_id", "user_id")
        .agg(
            *named(
                session_start_at="min(created_at)",
                session_end_at="max(created_at)",
                total_events="count(1)",
                has_product_view=_any("event_type = 'product'"),
                has_add_to_cart=_any("event_type = 'cart'"),
                has_purchase=_any("event_type = 'purchase'"),
                traffic_source="max(traffic_source)",
                browser="max(browser)",
                city="max(city)",
                state="max(state)",
            )
        )
        .selectExpr("*", f"{elapsed_seconds('session_start_at', 'session_end_at')} AS session_duration_seconds")
    )


def mart_funnel(sessions: DataFrame) -> DataFrame:
    """Step counts and conversion rates by traffic source.

    Steps are counted on their own, not as a path: a purchase without a view counts.
    """
    counts = sessions.groupBy("traffic_source").agg(
        *named(
            total_sessions="count(DISTINCT session_id)",
            sessions_with_view="sum(has_product_view)",
            sessions_with_cart="sum(has_add_to_cart)",
            sessions_with_purchase="sum(has_purchase)",
        )
    )
    return counts.selectExpr(
        "*",
        f"{ratio('sessions_with_view', 'total_sessions')} AS view_rate",
        f"{ratio('sessions_with_cart', 'sessions_with_view')} AS cart_add_rate",
        f"{ratio('sessions_with_purchase', 'sessions_with_cart')} AS purchase_rate",
        f"{ratio('sessions_with_purchase', 'total_sessions')} AS session_conversion_rate",
    ).orderBy(F.asc_nulls_last("traffic_source"))


def user_activities(sessions: DataFrame) -> DataFrame:
    """Distinct (user, week) pairs; sessions without a user take no part in cohorts."""
    return (
        sessions.filter("user_id IS NOT NULL")
        .selectExpr("user_id", f"{week_start('session_start_at')} AS activity_week")
        .distinct()
    )


def user_cohorts(sessions: DataFrame) -> DataFrame:
    """The week in which each user was first seen."""
    return (
        sessions.filter("user_id IS NOT NULL")
        .groupBy("user_id")
        .agg(*named(cohort_week=week_start("min(session_start_at)")))
    )


def _first_week(day: date) -> date:
    return day - timedelta(days=day.weekday())


def _user_weeks(timed: DataFrame, first: date, last: date) -> DataFrame:
    """A row per active week of a user, counted from the week of ``first``, beside the user's first one.

    Weeks are bits of a few longs, merged by ``bit_or``: a buffer of fixed width, so both
    sides of the shuffle aggregate by hash however many users there are.
    """
    origin = _first_week(first)
    words = (_first_week(last) - origin).days // 7 // WEEK_BITS + 1
    week = f"CAST(datediff({week_start('session_start_at')}, DATE'{origin}') DIV 7 AS INT)"
    inside = f"week BETWEEN 0 AND {words * WEEK_BITS - 1}"
    masks = [f"CASE WHEN week DIV {WEEK_BITS} = {i} THEN shiftleft(1L, week % {WEEK_BITS}) ELSE 0L END" for i in range(words)]
    merged = (
        timed.selectExpr("user_id", f"{week} AS week")
        .selectExpr("user_id", f"CASE WHEN {inside} THEN week ELSE raise_error('a session outside the given days') END AS week")
        .groupBy("user_id")
        .agg(*named(**{f"w{i}": f"bit_or({mask})" for i, mask in enumerate(masks)}))
    )
    # The zeros below the lowest bit of a mask are the bits of (mask & -mask) - 1.
    lowest = ", ".join(f"CASE WHEN w{i} != 0 THEN {i * WEEK_BITS} + bit_count((w{i} & -w{i}) - 1) END" for i in range(words))
    pairs = ", ".join(f"struct({i} AS word, w{i} AS mask)" for i in range(words))
    return (
        merged.selectExpr(f"coalesce({lowest}) AS cohort", f"explode(filter(array({pairs}), p -> p.mask != 0)) AS p")
        .selectExpr("cohort", "p.word", f"explode(filter(sequence(0, {WEEK_BITS - 1}), b -> getbit(p.mask, b) = 1)) AS bit")
        .selectExpr(f"date_add(DATE'{origin}', 7 * cohort) AS cohort_week", f"word * {WEEK_BITS} + bit - cohort AS period_number")
    )


def mart_retention(sessions: DataFrame, days: tuple[date, date] | None = None) -> DataFrame:
    """Active users by cohort week and weeks since then.

    Sessions are reduced to each user's active weeks in one aggregate. The first of the
    weeks is the cohort, so cohorts need no join back to the activity, and a user appears
    once per (cohort, period), so counting rows counts users. The cohort size is the count
    at period 0. ``days`` are the first and last day that sessions can start on; where they
    are not given they are read from the sessions, in a job of its own over that column.
    Weeks are kept as bits; sessions over more than 62 * 32 weeks (38 years, as one wrong
    date makes them) are kept as sets instead, with the same result.
    """
    timed = sessions.filter("user_id IS NOT NULL AND session_start_at IS NOT NULL")
    if days is None:
        days = tuple(timed.selectExpr("to_date(min(session_start_at))", "to_date(max(session_start_at))").first())
    first, last = days
    if first is None:
        first = last = EPOCH
    if (last - first).days // 7 < WEEK_BITS * MOST_WORDS - 1:
        weeks = _user_weeks(timed, first, last)
    else:
        weeks = (
            timed.groupBy("user_id")
            .agg(*named(weeks=f"collect_set({week_start('session_start_at')})"))
            .selectExpr("array_min(weeks) AS cohort_week", "explode(weeks) AS activity_week")
            .selectExpr("cohort_week", "CAST(datediff(activity_week, cohort_week) DIV 7 AS INT) AS period_number")
        )
    counts = weeks.groupBy("cohort_week", "period_number").agg(*named(active_users="count(1)"))
    initial = "max(CASE WHEN period_number = 0 THEN active_users END) OVER (PARTITION BY cohort_week)"
    return (
        counts.selectExpr("cohort_week", "period_number", f"{initial} AS initial_users", "active_users")
        .selectExpr("*", f"{ratio('active_users', 'initial_users')} AS retention_rate")
        .orderBy("cohort_week", "period_number")
    )
