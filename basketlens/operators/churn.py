"""Point-in-time churn features and labels, in two generations.

The snapshot date is an argument and becomes a literal, so the date filters
reach the scan; nothing dated on or after the snapshot enters a feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketlens.functions.sql import (
    Moment, before, elapsed_days_rounded, exact_sum, flag, look_ahead, look_back, moment, named, not_in,
    or_zero, ratio, with_stats,
)
from basketlens.schemas import VOID_STATUSES

# Dates and windows used when none are given.
FEATURE_SNAPSHOT = "2023-09-01"
SCORING_SNAPSHOT = "2024-01-17"
LEGACY_CUTOFF = "2023-10-01"
WINDOW_DAYS, SHORT_WINDOW_DAYS = 60, 30
ACTIVE_DAYS, HORIZON_DAYS = 60, 30

NUMERIC_FEATURES = [
    "recency_days", "frequency_60d", "frequency_30d", "tenure_days", "total_events",
    "view_count", "cart_count", "session_count", "view_to_cart_rate", "frequency_all_time",
]
CATEGORICAL_FEATURES = ["traffic_source", "country", "gender"]
LEGACY_FEATURES = ["recency_days", "frequency", "monetary", "avg_order_value", "tenure_days"]
TARGET = "is_churned"


def purchases(orders: DataFrame) -> DataFrame:
    """Orders that count: neither returned nor cancelled; an unknown status does not count."""
    return orders.filter(not_in("status", VOID_STATUSES))


def _any_order(inside: str) -> str:
    return f"max({flag(f'{inside} AND order_id IS NOT NULL')})"


def _order_stats(orders: DataFrame, windows: dict[str, str]) -> DataFrame:
    """Per user: distinct orders (all, and per window), first and last order time.

    Distinct orders are found by grouping on (user, order) first. Its shuffle key
    spreads a hot user over all tasks, and the second aggregate then merges
    partial sums; several distinct counts would instead multiply every row.
    """
    per_order = orders.groupBy("user_id", "order_id").agg(
        *named(first_at="min(created_at)", last_at="max(created_at)", rows="count(1)"),
        *named(**{name: _any_order(inside) for name, inside in windows.items()}),
    )
    return per_order.groupBy("user_id").agg(
        *named(
            frequency="count(order_id)", first_order_at="min(first_at)", last_order_at="max(last_at)",
            total_orders="sum(rows)",
        ),
        *named(**{name: f"sum({name})" for name in windows}),
    )


def rfm(orders: DataFrame, snapshot: Moment) -> DataFrame:
    """Recency and frequency inputs per user from purchases before the snapshot."""
    stats = _order_stats(purchases(orders).filter(before("created_at", snapshot)), {})
    return stats.selectExpr(
        "user_id", "frequency AS frequency_all_time", "total_orders", "last_order_at AS last_order_date",
        "first_order_at AS first_order_date",
    )


def windowed_rfm(
    orders: DataFrame, snapshot: Moment, days: int = WINDOW_DAYS, short_days: int = SHORT_WINDOW_DAYS
) -> DataFrame:
    """Distinct purchases in the last ``days`` and ``short_days`` before the snapshot."""
    inside = purchases(orders).filter(look_back("created_at", snapshot, days))
    stats = _order_stats(inside, {"frequency_short": look_back("created_at", snapshot, short_days)})
    return stats.selectExpr(
        "user_id", f"frequency AS frequency_{days}d", f"frequency_short AS frequency_{short_days}d"
    )


def engagement(events: DataFrame, snapshot: Moment) -> DataFrame:
    """Event counts and distinct sessions per user before the snapshot."""
    return (
        events.filter(before("created_at", snapshot))
        .groupBy("user_id")
        .agg(
            *named(
                total_events="count(1)",
                view_count="count_if(event_type = 'product')",
                cart_count="count_if(event_type = 'cart')",
                purchase_event_count="count_if(event_type = 'purchase')",
                session_count="count(DISTINCT session_id)",
            )
        )
    )


def churn_features(
    users: DataFrame,
    orders: DataFrame,
    events: DataFrame,
    snapshot: Moment = FEATURE_SNAPSHOT,
    date_column: str = "snapshot_date",
    days: int = WINDOW_DAYS,
    short_days: int = SHORT_WINDOW_DAYS,
) -> DataFrame:
    """One row per user with a purchase before the snapshot.

    All order features come from one scan of orders (the windows are flags on the
    same rows); users, orders and events meet once, on ``user_id``.
    """
    windows = {
        f"frequency_{days}d": look_back("created_at", snapshot, days),
        f"frequency_{short_days}d": look_back("created_at", snapshot, short_days),
    }
    bought = _order_stats(purchases(orders).filter(before("created_at", snapshot)), windows)
    bought = bought.filter("frequency > 0")
    used = engagement(events, snapshot)
    counts = ["total_events", "view_count", "cart_count", "session_count"]
    return (
        users.select("user_id", "traffic_source", "country", "gender")
        .join(bought, "user_id")
        .join(used, "user_id", "left")
        .selectExpr(
            "user_id",
            f"{moment(snapshot)} AS {date_column}",
            "traffic_source",
            "country",
            "gender",
            "frequency AS frequency_all_time",
            *windows,
            f"{elapsed_days_rounded('last_order_at', snapshot)} AS recency_days",
            f"{elapsed_days_rounded('first_order_at', snapshot)} AS tenure_days",
            *[f"{or_zero(c)} AS {c}" for c in counts],
            f"CASE WHEN view_count > 0 THEN {ratio('cart_count', 'view_count')} ELSE 0D END AS view_to_cart_rate",
        )
    )


def churn_scoring(
    users: DataFrame, orders: DataFrame, events: DataFrame, snapshot: Moment = SCORING_SNAPSHOT, **windows: int
) -> DataFrame:
    """The same features at the latest date, dated ``scoring_date``."""
    return churn_features(users, orders, events, snapshot, date_column="scoring_date", **windows)


def active_users(orders: DataFrame, snapshot: Moment, days: int = ACTIVE_DAYS) -> DataFrame:
    """Distinct buyers in the last ``days`` before the snapshot."""
    return purchases(orders).filter(look_back("created_at", snapshot, days)).select("user_id").distinct()


def churn_labels(
    orders: DataFrame, snapshot: Moment = FEATURE_SNAPSHOT, active: int = ACTIVE_DAYS, horizon: int = HORIZON_DAYS
) -> DataFrame:
    """Of the recent buyers, who did not buy in the ``horizon`` days from the snapshot on.

    Both date ranges are read in one scan and told apart by flags. Buyers without
    a user id form one labelled row, never matched with later orders.
    """
    recent, ahead = look_back("created_at", snapshot, active), look_ahead("created_at", snapshot, horizon)
    return (
        purchases(orders)
        .filter(f"{recent} OR {ahead}")
        .groupBy("user_id")
        .agg(
            *named(
                recent=f"max({flag(recent)})",
                later=f"max({flag(f'{ahead} AND order_id IS NOT NULL AND user_id IS NOT NULL')})",
            )
        )
        .filter("recent = 1")
        .selectExpr("user_id", f"{moment(snapshot)} AS snapshot_date", f"1 - later AS {TARGET}")
    )


def monetary(order_items: DataFrame, orders: DataFrame, cutoff: Moment | None = None) -> DataFrame:
    """Money spent per user of the items of purchases; the item's own status is ignored."""
    bought = purchases(orders)
    if cutoff is not None:
        bought = bought.filter(before("created_at", cutoff))
    return (
        order_items.select("order_id", "user_id", "sale_price")
        .join(bought.select("order_id"), "order_id")
        .groupBy("user_id")
        .agg(*named(total_spend=exact_sum("sale_price")))
    )


def _legacy(stats: DataFrame, spend: DataFrame, cutoff_date: str, snapshot: str, *extra: str) -> DataFrame:
    """First-generation feature row from order stats, spend and the cutoff's expression."""
    return stats.filter("frequency > 0").join(spend, "user_id", "left").selectExpr(
        "user_id",
        f"{snapshot} AS snapshot_date",
        f"datediff({cutoff_date}, to_date(last_order_at)) AS recency_days",
        "frequency",
        "coalesce(total_spend, 0D) AS monetary",
        f"{ratio('coalesce(total_spend, 0D)', 'frequency')} AS avg_order_value",
        f"datediff({cutoff_date}, to_date(first_order_at)) AS tenure_days",
        *extra,
    )


def mart_churn_features(
    orders: DataFrame, order_items: DataFrame, cutoff: Moment = LEGACY_CUTOFF, horizon_days: int | None = None
) -> DataFrame:
    """First-generation features before a cutoff, with the target after it.

    Who ordered only void orders drops out with the frequency filter. Orders on
    both sides of the cutoff are read once; the past is told apart by a flag.
    """
    past, future = before("created_at", cutoff), look_ahead("created_at", cutoff, horizon_days)
    per_order = (
        purchases(orders)
        .filter(f"user_id IS NOT NULL AND ({past} OR {future})")
        .groupBy("user_id", "order_id")
        .agg(
            *named(
                first_at=f"min(CASE WHEN {past} THEN created_at END)",
                last_at=f"max(CASE WHEN {past} THEN created_at END)",
                past=_any_order(past),
                future=_any_order(future),
            )
        )
    )
    per_user = per_order.groupBy("user_id").agg(
        *named(
            frequency="sum(past)", first_order_at="min(first_at)", last_order_at="max(last_at)", came_back="max(future)"
        )
    )
    spend = monetary(order_items, orders, cutoff)
    at = moment(cutoff)
    return _legacy(per_user, spend, f"to_date({at})", at, f"1 - came_back AS {TARGET}")


def latest_order_date(orders: DataFrame) -> DataFrame:
    """The last order date over all statuses, in one row."""
    return orders.agg(*named(latest="max(to_date(created_at))"))


def mart_churn_inference(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """First-generation features over all orders, as of the last order date."""
    bought = _order_stats(purchases(orders).filter("user_id IS NOT NULL"), {})
    dated = with_stats(bought, "cutoff", latest_order_date(orders))
    return _legacy(dated, monetary(order_items, orders), "cutoff.latest", "cutoff.latest")


def train_set(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features of labelled users."""
    return features.join(labels.select("user_id", TARGET), "user_id")
