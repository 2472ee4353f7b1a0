"""The checked queries of the catalogue as plain SQL over the same tables.

Each is written from the meaning of the operator, with the joins and distinct
counts spelled out, so that it is a second opinion and not the Spark plan again.
"""

from __future__ import annotations

import re

from basketlens import schemas
from basketlens.functions.sql import ERFC_TERMS, listed
from basketlens.operators import experiments
from basketlens.operators.churn import CATEGORICAL_FEATURES, LEGACY_FEATURES, NUMERIC_FEATURES
from basketlens.operators.drift import DRIFT_FEATURES
from basketlens.plans.catalog import (
    EXPECTATIONS, FEATURE_CHECKS, KNOWN_INTERCEPT, KNOWN_WEIGHTS, LEGACY_CUTOFF, MART_CHECKS, SALT, SCORE_SNAPSHOT, SEED,
    TRAIN_SNAPSHOT,
)
from basketlens.sources.starschema import BROWSER_BY_NUMBER, EVENT_SHIFT_DAYS, SOURCE_BY_NUMBER, SOURCE_BY_SEGMENT

_SEGMENTS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SOURCE_BY_SEGMENT.items())
_VOID = listed(schemas.VOID_STATUSES)


def _features(snapshot: str, date_name: str) -> str:
    s = f"TIMESTAMP '{snapshot}'"
    return f"""
    SELECT u.user_id, {s} AS {date_name}, u.traffic_source, u.country, u.gender,
        CAST(r.n AS BIGINT) AS frequency_all_time,
        CAST(coalesce(w.n60, 0) AS BIGINT) AS frequency_60d, CAST(coalesce(w.n30, 0) AS BIGINT) AS frequency_30d,
        CAST(round(date_sub('second', r.last_at, {s}) / 86400.0) AS INT) AS recency_days,
        CAST(round(date_sub('second', r.first_at, {s}) / 86400.0) AS INT) AS tenure_days,
        CAST(coalesce(e.n, 0) AS BIGINT) AS total_events, CAST(coalesce(e.views, 0) AS BIGINT) AS view_count,
        CAST(coalesce(e.carts, 0) AS BIGINT) AS cart_count, CAST(coalesce(e.s, 0) AS BIGINT) AS session_count,
        CASE WHEN coalesce(e.views, 0) > 0 THEN CAST(e.carts AS DOUBLE) / e.views ELSE 0.0::DOUBLE END AS view_to_cart_rate
    FROM stg_users u
    LEFT JOIN (SELECT user_id, count(DISTINCT order_id) n, max(created_at) last_at, min(created_at) first_at
               FROM stg_orders WHERE created_at < {s} AND status NOT IN ({_VOID}) GROUP BY 1) r ON u.user_id = r.user_id
    LEFT JOIN (SELECT user_id, count(DISTINCT order_id) n60,
                   count(DISTINCT CASE WHEN created_at >= {s} - INTERVAL 30 DAY THEN order_id END) n30
               FROM stg_orders WHERE created_at >= {s} - INTERVAL 60 DAY AND created_at < {s}
                   AND status NOT IN ({_VOID}) GROUP BY 1) w ON u.user_id = w.user_id
    LEFT JOIN (SELECT user_id, count(*) n, count(CASE WHEN event_type = 'product' THEN 1 END) views,
                   count(CASE WHEN event_type = 'cart' THEN 1 END) carts, count(DISTINCT session_id) s
               FROM stg_events WHERE created_at < {s} GROUP BY 1) e ON u.user_id = e.user_id
    WHERE r.n > 0"""


def _known_score() -> str:
    z = " + ".join([f"{KNOWN_INTERCEPT}::DOUBLE", *[f"CAST({c} AS DOUBLE) * {w}::DOUBLE" for c, w in KNOWN_WEIGHTS.items()]])
    return f"round(1.0::DOUBLE / (1.0::DOUBLE + exp(-({z}))), 6)"


def _bucket(salt: str, key: str) -> str:
    return f"(CAST('0x' || substr(md5('{salt}' || {key}), 1, 8) AS BIGINT) % {experiments.BUCKETS})"


def _variant(key: str, shares: tuple[float, float]) -> str:
    c, t = (round(s * experiments.BUCKETS) for s in shares)
    b = _bucket(SALT, key)
    return f"CASE WHEN {b} < {c} THEN 'control' WHEN {b} >= {experiments.BUCKETS - t} THEN 'treatment' ELSE 'holdout' END"


# Named relations; a query gets those it mentions, directly or through others.
RELATIONS: dict[str, str] = {
    "src_users": f"""
    SELECT c_custkey AS id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
        lower(split_part(c_name, '#', 1)) || c_custkey || '@example.com' AS email,
        CAST(18 + c_custkey % 60 AS INT) AS age, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
        r_name AS state, c_custkey || ' Main St' AS street_address,
        lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code, 'City ' || (c_custkey % 100) AS city,
        n_name AS country, CAST(c_custkey % 90 AS DOUBLE) AS latitude, CAST(c_custkey % 180 AS DOUBLE) AS longitude,
        CASE c_mktsegment {_SEGMENTS} END AS traffic_source, TIMESTAMP '1995-01-01' AS created_at
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "src_products": """
    SELECT p_partkey AS id, p_retailprice / 2 AS cost, p_type AS category, p_name AS name, p_brand AS brand,
        p_retailprice AS retail_price, CASE WHEN p_partkey % 2 = 0 THEN 'Men' ELSE 'Women' END AS department,
        'SKU' || p_partkey AS sku, p_partkey % 10 AS distribution_center_id FROM part""",
    "src_orders": """
    SELECT o_orderkey AS order_id, o_custkey AS user_id, status,
        CASE WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, o_orderdate AS created_at,
        CASE WHEN status = 'Returned' THEN o_orderdate + INTERVAL 10 DAY END AS returned_at,
        CASE WHEN status IN ('Complete', 'Shipped', 'Returned') THEN o_orderdate + INTERVAL 1 DAY END AS shipped_at,
        CASE WHEN status IN ('Complete', 'Returned') THEN o_orderdate + INTERVAL 3 DAY END AS delivered_at,
        CAST(coalesce(n, 0) AS INT) AS num_of_item
    FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'Complete' WHEN o_orderstatus = 'O' THEN 'Shipped'
              WHEN o_orderpriority = '1-URGENT' THEN 'Cancelled' WHEN o_orderpriority = '2-HIGH' THEN 'Returned'
              ELSE 'Processing' END AS status FROM orders)
    LEFT JOIN (SELECT l_orderkey, count(*) n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
    "src_order_items": """
    SELECT CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
            CAST(l_shipdate AS DATE))), 1, 15) AS BIGINT) AS id, l_orderkey AS order_id, o.user_id, l_partkey AS product_id,
        CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
            CAST(l_shipdate AS DATE))), 1, 15) AS BIGINT) AS inventory_item_id,
        CASE WHEN l_returnflag = 'R' THEN 'Returned' ELSE o.status END AS status, o.created_at, l_shipdate AS shipped_at,
        CASE WHEN l_returnflag = 'R' THEN o.created_at + INTERVAL 3 DAY END AS delivered_at,
        CASE WHEN l_returnflag = 'R' THEN o.created_at + INTERVAL 10 DAY END AS returned_at, l_extendedprice AS sale_price
    FROM lineitem JOIN src_orders o ON l_orderkey = o.order_id""",
    "stream": f"""
    SELECT *, ts - INTERVAL {EVENT_SHIFT_DAYS} DAY AS created_at,
        CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
        CASE event_type WHEN 'view' THEN 'product' WHEN 'click' THEN 'cart' WHEN 'purchase' THEN 'purchase'
            WHEN 'error' THEN 'cancel' ELSE CASE WHEN event_id % 2 = 1 THEN 'department' ELSE 'home' END END AS kind,
        user_id || '-' || CAST(ts - INTERVAL {EVENT_SHIFT_DAYS} DAY AS DATE) AS session_id
    FROM events""",
    "src_events": f"""
    SELECT event_id AS id, user_id, CAST(event_id % 20 + 1 AS INT) AS sequence_number, session_id, created_at,
        '10.0.' || (user_id % 256) || '.' || (event_id % 256) AS ip_address, 'City ' || (user_id % 100) AS city,
        'State ' || (user_id % 50) AS state, lpad(CAST(user_id % 100000 AS VARCHAR), 5, '0') AS postal_code,
        [{listed(BROWSER_BY_NUMBER)}][k % 3 + 1] AS browser, [{listed(SOURCE_BY_NUMBER)}][k % 5 + 1] AS traffic_source,
        '/' || kind AS uri, kind AS event_type FROM stream""",
    "stg_users": """
    SELECT id AS user_id, * EXCLUDE (id), first_name || ' ' || last_name AS full_name FROM src_users""",
    "stg_products": "SELECT id AS product_id, * EXCLUDE (id) FROM src_products",
    "stg_orders": "SELECT * FROM src_orders",
    "stg_order_items": "SELECT id AS order_item_id, * EXCLUDE (id) FROM src_order_items",
    "stg_events": "SELECT id AS event_id, uri AS page_url, * EXCLUDE (id, uri) FROM src_events",
    "fct_sessions": """
    SELECT *, date_sub('second', session_start_at, session_end_at) AS session_duration_seconds FROM (
        SELECT session_id, user_id, min(created_at) AS session_start_at, max(created_at) AS session_end_at,
            count(*) AS total_events, max(CASE WHEN event_type = 'product' THEN 1 ELSE 0 END) AS has_product_view,
            max(CASE WHEN event_type = 'cart' THEN 1 ELSE 0 END) AS has_add_to_cart,
            max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS has_purchase,
            max(traffic_source) AS traffic_source, max(browser) AS browser, max(city) AS city, max(state) AS state
        FROM stg_events GROUP BY 1, 2)""",
    "mart_funnel": """
    SELECT traffic_source, count(DISTINCT session_id) AS total_sessions,
        CAST(sum(has_product_view) AS BIGINT) AS sessions_with_view, CAST(sum(has_add_to_cart) AS BIGINT) AS sessions_with_cart,
        CAST(sum(has_purchase) AS BIGINT) AS sessions_with_purchase,
        CAST(sum(has_product_view) AS DOUBLE) / count(DISTINCT session_id) AS view_rate,
        CAST(sum(has_add_to_cart) AS DOUBLE) / nullif(sum(has_product_view), 0) AS cart_add_rate,
        CAST(sum(has_purchase) AS DOUBLE) / nullif(sum(has_add_to_cart), 0) AS purchase_rate,
        CAST(sum(has_purchase) AS DOUBLE) / count(DISTINCT session_id) AS session_conversion_rate
    FROM fct_sessions GROUP BY 1""",
    "user_cohorts": """
    SELECT user_id, CAST(date_trunc('week', min(session_start_at)) AS DATE) AS cohort_week
    FROM fct_sessions WHERE user_id IS NOT NULL GROUP BY 1""",
    "user_activities": """
    SELECT DISTINCT user_id, CAST(date_trunc('week', session_start_at) AS DATE) AS activity_week
    FROM fct_sessions WHERE user_id IS NOT NULL""",
    "mart_retention": """
    SELECT a.cohort_week, a.period_number, s.n AS initial_users, a.n AS active_users, CAST(a.n AS DOUBLE) / s.n AS retention_rate
    FROM (SELECT c.cohort_week, CAST((a.activity_week - c.cohort_week) // 7 AS INT) AS period_number,
              count(DISTINCT c.user_id) AS n
          FROM user_cohorts c JOIN user_activities a ON c.user_id = a.user_id GROUP BY 1, 2) a
    JOIN (SELECT cohort_week, count(DISTINCT user_id) AS n FROM user_cohorts GROUP BY 1) s ON a.cohort_week = s.cohort_week""",
    "active_users": f"""
    SELECT DISTINCT user_id FROM stg_orders WHERE created_at >= TIMESTAMP '{TRAIN_SNAPSHOT}' - INTERVAL 60 DAY
        AND created_at < TIMESTAMP '{TRAIN_SNAPSHOT}' AND status NOT IN ({_VOID})""",
    "rfm": f"""
    SELECT user_id, count(DISTINCT order_id) AS frequency_all_time, count(*) AS total_orders,
        max(created_at) AS last_order_date, min(created_at) AS first_order_date
    FROM stg_orders WHERE created_at < TIMESTAMP '{TRAIN_SNAPSHOT}' AND status NOT IN ({_VOID}) GROUP BY 1""",
    "windowed_rfm": f"""
    SELECT user_id, count(DISTINCT order_id) AS frequency_60d,
        count(DISTINCT CASE WHEN created_at >= TIMESTAMP '{TRAIN_SNAPSHOT}' - INTERVAL 30 DAY THEN order_id END) AS frequency_30d
    FROM stg_orders WHERE created_at >= TIMESTAMP '{TRAIN_SNAPSHOT}' - INTERVAL 60 DAY
        AND created_at < TIMESTAMP '{TRAIN_SNAPSHOT}' AND status NOT IN ({_VOID}) GROUP BY 1""",
    "engagement": f"""
    SELECT user_id, count(*) AS total_events, count(CASE WHEN event_type = 'product' THEN 1 END) AS view_count,
        count(CASE WHEN event_type = 'cart' THEN 1 END) AS cart_count,
        count(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchase_event_count, count(DISTINCT session_id) AS session_count
    FROM stg_events WHERE created_at < TIMESTAMP '{TRAIN_SNAPSHOT}' GROUP BY 1""",
    "monetary": f"""
    SELECT i.user_id, sum(i.sale_price) AS total_spend
    FROM stg_order_items i JOIN stg_orders o ON i.order_id = o.order_id
    WHERE o.created_at < TIMESTAMP '{LEGACY_CUTOFF}' AND o.status NOT IN ({_VOID}) GROUP BY 1""",
    "churn_features": _features(TRAIN_SNAPSHOT, "snapshot_date"),
    "churn_scoring": _features(SCORE_SNAPSHOT, "scoring_date"),
    "churn_labels": f"""
    SELECT a.user_id, TIMESTAMP '{TRAIN_SNAPSHOT}' AS snapshot_date,
        CASE WHEN coalesce(f.n, 0) = 0 THEN 1 ELSE 0 END AS is_churned
    FROM active_users a LEFT JOIN (
        SELECT user_id, count(DISTINCT order_id) n FROM stg_orders WHERE created_at >= TIMESTAMP '{TRAIN_SNAPSHOT}'
            AND created_at < TIMESTAMP '{TRAIN_SNAPSHOT}' + INTERVAL 30 DAY AND status NOT IN ({_VOID}) GROUP BY 1) f
        ON a.user_id = f.user_id""",
    "mart_churn_features": f"""
    SELECT u.user_id, TIMESTAMP '{LEGACY_CUTOFF}' AS snapshot_date,
        CAST(DATE '{LEGACY_CUTOFF}' - p.last_day AS INT) AS recency_days, p.frequency,
        coalesce(m.total_spend, 0.0) AS monetary, coalesce(m.total_spend, 0.0) / nullif(p.frequency, 0) AS avg_order_value,
        CAST(DATE '{LEGACY_CUTOFF}' - p.first_day AS INT) AS tenure_days,
        CASE WHEN coalesce(f.n, 0) = 0 THEN 1 ELSE 0 END AS is_churned
    FROM (SELECT DISTINCT user_id FROM stg_orders WHERE created_at < TIMESTAMP '{LEGACY_CUTOFF}') u
    JOIN (SELECT user_id, CAST(min(created_at) AS DATE) first_day, CAST(max(created_at) AS DATE) last_day,
              count(DISTINCT order_id) AS frequency FROM stg_orders
          WHERE created_at < TIMESTAMP '{LEGACY_CUTOFF}' AND status NOT IN ({_VOID}) GROUP BY 1) p ON u.user_id = p.user_id
    LEFT JOIN monetary m ON u.user_id = m.user_id
    LEFT JOIN (SELECT user_id, count(DISTINCT order_id) n FROM stg_orders
          WHERE created_at >= TIMESTAMP '{LEGACY_CUTOFF}' AND status NOT IN ({_VOID}) GROUP BY 1) f ON u.user_id = f.user_id
    WHERE p.frequency > 0""",
    "mart_churn_inference": f"""
    SELECT p.user_id, c.d AS snapshot_date, CAST(c.d - p.last_day AS INT) AS recency_days, p.frequency,
        coalesce(m.total_spend, 0.0) AS monetary, coalesce(m.total_spend, 0.0) / nullif(p.frequency, 0) AS avg_order_value,
        CAST(c.d - p.first_day AS INT) AS tenure_days
    FROM (SELECT user_id, CAST(min(created_at) AS DATE) first_day, CAST(max(created_at) AS DATE) last_day,
              count(DISTINCT order_id) AS frequency FROM stg_orders WHERE status NOT IN ({_VOID}) GROUP BY 1) p
    LEFT JOIN (SELECT i.user_id, sum(i.sale_price) AS total_spend
               FROM stg_order_items i JOIN stg_orders o ON i.order_id = o.order_id
               WHERE o.status NOT IN ({_VOID}) GROUP BY 1) m ON p.user_id = m.user_id
    CROSS JOIN (SELECT CAST(max(created_at) AS DATE) AS d FROM stg_orders) c""",
    "train_set": "SELECT f.*, l.is_churned FROM churn_features f JOIN churn_labels l ON f.user_id = l.user_id",
    "train_scored": f"SELECT *, {_known_score()} AS p FROM train_set",
    "scored": f"SELECT *, {_known_score()} AS churn_probability FROM churn_scoring",
    "churn_scores": """
    SELECT user_id, scoring_date, churn_probability, round(uplift, 6) AS expected_uplift_value,
        CASE WHEN uplift > 20 AND churn_probability > 0.7 THEN 'High Priority Call' WHEN uplift > 0 THEN 'Send Email Coupon'
            ELSE 'No Action' END AS recommended_action, traffic_source
    FROM (SELECT *, churn_probability * 150.0::DOUBLE * 0.3::DOUBLE - 10.0::DOUBLE AS uplift FROM scored)""",
    "steps": """
    SELECT p, sum(is_churned) AS pos, sum(1 - is_churned) AS neg FROM train_scored GROUP BY 1""",
    "ranked": """
    SELECT *, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp FROM steps""",
    "gaps": """
    SELECT user_id, recency_days, CASE WHEN total_events > 0 THEN total_events END AS total_events,
        CASE WHEN total_events > 0 THEN view_count END AS view_count,
        CASE WHEN total_events > 0 THEN session_count END AS session_count FROM churn_features""",
    "long_features": " UNION ALL ".join(
        f"SELECT '{side}' AS side, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {table}"
        for side, table in (("reference", "churn_features"), ("current", "churn_scoring")) for f in DRIFT_FEATURES
    ),
    "units": f"""
    SELECT user_id AS unit_id, max(has_add_to_cart) AS reached_cart, max(has_purchase) AS purchased,
        CASE WHEN max(browser) = 'Safari' THEN 'Mobile' ELSE 'Desktop' END AS device,
        CAST(min(session_start_at) AS DATE) AS day, {_variant('user_id', experiments.RAMP_FULL)} AS variant
    FROM fct_sessions WHERE user_id IS NOT NULL GROUP BY user_id""",
    "conversion": """
    SELECT variant, count(DISTINCT unit_id) AS units,
        count(DISTINCT CASE WHEN reached_cart = 1 THEN unit_id END) AS cart_units,
        count(DISTINCT CASE WHEN reached_cart = 1 AND purchased = 1 THEN unit_id END) AS buyers
    FROM units WHERE variant != 'holdout' GROUP BY 1""",
    "conversion_by_device": """
    SELECT device, variant, count(DISTINCT CASE WHEN reached_cart = 1 THEN unit_id END) AS cart_units,
        count(DISTINCT CASE WHEN reached_cart = 1 AND purchased = 1 THEN unit_id END) AS buyers
    FROM units WHERE variant != 'holdout' GROUP BY 1, 2""",
    "guards": """
    SELECT *, treatment_latency_ms - control_latency_ms AS latency_change_ms,
        treatment_latency_ms - control_latency_ms <= 200 AS within_guardrail
    FROM (SELECT avg(CASE WHEN variant = 'control' AND kind = 'cart' THEN value END) AS control_latency_ms,
              avg(CASE WHEN variant = 'treatment' AND kind = 'cart' THEN value END) AS treatment_latency_ms,
              count(CASE WHEN variant = 'control' AND event_type = 'error' THEN 1 END) AS control_tickets,
              count(CASE WHEN variant = 'treatment' AND event_type = 'error' THEN 1 END) AS treatment_tickets
          FROM stream JOIN units ON user_id = unit_id)""",
}


def _p_value(z: str) -> str:
    x = f"(abs({z}) / sqrt(2.0::DOUBLE))"
    t = f"(1.0::DOUBLE / (1.0::DOUBLE + {x} / 2.0::DOUBLE))"
    powers = " + ".join(f"{a}::DOUBLE * pow({t}, {i})" for i, a in enumerate(ERFC_TERMS))
    return f"({t} * exp({powers} - {x} * {x}))"


def _read_out(source: str, by: str = "") -> str:
    """Values c, t and standard error se of both variants as a read-out."""
    head = f"{by}, " if by else ""
    return f"""
    SELECT {head}round(c, 8) AS control_value, round(t, 8) AS treatment_value, round((t - c) / nullif(c, 0), 8) AS lift,
        round(z, 8) AS z_score, round(pv, 8) AS p_value,
        CASE WHEN pv IS NULL THEN 'Undefined' WHEN pv >= 0.05 THEN 'Neutral' WHEN t > c THEN 'Significant Positive'
            ELSE 'Significant Negative' END AS status
    FROM (SELECT *, {_p_value('z')} AS pv FROM (SELECT *, (t - c) / nullif(se, 0) AS z FROM ({source})))"""


def _proportions(table: str, x: str, n: str, by: str = "") -> str:
    head, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""
    SELECT *, xc / nullif(nc, 0) AS c, xt / nullif(nt, 0) AS t,
        sqrt(((xc + xt) / (nc + nt)) * (1 - (xc + xt) / (nc + nt)) * (1 / nullif(nc, 0) + 1 / nullif(nt, 0))) AS se
    FROM (SELECT {head}CAST(sum(CASE WHEN variant = 'control' THEN {x} END) AS DOUBLE) AS xc,
              CAST(sum(CASE WHEN variant = 'treatment' THEN {x} END) AS DOUBLE) AS xt,
              CAST(sum(CASE WHEN variant = 'control' THEN {n} END) AS DOUBLE) AS nc,
              CAST(sum(CASE WHEN variant = 'treatment' THEN {n} END) AS DOUBLE) AS nt FROM {table} {group})"""


def _hash_order(by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    return f"row_number() OVER ({part}ORDER BY md5('{SEED}-' || user_id), user_id)"


def _check_sql(table: str, column: str, kind: str, arg, position: int) -> str:
    """One check as a result row."""
    head = f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS check_name, "
    tail = "CAST({o} AS DOUBLE) AS observed, CAST({t} AS DOUBLE) AS threshold, CAST({f} AS BIGINT) AS failed_rows, {s} AS success, "
    tail += f"{position} AS position"
    if kind == "row_count":
        low, high = arg
        return head + tail.format(o="count(*)", t=low, f=0, s=f"count(*) BETWEEN {low} AND {high}") + f" FROM {table}"
    if kind == "not_null":
        share = f"coalesce(count({column}) / nullif(CAST(count(*) AS DOUBLE), 0), 1.0)"
        return head + tail.format(o=share, t=arg, f=f"count(*) - count({column})", s=f"{share} >= {arg}") + f" FROM {table}"
    if kind == "accepted_values":
        bad = f"count(CASE WHEN {column} NOT IN ({listed(arg)}) THEN 1 END)"
        return head + tail.format(o=bad, t=0, f=bad, s=f"{bad} = 0") + f" FROM {table}"
    if kind == "unique":
        found = f"SELECT {column} AS v, count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    else:
        parent, key = arg
        found = (f"SELECT {column} AS v, count(*) AS n FROM {table} WHERE {column} IS NOT NULL "
                 f"AND {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL) GROUP BY 1")
    return head + tail.format(o="count(*)", t=0, f="coalesce(sum(n), 0)", s="count(*) = 0") + f" FROM ({found})"


def _checks_sql(declared) -> str:
    positions: dict[str, int] = {}
    parts = []
    for table, *check in declared:
        positions[table] = positions.get(table, 0) + 1
        parts.append(_check_sql(table, *check, positions[table]))
    return " UNION ALL ".join(parts)


def _dummy_columns(table: str) -> str:
    """0/1 columns of the test data's levels without the alphabetically first one."""
    countries = sorted(f"NATION_{i}" for i in range(25))[1:]
    parts = [f"CAST(traffic_source = '{s}' AS INT) AS traffic_source_{s}" for s in sorted(schemas.TRAFFIC_SOURCES)[1:]]
    parts += [f"CAST(country = '{c}' AS INT) AS country_{c}" for c in countries]
    return f"SELECT user_id, {', '.join(parts)}, CAST(gender = 'M' AS INT) AS gender_M FROM {table}"


_SCALED = ", ".join(
    f"round(({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1), 6) AS {c}" for c in NUMERIC_FEATURES
)
_IMPUTED = ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM gaps)) AS {c}"
    for c in ("recency_days", "total_events", "view_count", "session_count")
)
_SHARES = ", ".join(f"(CAST({c} AS DOUBLE) - avg({c}) OVER ()) * {w}::DOUBLE AS {c}" for c, w in KNOWN_WEIGHTS.items())
_WIDTH = "CASE WHEN high > low THEN (high - low) / 20 ELSE 1.0 END"



def _digits(what: str, digits: int) -> str:
    return f"CAST('0x' || substr(md5('42-{what}-' || i), 1, {digits}) AS BIGINT)"


def _smote_sql(features: list[str], k: int = 5) -> str:
    """Every pair of minority rows ranked by distance; each draw takes a row, a rank and a step between both."""
    squares = " + ".join(f"(CAST(a.{f} AS DOUBLE) - b.{f}) * (CAST(a.{f} AS DOUBLE) - b.{f})" for f in features)
    between = ", ".join(f"round(CAST(a.{f} AS DOUBLE) + step * (CAST(b.{f} AS DOUBLE) - a.{f}), 6) AS {f}" for f in features)
    original = ", ".join(f"round(CAST({f} AS DOUBLE), 6) AS {f}" for f in features)
    return f"""
    SELECT * FROM (WITH sizes AS (SELECT is_churned, count(*) AS n FROM mart_churn_features GROUP BY 1),
    base AS (
        SELECT *, row_number() OVER (ORDER BY md5('42-' || user_id), user_id) AS n FROM mart_churn_features
        WHERE is_churned = (SELECT is_churned FROM sizes ORDER BY n, is_churned LIMIT 1)),
    near AS (
        SELECT a.n AS one, b.n AS other, row_number() OVER (PARTITION BY a.n ORDER BY {squares}, b.n) - 1 AS slot
        FROM base a JOIN base b ON a.n != b.n QUALIFY slot < {k}),
    draws AS (
        SELECT {_digits('row', 15)} % (SELECT min(n) FROM sizes) + 1 AS one, {_digits('slot', 15)} % {k} AS slot,
            {_digits('step', 13)} / CAST({1 << 52} AS DOUBLE) AS step
        FROM (SELECT unnest(range((SELECT max(n) - min(n) FROM sizes))) AS i))
    SELECT {original}, is_churned, false AS synthetic FROM mart_churn_features UNION ALL
    SELECT {between}, a.is_churned, true FROM draws JOIN near USING (one, slot)
    JOIN base a ON a.n = one JOIN base b ON b.n = other)"""


QUERY_SQL: dict[str, str] = {
    **{name: f"SELECT * FROM {name}" for name in (
        "stg_users", "stg_products", "stg_orders", "stg_order_items", "stg_events", "fct_sessions", "mart_funnel",
        "user_cohorts", "user_activities", "mart_retention", "active_users", "rfm", "windowed_rfm", "engagement",
        "churn_features", "churn_labels", "churn_scoring", "train_set", "churn_scores")},
    "monetary": "SELECT user_id, round(total_spend, 6) AS total_spend FROM monetary",
    **{name: f"SELECT * REPLACE (round(monetary, 6) AS monetary, round(avg_order_value, 6) AS avg_order_value) FROM {name}"
       for name in ("mart_churn_features", "mart_churn_inference")},
    "src_csv_roundtrip": "SELECT * FROM src_users",
    "src_inventory_items": """
    SELECT i.id, i.product_id, i.created_at - INTERVAL 30 DAY AS created_at, i.created_at AS sold_at, p.cost,
        p.category AS product_category, p.name AS product_name, p.brand AS product_brand,
        p.retail_price AS product_retail_price, p.department AS product_department, p.sku AS product_sku,
        p.distribution_center_id AS product_distribution_center_id
    FROM src_order_items i LEFT JOIN src_products p ON i.product_id = p.id""",
    "load_report": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, 'loaded' AS status, count(*) AS loaded_rows, CAST(NULL AS VARCHAR) AS error FROM {table}"
        for name, table in (("events", "events"), ("inventory_items", "lineitem"), ("order_items", "lineitem"),
                            ("orders", "orders"), ("products", "part"), ("users", "customer"))),
    "class_balance": "SELECT is_churned, count(*) AS users FROM train_set GROUP BY 1",
    "class_weights": """
    SELECT is_churned, count(*) AS users, (SELECT count(*) FROM train_set) / (2.0::DOUBLE * count(*)) AS balanced_weight,
        (SELECT CAST(sum(1 - is_churned) AS DOUBLE) / sum(is_churned) FROM train_set) AS scale_pos_weight
    FROM train_set GROUP BY 1""",
    "impute_median": f"SELECT user_id, {_IMPUTED} FROM gaps",
    "scale_standard": f"SELECT user_id, {_SCALED} FROM churn_features",
    "encode_onehot": " UNION ALL ".join(
        f"SELECT user_id, '{c}' AS feature, coalesce({c}, 'missing') AS level FROM churn_features" for c in CATEGORICAL_FEATURES),
    "encode_dummies": _dummy_columns("train_set"),
    "aligned_features": f"""
    SELECT user_id, gender_M, 0 AS traffic_source_Affiliate, traffic_source_Email, traffic_source_Facebook,
        traffic_source_Organic, traffic_source_Search FROM ({_dummy_columns('churn_scoring')})""",
    "stratified_split": f"""
    SELECT user_id, is_churned, {_hash_order('is_churned')} <= round(count(*) OVER (PARTITION BY is_churned) * 0.2) AS is_test
    FROM train_set""",
    "plain_split": f"""
    SELECT user_id, is_churned, {_hash_order()} <= round(count(*) OVER () * 0.2) AS is_test FROM mart_churn_features""",
    "stratified_folds": f"SELECT user_id, is_churned, CAST(({_hash_order('is_churned')} - 1) % 3 AS INT) AS fold FROM train_set",
    "confusion": """
    SELECT tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives,
        CAST(tp + tn AS DOUBLE) / nullif(tp + fp + fn + tn, 0) AS accuracy, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS precision,
        CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall, CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0) AS f1_score
    FROM (SELECT count(CASE WHEN is_churned = 1 AND p > 0.5 THEN 1 END) tp, count(CASE WHEN is_churned = 0 AND p > 0.5 THEN 1 END) fp,
              count(CASE WHEN is_churned = 1 AND p <= 0.5 THEN 1 END) fn, count(CASE WHEN is_churned = 0 AND p <= 0.5 THEN 1 END) tn
          FROM train_scored)""",
    "roc_auc": """
    SELECT CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
        round(CAST(sum(neg * (tp - pos)) + sum(neg * pos) / 2.0 AS DOUBLE) / (sum(pos) * sum(neg)), 9) AS roc_auc FROM ranked""",
    "avg_precision": """
    SELECT CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(pos) AS DOUBLE) / (sum(pos) + sum(neg)) AS prevalence,
        round(sum(CAST(pos AS DOUBLE) * tp / (tp + fp)) / sum(pos), 9) AS average_precision FROM ranked""",
    "run_log": " UNION ALL ".join([
        *(f"SELECT 'known' AS run_name, 'param' AS kind, '{c}' AS key, '{w}' AS text, CAST(NULL AS DOUBLE) AS value"
          for c, w in KNOWN_WEIGHTS.items()),
        *(f"SELECT 'known', 'metric', '{name}', NULL, round(CAST({value} AS DOUBLE), 9) FROM ranked" for name, value in (
            ("positives", "sum(pos)"), ("negatives", "sum(neg)"),
            ("roc_auc", "CAST(sum(neg * (tp - pos)) + sum(neg * pos) / 2.0 AS DOUBLE) / (sum(pos) * sum(neg))"),
            ("average_precision", "sum(CAST(pos AS DOUBLE) * tp / (tp + fp)) / sum(pos)")))]),
    "registry_latest": "SELECT 'churn_boosted' AS name, CAST(2 AS BIGINT) AS version",
    "churn_predictions": "SELECT user_id, churn_probability FROM scored",
    "retention_targets": """
    SELECT * FROM churn_scores WHERE recommended_action != 'No Action' ORDER BY expected_uplift_value DESC, user_id LIMIT 500""",
    **dict.fromkeys(["score_requests", "score_stream"], """
    SELECT l_partkey AS user_id, l_orderkey AS request_id, CASE WHEN s.user_id IS NULL THEN 'not_found' ELSE 'ok' END AS status,
        churn_probability, churn_probability > 0.7 AS is_high_risk,
        CASE WHEN churn_probability > 0.8 THEN 'Call Customer' WHEN churn_probability < 0.5 THEN 'Retain'
            WHEN churn_probability IS NOT NULL THEN 'Send Coupon' END AS recommended_action
    FROM lineitem LEFT JOIN scored s ON l_partkey = s.user_id"""),
    "explain_linear_rows": f"""
    SELECT user_id, {', '.join(f'round({c}, 6) AS {c}' for c in KNOWN_WEIGHTS)}
    FROM (SELECT user_id, {_SHARES} FROM churn_scoring)""",
    "explain_linear": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg(abs({c})), 9) AS importance FROM (SELECT {_SHARES} FROM churn_scoring)"
        for c in KNOWN_WEIGHTS),
    "bi_risk_kpis": """
    SELECT round(sum(CASE WHEN recommended_action != 'No Action' THEN expected_uplift_value END), 6) AS revenue_at_risk,
        count(CASE WHEN churn_probability > 0.7 THEN 1 END) AS high_risk_users,
        round(avg(churn_probability), 6) AS avg_churn_probability FROM churn_scores""",
    "bi_risk_histogram": "SELECT floor(churn_probability * 10) / 10 AS risk_bucket, count(*) AS users FROM churn_scores GROUP BY 1",
    "bi_risk_by_source": "SELECT traffic_source, round(avg(churn_probability), 9) AS avg_risk FROM churn_scores GROUP BY 1",
    "bi_target_list": """
    SELECT s.user_id, u.email, s.churn_probability, s.expected_uplift_value, s.recommended_action
    FROM churn_scores s LEFT JOIN stg_users u ON s.user_id = u.user_id WHERE s.recommended_action != 'No Action'""",
    "drift_report": """
    SELECT feature, (SELECT count(*) FROM churn_features) AS reference_rows, (SELECT count(*) FROM churn_scoring) AS current_rows,
        round(r, 9) AS reference_mean, round(c, 9) AS current_mean, round((c - r) / nullif(r, 0) * 100, 9) AS shift_percent,
        coalesce(abs((c - r) / nullif(r, 0) * 100) > 10, false) AS retrain
    FROM (SELECT feature, avg(CASE WHEN side = 'reference' THEN value END) AS r,
              avg(CASE WHEN side = 'current' THEN value END) AS c FROM long_features GROUP BY 1)""",
    "drift_histogram": f"""
    SELECT feature, side, bin, round(low + bin * width, 9) AS bin_start, count(*) AS rows,
        round(count(*) / (any_value(side_rows) * width), 9) AS density
    FROM (SELECT f.feature, f.side, b.low, {_WIDTH} AS width, n.side_rows,
              CAST(least(floor((value - low) / ({_WIDTH})), 19) AS INT) AS bin
          FROM long_features f
          JOIN (SELECT feature, min(value) AS low, max(value) AS high FROM long_features GROUP BY 1) b ON f.feature = b.feature
          JOIN (SELECT feature, side, count(*) AS side_rows FROM long_features GROUP BY 1, 2) n
              ON f.feature = n.feature AND f.side = n.side)
    GROUP BY feature, side, bin, low, width""",
    "drift_density": """
    SELECT f.feature, f.side, g.point, round(g.x, 8) AS x,
        round(sum(exp(-0.5 * pow((g.x - f.value) / g.h, 2))) / (any_value(g.n) * any_value(g.h) * sqrt(2 * pi())), 8) AS density
    FROM long_features f JOIN (
        SELECT feature, side, n, h, point, low - 3 * h + point * ((high - low + 6 * h) / 99) AS x
        FROM (SELECT feature, side, count(*) AS n, min(value) AS low, max(value) AS high,
                  stddev_samp(value) * pow(count(*), -0.2) AS h FROM long_features GROUP BY 1, 2), 
             (SELECT CAST(unnest(range(100)) AS INT) AS point)) g ON f.feature = g.feature AND f.side = g.side
    GROUP BY f.feature, f.side, g.point, g.x""",
    "dq_unique": "SELECT name AS value, count(*) AS n FROM stg_products GROUP BY 1 HAVING count(*) > 1",
    "dq_not_null": _checks_sql([("stg_orders", c, "not_null", 1.0) for c in ("created_at", "shipped_at", "delivered_at", "returned_at")]),
    "dq_not_null_mostly": _checks_sql([("stg_orders", "shipped_at", "not_null", 0.6), ("stg_orders", "delivered_at", "not_null", 0.6),
                                       ("stg_orders", "status", "not_null", 0.9)]),
    "dq_accepted_values": "SELECT status AS value, count(*) AS n FROM stg_orders WHERE status NOT IN ('Complete', 'Shipped') GROUP BY 1",
    "dq_relationships": """
    SELECT user_id AS value, count(*) AS n FROM stg_orders o
    WHERE NOT EXISTS (SELECT 1 FROM stg_events e WHERE e.user_id = o.user_id) GROUP BY 1""",
    "dq_row_count": _checks_sql([("stg_users", "*", "row_count", (1, 10_000_000)), ("stg_products", "*", "row_count", (1, 100))]),
    "dq_suite": _checks_sql(EXPECTATIONS),
    "dq_checkpoint": _checks_sql(FEATURE_CHECKS),
    "dq_written_marts": _checks_sql(MART_CHECKS),
    "dq_summary": f"""
    SELECT count(*) AS checks, count(CASE WHEN NOT success THEN 1 END) AS failed_checks, bool_and(success) AS success
    FROM ({_checks_sql(EXPECTATIONS)})""",
    "smote_rows": _smote_sql(LEGACY_FEATURES),
    "smote_balance": """
    SELECT is_churned, false AS synthetic, count(*) AS rows FROM mart_churn_features GROUP BY 1 UNION ALL
    SELECT CASE WHEN ones < zeros THEN 1 ELSE 0 END, true, abs(ones - zeros) FROM (
        SELECT count(CASE WHEN is_churned = 1 THEN 1 END) AS ones, count(CASE WHEN is_churned = 0 THEN 1 END) AS zeros
        FROM mart_churn_features) WHERE ones != zeros""",
    "exp_assignment": f"""
    SELECT unit_id, {_variant('unit_id', experiments.RAMP_HEALTH_CHECK)} AS health_check_variant, variant AS full_variant
    FROM units""",
    "exp_conversion": """
    SELECT *, CAST(cart_units AS DOUBLE) / nullif(units, 0) AS add_to_cart_rate,
        CAST(buyers AS DOUBLE) / nullif(cart_units, 0) AS conversion_rate FROM conversion""",
    "exp_ztest": _read_out(_proportions("conversion", "buyers", "cart_units")),
    "exp_add_to_cart": _read_out(_proportions("conversion", "cart_units", "units")),
    "exp_segments": _read_out(_proportions("conversion_by_device", "buyers", "cart_units", "device"), "device"),
    "exp_aov": _read_out(f"""
    SELECT avg(CASE WHEN variant = 'control' THEN v END) AS c, avg(CASE WHEN variant = 'treatment' THEN v END) AS t,
        sqrt(var_samp(CASE WHEN variant = 'control' THEN v END) / count(CASE WHEN variant = 'control' THEN v END)
            + var_samp(CASE WHEN variant = 'treatment' THEN v END) / count(CASE WHEN variant = 'treatment' THEN v END)) AS se
    FROM (SELECT {_variant('user_id', experiments.RAMP_FULL)} AS variant, v FROM (
        SELECT order_id, user_id, sum(sale_price) AS v
        FROM stg_order_items GROUP BY 1, 2))"""),
    "exp_guardrail": """
    SELECT round(control_latency_ms, 6) AS control_latency_ms, round(treatment_latency_ms, 6) AS treatment_latency_ms,
        round(latency_change_ms, 6) AS latency_change_ms, control_tickets, treatment_tickets, within_guardrail FROM guards""",
    "exp_power": f"""
    SELECT device, round(b, 9) AS baseline, round(d, 9) AS daily_units, n AS units_per_variant,
        CAST(ceil(2 * n / d) AS BIGINT) AS days
    FROM (SELECT *, CAST(ceil(({experiments.Z_ALPHA} + {experiments.Z_POWER}) ^ 2 * (b * (1 - b) + b * 1.05::DOUBLE * (1 - b * 1.05::DOUBLE))
              / pow(b * 1.05::DOUBLE - b, 2)) AS BIGINT) AS n
          FROM (SELECT device, CAST(sum(reached_cart * purchased) AS DOUBLE) / sum(reached_cart) AS b,
                    CAST(sum(reached_cart) AS DOUBLE) / (max(day) - min(day) + 1) AS d FROM units GROUP BY 1))""",
    "exp_decision": f"""
    SELECT r.lift, r.p_value, g.within_guardrail,
        CASE WHEN r.status = 'Significant Positive' AND g.within_guardrail THEN 'launch' ELSE 'rollback' END AS decision
    FROM ({_read_out(_proportions('conversion', 'buyers', 'cart_units'))}) r CROSS JOIN guards g""",
}


def _needed(text: str) -> list[str]:
    """Relations a text mentions, after those they mention themselves."""
    out: list[str] = []

    def visit(body: str) -> None:
        for word in dict.fromkeys(re.findall(r"\w+", body)):
            if word in RELATIONS and word not in out:
                visit(RELATIONS[word])
                out.append(word)

    visit(text)
    return out


def full_sql(name: str) -> str:
    body = QUERY_SQL[name]
    with_ = ",\n".join(f"{r} AS ({RELATIONS[r]})" for r in _needed(body))
    return f"WITH {with_}\n{body}" if with_ else body


def all_sql() -> dict[str, str]:
    return {name: full_sql(name) for name in QUERY_SQL}
