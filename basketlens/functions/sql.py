"""SQL expression text with one fixed meaning for NULLs, zones and rounding.

Helpers take and return expression text, so an operator hands Spark a few whole
expressions (``selectExpr``, ``agg(*named(...))``) instead of building each one
node by node over the Python gateway.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Moment = str | date | datetime


def named(**expressions: str) -> list[Column]:
    """``named(n="count(1)")`` as columns for ``select`` or ``agg``."""
    return [F.expr(f"{text} AS `{name}`") for name, text in expressions.items()]


def quoted(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(values) -> str:
    """Literals for an ``IN`` list."""
    return ", ".join(quoted(v) if isinstance(v, str) else str(v) for v in values)


def _datetime(value: Moment) -> datetime:
    if isinstance(value, datetime):
        return value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return datetime.fromisoformat(value)


def moment(value: Moment, plus_days: int = 0) -> str:
    """A timestamp literal without zone: the scan can use it as a pushed-down bound."""
    return f"timestamp_ntz'{_datetime(value) + timedelta(days=plus_days)}'"


def shift_days(ts: str, days: int) -> str:
    return f"({ts} + INTERVAL '{days}' DAY)" if days >= 0 else f"({ts} - INTERVAL '{-days}' DAY)"


def before(ts: str, end: Moment) -> str:
    return f"({ts} < {moment(end)})"


def look_back(ts: str, end: Moment, days: int) -> str:
    """``[end - days, end)``"""
    return f"({ts} >= {moment(end, -days)} AND {ts} < {moment(end)})"


def look_ahead(ts: str, start: Moment, days: int | None) -> str:
    """``[start, start + days)``, or open-ended without ``days``."""
    if days is None:
        return f"({ts} >= {moment(start)})"
    return f"({ts} >= {moment(start)} AND {ts} < {moment(start, days)})"


def week_start(ts: str) -> str:
    """The Monday of the week, as a date."""
    return f"trunc(to_date({ts}), 'week')"


def elapsed_seconds(start: str, end: str) -> str:
    """Whole seconds between two timestamps without zone."""
    return f"timestampdiff(SECOND, {start}, {end})"


def elapsed_days_rounded(start: str, end: Moment) -> str:
    """Elapsed days as an integer, halves away from zero."""
    return f"CAST(round({elapsed_seconds(start, moment(end))} / 86400D) AS INT)"


def ratio(numerator: str, denominator: str) -> str:
    """Quotient as a double; NULL when the denominator is zero."""
    return f"(CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0D))"


def or_zero(c: str) -> str:
    return f"coalesce({c}, 0)"


def join_text(*parts: str) -> str:
    """Concatenate, with NULL parts read as empty text."""
    return "concat(" + ", ".join(f"coalesce({p}, '')" for p in parts) + ")"


def flag(condition: str) -> str:
    """1 or 0; an unknown condition counts as 0."""
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def not_in(c: str, values) -> str:
    """Neither of the values; unknown for NULL."""
    return f"({c} NOT IN ({listed(values)}))"


def exact_sum(price: str, scale: int = 10) -> str:
    """Sum of money as stored, as a double: added in decimal so that row order cannot matter.

    ``scale`` decimals are kept, which is more than a stored price has; what is smaller counts
    as 0. Where a value is no money (NaN, infinite, 1e17 or more) doubles are added.
    """
    fits = f"(abs({price}) < 1e17D)"
    cents = f"CAST(sum(CAST(CASE WHEN {fits} THEN {price} END AS DECIMAL(28, {scale}))) AS DOUBLE)"
    return f"CASE WHEN count_if(NOT {fits}) > 0 THEN sum(CAST({price} AS DOUBLE)) ELSE {cents} END"


def hash_bucket(salt: str, key: str, buckets: int) -> str:
    """Stable bucket of a key in ``[0, buckets)`` from the first 32 bits of an md5 digest."""
    digest = f"md5(concat({quoted(salt)}, CAST({key} AS STRING)))"
    return f"(CAST(conv(substring({digest}, 1, 8), 16, 10) AS BIGINT) % {buckets})"


# Rational approximation of the complementary error function,
# relative error below 1.2e-7 everywhere (constant term first).
ERFC_TERMS = [
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
]


def two_sided_p(z: str) -> str:
    """P(|Z| >= |z|) for a standard normal Z."""
    x = f"(abs({z}) / sqrt(2D))"
    t = f"(1D / (1D + {x} / 2D))"
    poly = f"{ERFC_TERMS[-1]}D"
    for term in reversed(ERFC_TERMS[:-1]):
        poly = f"({poly} * {t} + {term}D)"
    return f"({t} * exp({poly} - {x} * {x}))"


def with_stats(df: DataFrame, name: str, one_row: DataFrame) -> DataFrame:
    """Add a one-row table to every row as the struct ``name``, by a scalar subquery.

    Refer to the fields of the added column: each ``scalar()`` in an expression
    would be planned anew, while a column is planned once.
    """
    return df.withColumn(name, one_row.select(F.struct("*").alias(name)).scalar())
