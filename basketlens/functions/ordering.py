"""Ranks and running totals over a whole table without a one-task sort.

A window without a partition key, or keyed by a class label, puts an unbounded
group into one task. Both helpers cut the order into buckets, total each bucket,
and carry the totals of earlier buckets over: only the bucket totals (a number of
rows that the arguments or the session's partitions fix) are ever windowed as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS_PER_PARTITION = 16
#: Cut points that the approximate quantiles tell apart, and that are sent to all tasks.
MOST_CUTS = 4096


def hash_rank(
    df: DataFrame,
    key: str,
    seed: int | str,
    by: Sequence[str] = (),
    rank: str = "rank",
    size: str | None = None,
) -> DataFrame:
    """Number rows from 1 in the order of ``md5(seed-key)``, within each ``by`` group.

    The order is a repeatable shuffle: it depends on the key and the seed alone.
    ``size`` names an optional column with the number of rows of the group.
    Digests are uniform, so buckets are even however large one group is, and their number
    follows the session's shuffle partitions (the ranks do not depend on it). ``df`` is
    read twice, first for its key and group alone; pass a written table if it is costly.
    """
    by = list(by)
    group = f"PARTITION BY {', '.join(by) if by else '0'}"
    comma = "".join(f"{c}, " for c in by)
    buckets = BUCKETS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    head = "CAST(conv(substring(__digest, 1, 8), 16, 10) AS BIGINT)"
    marked = df.selectExpr("*", f"md5(concat('{seed}-', CAST({key} AS STRING))) AS __digest").selectExpr(
        "*", f"shiftright({head} * {buckets}L, 32) AS __bucket"
    )
    counts = marked.groupBy(*by, "__bucket").agg(F.expr("count(1) AS __n"))
    offsets = counts.selectExpr(
        *[f"{c} AS __g_{c}" for c in by],
        "__bucket AS __g_bucket",
        f"sum(__n) OVER ({group} ORDER BY __bucket) - __n AS __offset",
        f"sum(__n) OVER ({group}) AS __size",
    )
    same = " AND ".join(["__bucket = __g_bucket", *[f"{c} <=> __g_{c}" for c in by]])
    ranked = marked.selectExpr(
        "*", f"row_number() OVER (PARTITION BY {comma}__bucket ORDER BY __digest, {key}) AS __row"
    ).join(offsets, F.expr(same))
    sized = [f"__size AS {size}"] if size else []
    return ranked.selectExpr(*[f"`{c}`" for c in df.columns], f"__row + __offset AS {rank}", *sized)


def running_totals(
    df: DataFrame,
    order: str,
    totals: dict[str, str],
    by: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Add ``totals[new] = sum(old)`` over all rows of the ``by`` group up to and with the current one.

    ``order`` must be a double, not NULL and unique in its group (aggregate by it
    first). The cut points are approximate quantiles of ``order`` over all groups;
    they steer the work, not the result. Their number follows the session's shuffle
    partitions. Groups should be few: their bucket totals (``buckets`` rows each) are what
    is joined back. ``df`` is read three times; pass a stored table.
    """
    by = list(by)
    if buckets is None:
        buckets = min(MOST_CUTS, BUCKETS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = ", ".join(f"{i / buckets}D" for i in range(1, buckets))
    way = "DESC" if descending else "ASC"
    comma = "".join(f"{c}, " for c in by)
    bounds = df.agg(F.expr(f"percentile_approx({order}, array({cuts}), 10000) AS bounds")).scalar()
    marked = (
        df.withColumn("__bounds", bounds)
        .selectExpr("*", f"coalesce(size(filter(__bounds, b -> b < {order})), 0) AS __bucket")
        .drop("__bounds")
    )
    sums = marked.groupBy(*by, "__bucket").agg(*[F.expr(f"sum({old}) AS __t_{new}") for new, old in totals.items()])
    group = f"PARTITION BY {', '.join(by) if by else '0'}"
    earlier = f"OVER ({group} ORDER BY __bucket {way} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    offsets = sums.selectExpr(
        *[f"{c} AS __g_{c.lstrip('_')}" for c in by],
        "__bucket AS __g_bucket",
        *[f"coalesce(sum(__t_{new}) {earlier}, 0) AS __o_{new}" for new in totals],
    )
    if not by:
        offsets = F.broadcast(offsets)  # at most ``buckets`` rows
    # Null-safe, though never NULL: from a plain equality the optimizer would infer the
    # bucket's own expression for the other side, which does not have ``order``.
    same = " AND ".join(f"{c} <=> __g_{c.lstrip('_')}" for c in ["__bucket", *by])
    inside = (
        f"OVER (PARTITION BY {comma}__bucket ORDER BY {order} {way} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    return (
        marked.selectExpr("*", *[f"sum({old}) {inside} AS __r_{new}" for new, old in totals.items()])
        .join(offsets, F.expr(same))
        .selectExpr(*df.columns, *[f"__r_{new} + __o_{new} AS {new}" for new in totals])
    )


def in_share(rank: str, size: str, share: float) -> str:
    """Whether a rank lies in the first ``round(share * size)`` rows of its group."""
    return f"({rank} <= round({size} * {share}D))"
