"""Feature drift between a reference table (training) and a current one (scoring)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame

from basketlens.functions.sql import named, ratio, with_stats
from basketlens.session import scratch_path

DRIFT_FEATURES = ["recency_days", "frequency_60d", "total_events", "view_count"]
RETRAIN_PERCENT = 10.0
#: Moments kept of a cell of the density, and cells per bandwidth (see ``drift_density``).
TERMS, CELLS_PER_BANDWIDTH = 12, 2


def _stacked(df: DataFrame, features: Sequence[str], *parts: str, names: str) -> DataFrame:
    """A row per feature, with the columns ``{part}{feature}`` as its values."""
    rows = ", ".join(f"'{f}', " + ", ".join(f"{p}{f}" for p in parts) for f in features)
    return df.selectExpr(f"stack({len(features)}, {rows}) AS (feature, {names})")


def _means(df: DataFrame, features: Sequence[str], side: str) -> DataFrame:
    """Rows of the table and mean per feature (NULLs skipped), in one pass."""
    stats = df.agg(*named(n="count(1)", **{f"m_{f}": f"CAST(avg({f}) AS DOUBLE)" for f in features}))
    wide = stats.selectExpr("*", *[f"n AS n_{f}" for f in features])
    return _stacked(wide, features, "n_", "m_", names=f"{side}_rows, {side}_mean")


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str] = DRIFT_FEATURES,
    retrain_percent: float = RETRAIN_PERCENT,
) -> DataFrame:
    """Row counts, means and percent shift per feature, and whether to retrain.

    The shift is NULL where the reference mean is zero.
    """
    both = _means(reference, features, "reference").join(_means(current, features, "current"), "feature")
    shift = ratio("(current_mean - reference_mean)", "reference_mean")
    return both.selectExpr(
        "feature", "reference_rows", "current_rows", "reference_mean", "current_mean", f"{shift} * 100 AS shift_percent"
    ).selectExpr("*", f"coalesce(abs(shift_percent) > {retrain_percent}D, false) AS retrain")


def _value_counts(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows per (side, feature, value): all that a distribution needs, merged map-side.

    Written to the shared folder once, as bounds, spreads and sums each read them.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        doubles = df.selectExpr(*[f"CAST({f} AS DOUBLE) AS {f}" for f in features])
        return _stacked(doubles, features, "", names="value").selectExpr(f"'{name}' AS side", "feature", "value")

    rows = side(reference, "reference").unionByName(side(current, "current"))
    counts = rows.filter("value IS NOT NULL").groupBy("side", "feature", "value").agg(*named(n="count(1)"))
    path = scratch_path(reference.sparkSession, "counts")
    counts.write.parquet(path)
    return reference.sparkSession.read.schema(counts.schema).parquet(path)


def _lookup(df: DataFrame, name: str, stats: DataFrame, *keys: str) -> DataFrame:
    """Add the stats of a row's keys as the struct ``name``.

    ``stats`` has a row per feature (and side): as few as there are features, so
    it travels as one scalar map and needs no join.
    """
    key = f"concat_ws('|', {', '.join(keys)})"
    values = ", ".join(c for c in stats.columns if c not in keys)
    table = stats.agg(*named(m=f"map_from_entries(collect_list(struct({key}, struct({values}))))"))
    return with_stats(df, "__map", table).selectExpr(*df.columns, f"__map.m[{key}] AS {name}")


def drift_histogram(
    reference: DataFrame, current: DataFrame, features: Sequence[str] = DRIFT_FEATURES, bins: int = 20
) -> DataFrame:
    """Equal-width histogram per feature and side on shared bounds.

    ``density`` is the share of the side's rows per unit of the feature's width;
    a feature with one value only has one bin of width one.
    """
    counts = _value_counts(reference, current, features)
    bounds = (
        counts.groupBy("feature")
        .agg(*named(low="min(value)", high="max(value)"))
        .selectExpr("feature", "low", f"CASE WHEN high > low THEN (high - low) / {bins} ELSE 1D END AS width")
    )
    binned = (
        _lookup(counts, "b", bounds, "feature")
        .selectExpr("*", f"CAST(least(floor((value - b.low) / b.width), {bins - 1}) AS INT) AS bin")
        .groupBy("feature", "side", "bin", "b")
        .agg(*named(rows="sum(n)"))
    )
    return binned.selectExpr(
        "feature",
        "side",
        "bin",
        "b.low + bin * b.width AS bin_start",
        "rows",
        "rows / (sum(rows) OVER (PARTITION BY feature, side) * b.width) AS density",
    )


def _stored_sides(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """The features of both sides as doubles, written to the shared folder for the two passes over them."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.selectExpr(f"'{name}' AS side", *[f"CAST({f} AS DOUBLE) AS {f}" for f in features])

    rows = side(reference, "reference").unionByName(side(current, "current"))
    path = scratch_path(reference.sparkSession, "sides")
    rows.write.parquet(path)
    return reference.sparkSession.read.schema(rows.schema).parquet(path)


def hermite(degree: int) -> list[list[int]]:
    """Coefficients, constant term first, of the Hermite polynomials up to ``degree``:
    each is x times the one before less its degree times the one before that."""
    found = [[1], [0, 1]]
    for d in range(1, degree):
        raised, lower = [0, *found[-1]], found[-2]
        found.append([c - d * (lower[i] if i < len(lower) else 0) for i, c in enumerate(raised)])
    return found[: degree + 1]


def _series(t: str) -> str:
    """Sum of moments times Hermite polynomials of ``t``, as one polynomial in ``t`` by Horner's rule."""
    polynomials = hermite(TERMS - 1)
    text = "0D"
    for power in reversed(range(TERMS)):
        parts = [f"{h[power]}D * m{p}" for p, h in enumerate(polynomials) if power < len(h) and h[power]]
        text = f"({text} * {t} + ({' + '.join(parts) or '0D'}))"
    return text


def drift_density(
    reference: DataFrame, current: DataFrame, features: Sequence[str] = DRIFT_FEATURES, points: int = 100, cut: float = 3.0
) -> DataFrame:
    """Gaussian kernel density per feature and side on a grid of its own.

    Bandwidth is Scott's rule (deviation times n^-1/5), the grid runs ``cut``
    bandwidths past both ends. A constant feature has no density and gives no rows.

    Values are counted into cells half a bandwidth wide, each kept as ``TERMS`` moments about
    its middle, and the grid adds up the cells: the kernel exp(-(t - s)^2 / 2), for a point t and
    a value s bandwidths from the middle, is exp(-t^2 / 2) times the sum of He_p(t) s^p / p!.
    With s at most 1/4 and twelve terms the rest is below 1e-11 of the kernel's peak, so is what
    cells 12 bandwidths off would add. The work is ``TERMS`` sums a value and ``points`` sums a
    cell, whether values repeat or not; the sides are read twice, from a written copy of the features.
    """
    stored = _stored_sides(reference, current, features)
    wide = stored.groupBy("side").agg(
        *named(**{f"{part}{f}": f"{function}({f})" for f in features
                  for part, function in (("n_", "count"), ("l_", "min"), ("u_", "max"), ("d_", "stddev_samp"))})
    )
    rows = ", ".join(f"'{f}', n_{f}, l_{f}, u_{f}, d_{f}" for f in features)
    grid = (
        wide.selectExpr("side", f"stack({len(features)}, {rows}) AS (feature, rows, low, high, deviation)")
        .selectExpr("*", "deviation * pow(rows, -0.2D) AS h")
        .filter("h > 0")
        .selectExpr(
            "side", "feature", "rows", "h", "low", f"low - {cut}D * h AS start",
            f"(high - low + {2 * cut}D * h) / {points - 1} AS step",
        )
    )
    values = ", ".join(f"'{f}', {f}" for f in features)
    scaled = (
        _lookup(stored.selectExpr("side", f"stack({len(features)}, {values}) AS (feature, value)"), "g", grid, "side", "feature")
        .filter("value IS NOT NULL AND g IS NOT NULL")
        .selectExpr("side", "feature", "(value - g.low) / g.h AS z")
        .selectExpr("side", "feature", f"floor(z * {CELLS_PER_BANDWIDTH}) AS cell", "z")
        .selectExpr("side", "feature", "cell", f"z - (cell + 0.5D) / {CELLS_PER_BANDWIDTH} AS s")
    )
    moments = {f"m{p}": f"sum({' * '.join(['s'] * p) or '1D'}) / {math.factorial(p)}D" for p in range(TERMS)}
    cells = scaled.groupBy("side", "feature", "cell").agg(*named(**moments))
    return (
        _lookup(cells, "g", grid, "side", "feature")
        .selectExpr("*", f"explode(sequence(0, {points - 1})) AS point")
        .selectExpr(
            "feature", "side", "g", "point", *moments,
            f"(g.start - g.low + point * g.step) / g.h - (cell + 0.5D) / {CELLS_PER_BANDWIDTH} AS t",
        )
        .selectExpr("feature", "side", "g", "point", f"CASE WHEN abs(t) < 12 THEN exp(-0.5D * t * t) * {_series('t')} ELSE 0D END AS k")
        .groupBy("feature", "side", "g", "point")
        .agg(*named(kernel_sum="sum(k)"))
        .selectExpr(
            "feature", "side", "point", "g.start + point * g.step AS x",
            f"kernel_sum / (g.rows * g.h * {math.sqrt(2 * math.pi)!r}D) AS density",
        )
    )
