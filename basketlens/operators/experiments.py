"""A/B tests: assignment, conversion, significance, guardrails and the decision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from basketlens.functions.sql import hash_bucket, named, ratio, two_sided_p, with_stats

CONTROL, TREATMENT, HOLDOUT = "control", "treatment", "holdout"
BUCKETS = 10_000

# Traffic shares (control, treatment) of the two rollout steps.
RAMP_HEALTH_CHECK = (0.01, 0.01)
RAMP_FULL = (0.5, 0.5)

# Standard normal quantiles for alpha 0.05 (two-sided) and power 0.80.
Z_ALPHA, Z_POWER = 1.959963984540054, 0.8416212335729143


def variant(unit: str, salt: str, shares: tuple[float, float] = RAMP_FULL) -> str:
    """Stable assignment of a unit by its hash; units outside the shares are held out.

    Widening the shares keeps control units in control and adds treatment units
    from the other end of the buckets, so nobody changes sides during the ramp.
    """
    bucket = hash_bucket(salt, unit, BUCKETS)
    control, treatment = (round(s * BUCKETS) for s in shares)
    return (
        f"CASE WHEN {bucket} < {control} THEN '{CONTROL}' "
        f"WHEN {bucket} >= {BUCKETS - treatment} THEN '{TREATMENT}' ELSE '{HOLDOUT}' END"
    )


def assign(df: DataFrame, unit: str, salt: str, shares: tuple[float, float] = RAMP_FULL) -> DataFrame:
    return df.selectExpr("*", f"{variant(unit, salt, shares)} AS variant")


def exposed(df: DataFrame) -> DataFrame:
    return df.filter(f"variant != '{HOLDOUT}'")


def conversion(df: DataFrame, unit: str = "unit_id", by: Sequence[str] = ()) -> DataFrame:
    """Per variant: distinct units reaching the cart, distinct buyers among them, rates.

    Rows are first merged to one per unit, which serves all distinct counts at once.
    """
    per_unit = (
        exposed(df)
        .filter(f"{unit} IS NOT NULL")
        .groupBy(*by, "variant", unit)
        .agg(*named(cart="max(reached_cart)", bought="max(least(reached_cart, purchased))"))
    )
    counts = per_unit.groupBy(*by, "variant").agg(*named(units="count(1)", cart_units="sum(cart)", buyers="sum(bought)"))
    return counts.selectExpr(
        "*", f"{ratio('cart_units', 'units')} AS add_to_cart_rate", f"{ratio('buyers', 'cart_units')} AS conversion_rate"
    )


def _side_by_side(per_variant: DataFrame, columns: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """One row per ``by`` group with columns ``{short}_c`` and ``{short}_t`` of both variants."""
    picks = {
        f"{short}_{side[0]}": f"max(CASE WHEN variant = '{side}' THEN {c} END)"
        for short, c in columns.items()
        for side in (CONTROL, TREATMENT)
    }
    return per_variant.groupBy(*by).agg(*named(**picks))


def _read_out(wide: DataFrame, c: str, t: str, error: str, by: Sequence[str], alpha: float) -> DataFrame:
    """Values of both variants and the standard error of their difference as a read-out."""
    change = "(treatment_value - control_value)"
    return (
        wide.selectExpr(*by, f"{c} AS control_value", f"{t} AS treatment_value", f"{error} AS error")
        .selectExpr(
            *by, "control_value", "treatment_value", f"{ratio(change, 'control_value')} AS lift",
            f"{ratio(change, 'error')} AS z_score",
        )
        .selectExpr("*", f"{two_sided_p('z_score')} AS p_value")
        .selectExpr(
            "*",
            f"""CASE WHEN p_value IS NULL THEN 'Undefined' WHEN p_value >= {alpha}D THEN 'Neutral'
                WHEN lift > 0 THEN 'Significant Positive' ELSE 'Significant Negative' END AS status""",
        )
    )


def proportion_test(
    per_variant: DataFrame, successes: str = "buyers", trials: str = "cart_units", by: Sequence[str] = (), alpha: float = 0.05
) -> DataFrame:
    """Two-proportion z-test with pooled variance: values, lift, z, p-value, status."""
    wide = _side_by_side(per_variant, {"x": successes, "n": trials}, by)
    pooled = ratio("(x_c + x_t)", "(n_c + n_t)")
    error = f"sqrt({pooled} * (1 - {pooled}) * ({ratio('1', 'n_c')} + {ratio('1', 'n_t')}))"
    return _read_out(wide, ratio("x_c", "n_c"), ratio("x_t", "n_t"), error, by, alpha)


def mean_by_variant(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    v = f"CAST({value} AS DOUBLE)"
    return exposed(df).groupBy(*by, "variant").agg(
        *named(n=f"count({v})", mean=f"avg({v})", variance=f"var_samp({v})")
    )


def mean_test(per_variant: DataFrame, by: Sequence[str] = (), alpha: float = 0.05) -> DataFrame:
    """Difference of means with unequal variances (large-sample z): the same read-out."""
    wide = _side_by_side(per_variant, {"m": "mean", "v": "variance", "n": "n"}, by)
    return _read_out(wide, "m_c", "m_t", f"sqrt({ratio('v_c', 'n_c')} + {ratio('v_t', 'n_t')})", by, alpha)


def guardrails(
    timings: DataFrame, tickets: DataFrame, units: DataFrame, unit: str = "unit_id", latency_limit_ms: float = 200.0
) -> DataFrame:
    """One row: mean latency by variant and its difference, tickets per variant, verdict.

    ``timings`` (unit, latency_ms) and ``tickets`` (unit, ticket_id) take their
    variant from ``units``. Tickets are monitored; only latency gives the verdict.
    Both are summed per unit before they meet the units, so no hot unit is joined.
    """
    known = exposed(units).select(unit, "variant").distinct()
    rows = timings.selectExpr(unit, "latency_ms", "CAST(NULL AS BIGINT) AS ticket").unionByName(
        tickets.selectExpr(unit, "CAST(NULL AS DOUBLE) AS latency_ms", "CAST(ticket_id AS BIGINT) AS ticket")
    )
    per_unit = rows.groupBy(unit).agg(
        *named(total="sum(latency_ms)", views="count(latency_ms)", tickets="count(ticket)")
    )
    per_variant = (
        per_unit.join(known, unit)
        .groupBy("variant")
        .agg(*named(latency=ratio("sum(total)", "sum(views)"), tickets="sum(tickets)"))
    )
    return _side_by_side(per_variant, {"l": "latency", "k": "tickets"}).selectExpr(
        "l_c AS control_latency_ms", "l_t AS treatment_latency_ms", "l_t - l_c AS latency_change_ms",
        "k_c AS control_tickets", "k_t AS treatment_tickets",
        f"coalesce(l_t - l_c <= {latency_limit_ms}D, false) AS within_guardrail",
    )


def sample_size(baseline: str, relative_effect: float, z_alpha: float = Z_ALPHA, z_power: float = Z_POWER) -> str:
    """Units per variant to detect a relative change of a rate, unpooled variance."""
    target = f"({baseline} * {1 + relative_effect}D)"
    variance = f"({baseline} * (1 - {baseline}) + {target} * (1 - {target}))"
    squared_effect = f"(({target} - {baseline}) * ({target} - {baseline}))"
    return f"CAST(ceil({ratio(f'({(z_alpha + z_power) ** 2}D * {variance})', squared_effect)}) AS BIGINT)"


def power_plan(
    designs: DataFrame, baseline: str = "baseline", daily_units: str = "daily_units", relative_effect: float = 0.05,
    z_alpha: float = Z_ALPHA, z_power: float = Z_POWER,
) -> DataFrame:
    """Sample size per variant and days to fill two variants, per design row."""
    size = sample_size(baseline, relative_effect, z_alpha, z_power)
    return designs.selectExpr("*", f"{size} AS units_per_variant").selectExpr(
        "*", f"CAST(ceil({ratio('(2 * units_per_variant)', daily_units)}) AS BIGINT) AS days"
    )


def decide(primary: DataFrame, guards: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Launch on a significant positive lift with green guardrails, else roll back.

    Both inputs have one row; the guardrails enter as a scalar.
    """
    return with_stats(primary, "g", guards.select("within_guardrail")).selectExpr(
        "lift",
        "p_value",
        "g.within_guardrail AS within_guardrail",
        f"""CASE WHEN p_value < {alpha}D AND lift > 0 AND g.within_guardrail
            THEN 'launch' ELSE 'rollback' END AS decision""",
    )
