"""Exact medians of whole tables from a few passes, without sorting or grouping values."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from basketlens.functions.sql import named

#: Relative rank error of a sketch is 1 / ACCURACY; it is asked for GRID + 1 even quantiles.
ACCURACY, GRID = 10_000, 1_000
#: Quantiles beyond the wanted one on either side: 2 / GRID is more than ten times the error.
SLACK = 2


@dataclass
class _Search:
    """What is known of one column: values at the open ranks lie between ``low`` and ``high`` or equal one."""

    low: float | None = None  # no bounds before the first pass
    high: float | None = None
    size: int | None = None
    values: dict[int, float] = field(default_factory=dict)  # by rank among all values, from 0

    @property
    def open(self) -> list[int]:
        return sorted({(self.size - 1) // 2, self.size // 2} - set(self.values)) if self.size else []

    @property
    def done(self) -> bool:
        return self.size is not None and not self.open

    @property
    def median(self) -> float | None:
        found = list(self.values.values())
        # halved before they are added, as a sum of two large doubles may overflow
        return None if not found else found[0] if len(found) == 1 else 0.5 * found[0] + 0.5 * found[1]

    def conditions(self, x: str) -> tuple[str, str, str, str]:
        """Below the bounds, at the lower one, between them, at the upper one."""
        if self.low is None:
            return "false", "false", f"{x} IS NOT NULL", "false"
        low, high = (f"CAST('{v!r}' AS DOUBLE)" for v in (self.low, self.high))
        return f"{x} < {low}", f"{x} = {low}", f"{x} > {low} AND {x} < {high}", f"{x} = {high} AND {x} > {low}"

    def take(self, below: int, at_low: int, inside: int, at_high: int, quantiles: list[float] | None) -> None:
        """Settle ranks at the bounds and narrow the bounds of the others."""
        if self.size is None:
            self.size = inside
        start, end = below + at_low, below + at_low + inside
        for rank in self.open:
            if not below <= rank < end + at_high:
                raise RuntimeError("a middle value is outside the bounds: did the table change between two passes?")
            if rank < start:
                self.values[rank] = self.low
            elif rank >= end:
                self.values[rank] = self.high
            elif 2 * inside <= GRID:  # a sketch of so few values holds them all, with a quantile at least for each
                self.values[rank] = quantiles[round((rank - start + 0.5) * GRID / inside)]
        if self.open:
            first, last = self.open[0] - start, self.open[-1] - start
            self.low = quantiles[max(0, first * GRID // inside - SLACK)]
            self.high = quantiles[min(GRID, -(-(last + 1) * GRID // inside) + SLACK)]


def exact_medians(df: DataFrame, columns: dict[str, str]) -> dict[str, float | None]:
    """The median of each expression: the mean of the two middle values, None without values.

    NULL and NaN are no values. A pass counts, for all columns at once, the values below, at
    and between bounds that hold the middle, and draws a sketch of those between; the bounds of
    the next pass come from the sketch, the counts show that they hold. A pass leaves about one
    value in 150 between them, so a billion distinct values take four. State per task is one
    sketch a column. ``df`` is read in every pass: pass a written table.
    """
    grid = f"array({', '.join(f'{i / GRID}D' for i in range(GRID + 1))})"
    values = df.selectExpr(*[f"nanvl(CAST({e} AS DOUBLE), CAST(NULL AS DOUBLE)) AS x{i}" for i, e in enumerate(columns.values())])
    searches = [_Search() for _ in columns]
    while not all(s.done for s in searches):
        wanted = {}
        for i, s in enumerate(searches):
            if not s.done:
                parts = s.conditions(f"x{i}")
                wanted |= {f"c{i}_{n}": f"count_if({part})" for n, part in enumerate(parts)}
                wanted[f"q{i}"] = f"percentile_approx(CASE WHEN {parts[2]} THEN x{i} END, {grid}, {ACCURACY})"
        counted = values.agg(*named(**wanted)).first()
        for i, s in enumerate(searches):
            if not s.done:
                s.take(*(counted[f"c{i}_{n}"] for n in range(4)), counted[f"q{i}"])
    return {name: s.median for name, s in zip(columns, searches)}
