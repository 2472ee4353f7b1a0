"""Data checks: single checks, suites over one table, and a checkpoint over suites.

Checks that look at rows one by one, and one uniqueness check, share a single pass
over a table. Key references and further uniqueness checks take a shuffle each.
A table that is written anyway is checked from its written columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.sql import named, not_in, quoted
from basketlens.sources.layers import Layer

RESULT_COLUMNS = ["table_name", "column_name", "check_name", "observed", "threshold", "failed_rows", "success", "position"]


@dataclass(frozen=True)
class RowCount:
    """The number of rows lies in ``[low, high]``."""

    low: int
    high: int
    column: str = "*"
    name: str = "row_count"


@dataclass(frozen=True)
class NotNull:
    """At least the share ``mostly`` of the values is not NULL (by default, all)."""

    column: str
    mostly: float = 1.0
    name: str = "not_null"


@dataclass(frozen=True)
class Accepted:
    """Every value that is not NULL is one of ``values``."""

    column: str
    values: tuple
    name: str = "accepted_values"


@dataclass(frozen=True)
class Unique:
    """Every value that is not NULL occurs once; all rows of a repeated value fail."""

    column: str
    name: str = "unique"


@dataclass(frozen=True)
class References:
    """Every key that is not NULL exists in the parent column."""

    column: str
    parent: DataFrame
    parent_column: str
    name: str = "relationships"


Check = RowCount | NotNull | Accepted | Unique | References


@dataclass(frozen=True)
class Suite:
    """Ordered checks on one table, known by name."""

    table: str
    df: DataFrame
    checks: Sequence[Check] = field(default_factory=tuple)


def _counted(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(*named(n="count(1)"))


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Repeated values with their number of rows."""
    return _counted(df.filter(f"{column} IS NOT NULL"), column).filter("n > 1")


def unaccepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the accepted ones with their number of rows."""
    return _counted(df.filter(not_in(column, values)), column)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys that no parent has, with their number of rows.

    Keys are counted before the join, so a hot key crosses it as one row.
    """
    keys = _counted(child.filter(f"{column} IS NOT NULL"), column)
    return keys.join(parent.selectExpr(f"{parent_column} AS value"), "value", "left_anti")


def _result(suite: Suite, check: Check, observed: str, threshold: object, failed: str, success: str) -> str:
    """The fields of a result row, for ``stack``; its position is that of the check as declared, from 1."""
    position = next(i for i, c in enumerate(suite.checks, 1) if c is check)
    return (
        f"{quoted(suite.table)}, {quoted(check.column)}, {quoted(check.name)}, CAST({observed} AS DOUBLE), "
        f"CAST({threshold} AS DOUBLE), CAST({failed} AS BIGINT), {success}, {position}"
    )


def _failures(check: Check) -> str:
    if isinstance(check, NotNull):
        return f"count_if({check.column} IS NULL)"
    if isinstance(check, Accepted):
        return f"count_if({not_in(check.column, check.values)})"
    return "0L"


def _rows(wide: DataFrame, results: list[str]) -> DataFrame:
    return wide.selectExpr(f"stack({len(results)}, {', '.join(results)}) AS ({', '.join(RESULT_COLUMNS)})")


def _one_pass(suite: Suite, checks: list[Check], unique: Unique | None) -> DataFrame:
    """All row-level checks of a table, and one uniqueness check, in one scan.

    With a uniqueness check the rows are first merged per key, which counts the
    copies of each key and the failures among them; the totals follow from that.
    """
    failures = {f"f{i}": _failures(c) for i, c in enumerate(checks)}
    if unique is None:
        wide = suite.df.agg(*named(n="count(1)", **failures))
    else:
        wide = (
            suite.df.groupBy(F.col(unique.column).alias("key"))
            .agg(*named(copies="count(1)", **failures))
            .agg(
                *named(
                    n="coalesce(sum(copies), 0)",
                    repeated_keys="count_if(key IS NOT NULL AND copies > 1)",
                    repeated_rows="coalesce(sum(CASE WHEN key IS NOT NULL AND copies > 1 THEN copies END), 0)",
                    **{f: f"coalesce(sum({f}), 0)" for f in failures},
                )
            )
        )
    results = []
    if unique is not None:
        results.append(_result(suite, unique, "repeated_keys", 0, "repeated_rows", "repeated_keys = 0"))
    return _rows(wide, [*results, *_row_results(suite, checks)])


def _row_results(suite: Suite, checks: list[Check]) -> list[str]:
    """Results of row-level checks from ``n`` rows and the failures ``f0``, ``f1``..."""
    results = []
    for i, check in enumerate(checks):
        failed = f"f{i}"
        if isinstance(check, RowCount):
            results.append(_result(suite, check, "n", check.low, "0", f"n BETWEEN {check.low} AND {check.high}"))
        elif isinstance(check, NotNull):
            share = f"coalesce((n - {failed}) / CAST(nullif(n, 0) AS DOUBLE), 1D)"
            results.append(_result(suite, check, share, check.mostly, failed, f"{share} >= {check.mostly}D"))
        else:
            results.append(_result(suite, check, failed, 0, failed, f"{failed} = 0"))
    return results


def _own_shuffle(suite: Suite, check: Unique | References) -> DataFrame:
    if isinstance(check, Unique):
        bad = duplicates(suite.df, check.column)
    else:
        bad = orphans(suite.df, check.column, check.parent, check.parent_column)
    total = bad.agg(*named(n="coalesce(sum(n), 0)", v="count(1)"))
    return _rows(total, [_result(suite, check, "v", 0, "n", "v = 0")])


def run_suite(suite: Suite) -> DataFrame:
    """One result row per check; ``position`` gives their order."""
    row_level = [c for c in suite.checks if not isinstance(c, (Unique, References))]
    uniques = [c for c in suite.checks if isinstance(c, Unique)]
    others = [*uniques[1:], *[c for c in suite.checks if isinstance(c, References)]]
    parts = [_one_pass(suite, row_level, uniques[0] if uniques else None)] if row_level or uniques else []
    parts += [_own_shuffle(suite, c) for c in others]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def replace_checked(layer: Layer, suite: Suite) -> DataFrame:
    """Write a suite's table to a layer and check what was written; one result row per check.

    The checks read their columns from the written table, so the plan of a mart runs once.
    (Observed metrics would spare this read, but once a session has observed a query, Spark
    4.1 fails to serialize the functions of fitted encoders in it.)
    """
    layer.replace(suite.table, suite.df)
    return run_suite(replace(suite, df=layer.read(suite.table)))


def run_checkpoint(suites: Sequence[Suite]) -> DataFrame:
    """Results of all suites."""
    out = run_suite(suites[0])
    for suite in suites[1:]:
        out = out.unionByName(run_suite(suite))
    return out


def summary(results: DataFrame) -> DataFrame:
    """One row: number of checks, number failed, overall success."""
    return results.agg(
        *named(checks="count(1)", failed_checks="count_if(NOT success)", success="every(success)")
    )


class QualityError(RuntimeError):
    """Some checks failed; the message lists them."""


def assert_passed(results: DataFrame) -> None:
    """Raise when a check failed, which stops the run. Results have a row per check."""
    failed = results.filter("NOT success").collect()
    if failed:
        lines = [f"{r.table_name}.{r.column_name} {r.check_name}: {r.failed_rows} rows" for r in failed]
        raise QualityError("; ".join(lines))


def stamped(results: DataFrame, run_name: str) -> DataFrame:
    """Results with the run's name and time, for a history table."""
    return results.selectExpr(
        f"concat({quoted(run_name + '-')}, date_format(current_timestamp(), 'yyyyMMdd-HHmmss')) AS run_name",
        "current_timestamp() AS run_at",
        *RESULT_COLUMNS,
    )


class SuiteBook:
    """Suites registered once by name; a second registration keeps the first."""

    def __init__(self):
        self._suites: dict[str, Suite] = {}

    def register(self, name: str, suite: Suite) -> Suite:
        return self._suites.setdefault(name, suite)

    def run(self) -> DataFrame:
        return run_checkpoint(list(self._suites.values()))
