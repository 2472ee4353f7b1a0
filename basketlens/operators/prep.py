"""Feature preparation: imputing, scaling, encoding, weights, splits and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from basketlens.functions.sql import named, quoted, with_stats
from basketlens.functions.ordering import hash_rank, in_share
from basketlens.functions.selection import exact_medians

MAX_LEVELS = 10_000


def _replaced(df: DataFrame, new: dict[str, str]) -> list[str]:
    """All columns of ``df``, some of them replaced by expressions."""
    return [f"{new[c]} AS `{c}`" if c in new else f"`{c}`" for c in df.columns]


def medians(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """One row of medians. The exact form reads ``df``, best a written table, several
    times right here (see ``exact_medians``); the other is a sketch and lazy."""
    if exact:
        found = exact_medians(df, {c: f"`{c}`" for c in columns})
        schema = ", ".join(f"`{c}` double" for c in columns)
        return df.sparkSession.createDataFrame([tuple(found[c] for c in columns)], schema)
    return df.agg(*named(**{c: f"percentile_approx(CAST({c} AS DOUBLE), 0.5D, 10000)" for c in columns}))


def impute_median(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None, exact: bool = True) -> DataFrame:
    """Fill NULLs with the medians of the training rows."""
    fitted = medians(df if fitted_on is None else fitted_on, columns, exact)
    filled = {c: f"coalesce(CAST({c} AS DOUBLE), __mid.{c})" for c in columns}
    return with_stats(df, "__mid", fitted).selectExpr(*_replaced(df, filled))


def impute_missing(df: DataFrame, columns: Sequence[str], value: str = "missing") -> DataFrame:
    return df.na.fill(value, list(columns))


def scale_standard(df: DataFrame, columns: Sequence[str], fitted_on: DataFrame | None = None) -> DataFrame:
    """Subtract the mean, divide by the population deviation of the training rows.

    A constant column becomes zero, as its deviation counts as one.
    """
    moments = {f"mean_{c}": f"avg({c})" for c in columns} | {f"sd_{c}": f"stddev_pop({c})" for c in columns}
    fitted = (df if fitted_on is None else fitted_on).agg(*named(**moments))
    scaled = {c: f"({c} - __s.mean_{c}) / coalesce(nullif(__s.sd_{c}, 0D), 1D)" for c in columns}
    return with_stats(df, "__s", fitted).selectExpr(*_replaced(df, scaled))


def category_levels(df: DataFrame, columns: Sequence[str], limit: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted distinct values per column, in one pass over the training rows.

    Levels become columns of a model, so more than ``limit`` in all is an error.
    """
    pairs = ", ".join(f"'{c}', CAST({c} AS STRING)" for c in columns)
    found = (
        df.selectExpr(f"stack({len(columns)}, {pairs}) AS (name, level)")
        .filter("level IS NOT NULL").distinct().limit(limit + 1).collect()
    )
    if len(found) > limit:
        raise ValueError(f"more than {limit} category levels in {list(columns)}")
    return {c: sorted(r["level"] for r in found if r["name"] == c) for c in columns}


def encode_dummies(df: DataFrame, levels: dict[str, list[str]], drop_first: bool = True) -> DataFrame:
    """Replace each categorical column by 0/1 columns named ``column_level``.

    Levels come from the training rows; a value unknown there gives zeros. With
    ``drop_first`` the alphabetically first level is the base and gets no column.
    """
    dummies = [
        f"CAST({name} <=> {quoted(value)} AS INT) AS `{name}_{value}`"
        for name, values in levels.items()
        for value in (values[1:] if drop_first else values)
    ]
    return df.selectExpr(*[f"`{c}`" for c in df.columns if c not in levels], *dummies)


def align_columns(df: DataFrame, names: Sequence[str], fill: float = 0) -> DataFrame:
    """Exactly the named columns in their order; those missing hold ``fill``."""
    have = set(df.columns)
    return df.selectExpr(*[f"`{n}`" if n in have else f"{fill} AS `{n}`" for n in names])


def class_balance(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(target).agg(*named(users="count(1)"))


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Per class: rows, balanced weight n/(classes * rows), and negatives per positive."""
    per_class = class_balance(df, target)
    whole = per_class.agg(
        *named(
            n="sum(users)", classes="count(1)",
            neg=f"sum(CASE WHEN {target} = 0 THEN users END)", pos=f"sum(CASE WHEN {target} = 1 THEN users END)",
        )
    )
    return with_stats(per_class, "__all", whole).selectExpr(
        target,
        "users",
        "CAST(__all.n AS DOUBLE) / (__all.classes * users) AS balanced_weight",
        "CAST(coalesce(__all.neg, 0) AS DOUBLE) / __all.pos AS scale_pos_weight",
    )


def with_balanced_weight(df: DataFrame, target: str, name: str = "weight") -> DataFrame:
    """Add the balanced class weight to each row; class counts are a scalar subquery."""
    per_class = df.agg(*named(pos=f"count_if({target} = 1)", neg=f"count_if({target} = 0)"))
    own = f"(CASE WHEN {target} = 1 THEN __n.pos ELSE __n.neg END)"
    weight = f"CAST(__n.pos + __n.neg AS DOUBLE) / (2 * {own}) AS {name}"
    return with_stats(df, "__n", per_class).selectExpr(*[f"`{c}`" for c in df.columns], weight)


def stratified_split(
    df: DataFrame, target: str, key: str = "user_id", test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: exactly the rounded share of each class, in hash order of the key."""
    ranked = hash_rank(df, key, seed, by=[target], rank="__rank", size="__size")
    return ranked.selectExpr(*df.columns, f"{in_share('__rank', '__size', test_share)} AS is_test")


def plain_split(df: DataFrame, key: str = "user_id", test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test`` for exactly the rounded share of all rows, without strata."""
    ranked = hash_rank(df, key, seed, rank="__rank", size="__size")
    return ranked.selectExpr(*df.columns, f"{in_share('__rank', '__size', test_share)} AS is_test")


def stratified_folds(df: DataFrame, target: str, key: str = "user_id", folds: int = 3, seed: int = 42) -> DataFrame:
    """Add ``fold`` in ``[0, folds)``; class counts differ by at most one between folds."""
    ranked = hash_rank(df, key, seed, by=[target], rank="__rank")
    return ranked.selectExpr(*df.columns, f"CAST((__rank - 1) % {folds} AS INT) AS fold")
