"""Which features drive a score: exact shares for linear models, permutation for any."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.ordering import hash_rank
from basketlens.functions.sql import named, with_stats
from basketlens.operators.metrics import ranking_metrics
from basketlens.operators.models import feature_names, score


def linear_contributions(df: DataFrame, weights: dict[str, float], keep: Sequence[str] = ("user_id",)) -> DataFrame:
    """Per row and feature ``weight * (x - mean(x))``: the exact attribution of a linear model."""
    means = df.agg(*named(**{c: f"avg({c})" for c in weights}))
    shares = [f"({c} - __means.{c}) * {w}D AS {c}" for c, w in weights.items()]
    return with_stats(df, "__means", means).selectExpr(*keep, *shares)


def mean_absolute(contributions: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    wide = contributions.agg(*named(**{f: f"avg(abs({f}))" for f in features}))
    rows = ", ".join(f"'{f}', {f}" for f in features)
    long = wide.selectExpr(f"stack({len(features)}, {rows}) AS (feature, importance)")
    return long.orderBy(F.desc_nulls_last("importance"), "feature")


def split_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Share of split gain per feature of a tree model; a row per feature slot."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(feature_names(model, df), weights)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


def permuted(df: DataFrame, features: Sequence[str], key: str, seed: int) -> DataFrame:
    """Pair each row with the features of the next row in hash order (``other_...``).

    Hash order has nothing to do with the data, so this is a random permutation in
    which no row keeps its own values, made by one equi-join instead of a sort.
    """
    ranked = hash_rank(df, key, seed, rank="__rank", size="__size")
    partner = ranked.selectExpr("__rank % __size + 1 AS __rank", *[f"{f} AS other_{f}" for f in features])
    return ranked.join(partner, "__rank").drop("__rank", "__size")


def permutation_importance(
    model: PipelineModel, df: DataFrame, features: Sequence[str], label: str, key: str = "user_id", seed: int = 42
) -> DataFrame:
    """Loss of average precision when one feature at a time is permuted, largest first.

    Each row is scored once as it is and once per feature with that feature taken
    from its partner, all in one pass; the metric is then taken per variant.
    """
    paired = permuted(df.select(key, label, *features), features, key, seed)
    names = ", ".join(f"'{f}'" for f in ("", *features))
    variants = paired.selectExpr("*", f"explode(array({names})) AS permuted").selectExpr(
        label, "permuted", *[f"if(permuted = '{f}', other_{f}, {f}) AS {f}" for f in features]
    )
    by_variant = ranking_metrics(score(model, variants, "score"), label, "score", ["permuted"])
    whole = "max(CASE WHEN permuted = '' THEN average_precision END) OVER (PARTITION BY 0)"
    losses = by_variant.selectExpr("permuted AS feature", f"{whole} - average_precision AS importance")
    return losses.filter("feature != ''").orderBy(F.desc_nulls_last("importance"), "feature")
