"""Classifier metrics over a table with a 0/1 label and a score.

The ranking metrics group by score first (ties become one step) and then need
running counts in score order, which ``running_totals`` computes without a
one-task sort. The scored table is read once: what is kept of it are the counts
per distinct score, stored in the shared folder when the metric is asked for. A metric that is undefined for a one-class input is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from basketlens.functions.ordering import running_totals
from basketlens.functions.sql import named, ratio
from basketlens.session import shared_dir


def hard_label(score: str, threshold: float = 0.5) -> str:
    return f"CAST({score} > {threshold}D AS INT)"


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Confusion counts, accuracy, precision, recall and F1 in one row."""
    true, guess = f"{label} = 1", f"{score} > {threshold}D"
    counts = df.agg(
        *named(
            tp=f"count_if({true} AND {guess})",
            fp=f"count_if(NOT ({true}) AND {guess})",
            fn=f"count_if({true} AND NOT ({guess}))",
            tn=f"count_if(NOT ({true}) AND NOT ({guess}))",
        )
    )
    return counts.selectExpr(
        "tp AS true_positives",
        "fp AS false_positives",
        "fn AS false_negatives",
        "tn AS true_negatives",
        f"{ratio('(tp + tn)', '(tp + fp + fn + tn)')} AS accuracy",
        f"{ratio('tp', '(tp + fp)')} AS precision",
        f"{ratio('tp', '(tp + fn)')} AS recall",
        f"{ratio('(2 * tp)', '(2 * tp + fp + fn)')} AS f1_score",
    )


def _score_steps(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """Positives and negatives per distinct score, with counts down to that score."""
    steps = (
        df.filter(f"{score} IS NOT NULL AND {label} IS NOT NULL")
        .selectExpr(*by, f"CAST({score} AS DOUBLE) AS score", f"CAST({label} AS BIGINT) AS y")
        .groupBy(*by, "score")
        .agg(*named(pos="sum(y)", neg="sum(1 - y)"))
    )
    shared_dir(df.sparkSession)
    return running_totals(steps.checkpoint(), "score", {"tp": "pos", "fp": "neg"}, by, descending=True)


def ranking_metrics(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """One row (per ``by`` group): positives, negatives, prevalence, ROC AUC and average precision.

    AUC is the chance that a positive outranks a negative, ties counting half.
    Average precision adds precision times gained recall step by step, without
    interpolation; read it beside the prevalence, its value for a random ranker.
    """
    sums = _score_steps(df, label, score, by).groupBy(*by).agg(
        *named(
            positives="sum(pos)",
            negatives="sum(neg)",
            wins_twice="sum(CAST(neg AS DECIMAL(38, 0)) * (2 * tp - pos))",
            precision_sum=f"sum(pos * {ratio('tp', '(tp + fp)')})",
        )
    )
    pairs_twice = "(2D * CAST(positives AS DOUBLE) * CAST(negatives AS DOUBLE))"
    return sums.selectExpr(
        *by,
        "positives",
        "negatives",
        f"{ratio('positives', '(positives + negatives)')} AS prevalence",
        f"{ratio('wins_twice', pairs_twice)} AS roc_auc",
        f"{ratio('precision_sum', 'positives')} AS average_precision",
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return ranking_metrics(df, label, score).select("positives", "negatives", "roc_auc")


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return ranking_metrics(df, label, score).select("positives", "prevalence", "average_precision")


def metric_rows(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """All metrics of a scored table as (metric, value) rows."""
    wide = confusion(df, label, score, threshold).select("accuracy", "precision", "recall", "f1_score")
    ranked = ranking_metrics(df, label, score).select("prevalence", "roc_auc", "average_precision")

    def rows(one_row: DataFrame) -> DataFrame:
        pairs = ", ".join(f"'{c}', {c}" for c in one_row.columns)
        return one_row.selectExpr(f"stack({len(one_row.columns)}, {pairs}) AS (metric, value)")

    return rows(wide).unionByName(rows(ranked))
