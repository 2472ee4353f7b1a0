"""Dashboard queries over ``churn_scores``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.sql import named, quoted
from basketlens.operators.actions import NO_ACTION, actionable, by_uplift, is_high_risk


def risk_kpis(scores: DataFrame) -> DataFrame:
    """Revenue at risk, number of high-risk users and mean risk, in one pass."""
    return scores.agg(
        *named(
            revenue_at_risk=f"sum(CASE WHEN recommended_action != {quoted(NO_ACTION)} THEN expected_uplift_value END)",
            high_risk_users=f"count_if({is_high_risk('churn_probability')})",
            avg_churn_probability="avg(churn_probability)",
        )
    )


def risk_histogram(scores: DataFrame, buckets_per_unit: int = 10) -> DataFrame:
    bucket = f"floor(churn_probability * {buckets_per_unit}) / {float(buckets_per_unit)}D"
    return scores.selectExpr(f"{bucket} AS risk_bucket").groupBy("risk_bucket").agg(*named(users="count(1)")).orderBy("risk_bucket")


def risk_by_source(scores: DataFrame) -> DataFrame:
    means = scores.groupBy("traffic_source").agg(*named(avg_risk="avg(churn_probability)"))
    return means.orderBy(F.desc_nulls_last("avg_risk"))


def target_list(scores: DataFrame, users: DataFrame) -> DataFrame:
    """Who to contact: actionable users with their e-mail, best uplift first."""
    return (
        actionable(scores)
        .join(users.select("user_id", "email"), "user_id", "left")
        .select("user_id", "email", "churn_probability", "expected_uplift_value", "recommended_action")
        .orderBy(*by_uplift())
    )
