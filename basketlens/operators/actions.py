"""From churn probabilities to decisions: uplift, actions, targets, request answers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.sql import quoted
from basketlens.sources.keyed import KeyedTable

# Action names.
CALL, COUPON, NO_ACTION = "High Priority Call", "Send Email Coupon", "No Action"
REQUEST_CALL, REQUEST_COUPON, REQUEST_RETAIN = "Call Customer", "Send Coupon", "Retain"

SCORE_COLUMNS = [
    "user_id", "scoring_date", "churn_probability", "expected_uplift_value", "recommended_action", "traffic_source",
]


@dataclass(frozen=True)
class UpliftModel:
    """Value of keeping a customer, chance that an offer keeps one, cost of the offer."""

    lifetime_value: float = 150.0
    winback_rate: float = 0.30
    cost: float = 10.0
    call_uplift: float = 20.0
    high_risk: float = 0.7


def expected_uplift(probability: str, model: UpliftModel = UpliftModel()) -> str:
    return f"({probability} * {model.lifetime_value}D * {model.winback_rate}D - {model.cost}D)"


def batch_action(probability: str, uplift: str, model: UpliftModel = UpliftModel()) -> str:
    """The first rule that holds: call, coupon, nothing."""
    return (
        f"CASE WHEN {uplift} > {model.call_uplift}D AND {probability} > {model.high_risk}D THEN {quoted(CALL)} "
        f"WHEN {uplift} > 0 THEN {quoted(COUPON)} ELSE {quoted(NO_ACTION)} END"
    )


def churn_scores(scored: DataFrame, model: UpliftModel = UpliftModel()) -> DataFrame:
    """Scored users with expected uplift and recommended action."""
    return (
        scored.selectExpr("*", f"{expected_uplift('churn_probability', model)} AS expected_uplift_value")
        .selectExpr("*", f"{batch_action('churn_probability', 'expected_uplift_value', model)} AS recommended_action")
        .select(*SCORE_COLUMNS)
    )


def actionable(scores: DataFrame) -> DataFrame:
    return scores.filter(f"recommended_action != {quoted(NO_ACTION)}")


def by_uplift() -> list:
    """Best uplift first; ties go to the lower user id."""
    return [F.desc_nulls_last("expected_uplift_value"), F.asc("user_id")]


def retention_targets(scores: DataFrame, top: int = 500) -> DataFrame:
    """The ``top`` actionable users by expected uplift."""
    return actionable(scores).orderBy(*by_uplift()).limit(top)


def churn_predictions(scored: DataFrame) -> DataFrame:
    """Bare predictions with the time they were made."""
    return scored.selectExpr("user_id", "churn_probability", "current_timestamp() AS prediction_ts")


def request_action(probability: str) -> str:
    """The rule for single requests; its limits differ from the batch rule."""
    return (
        f"CASE WHEN {probability} > 0.8D THEN {quoted(REQUEST_CALL)} "
        f"WHEN {probability} < 0.5D THEN {quoted(REQUEST_RETAIN)} "
        f"WHEN {probability} IS NOT NULL THEN {quoted(REQUEST_COUPON)} END"
    )


def is_high_risk(probability: str, limit: float = 0.7) -> str:
    return f"({probability} > {limit}D)"


def asked_only(requests: DataFrame, features: DataFrame | KeyedTable) -> DataFrame:
    """The features of users that are asked for: scoring then costs what is asked, not what is stored.

    Of a keyed table only the files that can hold a user asked for are read.
    """
    if isinstance(features, KeyedTable):
        return features.lookup(requests)
    asked = requests.select("user_id").filter("user_id IS NOT NULL").distinct()
    return features.join(asked, "user_id", "left_semi")


def answer_requests(requests: DataFrame, scored: DataFrame) -> DataFrame:
    """Answer each request with its user's score; unknown users are ``not_found``.

    Works alike for a batch and for a stream of requests: a left join to a static
    table keeps no state.
    """
    known = scored.select("user_id", "churn_probability").filter("user_id IS NOT NULL")
    return requests.join(known, "user_id", "left").selectExpr(
        *requests.columns,
        "CASE WHEN churn_probability IS NULL THEN 'not_found' ELSE 'ok' END AS status",
        "churn_probability",
        f"{is_high_risk('churn_probability')} AS is_high_risk",
        f"{request_action('churn_probability')} AS recommended_action",
    )
