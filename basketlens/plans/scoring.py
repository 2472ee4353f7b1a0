"""Batch scoring: latest model, features, decisions, result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketlens.operators import actions, models
from basketlens.operators.churn import LEGACY_FEATURES
from basketlens.plans.training import LEGACY_EXPERIMENT, REGISTERED_MODEL
from basketlens.sources.layers import Layer
from basketlens.sources.registry import ModelRegistry


def batch_score(features: DataFrame, registry: ModelRegistry, name: str = REGISTERED_MODEL) -> DataFrame:
    """``churn_scores`` of all users under the latest registered model."""
    return actions.churn_scores(models.score(registry.load_latest(name), features))


def write_scores(scores: DataFrame, layer: Layer, top: int = 500) -> None:
    """Replace ``churn_scores``, then ``retention_targets`` from the written table."""
    layer.replace("churn_scores", scores)
    layer.replace("retention_targets", actions.retention_targets(layer.read("churn_scores"), top))


def legacy_predict(features: DataFrame, registry: ModelRegistry, experiment: str = LEGACY_EXPERIMENT) -> DataFrame:
    """``churn_predictions`` under the model of the experiment's last run."""
    model = registry.load_latest_run(experiment)
    return actions.churn_predictions(models.score(model, features.select("user_id", *LEGACY_FEATURES)))
