"""Training runs: split, fit, evaluate on the held-out part, log and register."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from basketlens.operators import models, prep
from basketlens.operators.churn import CATEGORICAL_FEATURES, LEGACY_FEATURES, TARGET
from basketlens.operators.metrics import metric_rows
from basketlens.operators.models import BoostedParams, LEGACY_PARAMS, WEIGHT
from basketlens.operators.smote import smote
from basketlens.session import shared_dir
from basketlens.sources.registry import ModelRegistry

EXPERIMENT, LEGACY_EXPERIMENT = "churn", "churn_legacy"
REGISTERED_MODEL = "churn_boosted"


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    params: dict[str, object]
    metrics: DataFrame
    test: DataFrame

    def log(self, registry: ModelRegistry, experiment: str, run_name: str) -> str:
        return registry.log_run(experiment, run_name, self.params, self.metrics, self.model)


def _cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder. Fitting runs many jobs over the same rows:
    they start from stored rows, not from the plan that made them, also when an
    executor is lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def _evaluated(model: PipelineModel, test: DataFrame, params: dict[str, object]) -> Trained:
    """Score the held-out rows once and read the metrics out (seven numbers)."""
    scored = _cut(models.score(model, test).select(TARGET, "churn_probability"))
    found = metric_rows(scored, TARGET, "churn_probability").collect()
    metrics = test.sparkSession.createDataFrame(found, "metric string, value double")
    return Trained(model, params, metrics, test)


def train_baseline(train_set: DataFrame, seed: int = 42) -> Trained:
    """Balanced logistic regression on a stratified 80/20 split."""
    split = _cut(prep.stratified_split(train_set, TARGET, seed=seed))
    train = _cut(prep.with_balanced_weight(split.filter("not is_test"), TARGET, WEIGHT))
    fitted = models.baseline_pipeline(train.count()).fit(train)
    last = fitted.stages[-1]
    params = {"model": type(last).__name__, "weight": last.getWeightCol(), "max_iter": last.getMaxIter(), "reg_param": last.getRegParam()}
    return _evaluated(fitted, split.filter("is_test").drop("is_test"), params)


def train_boosted(train_set: DataFrame, params: BoostedParams = BoostedParams(), seed: int = 42) -> Trained:
    """Boosted trees on a stratified 80/20 split."""
    split = _cut(prep.stratified_split(train_set, TARGET, seed=seed))
    train = models.with_positive_weight(split.filter("not is_test"), params.positive_weight)
    levels = prep.category_levels(train, CATEGORICAL_FEATURES)
    fitted = models.boosted_pipeline(levels, params).fit(train)
    return _evaluated(fitted, split.filter("is_test").drop("is_test"), asdict(params))


def train_legacy(features: DataFrame, params: BoostedParams = LEGACY_PARAMS, seed: int = 42) -> Trained:
    """First-generation model: unstratified split, oversampled training part, boosted trees."""
    split = _cut(prep.plain_split(features, seed=seed))
    balanced = smote(split.filter("not is_test"), LEGACY_FEATURES, TARGET, seed=seed)
    train = _cut(models.with_positive_weight(balanced, params.positive_weight))
    fitted = models.legacy_pipeline(params).fit(train)
    return _evaluated(fitted, split.filter("is_test").drop("is_test"), asdict(params))
