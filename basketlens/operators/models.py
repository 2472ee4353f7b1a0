"""Churn models as Spark ML pipelines: linear baseline and boosted trees."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import (
    ElementwiseProduct, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.selection import exact_medians
from basketlens.functions.sql import quoted
from basketlens.operators.churn import CATEGORICAL_FEATURES, LEGACY_FEATURES, NUMERIC_FEATURES, TARGET

WEIGHT = "weight"


@dataclass(frozen=True)
class BoostedParams:
    """Boosted trees. The defaults are the tuned values; ``min_info_gain`` is the
    nearest there is to a minimum loss reduction. Spark's trees have no L1/L2 terms."""

    trees: int = 200
    depth: int = 9
    rate: float = 0.82
    min_info_gain: float = 0.0056
    positive_weight: float = 1.008
    seed: int = 42


# The first-generation model.
LEGACY_PARAMS = BoostedParams(trees=100, depth=4, rate=0.1, min_info_gain=0.0, positive_weight=1.0)


def _cast_stage(numeric: Sequence[str]) -> SQLTransformer:
    casts = ", ".join(f"CAST(`{c}` AS DOUBLE) AS num_{c}" for c in numeric)
    return SQLTransformer(statement=f"SELECT *, {casts} FROM __THIS__")


class MedianFill(Estimator):
    """Fitted, fills NULL and NaN of the ``num_`` columns with their exact medians, as ``imp_`` columns.

    The fitted stage is plain SQL with the medians in it, so models are saved as before.
    """

    def __init__(self, numeric: Sequence[str]) -> None:
        super().__init__()
        self.numeric = list(numeric)

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        found = exact_medians(dataset, {c: f"num_{c}" for c in self.numeric})
        empty = [c for c, median in found.items() if median is None]
        if empty:
            raise ValueError(f"no values to take a median of in {empty}")
        known = "nanvl(num_{0}, CAST(NULL AS DOUBLE))"
        fills = ", ".join(f"coalesce({known.format(c)}, CAST('{found[c]!r}' AS DOUBLE)) AS imp_{c}" for c in self.numeric)
        return SQLTransformer(statement=f"SELECT *, {fills} FROM __THIS__")


def dummy_stage(levels: dict[str, list[str]]) -> tuple[SQLTransformer, list[str]]:
    """0/1 columns for all but the first level of each column, fixed at training time.

    The level list is part of the saved model: at scoring, unknown values give
    zeros and the base level stays the same whatever the new data holds.
    """
    names, parts = [], []
    for column, values in levels.items():
        for i, value in enumerate(values[1:], start=1):
            names.append(f"dummy_{column}_{i}")
            parts.append(f"CAST(`{column}` <=> {quoted(value)} AS DOUBLE) AS {names[-1]}")
    selected = "".join(f", {p}" for p in parts)
    return SQLTransformer(statement=f"SELECT *{selected} FROM __THIS__"), names


def onehot_stages(categorical: Sequence[str]) -> tuple[list, list[str]]:
    """Fill NULLs with 'missing' and one-hot encode; unknown values give all zeros."""
    fills = ", ".join(f"coalesce(`{c}`, 'missing') AS cat_{c}" for c in categorical)
    indexer = StringIndexer(
        inputCols=[f"cat_{c}" for c in categorical], outputCols=[f"idx_{c}" for c in categorical],
        handleInvalid="keep", stringOrderType="alphabetAsc",
    )
    encoder = OneHotEncoder(
        inputCols=[f"idx_{c}" for c in categorical], outputCols=[f"hot_{c}" for c in categorical], dropLast=True
    )
    return [SQLTransformer(statement=f"SELECT *, {fills} FROM __THIS__"), indexer, encoder], encoder.getOutputCols()


def baseline_pipeline(
    rows: int, numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES,
    target: str = TARGET, max_iter: int = 1000,
) -> Pipeline:
    """Median-imputed, standardized numbers and one-hot categories into a balanced
    logistic regression.

    ``rows`` is the number of training rows: it sets the penalty 1/rows that equals
    an L2 term with C = 1 (balanced weights sum to the row count), and turns the
    scaler's sample deviation into the population one.
    """
    numbers = [
        VectorAssembler(inputCols=[f"imp_{c}" for c in numeric], outputCol="numbers"),
        StandardScaler(inputCol="numbers", outputCol="sample_scaled", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="sample_scaled", outputCol="scaled",
            scalingVec=Vectors.dense([(rows / max(rows - 1, 1)) ** 0.5] * len(numeric)),
        ),
    ]
    onehot, hot = onehot_stages(categorical)
    model = LogisticRegression(
        labelCol=target, weightCol=WEIGHT, maxIter=max_iter, regParam=1.0 / rows, elasticNetParam=0.0, standardization=False
    )
    assemble = VectorAssembler(inputCols=["scaled", *hot], outputCol="features")
    return Pipeline(stages=[_cast_stage(numeric), MedianFill(numeric), *numbers, *onehot, assemble, model])


def boosted_classifier(params: BoostedParams, target: str = TARGET, weight: str = WEIGHT) -> GBTClassifier:
    return GBTClassifier(
        labelCol=target, weightCol=weight, maxIter=params.trees, maxDepth=params.depth, stepSize=params.rate,
        minInfoGain=params.min_info_gain, seed=params.seed, checkpointInterval=10,
    )


def tree_features(levels: dict[str, list[str]], numeric: Sequence[str]) -> list:
    """Stages up to the ``features`` vector of the tree models."""
    stages = [_cast_stage(numeric), MedianFill(numeric)]
    names = [f"imp_{c}" for c in numeric]
    if levels:
        dummies, dummy_names = dummy_stage(levels)
        stages.append(dummies)
        names += dummy_names
    return [*stages, VectorAssembler(inputCols=names, outputCol="features")]


def boosted_pipeline(
    levels: dict[str, list[str]], params: BoostedParams = BoostedParams(), numeric: Sequence[str] = NUMERIC_FEATURES,
    target: str = TARGET,
) -> Pipeline:
    """Imputed numbers and first-dropped dummies into boosted trees."""
    return Pipeline(stages=[*tree_features(levels, numeric), boosted_classifier(params, target)])


def legacy_pipeline(params: BoostedParams = LEGACY_PARAMS, target: str = TARGET) -> Pipeline:
    return boosted_pipeline({}, params, LEGACY_FEATURES, target)


def with_positive_weight(df: DataFrame, positive_weight: float, target: str = TARGET, name: str = WEIGHT) -> DataFrame:
    return df.selectExpr("*", f"CASE WHEN {target} = 1 THEN {positive_weight}D ELSE 1D END AS {name}")


def score(model: Transformer, df: DataFrame, name: str = "churn_probability") -> DataFrame:
    """Add the probability of class 1; the model's helper columns are left out."""
    scored = model.transform(df)
    return scored.select(*df.columns, F.element_at(vector_to_array("probability"), 2).alias(name))


def linear_score(weights: dict[str, float], intercept: float) -> str:
    """Logistic of a known linear form over columns."""
    z = " + ".join([f"{intercept}D", *[f"CAST({name} AS DOUBLE) * {weight}D" for name, weight in weights.items()]])
    return f"(1D / (1D + exp(-({z}))))"


def feature_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """Names of the slots of the ``features`` vector, from its metadata."""
    attrs = model.transform(df.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for group in attrs.values() for a in group)
    return [name for _, name in slots]
