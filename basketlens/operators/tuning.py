"""Random search over boosted-tree parameters by successive halving, with stratified cross-validation.

Trials start on a small share of the rows with few trees. After each rung the better part
goes on with more of both; the last rung has all rows and all trees. A rung's rows are those
of the rung before and more, and a row's fold stays. Besides the trees, the medians for
missing numbers are learned from rows, and those only from outside of the held-out fold.
"""

from __future__ import annotations

import math
import random
from dataclasses import asdict, dataclass, replace
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame

from basketlens.functions.sql import named
from basketlens.operators.churn import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET
from basketlens.operators.metrics import ranking_metrics
from basketlens.operators.models import BoostedParams, boosted_classifier, score, tree_features
from basketlens.operators.prep import category_levels, stratified_folds
from basketlens.session import shared_dir
from basketlens.sources.registry import ModelRegistry


@dataclass(frozen=True)
class SearchSpace:
    """Log-uniform rate and gain, uniform depth and positive weight.

    Penalties and the growth policy of other tree libraries have no counterpart in Spark.
    """

    depth: tuple[int, int] = (1, 9)
    rate: tuple[float, float] = (1e-8, 1.0)
    min_info_gain: tuple[float, float] = (1e-8, 1.0)
    positive_weight: tuple[float, float] = (1.0, 10.0)

    def draw(self, rng: random.Random, trees: int, seed: int) -> BoostedParams:
        def log_uniform(bounds: tuple[float, float]) -> float:
            return math.exp(rng.uniform(math.log(bounds[0]), math.log(bounds[1])))

        return BoostedParams(
            trees=trees, depth=rng.randint(*self.depth), rate=log_uniform(self.rate),
            min_info_gain=log_uniform(self.min_info_gain), positive_weight=rng.uniform(*self.positive_weight), seed=seed,
        )


@dataclass(frozen=True)
class Tuned:
    best: BoostedParams
    best_score: float
    trials: DataFrame
    model: PipelineModel

    def log(self, registry: ModelRegistry, experiment: str) -> str:
        """The best trial's parameters and score as a run, with its model; returns the run's id."""
        metrics = self.trials.sparkSession.createDataFrame(
            [("mean_average_precision", self.best_score)], "metric string, value double"
        )
        return registry.log_run(experiment, "tuned", asdict(self.best), metrics, self.model)


@dataclass(frozen=True)
class Rung:
    number: int
    share: float
    trees: int


def rungs_of(rungs: int, keep: float, trees: int) -> list[Rung]:
    """Shares of the rows that grow by 1 / keep up to all, and trees in proportion (2 at least)."""
    shares = [keep ** (rungs - 1 - r) for r in range(rungs)]
    return [Rung(r, share, min(trees, max(2, math.ceil(trees * share)))) for r, share in enumerate(shares)]


def survivors(scores: dict[int, float | None], keep: float) -> list[int]:
    """The better part of the trials, one at least, best first; ties go to the earlier trial.

    Trials without a score (one class in a fold) go last. Where none has one, all go on.
    """
    ranked = sorted(scores, key=lambda t: (scores[t] is None, -(scores[t] or 0.0), t))
    if not ranked or scores[ranked[0]] is None:
        return sorted(scores)
    return ranked[: max(1, math.ceil(len(ranked) * keep))]


_TRIAL = "trial int, depth int, rate double, min_info_gain double, positive_weight double"
_RESULT = f"{_TRIAL}, rung int, row_share double, trees int, fold_scores array<double>, mean_average_precision double, stopped string"


def tune_boosted(
    train: DataFrame, trials: int = 20, folds: int = 3, trees: int = 10, seed: int = 42, parallelism: int = 8,
    space: SearchSpace = SearchSpace(), target: str = TARGET, key: str = "user_id", rungs: int = 3, keep: float = 1 / 3,
) -> Tuned:
    """Maximize the mean average precision over stratified folds; one rung is a plain random search.

    The rows of a rung are encoded once per fold and checkpointed; fits of its trials start
    from those, several at a time, and the held-out rows of all of them are scored and ranked
    in one job. ``trials`` of the result has a row per trial: the last rung that it saw, its
    scores there and why it stopped.
    """
    spark = train.sparkSession
    shared_dir(spark)
    rng = random.Random(seed)
    drawn = [space.draw(rng, trees, seed) for _ in range(trials)]
    levels = category_levels(train, CATEGORICAL_FEATURES)
    place = f"pmod(xxhash64({key}, {seed}), 1000000) / 1000000D AS __place"
    folded = stratified_folds(train, target, key, folds, seed).selectExpr("*", place).checkpoint()
    weights = [f"CASE WHEN {target} = 1 THEN {p.positive_weight}D ELSE 1D END AS w_{i}" for i, p in enumerate(drawn)]

    def encoder(rows: DataFrame) -> PipelineModel:
        return Pipeline(stages=tree_features(levels, NUMERIC_FEATURES)).fit(rows)

    def encoded(rung: Rung, fold: int, alive: list[int]) -> tuple[DataFrame, DataFrame]:
        """Training and held-out rows of a fold; medians come from the training rows."""
        rows = folded.filter(f"__place < {rung.share}D")
        known = rows.filter(f"fold != {fold}")
        made = encoder(known).transform(rows).selectExpr(target, "features", "fold", *[weights[t] for t in alive]).checkpoint()
        return made.filter(f"fold != {fold}"), made.filter(f"fold = {fold}").select(target, "features")

    def held_out(job: tuple[Rung, int, int, tuple[DataFrame, DataFrame]]) -> DataFrame:
        rung, fold, trial, (known, rows) = job
        model = boosted_classifier(replace(drawn[trial], trees=rung.trees), target, f"w_{trial}").fit(known)
        return score(model, rows, "score").selectExpr(target, "score", f"{trial} AS trial", f"{fold} AS fold")

    found: dict[int, tuple] = {}
    alive = list(range(trials))
    for rung in rungs_of(rungs, keep, trees):
        with ThreadPool(parallelism) as pool:
            data = pool.map(inheritable_thread_target(spark)(lambda fold: encoded(rung, fold, alive)), range(folds))
            jobs = [(rung, fold, trial, data[fold]) for trial in alive for fold in range(folds)]
            parts = pool.map(inheritable_thread_target(spark)(held_out), jobs, chunksize=1)
        ranked = ranking_metrics(reduce(DataFrame.unionByName, parts), target, "score", ["trial", "fold"])
        per_trial = ranked.groupBy("trial").agg(
            *named(
                fold_scores="transform(array_sort(collect_list(struct(fold, average_precision))), f -> f.average_precision)",
                mean="avg(average_precision)",
            )
        )
        scores = {r["trial"]: (r["fold_scores"], r["mean"]) for r in per_trial.collect()}
        means = {t: scores[t][1] for t in alive}
        last = rung.number == rungs - 1
        going = survivors(means, 0.0 if last else keep)[: 1 if last else None]
        for t in alive:
            why = None if t in going else f"behind {len(going)} of {len(alive)} in rung {rung.number}"
            found[t] = (rung.number, rung.share, rung.trees, *scores[t], why)
        alive = sorted(going)
    best = alive[0]
    rows = [(i, p.depth, p.rate, p.min_info_gain, p.positive_weight, *found[i]) for i, p in enumerate(drawn)]
    encode = encoder(folded)
    whole = encode.transform(folded).selectExpr(target, "features", weights[best]).checkpoint()
    model = PipelineModel([*encode.stages, boosted_classifier(drawn[best], target, f"w_{best}").fit(whole)])
    return Tuned(drawn[best], found[best][4], spark.createDataFrame(rows, _RESULT), model)
