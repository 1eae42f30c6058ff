"""Hyper-parameter tuning (H1-H9) with Spark ML's tuning classes.

The search (H8) proposes parameters adaptively (``operators/search.py``) and fits a batch of them side by side; its
evaluator first re-thresholds the class-1 probability, then scores weighted F1. Validation rows come from a key hash,
so that results do not depend on how the input is partitioned.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Estimator
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.param import Param, Params
from pyspark.ml.tuning import (
    CrossValidator,
    CrossValidatorModel,
    ParamGridBuilder,
    TrainValidationSplit,
    TrainValidationSplitModel,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.functions.scalar import REORDER_THRESHOLD, above, positive_probability
from trolley.operators.search import Space, Trial, canonical, parzen_search, side_by_side

# The reference's search space (quniform / uniform bounds) and its number of trials.
SEARCH_SPACE = {
    "maxDepth": ("quniform", 10, 20, 1),
    "numLeaves": ("quniform", 32, 78, 4),
    "baggingFraction": ("uniform", 0.6, 1.0),
    "featureFraction": ("uniform", 0.6, 1.0),
    "learningRate": ("uniform", 0.01, 0.1),
}
SEARCH_TRIALS = 25
SEARCH_ROUNDS = 50
# The parameter set the reference reports from its search, and the rounds of its refit.
BEST_PARAMS = {"baggingFraction": 0.741, "featureFraction": 0.943, "learningRate": 0.013, "maxDepth": 18, "numLeaves": 72}
REFIT_ROUNDS = 100


def grid(est: Params, values: Mapping[str, Sequence[Any]]) -> list[dict]:
    """H1: a parameter grid from {param name: candidate values}."""
    b = ParamGridBuilder()
    for name, vals in values.items():
        b = b.addGrid(est.getParam(name), list(vals))
    return b.build()


def cross_validate(
    est: Estimator,
    param_maps: list[dict],
    evaluator: Evaluator,
    folds: int = 3,
    seed: int | None = None,
    parallelism: int = 1,
    fold_col: str = "",
) -> CrossValidator:
    """H2-H4: a CrossValidator (refits the best map on all rows). ``fold_col`` gives reproducible folds."""
    cv = CrossValidator(
        estimator=est,
        estimatorParamMaps=param_maps,
        evaluator=evaluator,
        numFolds=folds,
        parallelism=parallelism,
    )
    if seed is not None:
        cv.setSeed(seed)
    if fold_col:
        cv.setFoldCol(fold_col)
    return cv


class KeyedTrainValidationSplit(TrainValidationSplit):
    """H5: a TrainValidationSplit whose validation rows are those of a key hash, in a layout of their own.

    ``randomSplit`` and bagging depend on the partitions of the input; here every layout of the same rows gives the same
    models. The best parameter map is fit again on all rows.
    """

    keys: tuple[str, ...] = ()

    def keyed(self, *keys: str) -> KeyedTrainValidationSplit:
        self.keys = keys
        return self

    def _fit(self, dataset: DataFrame) -> TrainValidationSplitModel:
        from trolley.operators import models, splits

        est, maps, judge = self.getEstimator(), self.getEstimatorParamMaps(), self.getEvaluator()
        share = self.getTrainRatio()
        parts = splits.split(dataset, [share, 1.0 - share], seed=self.getSeed(), keys=self.keys)
        train, held = (canonical(p, self.keys) for p in parts)
        with models.persisted(train), models.persisted(held):

            def job(m):
                model = est.fit(train, m)
                return model, float(judge.evaluate(model.transform(held, m)))

            got = side_by_side([lambda m=m: job(m) for m in maps], self.getParallelism(), dataset.sparkSession)
        scores = [x for _, x in got]
        best = (max if judge.isLargerBetter() else min)(range(len(scores)), key=scores.__getitem__)
        sub = [m for m, _ in got] if self.getCollectSubModels() else None
        model = est.fit(canonical(dataset, self.keys), maps[best])
        return self._copyValues(TrainValidationSplitModel(model, scores, sub))


def train_validation(
    est: Estimator,
    param_maps: list[dict],
    evaluator: Evaluator,
    ratio: float = 0.75,
    seed: int = 0,
    parallelism: int = 1,
    keys: Sequence[str] = (),
) -> TrainValidationSplit:
    """H5: a TrainValidationSplit; with ``keys`` its split is a key hash, without them Spark's ``randomSplit``."""
    kind = KeyedTrainValidationSplit if keys else TrainValidationSplit
    tvs = kind(
        estimator=est, estimatorParamMaps=param_maps, evaluator=evaluator, trainRatio=ratio, seed=seed,
        parallelism=parallelism,
    )
    return tvs.keyed(*keys) if keys else tvs


def tuning_results(model, spark: SparkSession | None = None) -> DataFrame:
    """H6: one row per parameter map: ``params`` (name=value, sorted), ``metric``, ``is_best``."""
    spark = spark or SparkSession.getActiveSession()
    maps = model.getEstimatorParamMaps()
    metrics = model.avgMetrics if isinstance(model, CrossValidatorModel) else model.validationMetrics
    larger = model.getEvaluator().isLargerBetter()
    best = max(metrics) if larger else min(metrics)
    rows = []
    for m, v in zip(maps, metrics):
        desc = ", ".join(f"{p.name}={m[p]}" for p in sorted(m, key=lambda p: p.name))
        rows.append((desc, float(v), bool(v == best)))
    return spark.createDataFrame(rows, "params string, metric double, is_best boolean")


class ThresholdF1Evaluator(Evaluator):
    """H8: weighted F1 after labelling rows with class-1 probability > ``threshold``."""

    def __init__(self, label: str = "reordered", threshold: float = REORDER_THRESHOLD, probability: str = "probability"):
        super().__init__()
        self.label = label
        self.threshold = float(threshold)
        self.probability = probability

    def _evaluate(self, dataset: DataFrame) -> float:
        relabelled = dataset.withColumn(
            "prediction", above(positive_probability(self.probability), self.threshold, "double")
        )
        ev = MulticlassClassificationEvaluator(labelCol=self.label, predictionCol="prediction", metricName="f1")
        return float(ev.evaluate(relabelled))

    def isLargerBetter(self) -> bool:
        return True

    def copy(self, extra=None):
        return ThresholdF1Evaluator(self.label, self.threshold, self.probability)


def draw_params(space: Mapping[str, tuple] = SEARCH_SPACE, n: int = SEARCH_TRIALS, seed: int = 2021) -> list[dict]:
    """H8: ``n`` seeded random draws from a (quniform/uniform) search space."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        d = {}
        for name, spec in space.items():
            kind, lo, hi = spec[0], spec[1], spec[2]
            if kind == "quniform":
                q = spec[3]
                d[name] = round(rng.uniform(lo, hi) / q) * q
            else:
                d[name] = rng.uniform(lo, hi)
        out.append(d)
    return out


def gbt_param_maps(est, draws: Sequence[Mapping[str, Any]], rows: int, rounds: int = SEARCH_ROUNDS) -> list[dict]:
    """Turn drawn boosting parameters into GBTClassifier param maps (translated as in ``models.gbt``)."""
    from trolley.operators.models import translate_gbt

    maps = []
    for d in draws:
        kw = translate_gbt({"maxIter": rounds, **d}, rows)
        maps.append({est.getParam(k): v for k, v in kw.items()})
    return maps


def search(
    est,
    train: DataFrame,
    label: str = "reordered",
    draws: Sequence[Mapping[str, Any]] | None = None,
    threshold: float = REORDER_THRESHOLD,
    rounds: int = SEARCH_ROUNDS,
    ratio: float = 0.8,
    seed: int = 2021,
    parallelism: int = 4,
    keys: Sequence[str] = (),
):
    """H8 by seeded draws: evaluate every given parameter set on a validation split with threshold-aware F1.

    Returns the fitted TrainValidationSplitModel (``bestModel`` is refit on all of ``train``).
    """
    draws = list(draws) if draws is not None else draw_params()
    maps = gbt_param_maps(est, draws, train.count(), rounds)
    tvs = train_validation(est, maps, ThresholdF1Evaluator(label, threshold), ratio=ratio, seed=seed, parallelism=parallelism, keys=keys)
    return tvs.fit(train)


@dataclass(frozen=True)
class SearchResult:
    """H8: the scored trials; ``best`` has the largest score (the first of equal ones)."""

    trials: list[Trial]
    rows: int  # that each trial was fit on

    @property
    def best(self) -> Trial:
        return max(self.trials, key=lambda t: (t.score, -t.number))

    def table(self, spark: SparkSession) -> DataFrame:
        """One row a trial: (trial, params, metric, is_best)."""
        rows = []
        for t in self.trials:
            desc = ", ".join(f"{k}={t.params[k]!r}" for k in sorted(t.params))
            rows.append((t.number, desc, t.score, t.number == self.best.number))
        return spark.createDataFrame(rows, "trial int, params string, metric double, is_best boolean")


def adaptive_search(
    train: DataFrame,
    keys: Sequence[str],
    label: str = "reordered",
    space: Space = SEARCH_SPACE,
    trials: int = SEARCH_TRIALS,
    rounds: int = SEARCH_ROUNDS,
    threshold: float = REORDER_THRESHOLD,
    ratio: float = 0.8,
    seed: int = 2024,
    parallelism: int = 8,
    **options: Any,
) -> SearchResult:
    """H8: adaptive search of boosting parameters on a key-hash validation part, scored by F1 at the threshold.

    ``options`` go to ``parzen_search`` (``startup``, ``batch``). ``seed`` must not be that of an earlier split of the
    same rows by the same keys.
    """
    from trolley.operators import models, splits

    spark = train.sparkSession
    narrow = train.select(*keys, "features", label)
    parts = splits.split(narrow, [ratio, 1.0 - ratio], seed=seed, keys=keys)
    fit_rows, held = (canonical(p, keys) for p in parts)
    judge = ThresholdF1Evaluator(label, threshold)
    with models.persisted(held):
        # All trials have one seed, so they share one binned copy of the rows.
        any_trial = models.gbt(label, seed=seed)
        with models.persisted(fit_rows):
            models.check_binary(fit_rows, label)
            n = fit_rows.count()
            if not n or not held.limit(1).count():
                raise ValueError("a part of the split is empty: were the rows split by the same keys and seed before?")
            data = any_trial.bin_rows(fit_rows, n)
            data.blocks.count()

        def score(params: dict[str, float]) -> float:
            est = models.gbt(label, rows=n, numIterations=rounds, seed=seed, checkpointInterval=-1, **params)
            return judge.evaluate(est.fit_binned(data).transform(held))

        def scores(batch: list[dict[str, float]]) -> list[float]:
            return side_by_side([lambda p=p: score(p) for p in batch], parallelism, spark)

        try:
            return SearchResult(parzen_search(scores, space, trials, seed, **options), n)
        finally:
            data.blocks.unpersist()


def with_fold(df: DataFrame, folds: int, seed: int, keys: Sequence[str], out: str = "fold") -> DataFrame:
    """Reproducible fold ids from a key hash (for ``CrossValidator.setFoldCol``)."""
    from trolley.operators.splits import key_slot

    return df.withColumn(out, F.pmod(key_slot(keys, seed), F.lit(folds)).cast("int"))
