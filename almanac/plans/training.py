"""Grid search over expanding folds, the return classifier and the stacked regressor."""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from almanac.operators import labels, metrics, series
from almanac.operators.resample import smote
from almanac.schemas import CLASSIFIER_FEATURES, REGRESSOR_FEATURES
from almanac.session import settle

# The full search grids. Leaf penalties have no counterpart in Spark's trees.
FULL_CLASSIFIER_GRID = {
    "maxIter": [50, 100, 180, 250],
    "maxDepth": [3, 4, 5, 6],
    "stepSize": [0.01, 0.03, 0.04, 0.05],
    "subsamplingRate": [0.2, 0.3, 0.4, 0.5],
    "featureSubsetStrategy": ["0.05", "0.06", "0.07", "0.1"],
}
FULL_REGRESSOR_GRID = {
    "maxIter": [100, 180, 250],
    "maxDepth": [3, 4, 5],
    "stepSize": [0.01, 0.04, 0.1],
    "subsamplingRate": [0.3, 0.5, 0.7],
    "featureSubsetStrategy": ["0.06", "0.1", "0.3"],
}
SMALL_CLASSIFIER_GRID = {"maxIter": [5], "maxDepth": [3], "stepSize": [0.05, 0.1]}
SMALL_REGRESSOR_GRID = {"maxIter": [10], "maxDepth": [3], "stepSize": [0.04, 0.1]}
SEED = 42
PARALLEL_FITS = 6
# Shares of a candidate's trees after which a halving search compares, and the share that goes on.
RUNGS = (1 / 9, 1 / 3, 1.0)
KEPT_SHARE = 1 / 3

Fold = tuple[DataFrame, DataFrame]
Build = Callable[[dict], Estimator]
Score = Callable[[DataFrame], DataFrame]


@dataclass
class Search:
    """Outcome of a grid search: the score table, the best settings and the model refitted with them."""

    scores: list[dict]
    best: dict
    model: PipelineModel | None = None
    report: DataFrame | None = None
    evaluation: Row | None = None
    extra: dict = field(default_factory=dict)


def in_threads(work: Callable, tasks: list) -> list:
    """Runs independent Spark jobs side by side from the driver."""
    with ThreadPool(min(PARALLEL_FITS, len(tasks))) as pool:
        return pool.map(inheritable_thread_target(SparkSession.active())(work), tasks)


def candidates(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def classifier(settings: dict, label: str = "label") -> Estimator:
    return OneVsRest(
        classifier=GBTClassifier(seed=SEED, **settings), featuresCol="features", labelCol=label,
        predictionCol="clf_predictions", parallelism=3,
    )


def regressor(settings: dict) -> Estimator:
    stages = [
        VectorAssembler(inputCols=REGRESSOR_FEATURES, outputCol="reg_features", handleInvalid="skip"),
        GBTRegressor(featuresCol="reg_features", labelCol="future_returns", predictionCol="prediction", seed=SEED, **settings),
    ]
    return Pipeline(stages=stages)


def _fold_scores(folds: list[Fold], build: Build, score: Score, tried: list[dict]) -> list[dict]:
    """Per candidate the mean of every score over the folds, and of the seconds that a fit took.

    The loop is over settings and folds only, a few at a time; every fit and every score is a distributed job.
    """
    def run(task: tuple[dict, Fold]) -> dict:
        settings, (train, test) = task
        start = time.perf_counter()
        model = build(settings).fit(train)
        seconds = time.perf_counter() - start
        return {**score(model.transform(test)).first().asDict(), "seconds": seconds}

    results = in_threads(run, [(settings, fold) for settings in tried for fold in folds])
    found = [results[i * len(folds):(i + 1) * len(folds)] for i in range(len(tried))]
    return [{name: _mean([r[name] for r in rows]) for name in rows[0]} for rows in found]


def _best_first(rows: list[dict], rank_by: str, larger_is_better: bool) -> list[dict]:
    """Rows with a score, the best first; equal ones keep their order."""
    known = [r for r in rows if r[rank_by] is not None]
    if not known:
        raise ValueError(f"no candidate could be scored by {rank_by}")
    return sorted(known, key=lambda r: -r[rank_by] if larger_is_better else r[rank_by])


def grid_search(
    folds: list[Fold], build: Build, grid: dict[str, list], score: Score, rank_by: str, larger_is_better: bool
) -> tuple[list[dict], dict]:
    """Mean score over the folds for every candidate, and the best candidate.

    `score` is any function from scored rows to a one-row frame.
    """
    tried = candidates(grid)
    rows = [{"settings": settings, **found} for settings, found in zip(tried, _fold_scores(folds, build, score, tried))]
    return rows, _best_first(rows, rank_by, larger_is_better)[0]["settings"]


def halving_search(
    folds: list[Fold], build: Build, grid: dict[str, list], score: Score, rank_by: str, larger_is_better: bool
) -> tuple[list[dict], dict]:
    """Like `grid_search`, by successive halving: every candidate is boosted a little, the best third goes on.

    A rung stops the boosting after a share of each candidate's own trees (RUNGS); the last one runs to the end. The
    rows hold every candidate of every rung: rung, trees, whether it went on (kept), its scores and seconds a fit.
    The best is the best of those that ran to the end.
    """
    left, rows = candidates(grid), []
    for rung, share in enumerate(RUNGS):
        tried = [{**settings, "maxIter": max(1, math.ceil(settings["maxIter"] * share))} for settings in left]
        found = _fold_scores(folds, build, score, tried)
        here = [
            {"settings": full, "rung": rung, "trees": short["maxIter"], **scores}
            for full, short, scores in zip(left, tried, found)
        ]
        ranked = _best_first(here, rank_by, larger_is_better)
        kept = ranked[: 1 if rung == len(RUNGS) - 1 else math.ceil(len(left) * KEPT_SHARE)]
        left = [r["settings"] for r in kept]
        rows += [{**r, "kept": r["settings"] in left} for r in here]
    return rows, left[0]


def _mean(values: list) -> float | None:
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


def carried(features: DataFrame, day: str = "time_published") -> DataFrame:
    """The feature table with missing features taken from the latest earlier day that has them.

    A day without words has no sentiment of its own, and keeps that of the day before. Only days before a
    feature's first value stay without it; training leaves those out.
    """
    earlier = W.orderBy(day).rowsBetween(W.unboundedPreceding, W.currentRow)
    known = [c for c in dict.fromkeys([*CLASSIFIER_FEATURES, *REGRESSOR_FEATURES]) if c in features.columns]
    return features.withColumns({c: F.last(F.col(f"`{c}`"), ignorenulls=True).over(earlier) for c in known})


def assembled(df: DataFrame, day: str) -> DataFrame:
    """(day, id, values, features, and the rest): rows with all classifier features present."""
    complete = df.na.drop(subset=CLASSIFIER_FEATURES)
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in CLASSIFIER_FEATURES])
    return complete.withColumns({"row_id": F.unix_date(day), "values": values}).withColumn(
        "features", array_to_vector("values")
    )


def resampled(train: DataFrame) -> DataFrame:
    """(row_id, label, features, is_synthetic) with classes of equal size."""
    balanced = smote(train, "row_id", "label", "values", fewer=True)
    return settle(balanced.withColumn("features", array_to_vector("values")))


def time_folds(df: DataFrame, order: str, count: int = series.FOLDS) -> list[tuple[DataFrame, DataFrame]]:
    placed = settle(series.expanding_folds(df, order, count))
    return [
        (placed.where(F.col("test_fold").isNull() | (F.col("test_fold") < i)), placed.where(F.col("test_fold") == i))
        for i in range(count)
    ]


def train_classifier(
    features: DataFrame, grid: dict[str, list], day: str = "time_published", strict: bool = True,
    search: Callable = grid_search,
) -> Search:
    """Labels, rebalances, searches, refits and reports on the last tenth of the days.

    `search` is `grid_search`, which tries every candidate to the end, or `halving_search`.

    With `strict`, class thresholds come from training days only and rebalancing happens inside each
    training fold. Without it both use all rows first, so the scores look better than they are.
    """
    features = carried(features, day)
    rows = series.with_target(series.trim_edges(features, day))
    split = settle(series.chronological_split(assembled(rows, day), day))
    train_rows = split.where("is_train")
    labelled = labels.label_returns(split, fit_on=train_rows if strict else series.with_target(features))
    labelled = settle(labelled.withColumn("label", F.col("return_class_encoded").cast("double")))
    train, held = labelled.where("is_train"), labelled.where(~F.col("is_train"))
    balanced = resampled(train)
    if strict:
        cut = time_folds(train, day)
        folds = list(zip(in_threads(resampled, [a for a, _ in cut]), [b for _, b in cut]))
    else:
        placed = balanced.withColumn(
            "row_order", F.row_number().over(W.orderBy("is_synthetic", "row_id", F.xxhash64("values")))
        )
        folds = time_folds(placed, "row_order")

    def score(df: DataFrame) -> DataFrame:
        return metrics.accuracy(df, "label", "clf_predictions")

    scores, best = search(folds, classifier, grid, score, "accuracy", True)
    model = Pipeline(stages=[classifier(best)]).fit(balanced)
    scored = model.transform(held)
    return Search(
        scores, best, model,
        report=metrics.class_report(scored, "label", "clf_predictions"),
        evaluation=score(scored).first(),
        extra={"labelled": labelled, "folds": folds},
    )


def with_classifier(features: DataFrame, model: PipelineModel, day: str = "time_published") -> DataFrame:
    """Adds clf_predictions by the given model."""
    return model.transform(assembled(features, day)).drop("features", "values", "row_id", "rawPrediction")


def out_of_fold(labelled: DataFrame, settings: dict, day: str = "time_published") -> DataFrame:
    """Adds clf_predictions by models that saw only earlier days; the head of the series has none and is left out."""
    def predicted(fold: tuple[DataFrame, DataFrame]) -> DataFrame:
        return classifier(settings).fit(resampled(fold[0])).transform(fold[1])

    parts = in_threads(predicted, time_folds(labelled, day))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.drop("features", "values", "row_id", "rawPrediction", "test_fold")


def regression_scores(df: DataFrame, day: str = "time_published") -> DataFrame:
    errors = metrics.regression_metrics(df, "future_returns", "prediction")
    change = metrics.direction_of_change(df, "future_returns", "prediction", day)
    return errors.withColumn("direction_of_change", change.scalar())


def train_regressor(
    features: DataFrame,
    clf: Search | PipelineModel,
    grid: dict[str, list],
    day: str = "time_published",
    strict: bool = True,
    search: Callable = grid_search,
) -> Search:
    """Searches for the lowest MAPE on the first nine tenths, refits, evaluates on the rest.

    With `strict` the stacked class prediction of a training day comes from a model that has not seen it. That
    needs the search that made the classifier; a loaded model predicts all days itself.
    """
    model = clf.model if isinstance(clf, Search) else clf
    scored = settle(with_classifier(series.with_target(carried(features, day)), model, day))
    split = settle(series.chronological_split(scored, day))
    train, held = split.where("is_train"), split.where(~F.col("is_train"))
    if strict and isinstance(clf, Search):
        train = out_of_fold(clf.extra["labelled"].where("is_train"), clf.best, day)
        first_held = held.agg(F.min(day)).scalar()
        train = settle(train.where(F.col(day) < first_held))
    folds = time_folds(train, day)
    scores, best = search(folds, regressor, grid, lambda df: regression_scores(df, day), "mape", False)
    model = regressor(best).fit(train)
    predicted = model.transform(held)
    level = metrics.direction_of_level(predicted, "future_returns", "prediction")
    evaluation = metrics.regression_metrics(predicted, "future_returns", "prediction").withColumn(
        "direction_of_level", level.scalar()
    )
    return Search(scores, best, model, evaluation=evaluation.first())
