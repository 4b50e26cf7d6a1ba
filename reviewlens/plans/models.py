"""Training, cross-validation and evaluation on hashed model frames."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack, contextmanager
from dataclasses import replace

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import (
    LinearSVC,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from reviewlens.operators.clusters import majority_labels, sparse_wssse
from reviewlens.operators.forest import can_grow, forest_accuracies
from reviewlens.operators.metrics import classification_metrics, metrics_report
from reviewlens.operators.perceptron import SparsePerceptron
from reviewlens.plans.features import FOLDS, ModelFrame, stored_as
from reviewlens.schema import HASH_FEATURES

# MLlib's own default seed depends on the process, so one is always given.
SEED = 12345

# Learner settings.
LEARNERS: dict[str, Callable[[], Estimator]] = {
    "naive_bayes": lambda: NaiveBayes(modelType="multinomial", smoothing=1.0),
    "kmeans": lambda: KMeans(k=2, maxIter=100, seed=SEED),
    "random_forest": lambda: RandomForestClassifier(
        impurity="gini", numTrees=10, maxDepth=10, maxBins=32, seed=SEED
    ),
    "linear_svc": lambda: LinearSVC(maxIter=10, regParam=0.5),
    "perceptron": lambda: SparsePerceptron(
        layers=[HASH_FEATURES, 2], blockSize=128, seed=12345, maxIter=400
    ),
}

# Parameters tried in cross-validation.
GRIDS: dict[str, dict[str, list]] = {
    "naive_bayes": {"smoothing": [0.0, 0.5, 1.0]},
    "kmeans": {"maxIter": [100, 400, 500]},
    "random_forest": {"maxDepth": [10, 12, 15], "numTrees": [10, 12, 15]},
}


@contextmanager
def kept(df: DataFrame):
    """Keep rows at hand while a fit iterates over them."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


@contextmanager
def training_rows(frame: ModelFrame) -> Iterator[DataFrame]:
    """(label, features, fold) of the training part, at hand while a fit iterates over them."""
    if frame.at_hand is not None:
        yield frame.at_hand
    else:
        with kept(frame.train.select("label", "features", "fold")) as rows:
            yield rows


def check_classes(train: DataFrame) -> None:
    """Fail with a plain message unless the training rows hold two classes."""
    if train.select("label").distinct().limit(2).count() < 2:
        raise ValueError("training rows must hold at least two label classes")


def param_grid(estimator: Estimator, values: dict[str, list]) -> list[dict]:
    """Cartesian product of parameter values of one estimator."""
    builder = ParamGridBuilder()
    for name, choices in values.items():
        builder.addGrid(estimator.getParam(name), choices)
    return builder.build()


def report_rows(df: DataFrame, model: str, variant: str, dataset: str) -> DataFrame:
    return df.select(
        F.lit(model).alias("model"),
        F.lit(variant).alias("variant"),
        F.lit(dataset).alias("dataset"),
        "metric",
        "value",
    )


def predict(model: Model, rows: DataFrame) -> DataFrame:
    """(label, prediction) with the prediction as a double, also for cluster ids."""
    predicted = model.transform(rows)
    return predicted.select("label", F.col("prediction").cast("double").alias("prediction"))


def _aligned(model: Model, train: DataFrame, predicted: DataFrame) -> DataFrame:
    """Cluster ids replaced by the majority label of the training rows in them."""
    names = majority_labels(predict(model, train))
    return predicted.join(names, "prediction", "left").select(
        "label", F.coalesce("aligned", "prediction").alias("prediction")
    )


def train_and_evaluate(
    name: str, frames: Sequence[ModelFrame], align: str | None = None
) -> DataFrame:
    """Metrics of one learner on the test part of each frame.

    Cluster ids stand as class labels as they are unless ``align="majority"``.
    For k-means the report also has the training cost.
    """
    if align not in (None, "majority"):
        raise ValueError("align must be None or 'majority'")
    reports = []
    for frame in frames:
        with training_rows(frame) as train:
            check_classes(train)
            model = LEARNERS[name]().fit(train)
        predicted = predict(model, frame.test)
        if name == "kmeans":
            rows = stored_as(frame.train.select("features"), ["features"], VectorUDT.sqlType())
            cost = sparse_wssse(rows, model.clusterCenters(), "features").select(
                F.lit("wssse").alias("metric"), F.col("wssse").alias("value")
            )
            reports.append(report_rows(cost, name, "plain", frame.dataset))
            if align:
                predicted = _aligned(model, frame.train, predicted)
        metrics = classification_metrics(predicted)
        reports.append(report_rows(metrics, name, "plain", frame.dataset))
    return metrics_report(reports)


def nb_train_eval(frames: Sequence[ModelFrame]) -> DataFrame:
    return train_and_evaluate("naive_bayes", frames)


def kmeans_train_eval(
    frames: Sequence[ModelFrame], align: str | None = None
) -> DataFrame:
    return train_and_evaluate("kmeans", frames, align)


def rf_train_eval(frames: Sequence[ModelFrame]) -> DataFrame:
    return train_and_evaluate("random_forest", frames)


def lsvc_train_eval(frames: Sequence[ModelFrame]) -> DataFrame:
    return train_and_evaluate("linear_svc", frames)


def mlp_train_eval(frames: Sequence[ModelFrame]) -> DataFrame:
    return train_and_evaluate("perceptron", frames)


def _check_folds(rows: DataFrame, folds: int) -> None:
    """Fail unless the folds are 0 to ``folds`` - 1, each with rows, and none holds all of them."""
    found = {r["fold"] for r in rows.select("fold").distinct().limit(folds + 1).collect()}
    if found != set(range(folds)) or folds < 2:
        raise ValueError(f"rows must be dealt to all of {folds} folds, and to no other")


def _at_once(rows: DataFrame, work: Callable, tasks: Sequence[tuple], parallelism: int) -> list:
    """Results of ``work`` on every task in order, ``parallelism`` at a time."""
    with ThreadPoolExecutor(parallelism) as pool:
        runs = [pool.submit(inheritable_thread_target(rows.sparkSession)(work), *t) for t in tasks]
        try:
            return [r.result() for r in runs]
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise


def _waves(estimator: Estimator, points: Sequence[dict]) -> list[list[int]]:
    """Places of grid points that differ in ``maxIter`` alone, fewest steps first.

    Only k-means tells how many steps it took; a point of another learner is on its own.
    """
    if not isinstance(estimator, KMeans):
        return [[i] for i in range(len(points))]
    steps = [point.get(estimator.maxIter, estimator.getMaxIter()) for point in points]
    groups: dict[frozenset, list[int]] = {}
    for i, point in enumerate(points):
        rest = frozenset((p.name, v) for p, v in point.items() if p.name != "maxIter")
        groups.setdefault(rest, []).append(i)
    return [sorted(g, key=steps.__getitem__) for g in groups.values()]


def _counts_hits(pipeline: Pipeline, evaluator: MulticlassClassificationEvaluator) -> bool:
    """Whether the evaluator gives the share of rows that the one learner labels rightly."""
    first, *others = pipeline.getStages()
    return (
        not others and evaluator.getMetricName() == "accuracy" and not evaluator.isDefined(evaluator.weightCol)
        and evaluator.getLabelCol() == first.getLabelCol()
        and evaluator.getPredictionCol() == first.getPredictionCol()
    )


def fold_accuracies(
    pipeline: Pipeline, points: Sequence[dict], evaluator: MulticlassClassificationEvaluator,
    rows: DataFrame, folds: int, parallelism: int,
) -> list[list[float]]:
    """Accuracy of every grid point (inner lists) on every fold, fitted on the other folds.

    All folds and points share one queue. A fit of k-means that ended before its last
    allowed step is the fit of every larger ``maxIter`` as well, and is taken for those.
    Random forests are grown together, level by level.
    """
    learner = pipeline.getStages()[0]
    if _counts_hits(pipeline, evaluator) and can_grow(learner, points, rows):
        return forest_accuracies(learner, points, rows, folds)
    found = [[0.0] * len(points) for _ in range(folds)]

    def run(fold: int, wave: list[int]) -> None:
        train, held_out = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
        while wave:
            first, *wave = wave
            model = pipeline.fit(train, points[first])
            found[fold][first] = evaluator.evaluate(model.transform(held_out))
            allowed = points[first].get(learner.maxIter) if wave else None
            if allowed is not None and model.stages[0].summary.numIter < allowed:
                for other in wave:
                    found[fold][other] = found[fold][first]
                return

    _at_once(rows, run, [(f, w) for f in range(folds) for w in _waves(learner, points)], parallelism)
    return found


def cross_validate(
    name: str,
    frames: Sequence[ModelFrame],
    grid: dict[str, list] | None = None,
    folds: int = FOLDS,
    parallelism: int = 4,
) -> DataFrame:
    """Metrics of the grid point with the best accuracy over the folds.

    The folds come from the frame's ``fold`` column, so they are the same in
    every run. K-means is selected on its cluster ids indexed by frequency,
    while the final metrics use the raw ids. Of equally good points the first is taken.
    Forests are grown for all frames at a time.
    """
    def run(frame: ModelFrame) -> DataFrame:
        estimator = LEARNERS[name]()
        points = param_grid(estimator, grid or GRIDS[name])
        stages, prediction = [estimator], "prediction"
        if name == "kmeans":
            prediction = "prediction2"
            stages.append(StringIndexer(inputCol="prediction", outputCol=prediction))
        pipeline = Pipeline(stages=stages)
        evaluator = MulticlassClassificationEvaluator(
            predictionCol=prediction, metricName="accuracy"
        )
        with training_rows(frame) as train:
            check_classes(train)
            _check_folds(train, folds)
            found = fold_accuracies(pipeline, points, evaluator, train, folds, parallelism)
            best = int(np.argmax(np.mean(found, axis=0)))
            model = pipeline.fit(train, points[best]).stages[0]
        metrics = classification_metrics(predict(model, frame.test))
        return report_rows(metrics, name, "cv", frame.dataset)

    # Forests go level by level; while the driver draws for one frame, tasks work for the other.
    at_once = len(frames) if name == "random_forest" else 1
    return metrics_report(_at_once(frames[0].rows, run, [(f,) for f in frames], at_once))


def nb_cv(frames: Sequence[ModelFrame], **options) -> DataFrame:
    return cross_validate("naive_bayes", frames, **options)


def kmeans_cv(frames: Sequence[ModelFrame], **options) -> DataFrame:
    return cross_validate("kmeans", frames, **options)


def rf_cv(frames: Sequence[ModelFrame], **options) -> DataFrame:
    return cross_validate("random_forest", frames, **options)


def run_named(
    frames: Sequence[ModelFrame], work: dict[str, Callable[[], DataFrame]], parallelism: int
) -> list[DataFrame]:
    """Results of all jobs in order, some at a time, each in a job group of its name.

    The last ones are begun first, so long jobs should stand last: they then run beside the
    others and not after them. All jobs are run; if any failed, the error names each of them.
    """
    spark = frames[0].rows.sparkSession

    @inheritable_thread_target(spark)
    def run(name: str) -> DataFrame:
        spark.sparkContext.setJobGroup(name, name)
        return work[name]()

    with ThreadPoolExecutor(parallelism) as pool:
        begun = {name: pool.submit(run, name) for name in reversed(work)}
    futures = {name: begun[name] for name in work}
    failed = {name: f.exception() for name, f in futures.items() if f.exception() is not None}
    if failed:
        reasons = "; ".join(f"{name}: {error}" for name, error in failed.items())
        raise RuntimeError(f"runs failed: {reasons}") from next(iter(failed.values()))
    return [f.result() for f in futures.values()]


def run_all(
    frames: Sequence[ModelFrame], path: str | None = None, parallelism: int = 2
) -> DataFrame:
    """The report of all eight runs, written to ``path`` if given.

    Five learners as they are, and three chosen by cross-validation over full grids. The
    training rows of a frame are kept once for all of them, and ``parallelism`` runs go on
    at a time.
    """
    with ExitStack() as held:
        rows = [
            replace(f, at_hand=held.enter_context(kept(f.train.select("label", "features", "fold"))))
            for f in frames
        ]
        work = {f"{name} plain": lambda n=name: train_and_evaluate(n, rows) for name in LEARNERS}
        work |= {f"{name} cv": lambda n=name: cross_validate(n, rows) for name in GRIDS}
        runs = run_named(frames, work, parallelism)
    return metrics_report(runs, path)
