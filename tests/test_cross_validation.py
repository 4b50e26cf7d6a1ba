"""Cross-validation: fits that are shared, folds, and what CrossValidator finds."""

import threading

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator

from reviewlens.plans import models
from reviewlens.plans.features import ModelFrame

FOLDS = 3


@pytest.fixture(scope="module")
def points(spark):
    data = [
        (float(i % 2), Vectors.dense([float(i % 7), float(i % 5 + 4 * (i % 2)), 1.0]), i // 2 % FOLDS, i % 4 // 3)
        for i in range(120)
    ]
    return spark.createDataFrame(data, ["label", "features", "fold", "part"]).persist()


def _search(learner, points, rows, prediction="prediction", stages=()):
    evaluator = MulticlassClassificationEvaluator(predictionCol=prediction, metricName="accuracy")
    pipeline = Pipeline(stages=[learner, *stages])
    whole = CrossValidator(
        estimator=pipeline, estimatorParamMaps=points, evaluator=evaluator, numFolds=FOLDS, foldCol="fold", seed=1
    ).fit(rows)
    return models.fold_accuracies(pipeline, points, evaluator, rows, FOLDS, 2), whole.avgMetrics


@pytest.mark.parametrize("steps", [[1, 2, 50, 60], [60, 1, 50], [30]])
def test_kmeans_grid_is_that_of_the_cross_validator(points, steps):
    learner = KMeans(k=2, seed=7)
    grid = models.param_grid(learner, {"maxIter": steps})
    index = StringIndexer(inputCol="prediction", outputCol="prediction2")
    found, mean = _search(learner, grid, points, "prediction2", [index])
    assert [sum(x) / FOLDS for x in zip(*found)] == pytest.approx(mean)


def test_bayes_grid_is_that_of_the_cross_validator(points):
    learner = NaiveBayes()
    found, mean = _search(learner, models.param_grid(learner, {"smoothing": [0.0, 0.5, 1.0]}), points)
    assert [sum(x) / FOLDS for x in zip(*found)] == pytest.approx(mean)


def test_kmeans_that_has_ended_is_not_fitted_again(points, monkeypatch):
    """Three limits of steps that no fit reaches: one fit for each fold, and the last one."""
    fits, lock, fit = [], threading.Lock(), KMeans._fit

    def counted(self, rows):
        with lock:
            fits.append(self.getMaxIter())
        return fit(self, rows)

    monkeypatch.setattr(KMeans, "_fit", counted)
    frame = ModelFrame("one", points, None)
    report = models.cross_validate("kmeans", [frame], grid={"maxIter": [100, 400, 500]}, folds=FOLDS)
    assert report.count() == 4
    assert fits == [100] * (FOLDS + 1)


def test_kmeans_limits_that_bind_are_fitted_each(points):
    learner = KMeans(k=2, seed=7)
    grid = models.param_grid(learner, {"maxIter": [5, 1]}) + models.param_grid(learner, {"k": [2], "maxIter": [1]})
    assert models._waves(learner, grid) == [[1, 0], [2]]


def test_folds_without_rows_are_refused(points):
    frame = ModelFrame("one", points.where("fold < 2"), None)
    with pytest.raises(ValueError, match="all of 3 folds"):
        models.cross_validate("naive_bayes", [frame], grid={"smoothing": [1.0]}, folds=FOLDS)


def test_last_runs_are_begun_first(spark, points):
    begun = []
    work = {n: lambda n=n: begun.append(n) or n for n in ("short", "long")}
    assert models.run_named([ModelFrame("one", points, None)], work, 1) == ["short", "long"]
    assert begun == ["long", "short"]
