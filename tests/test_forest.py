"""Forests grown together: what MLlib draws, and what CrossValidator finds."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator

from reviewlens.operators import draws, forest
from reviewlens.plans import models
from reviewlens.plans.features import ModelFrame

FOLDS = 3
WIDTH = 40


def _vector(random, label, width=WIDTH, negative=False):
    places = np.sort(random.choice(width, 12, replace=False))
    values = np.round(random.exponential(1.0 + 0.4 * label, 12), 1) - (1.0 if negative else 0.0)
    return Vectors.sparse(width, places.tolist(), values.tolist())


def _rows(spark, n, classes=2, parts=3, **options):
    random = np.random.default_rng(n)
    labels = random.integers(classes, size=n)
    data = [(float(k), _vector(random, k, **options), int(random.integers(FOLDS))) for k in labels]
    return spark.createDataFrame(data, ["label", "features", "fold"]).repartition(parts).persist()


def _both(learner, grid, rows):
    points = models.param_grid(learner, grid)
    evaluator = MulticlassClassificationEvaluator(metricName="accuracy")
    pipeline = Pipeline(stages=[learner])
    assert models._counts_hits(pipeline, evaluator) and forest.can_grow(learner, points, rows)
    whole = CrossValidator(
        estimator=pipeline, estimatorParamMaps=points, evaluator=evaluator, numFolds=FOLDS, foldCol="fold", seed=1
    ).fit(rows)
    found = models.fold_accuracies(pipeline, points, evaluator, rows, FOLDS, 2)
    return [sum(x) / FOLDS for x in zip(*found)], whole.avgMetrics


def test_draws_are_those_of_spark(spark):
    jvm = spark._jvm
    java = jvm.java.util.Random(12345)
    first, second = draws.JavaRandom(12345), [java.nextLong() for _ in range(9)]
    longs = np.concatenate([first.longs(2)[0], first.longs(7)[0]])
    assert longs.view("int64").tolist() == second
    theirs, ours = jvm.org.apache.spark.util.random.XORShiftRandom(-7), draws.XorShift(-7)
    assert [theirs.nextDouble() for _ in range(9)] == [ours.double() for _ in range(9)]
    poisson = jvm.org.apache.commons.math3.distribution.PoissonDistribution(1.0)
    poisson.reseedRandomGenerator(12347)
    drawn = draws.Poissons(12347)
    found = drawn.between(0, 700).tolist() + drawn.between(700, 2000).tolist()
    assert found == [poisson.sample() for _ in range(2000)]


@pytest.mark.parametrize(
    "classes, negative, grid",
    [
        (2, False, {"maxDepth": [2, 7], "numTrees": [3, 7]}),
        (3, False, {"maxDepth": [2, 5], "numTrees": [6]}),
        (2, True, {"maxDepth": [3], "numTrees": [15]}),
    ],
)
def test_forests_are_those_of_mllib(spark, classes, negative, grid):
    rows = _rows(spark, 400, classes, negative=negative)
    learner = RandomForestClassifier(maxBins=32, seed=12345)
    found, mean = _both(learner, grid, rows)
    assert found == pytest.approx(mean, abs=1e-12)


def test_few_bins_take_thresholds_by_stride(spark):
    learner = RandomForestClassifier(numTrees=5, maxDepth=5, maxBins=4, minInstancesPerNode=3, seed=7)
    found, mean = _both(learner, {"maxDepth": [5]}, _rows(spark, 300))
    assert found == pytest.approx(mean, abs=1e-12)


def test_memory_for_few_nodes_grows_every_depth_alone(spark):
    """Without memory MLlib splits one node at a time, and draws differ by depth."""
    learner = RandomForestClassifier(numTrees=3, maxMemoryInMB=0, seed=3)
    found, mean = _both(learner, {"maxDepth": [1, 3]}, _rows(spark, 40))
    assert found == pytest.approx(mean, abs=1e-12)


def test_thresholds_of_many_rows_come_from_a_sample(spark):
    learner = RandomForestClassifier(numTrees=2, maxDepth=4, seed=11)
    found, mean = _both(learner, {"maxDepth": [4]}, _rows(spark, 24000, parts=2))
    assert found == pytest.approx(mean, abs=1e-12)


def test_no_forest_of_the_grid_is_fitted_alone(spark, monkeypatch):
    """One fit of MLlib for each frame, that of the chosen point; one for every fold and point before."""
    fits, fit = [], RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: fits.append(1) or fit(self, df))
    rows = _rows(spark, 200).selectExpr("*", "cast(rand(1) < 0.3 as int) as part").persist()
    grid = {"maxDepth": [2, 3], "numTrees": [2, 3]}
    report = models.cross_validate("random_forest", [ModelFrame("one", rows, None)], grid=grid, folds=FOLDS)
    assert report.count() == 4 and len(fits) == 1
