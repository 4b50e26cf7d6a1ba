"""The perceptron on sparse rows against MLlib's on dense ones."""

import pytest
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reviewlens.operators import perceptron
from reviewlens.operators.perceptron import SparsePerceptron
from reviewlens.plans import models

CLASSES, WIDTH = 3, 40


@pytest.fixture(scope="module")
def points(spark):
    """Sparse, dense and empty rows of three classes that no line parts, in uneven partitions."""
    data = []
    for i in range(203):
        label = float((i * i + i // 7) % CLASSES)
        entries = {(i * 7 + j * 5) % WIDTH: 1.0 + (i + j) % 3 for j in range(i % 6)}
        entries[int(label)] = float(i % 2)
        vector = Vectors.sparse(WIDTH, entries)
        data.append((label, Vectors.dense(vector.toArray()) if i % 10 == 0 else vector))
    data.append((1.0, Vectors.sparse(WIDTH, {})))
    return spark.createDataFrame(data, ["label", "features"]).repartition(3).persist()


def learners(**more):
    options = {"layers": [WIDTH, CLASSES], "blockSize": 16, "seed": 5, "maxIter": 30} | more
    return SparsePerceptron(**options), MultilayerPerceptronClassifier(**options)


def test_weights_are_those_of_mllib(points):
    own, mllib = (x.fit(points) for x in learners())
    assert type(own) is MultilayerPerceptronClassificationModel
    assert own.weights.toArray() == pytest.approx(mllib.weights.toArray(), rel=1e-5, abs=1e-7)
    assert own.getMaxIter() == 30 and not own.isSet(own.initialWeights)
    with_layer = learners(layers=[WIDTH, 4, CLASSES], maxIter=5)
    own, mllib = (x.fit(points) for x in with_layer)
    assert own.weights.toArray() == pytest.approx(mllib.weights.toArray(), rel=1e-6)


def test_given_start_weights_are_taken(points):
    start = Vectors.dense([0.01 * (i % 9) for i in range((WIDTH + 1) * CLASSES)])
    own, mllib = (x.fit(points) for x in learners(initialWeights=start, maxIter=3))
    assert own.weights.toArray() == pytest.approx(mllib.weights.toArray(), rel=1e-6, abs=1e-9)


def test_training_rows_are_kept_sparse(spark, monkeypatch):
    """300 rows of 5000 inputs are 12 MB as dense rows; the learner keeps their few entries."""
    kept = []
    monkeypatch.setattr(
        perceptron, "_objective",
        lambda chunks, *a, real=perceptron._objective: kept.append(chunks.agg(
            F.sum(sum(F.octet_length(c) for c in chunks.columns))
        ).first()[0]) or real(chunks, *a),
    )
    data = [(float(i % 2), Vectors.sparse(5000, {i: 1.0, 4000 + i % 2: 1.0})) for i in range(300)]
    model = models.LEARNERS["perceptron"]().fit(spark.createDataFrame(data, ["label", "features"]))
    assert kept and kept[0] < 300 * 100
    assert model.getLayers() == [5000, 2]


def test_labels_out_of_range_are_refused(spark):
    odd = spark.createDataFrame([(0.0, Vectors.dense([1.0])), (2.0, Vectors.dense([0.0]))], ["label", "features"])
    with pytest.raises(Exception, match="labels must be 0 to 1"):
        SparsePerceptron(layers=[1, 2], seed=1).fit(odd)


def test_a_row_that_is_very_long_does_not_end_the_fit(spark):
    """Its loss at the start weights is infinite when probabilities are rounded."""
    data = [(float(i % 2), Vectors.sparse(4, {i % 2: 1.0})) for i in range(40)]
    start = learners(layers=[4, 2], maxIter=0)[1].fit(spark.createDataFrame(data, ["label", "features"]))
    # Weights of the third input for either class: the long row is far on the wrong side.
    left, right = start.weights.toArray()[4:6]
    data.append((float(left > right), Vectors.sparse(4, {2: 1000 / abs(left - right)})))
    rows = spark.createDataFrame(data, ["label", "features"]).coalesce(1).persist()
    own, mllib = (x.fit(rows) for x in learners(layers=[4, 2]))
    assert mllib.weights == start.weights
    assert own.transform(rows).where("label = prediction").count() == len(data)
