"""Relational learners, metrics and clusters against MLlib."""

import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizer, IDF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from checks import fixtures as fx
from conftest import rows
from reviewlens.functions.split import split_part
from reviewlens.functions.text import normalized_tokens
from reviewlens.operators import bayes, clusters, metrics
from reviewlens.operators.terms import tfidf_terms

SIX = [(0.0, 0.0), (0.0, 1.0), (0.0, 0.0), (1.0, 1.0), (1.0, 0.0), (2.0, 0.0)]


def as_dict(report):
    return {r["metric"]: r["value"] for r in report.collect()}


@pytest.mark.parametrize(
    "pairs",
    [SIX, [(1.0, 1.0)] * 3, [(0.0, 1.0), (1.0, 0.0)], [(0.0, 5.0), (0.0, 0.0), (1.0, 5.0)]],
)
def test_metrics_equal_the_evaluator(spark, pairs):
    df = spark.createDataFrame(pairs, "label double, prediction double")
    got = as_dict(metrics.classification_metrics(df))
    assert list(got) == metrics.METRICS
    for name, value in got.items():
        evaluator = MulticlassClassificationEvaluator(metricName=name)
        assert value == pytest.approx(evaluator.evaluate(df), abs=1e-9)
    assert got["weightedRecall"] == pytest.approx(got["accuracy"])


def test_metrics_by_hand(spark):
    df = spark.createDataFrame(SIX, "label double, prediction double")
    got = as_dict(metrics.classification_metrics(df))
    assert got["accuracy"] == pytest.approx(0.5)
    assert got["weightedPrecision"] == pytest.approx((3 * 2 / 4 + 2 * 1 / 2) / 6)


def test_report_is_written_and_read(spark, tmp_path):
    part = spark.createDataFrame([("m", "plain", "d", "f1", 0.5)], "model string, variant string, dataset string, metric string, value double")
    report = metrics.metrics_report([part, part], str(tmp_path / "r"))
    assert rows(report) == [("m", "plain", "d", "f1", 0.5)] * 2


def test_naive_bayes_equals_mllib(spark, sf):
    """Priors, conditionals and predictions of the relational and the fitted model."""
    reviews = fx.reviews(spark, sf).select("reviewID", "reviewText", "label")
    words = normalized_tokens("reviewText")
    weights = tfidf_terms(reviews, "reviewID", words)
    labels = reviews.select(F.col("reviewID").alias("id"), "label")
    joined = weights.join(labels, "id").withColumn("part", split_part("id")).persist()
    train = joined.withColumn("label", F.when(F.col("part") == 0, F.col("label")))
    priors = bayes.nb_priors(labels.where(split_part("id") == 0)).persist()

    docs = reviews.withColumn("w", words)
    vectorizer = CountVectorizer(inputCol="w", outputCol="tf", vocabSize=1 << 20).fit(docs)
    counted = vectorizer.transform(docs)
    weighted = IDF(inputCol="tf", outputCol="features").fit(counted).transform(counted)
    part = split_part("reviewID")
    model = NaiveBayes(smoothing=1.0).fit(weighted.where(part == 0))

    pi = {r["label"]: r["pi"] for r in priors.collect()}
    assert [pi[0.0], pi[1.0]] == pytest.approx(list(model.pi.toArray()), abs=1e-9)
    theta = model.theta.toArray()
    index = {term: i for i, term in enumerate(vectorizer.vocabulary)}
    got = bayes.nb_aggregates(train).collect()
    assert len(got) == 2 * len(index)
    worst = max(abs(r["theta"] - theta[int(r["label"]), index[r["term"]]]) for r in got)
    assert worst < 1e-9

    test = joined.where("part = 1").select("id", "term", "weight")
    own = bayes.nb_predict(train, test, priors)
    ml = model.transform(weighted.where(part == 1))
    assert dict(rows(own.select("id", "prediction"))) == dict(rows(ml.select("reviewID", "prediction")))
    joined.unpersist()
    priors.unpersist()


def test_wssse_equals_brute_force_and_converged_cost(spark, sf):
    vectors = fx.table(spark, sf, "embeddings")
    features = vectors.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = KMeans(k=2, maxIter=200, seed=3, tol=0.0).fit(features)
    got = clusters.wssse(features, model.clusterCenters(), vector_to_array("features")).first()
    data = np.array([r["embedding"] for r in vectors.collect()], dtype=float)
    distance = ((data[:, None, :] - np.array(model.clusterCenters())[None]) ** 2).sum(-1)
    assert got["n"] == len(data)
    assert got["wssse"] == pytest.approx(distance.min(1).sum())
    assert got["wssse"] == pytest.approx(model.summary.trainingCost, rel=1e-6)


def test_majority_label_breaks_ties_downward(spark):
    df = spark.createDataFrame([(0.0, 0), (1.0, 0), (1.0, 1), (1.0, 1), (0.0, 1)], "label double, prediction int")
    assert rows(clusters.majority_labels(df)) == [(0, 0.0), (1, 1.0)]
