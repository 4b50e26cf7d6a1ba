"""Naive Bayes over the whole grid of smoothings, beside MLlib."""

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizer, IDF
from pyspark.sql import functions as F

from checks import fixtures as fx
from conftest import rows
from reviewlens.functions.split import fold_number, split_part
from reviewlens.functions.text import normalized_tokens
from reviewlens.operators import bayes

GRID = [0.0, 0.5, 1.0]
FOLDS = 3


@pytest.fixture(scope="module")
def weighted(spark, sf):
    """MLlib's vectors of exact terms, and the relational weights of the same reviews."""
    reviews = fx.reviews(spark, sf).select("reviewID", "reviewText", "label")
    fold = fold_number("reviewID", FOLDS)
    weights = bayes.bayes_weights(reviews, fold=fold)
    docs = reviews.withColumn("w", normalized_tokens("reviewText"))
    vectorizer = CountVectorizer(inputCol="w", outputCol="tf", vocabSize=1 << 20).fit(docs)
    counted = vectorizer.transform(docs)
    vectors = IDF(inputCol="tf", outputCol="features").fit(counted).transform(counted)
    marked = vectors.select(
        "reviewID", "label", "features", split_part("reviewID").alias("part"), fold.alias("fold")
    )
    yield reviews, weights, marked.persist(), vectorizer.vocabulary
    marked.unpersist()


@pytest.mark.parametrize("smoothing", GRID)
def test_predictions_equal_mllib(weighted, smoothing):
    reviews, weights, vectors, vocabulary = weighted
    model = NaiveBayes(smoothing=smoothing).fit(vectors.where("part = 0"))
    theta, index = model.theta.toArray(), {term: i for i, term in enumerate(vocabulary)}
    for r in bayes.nb_aggregates(weights, smoothing).collect():
        want = theta[int(r["label"]), index[r["term"]]]
        assert r["theta"] == want or r["theta"] == pytest.approx(want, abs=1e-9)
    priors = bayes.nb_priors(reviews.where(split_part("reviewID") == 0), smoothing)
    test = weights.where("part = 1").select("id", "term", "weight")
    own = bayes.nb_predict(weights, test, priors, smoothing).select("id", "prediction")
    theirs = model.transform(vectors.where("part = 1")).select("reviewID", "prediction")
    assert dict(rows(own)) == dict(rows(theirs))


def test_fold_predictions_equal_mllib(weighted):
    _, weights, vectors, _ = weighted
    found = bayes.nb_fold_predictions(weights, FOLDS, GRID)
    own = {(r["smoothing"], r["id"]): r["prediction"] for r in found.collect()}
    accuracy = {}
    for smoothing in GRID:
        for fold in range(FOLDS):
            training = vectors.where((F.col("part") == 0) & (F.col("fold") != fold))
            model = NaiveBayes(smoothing=smoothing).fit(training)
            held = vectors.where((F.col("part") == 0) & (F.col("fold") == fold))
            scored = model.transform(held).select("reviewID", "label", "prediction").collect()
            for r in scored:
                assert own.pop((smoothing, r["reviewID"])) == r["prediction"]
            accuracy.setdefault(smoothing, []).append(sum(r["label"] == r["prediction"] for r in scored) / len(scored))
    assert not own
    got = dict(rows(bayes.nb_grid(weights, FOLDS, GRID)))
    assert got == pytest.approx({s: sum(a) / FOLDS for s, a in accuracy.items()})


def test_terms_of_one_fold_leave_exactly_nothing(spark):
    rows_ = [(1, "a", 3, 1, 0.3, 0, 0.0, 0), (2, "b", 1, 2, 0.1, 0, 1.0, 1), (3, "b", 2, 2, 0.2, 0, 0.0, 0)]
    weights = spark.createDataFrame(
        rows_, "id int, term string, tf int, df int, weight double, part int, label double, fold int"
    )
    sums = {r["term"]: (list(r["t0"]), list(r["t1"])) for r in bayes.fold_sums(weights, 2).collect()}
    assert sums == {"a": ([3, 0], [0, 0]), "b": ([2, 0], [0, 1])}
    # Without fold 0 no row of class 0 is left, so class 1 is predicted or the first one.
    found = {r["id"]: r for r in bayes.nb_fold_predictions(weights, 2, [0.0]).collect()}
    assert found[1]["prediction"] == 0.0 and found[2]["prediction"] == 0.0


@pytest.mark.parametrize(
    "scores, want",
    [((1.0, 2.0), 1.0), ((2.0, 2.0), 0.0), ((float("-inf"), -5.0), 1.0), ((float("-inf"),) * 2, 0.0),
     ((float("nan"), 1.0), 0.0), ((1.0, float("nan")), 0.0)],
)
def test_the_class_of_largest_score(spark, scores, want):
    df = spark.createDataFrame([scores], "a double, b double")
    assert df.select(bayes._predicted([F.col("a"), F.col("b")], (0.0, 1.0))).first()[0] == want


def test_best_smoothing_takes_the_first_of_equals(spark):
    grid = spark.createDataFrame([(1.0, 0.8), (0.5, 0.8), (0.0, 0.2)], "smoothing double, accuracy double")
    assert bayes.best_smoothing(grid, GRID) == 0.5
