"""Model frames, learners, cross-validation and saved models."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import fixtures as fx
from conftest import rows
from reviewlens.operators import profiles
from reviewlens.operators.metrics import METRICS
from reviewlens.plans import features, models, scoring
from reviewlens.schema import FEATURE_COLUMNS


@pytest.fixture(scope="module")
def frames(spark, sf):
    return features.model_frames(fx.reviews(spark, sf))


@pytest.fixture(scope="module")
def lines(spark, sf):
    docs = fx.labeled_documents(spark, sf)
    return docs.select(F.col("doc_id").alias("id"), F.col("text").alias("value"), F.col("quality").alias("label"))


def test_feature_table_columns(spark, sf):
    table = features.feature_table(fx.reviews(spark, sf))
    assert table.columns == FEATURE_COLUMNS
    assert {f.dataType.simpleString() for f in table.schema} == {"double"}
    assert table.where("userReviewRate <= 0").count() == 0


def test_features_as_text_repeats_the_first_star(spark, sf):
    table = features.feature_table(fx.reviews(spark, sf))
    for rate, column in ((False, "pstar1"), (True, "userReviewRate")):
        text = features.features_as_text(table, include_review_rate=rate)
        for r in text.join(table.drop("label"), "reviewID").collect():
            words = r["featureText"].split(" ")
            assert len(words) == 15
            assert float(words[4]) == r["pstar1"]
            assert float(words[14]) == r[column]


def test_hashed_counts_keep_every_token(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "")], "k int, text string")
    counted = features.hashed_counts(df).select("k", vector_to_array("rawFeatures").alias("v"))
    assert {r["k"]: sum(r["v"]) for r in counted.collect()} == {1: 3.0, 2: 1.0}


def test_frames_hold_all_reviews_once(spark, sf, frames):
    ids = rows(fx.reviews(spark, sf).select("reviewID"))
    assert [f.dataset for f in frames] == ["text_only", "text_features"]
    for f in frames:
        assert rows(f.rows.select("reviewID")) == ids
        assert f.train.count() + f.test.count() == len(ids)
        assert f.rows.first()["features"].size == 5000
    a, b = (f.rows.select("reviewID", "part", "fold") for f in frames)
    assert rows(a) == rows(b)


def test_review_without_text_is_left_out(spark, sf):
    reviews = fx.reviews(spark, sf)
    cut = reviews.withColumn(
        "reviewText", F.when(F.col("reviewID") % 2 == 0, F.col("reviewText"))
    )
    got = features.text_frames(cut).select("reviewID")
    assert rows(got) == rows(reviews.where("reviewID % 2 = 0").select("reviewID"))


def test_weighting_fitted_on_train_only(spark, sf, lines):
    everything = features.corpus_frame(lines)
    train = features.corpus_frame(lines, fit_on="train")
    assert everything.idf.numDocs == lines.count()
    assert train.idf.numDocs == train.train.count()
    with pytest.raises(ValueError):
        features.corpus_frame(lines, fit_on="test")


def test_repeated_or_missing_review_ids_are_refused(spark, sf):
    reviews = fx.reviews(spark, sf)
    with pytest.raises(ValueError, match="unique"):
        features.model_frames(reviews.unionByName(reviews.limit(1)))
    with pytest.raises(ValueError, match="null"):
        features.check_unique(spark.createDataFrame([(None,), (1,)], "k int"), "k")


def test_independent_splits_differ(spark, sf):
    a, b = features.model_frames(fx.reviews(spark, sf), independent_splits=True)
    assert rows(a.test.select("reviewID")) != rows(b.test.select("reviewID"))


def values(report):
    return {(r["dataset"], r["metric"]): r["value"] for r in report.collect()}


@pytest.mark.parametrize("name", ["naive_bayes", "linear_svc", "random_forest"])
def test_report_equals_evaluator(frames, name):
    got = values(models.train_and_evaluate(name, frames))
    assert set(got) == {(f.dataset, m) for f in frames for m in METRICS}
    for f in frames:
        predicted = models.LEARNERS[name]().fit(f.train).transform(f.test)
        for metric in METRICS:
            evaluator = MulticlassClassificationEvaluator(metricName=metric)
            assert got[f.dataset, metric] == pytest.approx(evaluator.evaluate(predicted), abs=1e-9)
        assert got[f.dataset, "weightedRecall"] == pytest.approx(got[f.dataset, "accuracy"])


def test_kmeans_report_has_cost_and_aligned_ids_do_not_lose(frames):
    raw = values(models.kmeans_train_eval(frames[:1]))
    aligned = values(models.kmeans_train_eval(frames[:1], align="majority"))
    assert raw["text_only", "wssse"] > 0
    assert aligned["text_only", "wssse"] == pytest.approx(raw["text_only", "wssse"])
    assert aligned["text_only", "accuracy"] >= raw["text_only", "accuracy"] - 1e-9


def test_grid_sizes():
    sizes = {
        name: len(models.param_grid(models.LEARNERS[name](), grid))
        for name, grid in models.GRIDS.items()
    }
    assert sizes == {"naive_bayes": 3, "kmeans": 3, "random_forest": 9}


@pytest.mark.parametrize(
    "name, grid",
    [("naive_bayes", {"smoothing": [0.0, 1.0]}), ("kmeans", {"maxIter": [5]})],
)
def test_cross_validation(frames, name, grid):
    got = models.cross_validate(name, frames[:1], grid=grid, folds=7)
    assert {r["variant"] for r in got.collect()} == {"cv"}
    assert {m for _, m in values(got)} == set(METRICS)


def test_single_class_is_a_plain_error(frames):
    one = features.ModelFrame("one", frames[0].rows.where("label = 1"), frames[0].idf)
    with pytest.raises(ValueError, match="two label classes"):
        models.nb_train_eval([one])


def test_saved_model_labels_raw_text_like_the_fitted_one(spark, sf, lines, tmp_path):
    model, report = scoring.train_corpus_model(lines, "naive_bayes")
    assert {r["dataset"] for r in report.collect()} == {"corpus"}
    path = str(tmp_path / "model")
    scoring.save_model(model, path)
    scoring.save_model(model, path)
    docs = fx.unlabeled_documents(spark, sf).select("doc_id", "text")
    fresh = scoring.label_reviews(model, docs, "text")
    loaded = scoring.score_with_saved_model(path, docs, "text")
    assert loaded.columns == ["doc_id", "text", "label"]
    assert rows(loaded) == rows(fresh)
    assert loaded.count() == docs.count()


def test_large_ids_keep_their_rows(spark, sf):
    """Ids above 2^53 do not fit a double; the frames join on the id itself."""
    reviews = fx.reviews(spark, sf)
    large = reviews.withColumn("reviewID", F.col("reviewID") + 2**53 + 1)
    frames = features.text_frames(large)
    for frame in (features.text_only_frame, features.text_features_frame):
        found = frame(frames)
        assert found.count() == found.distinct().count() == reviews.count()
        assert found.join(large, "reviewID", "left_anti").isEmpty()


def test_missing_numbers_leave_the_second_frame_only(spark, sf):
    reviews = fx.reviews(spark, sf)
    gap = F.when(F.col("reviewID") % 5 > 0, F.col("helpfulPos")).alias("helpfulPos")
    holes = reviews.withColumn("helpfulPos", gap)
    missing = holes.where("helpfulPos is null").count()
    first, second = features.model_frames(holes)
    assert missing > 0 and first.rows.count() == reviews.count()
    assert second.rows.count() == reviews.count() - missing


def test_repeated_ids_are_refused(spark, sf):
    reviews = fx.reviews(spark, sf)
    twice = reviews.unionByName(reviews.limit(1))
    with pytest.raises(ValueError, match="unique"):
        features.text_frames(twice)
    with pytest.raises(Exception, match="unique"):
        profiles.attach_profiles(twice).collect()


def test_run_all_is_one_row_per_run_frame_and_metric(frames, monkeypatch, tmp_path):
    assert len(models.LEARNERS) + len(models.GRIDS) == 8
    monkeypatch.setattr(models, "LEARNERS", {"naive_bayes": models.LEARNERS["naive_bayes"]})
    monkeypatch.setattr(models, "GRIDS", {"naive_bayes": {"smoothing": [1.0]}})
    report = models.run_all(frames, str(tmp_path / "report"))
    keys = {(r["model"], r["variant"], r["dataset"], r["metric"]) for r in report.collect()}
    assert report.count() == len(keys) == 2 * 2 * len(METRICS)


def test_run_all_keeps_the_rows_of_a_frame_once(frames, monkeypatch):
    monkeypatch.setattr(models, "LEARNERS", {n: models.LEARNERS[n] for n in ("naive_bayes", "linear_svc")})
    monkeypatch.setattr(models, "GRIDS", {"naive_bayes": {"smoothing": [1.0]}})
    calls, keep = [], models.kept
    monkeypatch.setattr(models, "kept", lambda df: calls.append(df.columns) or keep(df))
    report = models.run_all(frames)
    assert calls == [["label", "features", "fold"]] * 2
    runs = {(r["model"], r["variant"]) for r in report.collect()}
    assert runs == {("naive_bayes", "plain"), ("linear_svc", "plain"), ("naive_bayes", "cv")}


def test_failed_runs_are_named(frames, monkeypatch):
    def fail():
        raise ValueError("no learner")

    monkeypatch.setattr(models, "LEARNERS", {"naive_bayes": models.LEARNERS["naive_bayes"], "a": fail, "b": fail})
    monkeypatch.setattr(models, "GRIDS", {})
    with pytest.raises(RuntimeError, match="a plain: no learner; b plain: no learner"):
        models.run_all(frames)
