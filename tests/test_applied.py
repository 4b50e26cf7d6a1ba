"""Fitted things applied: indexes, saved lemma tables, costs of sparse vectors."""

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from checks import fixtures as fx
from conftest import rows
from reviewlens.operators import clusters
from reviewlens.operators.indexing import apply_index, string_index
from reviewlens.operators.normalize import TextNormalizer, normalize_text
from reviewlens.plans import features, scoring

LEMMAS = [("ran", "run"), ("Cars", "car"), ("was", "be")]


@pytest.mark.parametrize("unseen", ["error", "keep", "skip"])
def test_index_equals_the_ml_indexer(spark, unseen):
    fitted_on = spark.createDataFrame([("b",)] * 3 + [("a",)] * 2 + [("c",)] * 2, "v string")
    asked = fitted_on.unionByName(spark.createDataFrame([("a",)] * 5, "v string"))
    if unseen != "error":
        asked = asked.unionByName(spark.createDataFrame([("z",), (None,), ("z",)], "v string"))
    model = StringIndexer(inputCol="v", outputCol="index", handleInvalid=unseen).fit(fitted_on)
    own = apply_index(asked, "v", string_index(fitted_on, "v"), unseen=unseen)
    assert rows(own.select("v", "index")) == rows(model.transform(asked).select("v", "index"))


@pytest.mark.parametrize("value", ["z", None])
def test_value_without_index_is_an_error(spark, value):
    index = string_index(spark.createDataFrame([("a",)], "v string"), "v")
    asked = spark.createDataFrame([(value,), ("a",)], "v string")
    with pytest.raises(ValueError, match="without index"):
        apply_index(asked, "v", index)
    with pytest.raises(ValueError, match="unseen must be"):
        apply_index(asked, "v", index, unseen="drop")
    with pytest.raises(ValueError, match="already"):
        apply_index(asked, "v", index, name="v")


def test_index_of_numbers_and_of_an_empty_table(spark):
    numbers = spark.createDataFrame([(7, "x"), (7, "y"), (9, "z")], "v int, _n string")
    found = apply_index(numbers, "v", string_index(numbers, "v"))
    assert rows(found) == [(7, "x", 0.0), (7, "y", 0.0), (9, "z", 1.0)] and found.columns == ["v", "_n", "index"]
    empty = numbers.where("false")
    assert apply_index(empty, "v", string_index(numbers, "v")).count() == 0
    assert apply_index(empty, "v", string_index(empty, "v"), unseen="keep").count() == 0


def texts(spark):
    data = [(1, "He ran, ran!  Cars cars"), (2, "was it"), (3, ""), (4, None), (5, "ran " * 50)]
    return spark.createDataFrame(data, "k int, t string")


@pytest.mark.parametrize("given", [LEMMAS, [], None])
def test_stage_is_saved_with_its_lemmas(spark, tmp_path, given):
    lemmas = None if given is None else spark.createDataFrame(given, "surface string, lemma string")
    stage = TextNormalizer(inputCol="t", outputCol="n", lemmas=lemmas)
    for _ in range(2):
        stage.write().overwrite().save(str(tmp_path / "s"))
    loaded = TextNormalizer.load(str(tmp_path / "s"))
    assert (loaded.lemmas is None) == (given is None)
    want = rows(normalize_text(texts(spark), "t", "n", lemmas))
    assert rows(loaded.transform(texts(spark))) == want
    assert rows(loaded.copy().transform(texts(spark))) == want


def test_saved_model_keeps_its_lemmas(spark, sf, tmp_path):
    docs = fx.labeled_documents(spark, sf)
    lines = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("value"), F.col("quality").alias("label"))
    lemmas = fx.lemma_table(spark, sf)
    model, _ = scoring.train_corpus_model(lines, "naive_bayes", lemmas=lemmas)
    path = str(tmp_path / "model")
    scoring.save_model(model, path)
    asked = fx.unlabeled_documents(spark, sf).select("doc_id", "text", F.lit("x").alias("_row"))
    loaded = scoring.score_with_saved_model(path, asked, "text")
    assert loaded.columns == ["doc_id", "text", "_row", "label"]
    assert rows(loaded) == rows(scoring.label_reviews(model, asked, "text"))
    given = {r["doc_id"]: " ".join(r["words"]) for r in scoring.model_input(path, asked, "text").collect()}
    plain = normalize_text(asked, "text", "n", lemmas)
    assert given == {r["doc_id"]: r["n"] for r in plain.collect()}
    bare = {r["doc_id"]: r["n"] for r in normalize_text(asked, "text", "n").collect()}
    assert given != bare


def test_sparse_cost_equals_the_dense_one(spark, sf):
    rng = np.random.default_rng(1)
    dense = rng.standard_normal((60, 40)) * (rng.random((60, 40)) < 0.2)
    vectors = [Vectors.dense(d) if i % 9 == 0 else Vectors.sparse(40, [(j, x) for j, x in enumerate(d) if x]) for i, d in enumerate(dense)]
    df = spark.createDataFrame([(v,) for v in vectors], ["features"])
    stored = features.stored_as(df, ["features"], VectorUDT.sqlType())
    centres = [dense[0], dense[7] + 0.5, np.zeros(40)]
    got = clusters.sparse_wssse(stored, centres, "features").first()
    want = ((dense[:, None, :] - np.array(centres)[None]) ** 2).sum(-1).min(1)
    assert got["n"] == 60 and got["wssse"] == pytest.approx(want.sum(), rel=1e-9)


def test_cost_of_a_frame_equals_the_dense_one(spark, sf):
    frame = features.model_frames(fx.reviews(spark, sf))[1]
    centres = [frame.train.first()["features"].toArray(), np.full(5000, 0.01)]
    stored = features.stored_as(frame.train.select("features"), ["features"], VectorUDT.sqlType())
    cost = clusters.sparse_wssse(stored, centres, "features")
    data = np.array([r["features"].toArray() for r in frame.train.select("features").collect()])
    want = ((data[:, None, :] - np.array(centres)[None]) ** 2).sum(-1).min(1).sum()
    assert cost.first()["wssse"] == pytest.approx(want, rel=1e-9)
    plan = cost._jdf.queryExecution().executedPlan().toString()
    assert "vector_to_array" not in plan and "UDF" not in plan
