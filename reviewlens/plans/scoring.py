"""A line corpus to a saved model, and a saved model to labelled reviews."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.sql import DataFrame, functions as F

from reviewlens.operators.metrics import classification_metrics
from reviewlens.operators.normalize import TextNormalizer
from reviewlens.plans.features import corpus_frame
from reviewlens.plans.models import LEARNERS, check_classes, kept, predict, report_rows
from reviewlens.schema import HASH_FEATURES, STOP_WORDS


def train_corpus_model(
    corpus: DataFrame,
    learner: str = "perceptron",
    stop: Iterable[str] = STOP_WORDS,
    lemmas: DataFrame | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Model from raw text to label, and its metrics on the test part.

    The model holds every stage from normalisation to classifier and the lemma table, so
    scoring needs nothing but the saved folder and a text column ``value``.
    """
    frame = corpus_frame(corpus, stop=stop, lemmas=lemmas)
    with kept(frame.train.select("label", "features")) as train:
        check_classes(train)
        classifier = LEARNERS[learner]().fit(train)
    metrics = classification_metrics(predict(classifier, frame.test))
    stages = [
        TextNormalizer(inputCol="value", outputCol="text", stop=list(stop), lemmas=lemmas),
        Tokenizer(inputCol="text", outputCol="words"),
        HashingTF(numFeatures=HASH_FEATURES, inputCol="words", outputCol="rawFeatures"),
        frame.idf,
        classifier,
    ]
    return PipelineModel(stages), report_rows(metrics, learner, "plain", frame.dataset)


def save_model(model: PipelineModel, path: str) -> None:
    """Write the fitted stages, replacing what is there."""
    model.write().overwrite().save(path)


def label_reviews(model: PipelineModel, df: DataFrame, text: str) -> DataFrame:
    """All columns of ``df`` and the predicted ``label``; rows without text drop out."""
    keep = [c for c in df.columns if c != "label"]
    raw = df.where(F.col(text).isNotNull()).select(
        F.struct(*keep).alias("_fields"), F.col(text).alias("value")
    )
    return model.transform(raw).select(
        "_fields.*", F.col("prediction").cast("double").alias("label")
    )


def score_with_saved_model(path: str, df: DataFrame, text: str) -> DataFrame:
    """Label ``df`` with the model saved at ``path``."""
    return label_reviews(PipelineModel.load(path), df, text)


def model_input(path: str, df: DataFrame, text: str) -> DataFrame:
    """All columns of ``df`` and ``words``: the tokens that the saved model is given."""
    stages = PipelineModel.load(path).stages
    rows = df.where(F.col(text).isNotNull()).select(
        F.struct(*df.columns).alias("_fields"), F.col(text).alias("value")
    )
    for stage in stages[:2]:
        rows = stage.transform(rows)
    return rows.select("_fields.*", "words")
