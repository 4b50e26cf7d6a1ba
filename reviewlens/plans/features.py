"""Labelled reviews to feature table, text frames and hashed model frames."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml.feature import IDF, HashingTF, IDFModel, Tokenizer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from reviewlens.functions.split import fold_number, split_part
from reviewlens.functions.text import capital_ratio, word_count
from reviewlens.operators.folds import stratified_folds
from reviewlens.operators.normalize import normalize_text
from reviewlens.operators.profiles import attach_for_features
from reviewlens.schema import (
    FEATURE_COLUMNS,
    HASH_FEATURES,
    PRODUCT_STARS,
    SPLIT_WEIGHTS,
    STOP_WORDS,
    TEXT_FEATURE_ORDER,
    USER_STARS,
)
from reviewlens.sources.staging import new_path, stage

# Fixed value: the reference number of cross-validation folds.
FOLDS = 7


def text_shape(df: DataFrame, text: str) -> DataFrame:
    """Add reviewWordCount and capitalLetterRatio of the raw text."""
    return df.withColumns(
        {"reviewWordCount": word_count(text), "capitalLetterRatio": capital_ratio(text)}
    )


def _features(reviews: DataFrame) -> DataFrame:
    """The feature table with the review id in its own type.

    Text is reduced to two numbers before any exchange, so only narrow rows are
    written and joined.
    """
    narrow = text_shape(reviews, "reviewText").select(
        "reviewID",
        "asin",
        "reviewerID",
        (F.col("helpfulPos") - F.col("helpfulNeg")).alias("helpfulness"),
        F.col("overall").alias("rating"),
        "capitalLetterRatio",
        "reviewWordCount",
        "label",
    )
    joined = attach_for_features(
        reviews, narrow, "asin", "reviewerID", "overall", "unixReviewTime"
    )
    names = dict(zip(FEATURE_COLUMNS[5:15], PRODUCT_STARS + USER_STARS))
    names["userReviewRate"] = "reviewRate"
    values = [F.col(names.get(c, c)).cast("double").alias(c) for c in FEATURE_COLUMNS[1:]]
    return joined.select("reviewID", *values)


def feature_table(reviews: DataFrame) -> DataFrame:
    """The 17 numeric features of each review with product and reviewer, all double."""
    return _features(reviews).withColumn("reviewID", F.col("reviewID").cast("double"))


def features_as_text(
    features: DataFrame,
    key: str = "reviewID",
    include_review_rate: bool = False,
    out: str = "featureText",
) -> DataFrame:
    """(key, label, featureText): feature values as blank-separated words.

    The value order has `pstar1` in fifteenth place as well;
    ``include_review_rate`` puts the posting rate there instead.
    """
    order = list(TEXT_FEATURE_ORDER)
    if include_review_rate:
        order[-1] = "userReviewRate"
    # `||` keeps a missing value visible as a null; concat_ws would skip it.
    words = [F.col(c).cast("string") for c in order]
    spaced = [part for word in words for part in (word, F.lit(" "))][:-1]
    return features.select(key, "label", F.concat(*spaced).alias(out))


def text_frames(
    reviews: DataFrame,
    lemmas: DataFrame | None = None,
    stop: Iterable[str] = STOP_WORDS,
    include_review_rate: bool = False,
) -> DataFrame:
    """(reviewID, label, text, featureText) of reviews that have a text.

    ``text`` is the normalised text; the text-and-features document of a review
    is featureText, a blank and text. ``featureText`` is null where a number of the
    review is missing. The id joins both parts, so it must be there and unique.
    """
    check_unique(reviews, "reviewID")
    with_text = reviews.where(F.col("reviewText").isNotNull())
    texts = normalize_text(
        with_text.select("reviewID", "reviewText"), "reviewText", "text", lemmas, stop
    ).select("reviewID", "text")
    features = features_as_text(
        _features(with_text), include_review_rate=include_review_rate
    )
    return texts.join(features, "reviewID")


def text_only_frame(frames: DataFrame) -> DataFrame:
    """(reviewID, label, text) from `text_frames`."""
    return frames.select("reviewID", "label", "text")


def text_features_frame(frames: DataFrame) -> DataFrame:
    """(reviewID, label, text) with the feature words in front of the text.

    Reviews with a missing number are left out; `null_report` counts them.
    """
    frames = frames.where(F.col("featureText").isNotNull())
    text = F.concat("featureText", F.lit(" "), "text")
    return frames.select("reviewID", "label", text.alias("text"))


def hashed_counts(
    df: DataFrame, text: str = "text", out: str = "rawFeatures",
    width: int = HASH_FEATURES,
) -> DataFrame:
    """Add hashed term counts of ``text``."""
    words = Tokenizer(inputCol=text, outputCol="_words").transform(df)
    tf = HashingTF(numFeatures=width, inputCol="_words", outputCol=out)
    return tf.transform(words).drop("_words")


def stored_as(df: DataFrame, vectors: Iterable[str], stored: T.DataType) -> DataFrame:
    """``df`` written and read back with ``vectors`` as columns of type ``stored``.

    A vector is stored as a struct of its type, size, indices and values, so the same
    files can be read with vectors or with the sparse arrays inside them.
    """
    vectors = set(vectors)
    fields = [T.StructField(f.name, stored if f.name in vectors else f.dataType) for f in df.schema]
    path = new_path(df.sparkSession, "hashed")
    df.write.parquet(path)
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def _sum_of(counts: Column, few: Column) -> Column:
    """Sum of two stored sparse vectors, the second with few entries."""
    extra = F.map_from_arrays(few["indices"], few["values"])
    grown = F.transform(
        F.arrays_zip(counts["indices"].alias("i"), counts["values"].alias("v")),
        lambda e: F.struct(e["i"].alias("i"), (e["v"] + F.coalesce(extra[e["i"]], F.lit(0.0))).alias("v")),
    )
    new = F.transform(
        F.filter(few["indices"], lambda i: ~F.array_contains(counts["indices"], i)),
        lambda i: F.struct(i.alias("i"), extra[i].alias("v")),
    )
    # Unlike array_sort, sort_array compares without a lambda for each pair of entries.
    entries = F.sort_array(F.concat(grown, new))
    return F.struct(
        few["type"].alias("type"), few["size"].alias("size"),
        entries["i"].alias("indices"), entries["v"].alias("values"),
    )


@dataclass(frozen=True)
class ModelFrame:
    """Hashed TF-IDF rows (id, label, features, part, fold) and their weighting."""

    dataset: str
    rows: DataFrame
    idf: IDFModel
    # Training rows that are kept for several fits.
    at_hand: DataFrame | None = None

    @property
    def train(self) -> DataFrame:
        return self.rows.where("part = 0")

    @property
    def test(self) -> DataFrame:
        return self.rows.where("part = 1")


def check_unique(df: DataFrame, key: str) -> None:
    """Fail unless ``key`` is present in every row and never repeated."""
    repeated = df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    if not repeated.isEmpty():
        raise ValueError(f"{key} must be unique")
    if not df.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"{key} must not be null")


def class_folds(rows: DataFrame, key: str, folds: int) -> DataFrame:
    """(key, fold) of the training rows of ``rows`` (key, label, part), classes dealt evenly.

    Only narrow rows are sorted, and written to the shared folder.
    """
    training = rows.where("part = 0 and label is not null").select(key, "label")
    return stratified_folds(training, key, "label", folds).select(key, "fold")


def weighted_frame(
    counts: DataFrame,
    key: str,
    dataset: str,
    fit_on: str = "all",
    folds: int = FOLDS,
    split_seed: str | None = None,
) -> ModelFrame:
    """Weight staged hashed counts by inverse document frequency.

    The weighting is fitted on all rows, or with ``fit_on="train"`` on the
    training part only. The part depends on key and seed alone. The folds are the
    column ``fold`` of ``counts`` where it is not null, else they follow from the key.
    """
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be 'all' or 'train'")
    fold = fold_number(key, folds)
    rows = counts.select(
        key,
        F.col("label").cast("double").alias("label"),
        "rawFeatures",
        split_part(key, SPLIT_WEIGHTS, split_seed).alias("part"),
        (F.coalesce("fold", fold) if "fold" in counts.columns else fold).alias("fold"),
    )
    fitted = rows if fit_on == "all" else rows.where("part = 0")
    idf = IDF(inputCol="rawFeatures", outputCol="features").fit(fitted)
    return ModelFrame(dataset, idf.transform(rows).drop("rawFeatures"), idf)


DATASETS = ("text_only", "text_features")


def hashed_frames(
    reviews: DataFrame,
    folds: int = FOLDS,
    independent_splits: bool = False,
    fold_by: str = "class",
    lemmas: DataFrame | None = None,
    stop: Iterable[str] = STOP_WORDS,
    include_review_rate: bool = False,
) -> DataFrame:
    """(reviewID, label, text_only, text_features, fold_…) of reviews with a text, written.

    ``text_only`` and ``text_features`` are hashed counts; the latter is null where a
    number of the review is missing. Texts are hashed where they are read, and the counts
    of the feature words are added after a join by id, so no text passes an exchange
    (with ``lemmas``, only single tokens do). There is a fold column for each frame, null
    outside its training part, unless ``fold_by`` is "key".
    """
    if fold_by not in ("class", "key"):
        raise ValueError("fold_by must be 'class' or 'key'")
    check_unique(reviews, "reviewID")
    with_text = reviews.where(F.col("reviewText").isNotNull())
    texts = normalize_text(
        with_text.select("reviewID", "reviewText"), "reviewText", "text", lemmas, stop
    )
    # An empty text is one empty word, but adds none to the feature words.
    hashed = hashed_counts(texts.select("reviewID", "text", (F.col("text") == "").alias("_empty")), out="text_only")
    sparse = stored_as(hashed.drop("text"), ["text_only"], VectorUDT.sqlType())

    numbers = features_as_text(_features(with_text), include_review_rate=include_review_rate)
    words = numbers.withColumn("_known", F.coalesce("featureText", F.lit("")))
    narrow = stored_as(
        hashed_counts(words, "_known", "_few").select("reviewID", "label", F.col("featureText").isNull().alias("_gap"), "_few"),
        ["_few"], VectorUDT.sqlType(),
    )
    if fold_by == "class":
        kept = narrow
        for name in DATASETS:
            part = split_part("reviewID", SPLIT_WEIGHTS, name if independent_splits else None)
            own = kept if name == DATASETS[0] else kept.where("not _gap")
            dealt = class_folds(own.select("reviewID", "label", part.alias("part")), "reviewID", folds)
            narrow = narrow.join(dealt.withColumnRenamed("fold", f"fold_{name}"), "reviewID", "left")
    else:
        narrow = narrow.withColumns({f"fold_{name}": F.lit(None).cast("int") for name in DATASETS})
    both = F.when(
        ~F.col("_gap"),
        F.when(F.col("_empty"), F.col("_few")).otherwise(_sum_of(F.col("text_only"), F.col("_few"))),
    )
    joined = sparse.join(narrow, "reviewID").select(
        "reviewID", "label", "text_only", both.alias("text_features"), *(f"fold_{n}" for n in DATASETS)
    )
    return stored_as(joined, DATASETS, VectorUDT())


def model_frames(
    reviews: DataFrame,
    fit_on: str = "all",
    folds: int = FOLDS,
    independent_splits: bool = False,
    **options,
) -> list[ModelFrame]:
    """The text-only and the text-and-features frame of labelled reviews.

    Normalised text, joins and hashing are computed once and written to the
    shared folder as sparse counts; fits and evaluations read those. Both frames
    have the same test rows unless ``independent_splits`` is set. Reviews with a
    missing number are in the first frame only. ``options`` are those of `hashed_frames`;
    every fold holds each class that has as many training rows as there are folds.
    """
    staged = hashed_frames(reviews, folds, independent_splits, **options)
    return [
        weighted_frame(
            staged.where(F.col(name).isNotNull()).select(
                "reviewID", "label", F.col(name).alias("rawFeatures"), F.col(f"fold_{name}").alias("fold")
            ),
            "reviewID", name, fit_on, folds, name if independent_splits else None,
        )
        for name in DATASETS
    ]


def corpus_frame(
    corpus: DataFrame, fit_on: str = "all", folds: int = FOLDS,
    stop: Iterable[str] = STOP_WORDS, lemmas: DataFrame | None = None,
) -> ModelFrame:
    """The hashed TF-IDF frame of a labelled line corpus (id, value, label)."""
    lines = corpus.where(F.col("value").isNotNull()).select("id", "label", "value")
    texts = normalize_text(lines, "value", "text", lemmas, stop).select("id", "label", "text")
    counts = stage(hashed_counts(texts).select("id", "label", "rawFeatures"), "hashed")
    narrow = counts.select("id", "label", split_part("id").alias("part"))
    dealt = counts.join(class_folds(narrow, "id", folds), "id", "left")
    return weighted_frame(stage(dealt, "hashed"), "id", "corpus", fit_on, folds)
