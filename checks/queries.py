"""One Spark query per operator, each over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import fixtures as fx
from reviewlens.functions.split import fold_number, random_split, split_part
from reviewlens.functions.text import normalized_tokens
from reviewlens.operators import bayes, clusters, indexing, metrics, profiles, terms
from reviewlens.operators.folds import stratified_folds
from reviewlens.operators.normalize import normalize_text
from reviewlens.plans import features, models, scoring
from reviewlens.sources import corpus, reviews as review_files
from reviewlens.sources.staging import new_path

Query = Callable[[SparkSession, str], DataFrame]

NB_SMOOTHINGS = models.GRIDS["naive_bayes"]["smoothing"]


# --- sources ---------------------------------------------------------------


def read_labeled_reviews(spark, sf):
    root = new_path(spark, "csv")
    review_files.write_labeled_reviews(fx.reviews(spark, sf), root, "reviews")
    return review_files.read_labeled_reviews(spark, root, "reviews", multi_line=True)


def bad_records(spark, sf):
    """Reviews written with their source in place of the rating, unless it is 1 or 2.

    Texts are written whole, a null one as an empty text, which counts as a field.
    """
    root = new_path(spark, "csv")
    low = F.col("overall") <= 2
    odd = fx.reviews(spark, sf).select(
        "reviewID", "asin", "helpfulPos", "helpfulNeg",
        F.when(low, F.col("overall").cast("string")).otherwise(F.col("asin")).alias("overall"),
        F.coalesce("reviewText", F.lit("")).alias("reviewText"), F.lit("").alias("reviewTime"),
        "reviewerID",
        F.lit("").alias("reviewerName"), F.lit("").alias("summary"), "unixReviewTime", "label",
    )
    odd.write.options(**review_files._CSV_FORMAT).csv(f"{root}/reviews")
    return review_files.bad_records(spark, root, "reviews", multi_line=True)


def null_report(spark, sf):
    columns = [
        "reviewID", "asin", "reviewerID", "reviewText", "helpfulPos", "helpfulNeg", "overall"
    ]
    return review_files.null_report(fx.reviews(spark, sf), columns)


def read_line_corpus(spark, sf):
    return fx.corpora(spark, sf)[0]


def union_corpora(spark, sf):
    return corpus.union_corpora(*fx.corpora(spark, sf))


def contiguous_index(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "lang", "source")
    order = ["lang", F.desc("source"), "doc_id"]
    return indexing.contiguous_index(docs, order)


def contiguous_index_lineitem(spark, sf):
    lines = fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"]
    return indexing.contiguous_index(lines, order)


def running_start(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return indexing.running_start(orders, ["o_orderkey"], "o_custkey", "before")


def corpus_completeness(spark, sf):
    labels = fx.table(spark, sf, "labels").select(
        F.when(F.col("quality") == 1, "t").otherwise("d").alias("class"), "doc_id"
    )
    return corpus.corpus_completeness(labels, unit_col="doc_id")


def class_files_completeness(spark, sf):
    """Entries of a corpus written as text, one per quality and language, and an empty one.

    An entry is the folder of a language, to which every task writes its own file.
    """
    root = new_path(spark, "corpus")
    docs = fx.labeled_documents(spark, sf)
    for quality, name in ((0, "d"), (1, "t")):
        chosen = docs.where(F.col("quality") == quality).select("lang", "text")
        empty = chosen.select(F.lit("none").alias("lang"), F.lit(None).cast("string").alias("text"))
        parts = chosen.unionByName(empty.limit(1))
        parts.write.partitionBy("lang").text(f"{root}/{name}")
    return corpus.class_files(spark, root).groupBy("class").agg(F.count("*").alias("files"))


# --- profiles and rates ----------------------------------------------------


def product_star_profile(spark, sf):
    return profiles.product_star_profile(fx.reviews(spark, sf))


def user_star_profile(spark, sf):
    return profiles.user_star_profile(fx.reviews(spark, sf))


def product_star_profile_lineitem(spark, sf):
    return profiles.product_star_profile(fx.rated_lines(spark, sf), "l_partkey", "rating")


def user_star_profile_lineitem(spark, sf):
    return profiles.user_star_profile(fx.rated_lines(spark, sf), "l_suppkey", "rating")


def full_outer_merge(spark, sf):
    lines = fx.rated_lines(spark, sf)
    per_rating = [
        lines.where(F.col("rating") == k)
        .groupBy("l_partkey")
        .agg(F.count("*").alias(f"n{k}"))
        for k in range(1, 6)
    ]
    total = lines.groupBy("l_partkey").agg(F.count("*").alias("total"))
    return profiles.full_outer_merge([*per_rating, total], "l_partkey")


def user_review_rate(spark, sf):
    return profiles.user_review_rate(fx.reviews(spark, sf), product="asin")


def user_review_rate_orders(spark, sf):
    return profiles.user_review_rate(fx.order_times(spark, sf), "o_custkey", "seconds")


def user_review_rate_events(spark, sf):
    return profiles.user_review_rate(fx.event_times(spark, sf), "user_id", "seconds")


def top_reviewers_by_rate(spark, sf):
    return profiles.top_reviewers_by_rate(user_review_rate(spark, sf), 10)


def top_reviewers_by_rate_orders(spark, sf):
    rates = user_review_rate_orders(spark, sf)
    return profiles.top_reviewers_by_rate(rates, 100, "o_custkey")


def attach_profiles(spark, sf):
    return profiles.attach_profiles(fx.reviews(spark, sf))


def attach_profiles_lineitem(spark, sf):
    lines = fx.identified_lines(spark, sf)
    return profiles.attach_profiles(lines, "l_partkey", "l_suppkey", "rating", "line")


# --- text and features -----------------------------------------------------


def text_shape(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", "text")
    return features.text_shape(docs, "text").drop("text")


def text_shape_conversations(spark, sf):
    turns = fx.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return features.text_shape(turns, "text").drop("text")


def feature_table(spark, sf):
    return features.feature_table(fx.reviews(spark, sf))


def features_as_text(spark, sf):
    return features.features_as_text(feature_table(spark, sf))


def normalize_text_documents(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", "text")
    return normalize_text(docs, "text").drop("text")


def normalize_text_lemmas(spark, sf):
    docs = fx.documents(spark, sf).select("doc_id", "text")
    lemmas = fx.lemma_table(spark, sf)
    return normalize_text(docs, "text", lemmas=lemmas).drop("text")


def normalize_text_lemma_join(spark, sf):
    """Conversation turns, with the lemmas of the documents."""
    turns = fx.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return normalize_text(turns, "text", lemmas=fx.lemma_table(spark, sf)).drop("text")


def normalize_text_repeated_ids(spark, sf):
    """Ten ids for all documents, and none for some: rows stay apart."""
    few = F.when(F.col("doc_id") % 11 > 0, F.col("doc_id") % 10).alias("few")
    docs = fx.documents(spark, sf).select(few, "text")
    return normalize_text(docs, "text", lemmas=fx.lemma_table(spark, sf)).drop("text")


def text_only_frame(spark, sf):
    frames = features.text_frames(fx.reviews(spark, sf))
    return features.text_only_frame(frames)


def text_features_frame(spark, sf):
    frames = features.text_frames(fx.reviews(spark, sf))
    return features.text_features_frame(frames)


def hashing_tf(spark, sf):
    """Hashed counts keep the number of tokens of every review."""
    counted = features.hashed_counts(text_only_frame(spark, sf))
    total = F.aggregate(vector_to_array("rawFeatures"), F.lit(0.0), lambda a, b: a + b)
    return counted.select("reviewID", total.cast("bigint").alias("n_tokens"))


def idf_frames(spark, sf):
    """Hashed TF-IDF rows of both frames: part, fold and number of weights."""
    nonzero = F.size(F.filter(vector_to_array("features"), lambda x: x != 0))
    frames = features.model_frames(fx.reviews(spark, sf))
    rows = [
        f.rows.select(
            F.lit(f.dataset).alias("dataset"), "reviewID", "label", "part", "fold",
            nonzero.alias("n_weights"),
        )
        for f in frames
    ]
    return rows[0].unionByName(rows[1])


def _review_words(spark, sf):
    return fx.reviews(spark, sf).where("reviewText is not null").select(
        "reviewID", "reviewText"
    )


def term_counts(spark, sf):
    words = normalized_tokens("reviewText")
    return terms.term_counts(_review_words(spark, sf), "reviewID", words)


def document_frequency(spark, sf):
    return terms.document_frequency(term_counts(spark, sf))


def tfidf_terms(spark, sf):
    words = normalized_tokens("reviewText")
    weighted = terms.tfidf_terms(_review_words(spark, sf), "reviewID", words)
    return weighted.withColumn("weight", F.round("weight", 6))


def random_split_documents(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id", "lang")
    train, test = random_split(docs, "doc_id")
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )


def cross_validation_folds(spark, sf):
    labels = fx.table(spark, sf, "labels")
    return labels.select("doc_id", fold_number("doc_id", features.FOLDS).alias("fold"))


def stratified_folds_labels(spark, sf):
    labels = fx.table(spark, sf, "labels").select("doc_id", "quality")
    return stratified_folds(labels, "doc_id", "quality", features.FOLDS)


# --- naive Bayes in relational form, metrics, clusters ---------------------


def nb_aggregates(spark, sf):
    table = bayes.nb_aggregates(bayes.bayes_weights(fx.reviews(spark, sf)))
    return table.withColumns(
        {"weight_sum": F.round("weight_sum", 6), "theta": F.round("theta", 6)}
    )


def nb_priors(spark, sf):
    labels = fx.reviews(spark, sf).select(F.col("reviewID").alias("id"), "label")
    priors = bayes.nb_priors(labels.where(split_part("id") == 0))
    return priors.withColumn("pi", F.round("pi", 9))


def nb_predict(spark, sf):
    scores = {c: F.round(c, 4) for c in ("score0", "score1")}
    return bayes.nb_split_predict(fx.reviews(spark, sf)).withColumns(scores)


def nb_predict_unsmoothed(spark, sf):
    """Predictions without smoothing, and how many classes have a finite score."""
    found = bayes.nb_split_predict(fx.reviews(spark, sf), smoothing=0.0)
    finite = [(F.abs(c) < float("inf")).cast("int") for c in ("score0", "score1")]
    return found.select("id", (finite[0] + finite[1]).alias("n_finite"), "prediction")


def _cv_weights(spark, sf):
    fold = fold_number("reviewID", features.FOLDS)
    return bayes.bayes_weights(fx.reviews(spark, sf), fold=fold)


def nb_cv_predictions(spark, sf):
    """Every training row scored without its fold, for every smoothing of the grid."""
    found = bayes.nb_fold_predictions(_cv_weights(spark, sf), features.FOLDS, NB_SMOOTHINGS)
    return found.select("id", "fold", "label", "smoothing", "prediction")


def nb_cv_relational(spark, sf):
    """Mean accuracy over the folds for every smoothing of the grid."""
    grid = bayes.nb_grid(_cv_weights(spark, sf), features.FOLDS, NB_SMOOTHINGS)
    return grid.withColumn("accuracy", F.round("accuracy", 9))


def nb_cv_metrics(spark, sf):
    """Smoothing chosen over the folds, fitted on the training part, metrics of the rest."""
    reviews = fx.reviews(spark, sf)
    weights = _cv_weights(spark, sf)
    grid = bayes.nb_grid(weights, features.FOLDS, NB_SMOOTHINGS)
    best = bayes.best_smoothing(grid, NB_SMOOTHINGS)
    priors = bayes.nb_priors(reviews.where(split_part("reviewID") == 0), best)
    test = weights.where("part = 1").select("id", "term", "weight")
    labels = reviews.select(F.col("reviewID").alias("id"), "label")
    predicted = bayes.nb_predict(weights, test, priors, best).join(labels, "id")
    report = metrics.classification_metrics(predicted)
    return report.select("metric", F.round("value", 9).alias("value"), F.lit(best).alias("smoothing"))


def nb_split_metrics(spark, sf):
    """Relational naive Bayes from reviews to metrics."""
    reviews = fx.reviews(spark, sf)
    labels = reviews.select(F.col("reviewID").alias("id"), "label")
    report = metrics.classification_metrics(bayes.nb_split_predict(reviews).join(labels, "id"))
    return report.withColumn("value", F.round("value", 9))


def classification_metrics(spark, sf):
    labels = fx.table(spark, sf, "labels")
    report = metrics.classification_metrics(labels, "quality", "toxic")
    return report.withColumn("value", F.round("value", 9))


def classification_metrics_languages(spark, sf):
    """Many classes: the language of a document against that of its neighbour."""
    names = F.array(*[F.lit(x) for x in ("en", "de", "fr", "es")])
    docs = fx.table(spark, sf, "documents").select("doc_id", "lang")
    other = docs.select((F.col("doc_id") + 1).alias("doc_id"), F.col("lang").alias("guess"))
    pairs = docs.join(other, "doc_id").select(
        F.array_position(names, F.col("lang")).alias("label"),
        F.array_position(names, F.col("guess")).alias("prediction"),
    )
    report = metrics.classification_metrics(pairs)
    return report.withColumn("value", F.round("value", 9))


def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(fx.table(spark, sf, "labels"), "quality", "toxic")


def wssse(spark, sf):
    vectors = fx.table(spark, sf, "embeddings")
    # Two centres are the whole model state.
    centres = [
        vectors.where(F.col("vec_id") == i).first()["embedding"] for i in (0, 1)
    ]
    cost = clusters.wssse(vectors, centres, "embedding")
    return cost.withColumn("wssse", F.round("wssse", 6))


def majority_labels(spark, sf):
    labels = fx.table(spark, sf, "labels")
    return clusters.majority_labels(labels, "quality", "toxic")


def string_index(spark, sf):
    return indexing.string_index(fx.table(spark, sf, "documents"), "source")


def string_index_terms(spark, sf):
    words = term_counts(spark, sf)
    return indexing.string_index(words, "term")


# --- learners --------------------------------------------------------------


def _frames(spark, sf):
    return features.model_frames(fx.reviews(spark, sf))


def nb_train_eval(spark, sf):
    return models.nb_train_eval(_frames(spark, sf))


def kmeans_train_eval(spark, sf):
    return models.kmeans_train_eval(_frames(spark, sf))


def kmeans_train_eval_aligned(spark, sf):
    return models.kmeans_train_eval(_frames(spark, sf), align="majority")


def rf_train_eval(spark, sf):
    return models.rf_train_eval(_frames(spark, sf))


def lsvc_train_eval(spark, sf):
    return models.lsvc_train_eval(_frames(spark, sf))


def mlp_train_eval(spark, sf):
    return models.mlp_train_eval(_frames(spark, sf))


def nb_cv(spark, sf):
    return models.nb_cv(_frames(spark, sf))


def kmeans_cv(spark, sf):
    return models.kmeans_cv(_frames(spark, sf))


def rf_cv(spark, sf):
    return models.rf_cv(_frames(spark, sf))


def metrics_report(spark, sf):
    """All eight runs on both frames, written and read back."""
    return models.run_all(_frames(spark, sf), new_path(spark, "report"))


def corpus_mlp_train_eval(spark, sf):
    lines = corpus.union_corpora(*fx.corpora(spark, sf))
    return scoring.train_corpus_model(lines)[1]


def _saved_model(spark, sf):
    lines = corpus.union_corpora(*fx.corpora(spark, sf))
    model, _ = scoring.train_corpus_model(lines)
    path = new_path(spark, "model")
    scoring.save_model(model, path)
    return model, path


def save_model(spark, sf):
    """The model read back labels every document as the fitted one does."""
    model, path = _saved_model(spark, sf)
    docs = fx.unlabeled_documents(spark, sf).select("doc_id", "text")
    fresh = scoring.label_reviews(model, docs, "text").select(
        "doc_id", F.col("label").alias("fresh")
    )
    loaded = scoring.score_with_saved_model(path, docs, "text")
    same = F.col("fresh") == F.col("label")
    return loaded.join(fresh, "doc_id").select("doc_id", same.alias("same"))


def score_with_saved_model(spark, sf):
    _, path = _saved_model(spark, sf)
    docs = fx.unlabeled_documents(spark, sf).select("doc_id", "source", "text")
    return scoring.score_with_saved_model(path, docs, "text").drop("text")


def saved_model_tokens(spark, sf):
    """What a model saved with its lemma table is given of every unlabelled document."""
    lines = corpus.union_corpora(*fx.corpora(spark, sf))
    lemmas = fx.lemma_table(spark, sf)
    model, _ = scoring.train_corpus_model(lines, "naive_bayes", lemmas=lemmas)
    path = new_path(spark, "model")
    scoring.save_model(model, path)
    docs = fx.unlabeled_documents(spark, sf).select("doc_id", "text")
    given = scoring.model_input(path, docs, "text")
    return given.select("doc_id", F.array_join("words", " ").alias("normalized"))


def saved_model_class_counts(spark, sf):
    """Lines of each class that the saved model was trained on, out of its own priors."""
    lines = corpus.union_corpora(*fx.corpora(spark, sf))
    model, _ = scoring.train_corpus_model(lines, "naive_bayes")
    path = new_path(spark, "model")
    scoring.save_model(model, path)
    fitted = scoring.PipelineModel.load(path).stages
    # ln((n + 1) / (N + 2)) of either class, with N from the sum of both.
    shares = [float(x) for x in fitted[-1].pi.toArray()]
    return spark.createDataFrame([(fitted[3].numDocs, *shares)], "n_docs bigint, pi0 double, pi1 double").select(
        "n_docs", F.round("pi0", 9).alias("pi0"), F.round("pi1", 9).alias("pi1")
    )


def string_index_applied(spark, sf):
    """Every document with the number of its source; a source without one is an error."""
    docs = fx.documents(spark, sf).select("doc_id", "source")
    return indexing.apply_index(docs, "source", indexing.string_index(docs, "source"))


def string_index_kept(spark, sf):
    """Sources of documents numbered by those of labelled ones, the rest behind them."""
    known = fx.labeled_documents(spark, sf).where("doc_id % 3 = 0").select("source")
    docs = fx.documents(spark, sf).select("doc_id", "source")
    return indexing.apply_index(docs, "source", indexing.string_index(known, "source"), unseen="keep")


QUERIES: dict[str, Query] = {
    "read_labeled_reviews": read_labeled_reviews,
    "bad_records": bad_records,
    "null_report": null_report,
    "read_line_corpus": read_line_corpus,
    "union_corpora": union_corpora,
    "contiguous_index": contiguous_index,
    "contiguous_index_lineitem": contiguous_index_lineitem,
    "running_start": running_start,
    "corpus_completeness": corpus_completeness,
    "class_files_completeness": class_files_completeness,
    "product_star_profile": product_star_profile,
    "user_star_profile": user_star_profile,
    "product_star_profile_lineitem": product_star_profile_lineitem,
    "user_star_profile_lineitem": user_star_profile_lineitem,
    "full_outer_merge": full_outer_merge,
    "user_review_rate": user_review_rate,
    "user_review_rate_orders": user_review_rate_orders,
    "user_review_rate_events": user_review_rate_events,
    "top_reviewers_by_rate": top_reviewers_by_rate,
    "top_reviewers_by_rate_orders": top_reviewers_by_rate_orders,
    "attach_profiles": attach_profiles,
    "attach_profiles_lineitem": attach_profiles_lineitem,
    "text_shape": text_shape,
    "text_shape_conversations": text_shape_conversations,
    "feature_table": feature_table,
    "features_as_text": features_as_text,
    "normalize_text": normalize_text_documents,
    "normalize_text_lemmas": normalize_text_lemmas,
    "normalize_text_lemma_join": normalize_text_lemma_join,
    "normalize_text_repeated_ids": normalize_text_repeated_ids,
    "text_only_frame": text_only_frame,
    "text_features_frame": text_features_frame,
    "hashing_tf": hashing_tf,
    "idf_frames": idf_frames,
    "term_counts": term_counts,
    "document_frequency": document_frequency,
    "tfidf_terms": tfidf_terms,
    "random_split": random_split_documents,
    "cross_validation_folds": cross_validation_folds,
    "stratified_folds": stratified_folds_labels,
    "nb_aggregates": nb_aggregates,
    "nb_priors": nb_priors,
    "nb_predict": nb_predict,
    "nb_predict_unsmoothed": nb_predict_unsmoothed,
    "nb_cv_predictions": nb_cv_predictions,
    "nb_cv_relational": nb_cv_relational,
    "nb_cv_metrics": nb_cv_metrics,
    "nb_split_metrics": nb_split_metrics,
    "classification_metrics": classification_metrics,
    "classification_metrics_languages": classification_metrics_languages,
    "confusion_matrix": confusion_matrix,
    "wssse": wssse,
    "majority_labels": majority_labels,
    "string_index": string_index,
    "string_index_terms": string_index_terms,
    "nb_train_eval": nb_train_eval,
    "kmeans_train_eval": kmeans_train_eval,
    "kmeans_train_eval_aligned": kmeans_train_eval_aligned,
    "rf_train_eval": rf_train_eval,
    "lsvc_train_eval": lsvc_train_eval,
    "mlp_train_eval": mlp_train_eval,
    "nb_cv": nb_cv,
    "kmeans_cv": kmeans_cv,
    "rf_cv": rf_cv,
    "metrics_report": metrics_report,
    "corpus_mlp_train_eval": corpus_mlp_train_eval,
    "save_model": save_model,
    "score_with_saved_model": score_with_saved_model,
    "saved_model_tokens": saved_model_tokens,
    "saved_model_class_counts": saved_model_class_counts,
    "string_index_applied": string_index_applied,
    "string_index_kept": string_index_kept,
}
