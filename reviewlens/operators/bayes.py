"""Multinomial naive Bayes from relational sufficient statistics.

Without smoothing a term that a class lacks has log probability -inf there. Sums follow
the rules of floating-point numbers, in which a weight of 0 times -inf is not a number:
the class of largest score is predicted, the first one on equal scores, hence where every
class has -inf, and also where any score is not a number.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.functions.split import split_part
from reviewlens.functions.text import normalized_tokens
from reviewlens.operators.lookup import lookup_join
from reviewlens.operators.terms import term_counts, tfidf_terms
from reviewlens.schema import CLASSES
from reviewlens.sources.staging import stage


def _ln(value: Column) -> Column:
    """Natural logarithm, -inf at 0."""
    return F.when(value == 0, F.lit(float("-inf"))).otherwise(F.log(value))


def _predicted(scores: Sequence[Column], classes: Sequence[float]) -> Column:
    """The class of largest score by the rules above."""
    best, label = scores[0], F.lit(float(classes[0]))
    for score, name in zip(scores[1:], classes[1:]):
        label = F.when(score > best, F.lit(float(name))).otherwise(label)
        best = F.greatest(best, score)
    undefined = reduce(or_, [F.isnan(s) for s in scores])
    return F.when(undefined, F.lit(float(classes[0]))).otherwise(label)


def nb_priors(
    labels: DataFrame, smoothing: float = 1.0, classes: Sequence[float] = CLASSES
) -> DataFrame:
    """(label, n, pi) with pi = ln(n_c + s) - ln(N + C * s)."""
    total = labels.agg(F.count_if(F.col("label").isin(list(classes)))).scalar()
    pi = F.log(F.col("n") + smoothing) - F.log(total + len(classes) * smoothing)
    return (
        labels.where(F.col("label").isin(list(classes)))
        .groupBy("label")
        .agg(F.count("*").alias("n"))
        .select("label", "n", pi.alias("pi"))
    )


def _weight_sums(weights: DataFrame, classes: Sequence[float]) -> DataFrame:
    """(term, df, s0, s1, …): weight of the term in training rows of each class.

    ``weights`` holds (id, term, df, weight, label); rows outside the training
    part carry a null label and only keep their terms in the vocabulary.
    """
    sums = [
        F.sum(F.when(F.col("label") == c, F.col("weight")).otherwise(0.0)).alias(f"s{i}")
        for i, c in enumerate(classes)
    ]
    return weights.groupBy("term").agg(F.max("df").alias("df"), *sums)


def _theta(sums: DataFrame, smoothing: float, n_classes: int) -> DataFrame:
    """Add theta0, theta1, … = ln(S_ct + s) - ln(S_c + V * s), from one aggregate."""
    masses = F.array(*[F.sum(f"s{i}") + F.count("*") * smoothing for i in range(n_classes)])
    total = sums.agg(masses).scalar()
    return sums.withColumns(
        {
            f"theta{i}": _ln(F.col(f"s{i}") + smoothing) - _ln(total[i])
            for i in range(n_classes)
        }
    )


def bayes_weights(
    reviews: DataFrame,
    row_id: str = "reviewID",
    text: str = "reviewText",
    label: str = "label",
    part: Column | None = None,
    fold: Column | None = None,
) -> DataFrame:
    """(id, term, tf, df, weight, part, label) of all reviews with text, staged.

    Part 0 is for training; the label is null outside it. The label travels with
    the terms of its row, and the terms are counted once. ``fold`` adds that column.
    """
    part = split_part(row_id) if part is None else part
    extra = {"part": part, "label": F.when(part == 0, F.col(label))}
    if fold is not None:
        extra["fold"] = fold
    rows = reviews.where(F.col(text).isNotNull()).select(
        row_id, text, *(c.alias(n) for n, c in extra.items())
    )
    carry = list(extra)
    words = normalized_tokens(text)
    counts = stage(term_counts(rows, row_id, words, carry), "counts")
    weights = tfidf_terms(rows, row_id, words, counts, carry)
    return stage(weights.select("id", "term", "tf", "df", "weight", *carry), "weights")


def nb_aggregates(
    weights: DataFrame, smoothing: float = 1.0, classes: Sequence[float] = CLASSES
) -> DataFrame:
    """(label, term, weight_sum, theta) for every class and vocabulary term."""
    model = _theta(_weight_sums(weights, classes), smoothing, len(classes))
    cells = [
        F.struct(
            F.lit(float(c)).alias("label"),
            F.col(f"s{i}").alias("weight_sum"),
            F.col(f"theta{i}").alias("theta"),
        )
        for i, c in enumerate(classes)
    ]
    return model.select("term", F.inline(F.array(*cells))).select(
        "label", "term", "weight_sum", "theta"
    )


def nb_predict(
    weights: DataFrame,
    test: DataFrame,
    priors: DataFrame,
    smoothing: float = 1.0,
    classes: Sequence[float] = CLASSES,
) -> DataFrame:
    """(id, score0, score1, …, prediction) for the rows of ``test``.

    ``test`` holds (id, term, weight). Each term is scored for all classes in
    one join; on equal scores the first class wins.
    """
    model = _theta(_weight_sums(weights, classes), smoothing, len(classes))
    thetas = [f"theta{i}" for i in range(len(classes))]
    # Every row of weights is one document of its term.
    documents = weights.agg(F.count("term")).scalar()
    scored = lookup_join(
        test, model.select("term", "df", *thetas), "term", "df", total=documents
    )
    pi = [
        priors.where(F.col("label") == c).agg(F.max("pi")).scalar() for c in classes
    ]
    scores = [
        (F.sum(F.col("weight") * F.col(t)) + p).alias(f"score{i}")
        for i, (t, p) in enumerate(zip(thetas, pi))
    ]
    names = [f"score{i}" for i in range(len(classes))]
    label = _predicted([F.col(n) for n in names], classes)
    return (
        scored.groupBy("id").agg(*scores).select("id", *names, label.alias("prediction"))
    )


def nb_split_predict(reviews: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """Reviews to predictions: train on part 0, score part 1 of the random split."""
    weights = bayes_weights(reviews)
    priors = nb_priors(reviews.where(split_part("reviewID") == 0), smoothing)
    test = weights.where("part = 1").select("id", "term", "weight")
    return nb_predict(weights, test, priors, smoothing)


def fold_sums(
    weights: DataFrame, folds: int, classes: Sequence[float] = CLASSES
) -> DataFrame:
    """(term, df, idf, t0, t1, …): array ``t_i`` has the count of class i in each fold.

    One aggregate serves every fold and smoothing: what a model is trained on without
    a fold is the sum of the array minus the fold's cell. Counts are whole numbers, so
    that a term seen in no other fold has exactly nothing left.
    """
    cells = {
        f"t{i}": F.array(
            *[
                F.sum(F.when((F.col("label") == c) & (F.col("fold") == f), F.col("tf")).otherwise(0))
                for f in range(folds)
            ]
        )
        for i, c in enumerate(classes)
    }
    idf = F.max(F.col("weight") / F.col("tf"))
    return weights.groupBy("term").agg(
        F.max("df").alias("df"), idf.alias("idf"), *(c.alias(n) for n, c in cells.items())
    )


def _array(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _log(value: float) -> float:
    return math.log(value) if value > 0 else -math.inf


def nb_fold_predictions(
    weights: DataFrame,
    folds: int,
    smoothings: Sequence[float],
    classes: Sequence[float] = CLASSES,
) -> DataFrame:
    """(id, fold, label, smoothing, score0, score1, …, prediction) of all training rows.

    Each row is scored by the model of all folds but its own, for every smoothing, in
    one join and one aggregate. ``weights`` is that of `bayes_weights` with folds. To
    the driver come one sum per class and fold, and the number of terms.
    """
    terms = stage(fold_sums(weights, folds, classes), "fold-sums")
    k = range(len(classes))
    rest = [f"transform(t{i}, x -> aggregate(t{i}, 0L, (a, b) -> a + b) - x) as r{i}" for i in k]
    terms = terms.selectExpr("term", "df", "idf", *rest)
    masses = [
        F.sum(F.col("idf") * F.get(f"r{i}", F.lit(f))).alias(f"m{i}_{f}") for i in k for f in range(folds)
    ]
    total = terms.agg(F.count("*").alias("terms"), *masses).first()
    mass = [[total[f"m{i}_{f}"] or 0.0 for f in range(folds)] for i in k]

    training = weights.where((F.col("part") == 0) & F.col("label").isin(list(classes)))
    by_cell = training.select("id", "label", "fold").distinct().groupBy("label", "fold")
    found = {(r["label"], r["fold"]): r["n"] for r in by_cell.agg(F.count("*").alias("n")).collect()}
    own = [[found.get((float(c), f), 0) for f in range(folds)] for c in classes]
    left = [[sum(row) - n for n in row] for row in own]

    documents = weights.agg(F.count("term")).scalar()
    rows = training.select("id", "term", "weight", "label", "fold")
    joined = lookup_join(rows, terms, "term", "df", total=documents)
    fold = F.col("fold")
    sums, scores = [], []
    for j, s in enumerate(smoothings):
        for i in k:
            log_mass = _array([_log(m + s * total["terms"]) for m in mass[i]])
            theta = _ln(F.col("idf") * F.get(f"r{i}", fold) + s) - F.get(log_mass, fold)
            sums.append(F.sum(F.col("weight") * theta).alias(f"_s{j}_{i}"))
    summed = joined.groupBy("id", "fold", "label").agg(*sums)
    for j, s in enumerate(smoothings):
        cells = []
        for i in k:
            logs = [
                _log(left[i][f] + s) - _log(sum(c[f] for c in left) + len(classes) * s) for f in range(folds)
            ]
            cells.append((F.col(f"_s{j}_{i}") + F.get(_array(logs), fold)).alias(f"score{i}"))
        scores.append(F.struct(F.lit(float(s)).alias("smoothing"), *cells))
    names = [f"score{i}" for i in k]
    out = summed.select("id", "fold", "label", F.inline(F.array(*scores)))
    return out.withColumn("prediction", _predicted([F.col(n) for n in names], classes))


def nb_grid(
    weights: DataFrame,
    folds: int,
    smoothings: Sequence[float],
    classes: Sequence[float] = CLASSES,
) -> DataFrame:
    """(smoothing, accuracy): mean accuracy over the folds that hold rows."""
    scored = nb_fold_predictions(weights, folds, smoothings, classes)
    hit = F.avg((F.col("label") == F.col("prediction")).cast("double"))
    per_fold = scored.groupBy("smoothing", "fold").agg(hit.alias("accuracy"))
    return per_fold.groupBy("smoothing").agg(F.avg("accuracy").alias("accuracy"))


def best_smoothing(grid: DataFrame, smoothings: Sequence[float]) -> float:
    """The smoothing of best accuracy, the first one tried among equals."""
    found = {r["smoothing"]: r["accuracy"] for r in grid.collect()}
    return max(smoothings, key=lambda s: found.get(float(s), -1.0))
