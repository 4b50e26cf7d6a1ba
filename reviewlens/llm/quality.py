"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class has a mean, a covariance shrunk towards its diagonal and a prior. The
score is the logistic of the difference of the two log densities, each from a
Mahalanobis distance by the class's Cholesky factor, which is computed once.

Statistics of all labelled training rows are summed where the rows are; one sum per
class reaches the driver. No bound on the training rows is needed.

Defined results: null and empty texts have the statistics of a text without words and
a score; rows without label train nothing, rows whose label is not 0 or 1 neither;
an id with several labels counts once for each; with a class that has no training
row every score is that of the other class; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from reviewlens.llm.common import map_texts, narrow
from reviewlens.sources.staging import stage

FOLDS, HELD_FOLD = 4, 2
THRESHOLD = 0.7
SHRINKAGE = 0.2
# Added to every variance, in units of the variance over all training rows.
RIDGE = 0.05

STATISTICS = (
    "words", "word_length", "long_words", "capitals", "symbols", "digits", "marks",
    "symbol_words", "wordless", "shouted", "repeated_next", "repeated_lines",
    "distinct_words", "pair_reuse", "line_words",
)

_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_LETTER = re.compile(r"[^\W\d_]")
_SYMBOLS = "#*$%&|<>@^~=+_{}[]\\/"
_MARKS = ".,;:!?"


def statistics(text: str) -> list[float]:
    """The transformed statistics of a whole text, in the order of STATISTICS.

    Shares enter as square roots and counts as logarithms, which makes them nearer
    to normal.
    """
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    letters = max(1, len(_LETTER.findall(text)))
    lines = [line for line in text.split("\n") if line.strip()]
    ids: dict[str, int] = {}
    order = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    pairs = order[:-1] * len(ids) + order[1:]
    # A text of n words is expected to repeat some; what counts is more than usual.
    # Constants in denominators keep a single repeat in a short text from weighing much.
    usual = n**0.87
    symbol_words = sum(w[-1] in _SYMBOLS for w in words)
    wordless = sum(not any(c.isalnum() for c in w) for w in words)
    shares = [
        sum(len(w) > 15 for w in words) / n,
        len(_UPPER.findall(text)) / letters,
        sum(map(text.count, _SYMBOLS)) / chars,
        sum(map(text.count, "0123456789")) / chars,
        sum(map(text.count, _MARKS)) / n,
        symbol_words / n,
        wordless / n,
        sum(w.endswith("!!") or (len(w) > 1 and w.isupper()) for w in words) / n,
        float((order[1:] == order[:-1]).sum()) / n,
        (len(lines) - len(set(lines))) / (len(lines) + 8),
    ]
    return [
        float(np.log1p(n)),
        chars / n,
        *np.sqrt(np.minimum(shares, 1.0)).tolist(),
        min(len(ids) / usual, 2.0),
        (n - 1 - len(np.unique(pairs))) / (n + 60),
        float(np.log1p(n / max(1, len(lines)))),
    ]


@dataclass(frozen=True)
class Discriminant:
    """Means, Cholesky factors and log priors of classes 0 and 1."""

    means: list[np.ndarray | None]
    factors: list[np.ndarray | None]
    priors: list[float]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1 for rows of statistics."""
        if self.means[0] is None or self.means[1] is None:
            only = 0.5 if self.means[0] is self.means[1] else float(self.means[1] is not None)
            return np.full(len(rows), only)
        density = []
        for mean, factor, prior in zip(self.means, self.factors, self.priors):
            white = np.linalg.solve(factor, (rows - mean).T)
            half_det = np.log(np.diag(factor)).sum()
            density.append(prior - half_det - 0.5 * (white**2).sum(0))
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -500, 500)))


def described(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, x): the statistics of every whole text, made in one pass."""
    rows = narrow(docs, key, text).withColumn("held_out", held_out(F.col("doc_id")))

    def make():
        return lambda texts: [[statistics(t) for t in texts]]

    return map_texts(rows, make, "x array<double>", ("doc_id", "held_out"))


def _moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """label -> (rows, sum of x, sum of x xᵀ), added up inside the tasks first."""
    size = len(STATISTICS)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: np.zeros((size + 1, size + 1)) for k in (0, 1)}
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            x = np.concatenate([np.ones((len(values), 1)), values], 1)
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            for k, total in sums.items():
                total += x[labels == k].T @ x[labels == k]
        flat = [s.ravel().tolist() for s in sums.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array(flat, pa.list_(pa.float64()))],
            names=["label", "sums"],
        )

    parts = rows.select("x", "label").mapInArrow(partial, "label int, sums array<double>")
    cells = parts.select("label", F.posexplode("sums").alias("cell", "value"))
    # 2 x 256 numbers, whatever the number of rows or tasks.
    summed = cells.groupBy("label", "cell").agg(F.sum("value").alias("value")).collect()
    out = {k: np.zeros((size + 1) ** 2) for k in (0, 1)}
    for row in summed:
        out[row["label"]][row["cell"]] = row["value"]
    square = {k: v.reshape(size + 1, size + 1) for k, v in out.items()}
    return {k: (s[0, 0], s[0, 1:], s[1:, 1:]) for k, s in square.items()}


def fit(training: DataFrame) -> Discriminant:
    """Fit on all rows of ``training`` (x, label) whose label is 0 or 1."""
    moments = _moments(training.where(F.col("label").isin(0, 1)))
    total = sum(m[0] for m in moments.values())
    if not total:
        return Discriminant([None, None], [None, None], [0.0, 0.0])
    mean = sum(m[1] for m in moments.values()) / total
    overall = np.diag(sum(m[2] for m in moments.values())) / total - mean**2
    ridge = RIDGE * np.maximum(overall, 1e-6)
    means, factors, priors = [], [], []
    for k in (0, 1):
        n, first, second = moments[k]
        if not n:
            means.append(None), factors.append(None), priors.append(0.0)
            continue
        centre = first / n
        cov = second / n - np.outer(centre, centre)
        shrunk = (1 - SHRINKAGE) * cov + SHRINKAGE * np.diag(np.diag(cov)) + np.diag(ridge)
        means.append(centre)
        factors.append(np.linalg.cholesky(shrunk))
        priors.append(float(np.log(n / total)))
    return Discriminant(means, factors, priors)


def held_out(key: Column, folds: int = FOLDS, fold: int = HELD_FOLD) -> Column:
    """Whether the remainder of crc32 of the id as text is the one kept from training."""
    number = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return number % folds == fold


def training_rows(rows: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(x, label) of the labelled rows of `described` that are not held out."""
    known = labels.where(F.col(label).isin(0, 1)).select(
        F.col("doc_id").alias("label_id"), F.col(label).cast("int").alias("label")
    )
    own = rows.where(~F.col("held_out"))
    return own.join(known, F.col("doc_id") == F.col("label_id")).select("x", "label")


def score_rows(rows: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `described`."""
    fields = T.StructType.fromDDL("score double, predicted int")
    schema = T.StructType([rows.schema["doc_id"], rows.schema["held_out"], *fields])
    names, size = schema.names, len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            scores = model.score(values.reshape(-1, size))
            columns = [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=names)

    return rows.select("doc_id", "held_out", "x").mapInArrow(run, schema)


def classify_quality(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    The texts are read once: their statistics are written to the shared folder, and
    fitting and scoring read those.
    """
    rows = stage(described(docs), "statistics")
    return score_rows(rows, fit(training_rows(rows, labels, label)))
