"""The perceptron without hidden layer, fitted on sparse rows."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

# Executors need not have this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Point = tuple[float, np.ndarray]

# Rows of a chunk, at least; a chunk is a whole number of blocks.
_CHUNK = 2048
_CHUNK_SCHEMA = "labels binary, starts binary, places binary, weights binary"
_PARTIAL_SCHEMA = "blocks bigint, loss double, slope binary"


def _pack(labels: list[int], vectors: list[dict]) -> pa.RecordBatch:
    places = [
        np.arange(v["size"] or len(v["values"])) if v["indices"] is None else np.asarray(v["indices"])
        for v in vectors
    ]
    starts = np.cumsum([0, *(len(p) for p in places)])
    columns = {
        "labels": np.asarray(labels, "int32"),
        "starts": starts.astype("int32"),
        "places": np.concatenate(places).astype("int32"),
        "weights": np.concatenate([np.asarray(v["values"]) for v in vectors]).astype("float64"),
    }
    return pa.RecordBatch.from_pydict({k: [v.tobytes()] for k, v in columns.items()})


def _chunks(rows: int, classes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (label, features) of a partition as sparse chunks of ``rows``, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, vectors = [], []
        for batch in batches:
            for row in batch.to_pylist():
                label = row["label"]
                if label is None or row["features"] is None or label not in range(classes):
                    raise ValueError(f"labels must be 0 to {classes - 1}, and there must be features")
                labels.append(int(label))
                vectors.append(row["features"])
                if len(labels) == rows:
                    yield _pack(labels, vectors)
                    labels, vectors = [], []
        if labels:
            yield _pack(labels, vectors)

    return run


def _slopes(
    weights: np.ndarray, width: int, classes: int, block: int, exact: bool = False
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row per partition: number of blocks, sum of their mean losses and of their gradients."""
    point = weights[: width * classes].reshape(width, classes)
    bias = weights[width * classes :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, loss = 0, 0.0
        slope, bias_slope = np.zeros((width, classes)), np.zeros(classes)
        for chunk in (c for batch in batches for c in batch.to_pylist()):
            labels = np.frombuffer(chunk["labels"], "int32")
            starts = np.frombuffer(chunk["starts"], "int32")
            places = np.frombuffer(chunk["places"], "int32")
            x = np.frombuffer(chunk["weights"], "float64")
            n = len(labels)
            row = np.repeat(np.arange(n), np.diff(starts))
            # A row counts by the size of its block; only the last one may be smaller.
            own = np.arange(n) // block
            share = 1.0 / np.bincount(own)[own]
            score = np.stack(
                [np.bincount(row, x * point[places, k], n) for k in range(classes)], axis=1
            ) + bias
            score -= score.max(axis=1, keepdims=True)
            odds = np.exp(score)
            total = odds.sum(axis=1, keepdims=True)
            guess = odds / total
            target = np.eye(classes)[labels]
            # A probability of 0 makes the loss NaN or infinite, which the search steps back from.
            with np.errstate(divide="ignore", invalid="ignore"):
                logs = score - np.log(total) if exact else np.log(guess)
                loss += float(-(target * logs).sum(axis=1) @ share)
            delta = (guess - target) * share[:, None]
            for k in range(classes):
                slope[:, k] += np.bincount(places, x * delta[row, k], width)
            bias_slope += delta.sum(axis=0)
            blocks += int(own[-1]) + 1
        whole = np.concatenate([slope.ravel(), bias_slope])
        yield pa.RecordBatch.from_pydict({"blocks": [blocks], "loss": [loss], "slope": [whole.tobytes()]})

    return run


def _objective(
    chunks: DataFrame, width: int, classes: int, block: int, exact: bool = False
) -> Callable[[np.ndarray], Point]:
    """Mean loss over the blocks and its gradient, one Spark job per point.

    The driver gets one gradient per partition, never rows. The last point is remembered.
    With ``exact`` the logarithm of a probability is not taken of its rounded value.
    """
    last: list[tuple[np.ndarray, Point]] = []

    def at(weights: np.ndarray) -> Point:
        if last and np.array_equal(last[0][0], weights):
            return last[0][1]
        parts = chunks.mapInArrow(_slopes(weights, width, classes, block, exact), _PARTIAL_SCHEMA)
        blocks, loss, slope = 0, 0.0, np.zeros_like(weights)
        for part in parts.collect():
            blocks += part["blocks"]
            loss += part["loss"]
            slope += np.frombuffer(part["slope"])
        last[:] = [(weights, (loss / blocks, slope / blocks))]
        return last[0][1]

    return at


class _SearchFailed(Exception):
    pass


def _between(left: tuple, right: tuple) -> float:
    """Least point of the cubic through two (step, value, slope), not too near either end."""
    (lt, lv, ls), (rt, rv, rs) = left, right
    d1 = ls + rs - 3 * (lv - rv) / (lt - rt)
    with np.errstate(invalid="ignore", divide="ignore"):
        d2 = np.sqrt(d1 * d1 - ls * rs)
        t = rt - (rt - lt) * (rs + d2 - d1) / (rs - ls + 2 * d2)
    low, high = lt + 0.1 * (rt - lt), lt + 0.9 * (rt - lt)
    return low if t < low else high if t > high else float(t)


def _step_size(along: Callable[[float], tuple], first: float, tries: int = 10) -> float:
    """A step that meets the strong Wolfe conditions (Nocedal and Wright, 3.5 and 3.6)."""
    _, value, slope = low = along(0.0)
    if slope > 0:
        raise _SearchFailed("not a descent direction")

    def too_high(found: tuple) -> bool:
        return found[1] > value + 1e-4 * found[0] * slope

    def zoom(low: tuple, high: tuple) -> float:
        for _ in range(tries):
            found = along(_between(high, low) if low[0] > high[0] else _between(low, high))
            if too_high(found) or found[1] >= low[1]:
                high = found
            else:
                if abs(found[2]) <= 0.9 * abs(slope):
                    return found[0]
                if found[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = found
        raise _SearchFailed("zoom")

    t = first
    for i in range(tries):
        found = along(t)
        if not np.isfinite(found[1]):
            t /= 2
            continue
        if too_high(found) or (found[1] >= low[1] and i > 0):
            return zoom(low, found)
        if abs(found[2]) <= 0.9 * abs(slope):
            return t
        if found[2] >= 0:
            return zoom(found, low)
        low = found
        t *= 1.5
    raise _SearchFailed("no step")


def _descent(slope: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Minus the gradient times the inverse Hessian that the last steps tell."""
    way = slope.copy()
    scale = 1.0
    if history:
        step, change = history[0]
        scale = (step @ change) / (change @ change)
        if not scale >= 0:
            raise _SearchFailed("history")
    shares = []
    for step, change in history:
        shares.append((step @ way) / (step @ change))
        way -= shares[-1] * change
    way *= scale
    for (step, change), share in zip(reversed(history), reversed(shares)):
        way += (share - (change @ way) / (step @ change)) * step
    return -way


def minimize(
    objective: Callable[[np.ndarray], Point], start: np.ndarray,
    steps: int, tolerance: float, memory: int = 10,
) -> np.ndarray:
    """L-BFGS with the stopping rules of MLlib's learners.

    It ends after ``steps``, where the value moves less than ``tolerance`` of the first one
    over twenty steps, at a flat point, or when a search fails twice.
    """
    x = start
    value, slope = objective(x)
    first, recent = value, [np.inf]
    history: list[tuple[np.ndarray, np.ndarray]] = []
    taken, failed = 0, False
    while taken < steps:
        if len(recent) >= 2 and abs(value - max(recent)) <= tolerance * first:
            break
        if np.linalg.norm(slope) <= max(tolerance * value, 1e-8):
            break
        try:
            way = _descent(slope, history)

            def along(t: float) -> tuple[float, float, float]:
                found, gradient = objective(x + way * t)
                return t, found, float(gradient @ way)

            size = _step_size(along, 1.0 if taken else 1.0 / np.linalg.norm(way))
            if size * np.linalg.norm(slope) < 1e-10:
                raise _SearchFailed("step too small")
        except _SearchFailed:
            if failed:
                break
            failed, history = True, []
            continue
        moved = x + way * size
        new_value, new_slope = objective(moved)
        history = [(moved - x, new_slope - slope), *history][:memory]
        x, value, slope = moved, new_value, new_slope
        recent = [*recent, value][-20:]
        taken, failed = taken + 1, False
    return x


class SparsePerceptron(MultilayerPerceptronClassifier):
    """`MultilayerPerceptronClassifier` whose training rows stay sparse.

    MLlib keeps every training row as a dense array, 8 bytes for each of its inputs. With
    layers of input and output only, the loss and its gradient need the entries of a row
    alone, so the rows are kept as sparse chunks. Start weights, blocks, loss, search and
    stopping rules are those of MLlib, and so is the fitted model. With hidden layers, or
    another solver, MLlib fits as it does.

    Where a very long row has a probability that rounds to 0 at the start already, the loss
    is infinite there and MLlib takes no step; here its exact value is taken then.
    """

    def _with_weights(self, spark, weights=None) -> MultilayerPerceptronClassificationModel:
        """The model at ``weights``, or at the start weights, without a step."""
        width, label, features = self.getLayers()[0], self.getLabelCol(), self.getFeaturesCol()
        none = spark.createDataFrame([(0.0, Vectors.sparse(width, {}))], [label, features])
        extra = {self.maxIter: 0}
        if weights is not None:
            extra[self.initialWeights] = Vectors.dense(weights)
        return MultilayerPerceptronClassifier._fit(self.copy(extra), none)

    def _fit(self, dataset: DataFrame) -> MultilayerPerceptronClassificationModel:
        layers = self.getLayers()
        if len(layers) != 2 or self.getSolver() != "l-bfgs":
            return super()._fit(dataset)
        spark, (width, classes), block = dataset.sparkSession, layers, self.getBlockSize()
        rows = dataset.select(
            F.col(self.getLabelCol()).cast("double").alias("label"),
            F.unwrap_udt(self.getFeaturesCol()).alias("features"),
        )
        size = -(-_CHUNK // block) * block
        chunks = rows.mapInArrow(_chunks(size, classes), _CHUNK_SCHEMA).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            start = self._with_weights(spark).weights.toArray()
            objective = _objective(chunks, width, classes, block)
            if not np.isfinite(objective(start)[0]):
                objective = _objective(chunks, width, classes, block, exact=True)
            found = minimize(objective, start, self.getMaxIter(), self.getTol())
        finally:
            chunks.unpersist()
        model = self._with_weights(spark, found)
        model._set(maxIter=self.getMaxIter())
        if not self.isSet(self.initialWeights):
            model.clear(model.initialWeights)
        return model
