"""Within-cluster cost and alignment of cluster ids with labels."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def squared_distance(vector: Column, centre: Sequence[float]) -> Column:
    """Squared Euclidean distance of an array column to a fixed centre."""
    # One JSON literal is folded to an array at planning time.
    text = json.dumps([float(x) for x in centre])
    point = F.from_json(F.lit(text), "array<double>")
    squares = F.zip_with(vector, point, lambda x, c: (x - c) * (x - c))
    return F.aggregate(squares, F.lit(0.0), lambda total, square: total + square)


def wssse(
    df: DataFrame, centres: Sequence[Sequence[float]], vector: str | Column
) -> DataFrame:
    """(n, wssse): summed squared distance of each row to its nearest centre.

    ``vector`` is an array column; the centres are model state (k * d numbers).
    """
    vector = F.col(vector) if isinstance(vector, str) else vector
    distances = [squared_distance(F.col("_v"), centre) for centre in centres]
    nearest = F.array_min(F.array(*distances))
    return df.select(vector.cast("array<double>").alias("_v")).agg(
        F.count("_v").alias("n"), F.sum(nearest).alias("wssse")
    )


def _product(point: Column) -> Column:
    """Inner product of the entries ``_e`` with a point."""
    return F.aggregate("_e", F.lit(0.0), lambda total, e: total + e["x"] * F.get(point, e["i"]))


def sparse_wssse(
    df: DataFrame, centres: Sequence[Sequence[float]], vector: str
) -> DataFrame:
    """`wssse` of vectors in stored form, a struct of type, size, indices and values.

    |x|^2 - 2 x.c + |c|^2 needs the entries of a vector only, however wide it is; a
    difference below 0, which only rounding can give, counts as 0.
    """
    kept = F.col(vector)
    # A dense vector is stored without indices.
    places = F.coalesce(kept["indices"], F.sequence(F.lit(0), F.size(kept["values"]) - 1))
    entries = df.select(
        F.arrays_zip(places.alias("i"), kept["values"].alias("x")).alias("_e"), kept["values"].alias("_x")
    )
    squares = F.aggregate("_x", F.lit(0.0), lambda total, x: total + x * x)
    distances = []
    for centre in centres:
        centre = [float(c) for c in centre]
        point = F.from_json(F.lit(json.dumps(centre)), "array<double>")
        distances.append(squares - 2 * _product(point) + sum(c * c for c in centre))
    nearest = F.greatest(F.array_min(F.array(*distances)), F.lit(0.0))
    return entries.agg(F.count("_x").alias("n"), F.sum(nearest).alias("wssse"))


def majority_labels(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """(prediction, aligned): most frequent label per cluster, lower label on ties.

    Rows are counted per (cluster, label) first, so the window only ranks the
    labels of a cluster.
    """
    counts = predictions.groupBy(prediction, label).agg(F.count("*").alias("n"))
    order = Window.partitionBy(prediction).orderBy(F.desc("n"), F.col(label))
    ranked = counts.withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") == 1).select(
        F.col(prediction), F.col(label).cast("double").alias("aligned")
    )
