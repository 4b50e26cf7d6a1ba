"""Classification metrics from one confusion-matrix aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

# Metric names in report order.
METRICS = ["accuracy", "weightedPrecision", "weightedRecall", "f1"]


def confusion_matrix(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """(label, prediction, n)."""
    return predictions.groupBy(
        F.col(label).cast("double").alias("label"),
        F.col(prediction).cast("double").alias("prediction"),
    ).agg(F.count("*").alias("n"))


def classification_metrics(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """(metric, value): accuracy and the three metrics weighted by class support.

    A class that is never predicted has precision 0. The data is aggregated to
    one row per pair of classes first; all that follows works on those rows.
    """
    cells = confusion_matrix(predictions, label, prediction)
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)
    as_label = F.struct(
        F.col("label").alias("class"),
        F.col("n").alias("support"),
        zero.alias("predicted"),
        hit.alias("hits"),
    )
    as_prediction = F.struct(
        F.col("prediction").alias("class"),
        zero.alias("support"),
        F.col("n").alias("predicted"),
        zero.alias("hits"),
    )
    per_class = (
        cells.select(F.inline(F.array(as_label, as_prediction)))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
        .where(F.col("support") > 0)
    )
    precision = F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0))
    recall = F.col("hits") / F.col("support")
    f1 = F.coalesce(
        F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)
    )
    total = F.sum("support")
    values = per_class.agg(
        (F.sum("hits") / total).alias("accuracy"),
        (F.sum(precision * F.col("support")) / total).alias("weightedPrecision"),
        (F.sum(recall * F.col("support")) / total).alias("weightedRecall"),
        (F.sum(f1 * F.col("support")) / total).alias("f1"),
    )
    return values.unpivot([], METRICS, "metric", "value")


def metrics_report(reports: Sequence[DataFrame], path: str | None = None) -> DataFrame:
    """Union of (model, variant, dataset, metric, value) frames, written if asked."""
    report = reduce(DataFrame.unionByName, reports)
    if path is None:
        return report
    report.coalesce(1).write.mode("overwrite").parquet(path)
    return report.sparkSession.read.parquet(path)
