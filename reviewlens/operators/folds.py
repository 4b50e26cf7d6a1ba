"""Cross-validation folds with the same share of every class."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reviewlens.operators.indexing import contiguous_index


def stratified_folds(
    df: DataFrame, key: str, label: str, folds: int, seed: str = "fold", name: str = "fold"
) -> DataFrame:
    """Add ``name``: the rows of a class, in the order of a hash of the key, dealt in turn.

    Fold sizes of a class differ by one row at most, so every fold holds each class
    that has at least ``folds`` rows. Rows without label drop out. The ranks come from
    one range sort over all classes, written when this is called.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    marked = df.where(F.col(label).isNotNull()).withColumn("_digest", digest)
    ranked = contiguous_index(marked, [label, "_digest", key], "_place")
    starts = ranked.groupBy(label).agg(F.min("_place").alias("_start"))
    fold = F.pmod(F.col("_place") - F.col("_start"), F.lit(folds)).cast("int")
    return ranked.join(starts, label).select(*df.columns, fold.alias(name))
