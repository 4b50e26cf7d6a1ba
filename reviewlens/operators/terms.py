"""Term counts, document frequencies and TF-IDF over exact terms.

These are the long-table siblings of hashed TF-IDF: same weighting, but one row
per (document, term), so that every number can be checked in SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.operators.lookup import lookup_join


def term_counts(
    df: DataFrame, row_id: str, words: Column, carry: Sequence[str] = ()
) -> DataFrame:
    """(id, term, tf): the ``words`` of each row, counted inside the row, no shuffle.

    Columns ``carry`` of the row are repeated in front of each of its terms.
    In the sorted words every term is one run; its length is the distance
    between the ends of runs. Each step is a column of its own, because a
    lambda evaluates what it refers to once per element.
    """
    last = F.size("_words") - 1
    positions = F.when(F.col("_last") >= 0, F.sequence(F.lit(0), "_last"))
    ends = F.filter(
        positions,
        lambda i: (i == F.col("_last"))
        | (F.get("_words", i) != F.get("_words", i + 1)),
    )
    runs = F.transform(
        "_ends",
        lambda end, rank: F.struct(
            F.get("_words", end).alias("term"),
            (end - F.coalesce(F.get("_ends", rank - 1), F.lit(-1))).alias("tf"),
        ),
    )
    return (
        df.select(F.col(row_id).alias("id"), *carry, F.sort_array(words).alias("_words"))
        .select("id", *carry, "_words", last.alias("_last"))
        .select("id", *carry, "_words", ends.alias("_ends"))
        .select("id", *carry, F.inline(runs))
    )


def document_frequency(counts: DataFrame) -> DataFrame:
    """(term, df): number of documents per term; ``counts`` has a term once per row."""
    return counts.groupBy("term").agg(F.count("*").alias("df"))


def tfidf_terms(
    df: DataFrame,
    row_id: str,
    words: Column,
    counts: DataFrame | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(id, *carry, term, tf, df, weight) with weight = tf * ln((N + 1) / (df + 1)).

    N counts all rows of ``df``, so filter missing texts out before. Pass staged
    ``counts`` to tokenise once instead of twice.
    """
    if counts is None:
        counts = term_counts(df, row_id, words, carry)
    documents = df.agg(F.count("*")).scalar()
    frequency = document_frequency(counts).select("term", "df", F.col("df").alias("_n"))
    joined = lookup_join(counts, frequency, "term", "_n")
    weight = F.col("tf") * F.log((documents + 1) / (F.col("df") + 1))
    return joined.select("id", *carry, "term", "tf", "df", weight.alias("weight"))
