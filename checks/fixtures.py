"""Review-shaped views of the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlens.functions.dates import epoch_seconds
from reviewlens.functions.text import surface_tokens
from reviewlens.sources.corpus import read_line_corpus
from reviewlens.sources.staging import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def labeled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents in the form of the labelled-review table."""
    seconds = (
        F.lit(1356998400)
        + (F.col("doc_id") * 7919) % 500 * 86400
        + F.col("n_chars") % 86400
    )
    return labeled_documents(spark, sf_dir).select(
        F.col("doc_id").alias("reviewID"),
        F.col("source").alias("asin"),
        (F.col("n_chars") % 11).cast("int").alias("helpfulPos"),
        (F.col("doc_id") % 4).cast("int").alias("helpfulNeg"),
        (F.col("n_chars") % 5 + 1).cast("double").alias("overall"),
        F.col("text").alias("reviewText"),
        F.concat(F.lit("u"), F.col("doc_id") % 37).alias("reviewerID"),
        seconds.cast("bigint").alias("unixReviewTime"),
        F.col("quality").cast("double").alias("label"),
    )


def rated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a rating 1..5: a profile input with many keys."""
    rating = ((F.col("l_linenumber") - 1) % 5 + 1).cast("double")
    return table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", rating.alias("rating")
    )


def identified_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with an id and a rating: many cold part keys, and supplier keys that are hot."""
    line = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line")
    rating = ((F.col("l_linenumber") - 1) % 5 + 1).cast("double").alias("rating")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber")
    keys = lines.agg(F.min("l_partkey").alias("l_partkey"), F.min("l_suppkey").alias("l_suppkey"))
    return keys.select(line, "l_partkey", "l_suppkey", rating)


def order_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_custkey", epoch_seconds(F.col("o_orderdate")).alias("seconds")
    )


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "user_id", epoch_seconds(F.col("ts")).alias("seconds")
    )


def unlabeled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return documents(spark, sf_dir).join(labels, "doc_id", "left_anti")


def write_corpus(spark: SparkSession, sf_dir: str) -> str:
    """Texts by quality as ``<root>/d`` and ``<root>/t``, files in order of doc_id."""
    root = new_path(spark, "corpus")
    docs = labeled_documents(spark, sf_dir)
    for name, quality in (("d", 0), ("t", 1)):
        chosen = docs.where(F.col("quality") == quality)
        ordered = chosen.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
        ordered.select("text").write.text(f"{root}/{name}")
    return root


def corpora(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The deceptive and the truthful line corpus, written as text and read back."""
    root = write_corpus(spark, sf_dir)
    return (
        read_line_corpus(spark, f"{root}/d", "D", 0),
        read_line_corpus(spark, f"{root}/t", "T", 1),
    )


def lemma_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(surface, lemma): words of the documents that end in s, without that s."""
    words = documents(spark, sf_dir).select(
        F.explode(surface_tokens("text")).alias("surface")
    )
    plural = words.where(F.col("surface").endswith("s") & (F.length("surface") > 4))
    return plural.distinct().select(
        "surface", F.expr("substring(surface, 1, length(surface) - 1)").alias("lemma")
    )
