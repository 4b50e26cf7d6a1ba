"""Shards by rendezvous hashing of a stable record key over weighted shards.

Every shard draws a number from the hash of (key, shard); the smallest
``-ln(u) / weight`` wins. Key, shard count and weights alone decide, so a further
shard takes rows only into itself, and changing one weight moves rows only from or
to that shard. Copies of one text with different keys may part: the key decides.

Defined results: a null key is hashed like any value; null and empty texts have 8
bytes; rows that repeat a key share its shard and have slots of their own; an empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.operators.indexing import contiguous_index

# Bytes that a record takes besides its text.
RECORD_BYTES = 8


def _draw(key: Column, shard: int, weight: float) -> Column:
    """Exponential with rate ``weight``, from 53 bits of the hash of key and shard."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard).cast("bigint")), 11)
    return -F.log((bits + 0.5) / float(1 << 53)) / weight


def winner(key: Column, weights: Sequence[float]) -> Column:
    """struct(draw, shard) of the shard that takes the key; shards of weight 0 take none."""
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, one must be above 0")
    draws = [
        F.struct(_draw(key, i, w).alias("draw"), F.lit(i).alias("shard"))
        for i, w in enumerate(weights)
        if w > 0
    ]
    return F.array_min(F.array(*draws))


def assign_shards(
    docs: DataFrame,
    weights: Sequence[float],
    key: str = "doc_id",
    text: str = "text",
    grown_by: float = 1.0,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row.

    ``slot`` numbers the rows of a shard from 0 by key; ``grown_shard`` is the shard
    with one more shard of weight ``grown_by``. Only narrow rows are sorted, by range,
    so that no shard has to fit into one task.
    """
    payload = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    hashed = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(payload) + RECORD_BYTES).cast("bigint").alias("size"),
        F.crc32(payload).alias("text_crc32"),
        winner(F.col(key), weights).alias("best"),
        _draw(F.col(key), len(weights), grown_by).alias("further"),
    )
    grown = F.when(F.col("further") < F.col("best.draw"), len(weights)).otherwise(F.col("best.shard"))
    placed = hashed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"),
        F.col("best.shard").alias("shard"), grown.alias("grown_shard"),
    )
    ranked = contiguous_index(placed, ["shard", "doc_id", "text_crc32", "size"], "place")
    # One row per shard.
    starts = ranked.groupBy("shard").agg(F.min("place").alias("start"))
    return ranked.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", "law", "shard",
        (F.col("place") - F.col("start")).alias("slot"), "grown_shard",
    )


def write_shards(
    docs: DataFrame, weights: Sequence[float], path: str, key: str = "doc_id"
) -> None:
    """Write whole rows under ``path/shard=N``, without a shuffle."""
    shard = winner(F.col(key), weights)["shard"]
    docs.withColumn("shard", shard).write.partitionBy("shard").parquet(path)
