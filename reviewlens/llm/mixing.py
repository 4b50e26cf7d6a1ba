"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets: sources, by code point with null last, take their weights in turn and share
the budget by weight; none gets more than ``epochs`` times its size, and the excess is
shared again by weight until none is above. A source is first taken as often as it
fits whole; the rest is filled in the order of exponential keys, scaled by a quality
weight per document, up to the budget. The document that meets the budget is cut
there, so each source gives its target down to the word.

Defined results: null or empty text has size 0 and is never taken; a null source is
a source of its own; rows that repeat are rows of their own; reruns agree, since a
key is a function of the document id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens.llm.common import unused
from reviewlens.operators.indexing import running_start
from reviewlens.sources.staging import stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
WORD = r"[^\x20\x09-\x0D]+"


def quality_weight(text: Column) -> Column:
    """Share of letters among all characters, 0.05 at least."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.greatest(F.lit(0.05), letters / F.greatest(F.length(text), F.lit(1)))


def sampling_key(doc_id: Column, weight: Column, seed: str = "mix") -> Column:
    """-ln(u) / weight with u from 52 bits of the md5 of id and seed."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}")))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / float(1 << 52)) / weight


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS
) -> DataFrame:
    """(source, source_size, before, target) from one (source, source_size) row per source.

    ``before`` is the size of all earlier sources. The windows see one row per
    source, no documents.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(named) - 1) % len(weights)
    ranked = sizes.select(
        "source", "source_size",
        F.get(F.array(*map(F.lit, weights)), turn).alias("weight"),
        (epochs * F.col("source_size")).alias("cap"),
        (F.sum("source_size").over(named) - F.col("source_size")).alias("before"),
    )
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    rest = by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = (
        share * F.sum("source_size").over(everything)
        - (F.sum("cap").over(by_fill) - F.col("cap"))
    )
    filled = ranked.select(
        "*",
        F.row_number().over(by_fill).alias("place"),
        (left / F.sum("weight").over(rest)).alias("level"),
    )
    # The first source, from the smallest cap on, that the common level leaves below its cap.
    below = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level"))
    level = F.min(below).over(everything)["level"]
    return filled.select(
        "source", "source_size", "before",
        F.least(level * F.col("weight"), F.col("cap").cast("double")).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    quality: Column | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, size, source_size, target, taken) and ``carry``, one row per row.

    Texts are reduced to numbers in the scan. The running sum inside a source comes
    from a range sort over all sources, so a source may hold any share of the rows.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    weight = quality_weight(whole) if quality is None else quality
    rows = stage(
        docs.select(
            F.col(key).alias("doc_id"),
            F.col(source).alias("source"),
            F.regexp_count(whole, F.lit(WORD)).cast("bigint").alias("size"),
            sampling_key(F.col(key), weight).alias("sampling_key"),
            *carry,
        ),
        "sizes",
    )
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stage(source_targets(totals, weights, share, epochs), "targets")
    order = [F.col("source").asc_nulls_last(), F.col("sampling_key"), F.col("doc_id"), F.col("size")]
    placed = running_start(rows, order, "size", "start")
    same = F.expr("placed.source <=> targets.source")
    joined = placed.alias("placed").join(targets.alias("targets"), same).drop("source")
    full = F.floor(F.try_divide(F.floor("target"), F.col("source_size")))
    turns = F.coalesce(full, F.lit(0))
    rest = F.floor("target") - turns * F.col("source_size")
    part = F.greatest(F.lit(0), F.least("size", rest - (F.col("start") - F.col("before"))))
    return joined.select(
        "doc_id", "size", "source_size", "target",
        (turns * F.col("size") + part).cast("bigint").alias("taken"), *carry,
    )


def mixed_rows(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    whole_texts: bool = False,
) -> DataFrame:
    """``docs`` as the mix takes them: whole copies, then a cut one up to the budget.

    With ``whole_texts`` the document that meets the budget is taken whole or not at all,
    whichever leaves its source nearer the target; at equal distance it is taken.

    Rows that are equal in every column are taken together.
    """
    mark, took, size, rows, copy = (
        unused(docs, f"mix_{c}") for c in ("mark", "taken", "size", "rows", "copy")
    )
    tagged = docs.withColumn(mark, F.xxhash64(*docs.columns))
    mixed = mix_sources(tagged, key, text, source, weights, share, epochs, carry=[mark])
    chosen = stage(
        mixed.groupBy(F.col("doc_id").alias("mix_id"), F.col(mark).alias("mix_other"))
        .agg(F.sum("taken").alias(took), F.max("size").alias(size), F.count("*").alias(rows))
        .where(2 * F.col(took) >= F.col(size) if whole_texts else F.col(took) > 0)
        .where(F.col(took) > 0),
        "chosen",
    )

    def meet(part: DataFrame) -> DataFrame:
        on = (tagged[mark] == part["mix_other"]) & tagged[key].eqNullSafe(part["mix_id"])
        return tagged.join(part.hint("merge"), on).select(*tagged.columns, took, size, rows)

    met = meet(chosen.where(F.col(rows) == 1))
    repeated = chosen.where(F.col(rows) > 1)
    if not repeated.isEmpty():
        met = met.unionByName(meet(repeated).dropDuplicates([key, mark]))
    if whole_texts:
        times = F.floor((2 * F.col(took) + F.col(size)) / (2 * F.col(size)))
        copies = F.explode(F.sequence(F.lit(1), times.cast("int")))
        return met.select("*", copies.alias(copy)).select(docs.columns)
    words = F.least(F.col(size), F.col(took) - F.col(copy) * F.col(size))
    ends = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"  # after every word
    cut = F.array_join(F.slice(F.split(text, ends), F.lit(1), words.cast("int")), "")
    copies = F.explode(F.sequence(F.lit(0), F.floor((F.col(took) - 1) / F.col(size)).cast("int")))
    kept = F.when(words < F.col(size), cut).otherwise(F.col(text))
    return met.select("*", copies.alias(copy)).withColumn(text, kept).select(docs.columns)
