"""Exact dedup by deterministic block naming.

A normalised text is cut into blocks of fixed size; sorting all blocks gives each
distinct one an integer name. Adjacent names are paired and the pairs named the same
way, level by level, until every document has one name. Names are places in a sorted
order of contents, so two documents have the same block count and name exactly if
their normalised texts are equal; no hash decides.

Defined results: null counts as the empty text, which is one empty block; of rows that
repeat id and text one stays; rows with the same id and different texts are documents
of their own; a null id stays only where its group has no other; an empty table gives
no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.llm.common import unused
from reviewlens.llm.naming import name_values
from reviewlens.sources.staging import stage

BLOCK_BYTES = 8192
BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: str) -> Column:
    """The text in UTF-8 with every run of blanks as one space; null is empty."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return F.regexp_replace(whole, BLANKS, " ").cast("binary")


def digest(text: str) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def _blocks(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, digest, n, at, block): the numbered blocks of every row."""
    rows = docs.select(F.col(key).alias("doc_id"), normalised(text).alias("body"))
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("body") / BLOCK_BYTES)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.substring(F.col("body"), i * BLOCK_BYTES + 1, F.lit(BLOCK_BYTES)),
    )
    return rows.select(
        "doc_id", F.unhex(F.sha2("body", 256)).alias("digest"), count.alias("n"),
        F.posexplode(cut).alias("at", "block"),
    )


def _pair_value() -> Column:
    """Both names as 16 bytes; a last name without partner pairs with -1."""
    parts = [F.unhex(F.lpad(F.hex(c), 16, "0")) for c in ("left", F.coalesce("right", F.lit(-1)))]
    return F.concat(*parts)


def document_names(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, n, name, copies): one row per distinct (doc_id, text).

    (n, name) is the identity of the text, ``copies`` the rows that repeat it.
    """
    blocks = _blocks(docs, key, text)
    carry = ["doc_id", "digest", "n", "at"]
    names = name_values(blocks, "block", carry, ["doc_id", "at"]).withColumn("copies", F.lit(1))
    done, level = [], 0
    while True:
        # ceil(n / 2^level) names are left; with one left the document is named.
        width = 1 << level
        done.append(names.where((F.col("n") <= width) & (F.col("n") * 2 > width)))
        rest = names.where(F.col("n") > width)
        if rest.isEmpty():
            break
        level += 1
        even = F.col("at") % 2 == 0
        pairs = rest.groupBy("doc_id", "digest", "n", F.floor(F.col("at") / 2).cast("int").alias("at")).agg(
            F.min(F.when(even, F.col("name"))).alias("left"),
            F.min(F.when(~even, F.col("name"))).alias("right"),
            F.sum(F.when(even, F.col("copies"))).cast("int").alias("copies"),
        )
        valued = pairs.withColumn("pair", _pair_value())
        names = name_values(valued, "pair", [*carry, "copies"], ["doc_id", "at"])
    named = reduce(DataFrame.unionByName, done)
    same = ["doc_id", "digest", "n", "name"]
    return named.groupBy(*same).agg(F.sum("copies").alias("copies"))


def equal_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, copies, keep_id, group_size): `document_names` and their groups."""
    named = stage(document_names(docs, key, text), "identities")
    groups = named.groupBy("n", "name").agg(
        F.min("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")
    )
    # Written, so that a join by group can be split where a group is large.
    several = stage(groups.where("group_size > 1"), "several")
    return named.join(several, ["n", "name"], "left").select(
        "doc_id", "digest", "copies",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
    )


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per row of ``docs``."""
    found = equal_texts(docs, key, text)
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return found.select("*", copy).select(
        "doc_id", "keep_id", "group_size", stays.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` that stay, with all their columns."""
    mark, same, number = (unused(docs, c) for c in ("dedup_digest", "dedup_id", "dedup_copies"))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    found = stage(equal_texts(docs, key, text), "groups")
    leaving = found.where(~stays | (F.col("copies") > 1)).select(
        F.col("doc_id").alias(same), F.col("digest").alias(f"{mark}_other"),
        F.when(stays, F.col("copies")).otherwise(0).alias(number),
    )
    marked = docs.withColumn(mark, digest(text))
    on = F.col(key).eqNullSafe(F.col(same)) & (F.col(mark) == F.col(f"{mark}_other"))
    # What leaves grows with the documents, so it is joined by key at every size.
    kept = marked.join(leaving.hint("merge"), on, "left_anti")
    if not leaving.where(F.col(number) > 1).isEmpty():
        repeated = marked.join(leaving.where(F.col(number) > 1).hint("merge"), on, "left_semi")
        kept = kept.unionByName(repeated.dropDuplicates([key, mark]))
    return kept.drop(mark)
