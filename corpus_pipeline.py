"""Documents to token digests: toxic texts and copies go, sources are mixed, the rest is encoded.

Every stage keeps the columns of ``documents``, of which it reads doc_id, text and source,
and n_chars, which the mix counts anew. Defined results: a null text is an empty one, which
the toxicity network never rejects; of null and empty texts one stays, as of any equal
texts; a row without id is kept by the first and third stage and stands behind all ids in
the second; rows that repeat are copies; an empty table gives no rows in any stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlens.llm import bpe, dedup, mixing, similarity, toxicity
from reviewlens.llm.common import table
from reviewlens.llm.queries import TOKENIZER
from reviewlens.sources.staging import stage


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network does not reject."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of equal texts."""
    return dedup.drop_exact_duplicates(docs)


def without_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every component of near copies: five words, 80 percent."""
    return similarity.drop_similar(docs, n=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, in whole texts; n_chars is counted anew."""
    taken = mixing.mixed_rows(docs, whole_texts=True)
    return taken.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text in the mix."""
    return bpe.encoding_digests(docs, TOKENIZER)


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("n-gram Jaccard join", without_similar),
    ("mixing", mixed),
    ("BPE", encoded),
]

# A trained network, a sampling of whole texts and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; every stage but the last is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
