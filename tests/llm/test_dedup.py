"""Block naming against brute force."""

from collections import defaultdict

from pyspark.sql import functions as F

from reviewlens.llm import dedup
from reviewlens.llm.naming import name_values


def test_names_follow_values_over_many_partitions(spark, shuffled):
    shuffled(13)
    rows = [(i, bytes([i % 7]) * 3 if i % 3 else b"hot") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, value binary")
    found = name_values(df, "value", ["doc_id"], ["doc_id"]).collect()
    values = dict(rows)
    names = defaultdict(set)
    for r in found:
        names[bytes(values[r.doc_id])].add(r.name)
    assert len(found) == 900 and all(len(n) == 1 for n in names.values())
    assert len({n for s in names.values() for n in s}) == len(names)


def test_long_texts_that_differ_late(spark, monkeypatch):
    monkeypatch.setattr(dedup, "BLOCK_BYTES", 16)
    base = "".join(chr(97 + i * i % 26) for i in range(500))
    texts = [base, base + "x", base[:-1] + "?", base, base[::-1], "a", base[:16], base[:32], base[:17]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in dedup.exact_duplicates(df).collect()}
    for i, text in enumerate(texts):
        assert found[i].keep_id == texts.index(text)
        assert found[i].group_size == texts.count(text)


def test_drop_keeps_the_first_of_each_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = {}
    for r in docs.orderBy("doc_id").select("doc_id", F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")).collect():
        first.setdefault(r[1], r[0])
    assert {r.doc_id for r in dedup.drop_exact_duplicates(docs).collect()} == set(first.values())
