"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import pytest

from reviewlens.llm import (
    bpe, chat, dedup, licenses, mixing, quality, rules, sharding, similarity, toxicity,
)
from reviewlens.llm.queries import TOKENIZER

SCHEMA = "doc_id bigint, text string, source string, kept string, name int, size string"
LONG = "lorem ipsum dolor sit amet " * 8000
ROWS = [
    (1, "one two three four five", "a", "x", 1, "s"),
    (1, "one two three four five", "a", "x", 1, "s"),
    (2, "one  two three\nfour five", "a", "x", 1, "s"),
    (3, None, "b", None, None, None),
    (4, "", None, "y", 2, "t"),
    (5, " \n\t ", "b", "y", 2, "t"),
    (6, LONG, "a", "z", 3, "u"),
    (7, LONG, "b", "z", 3, "u"),
    (None, "without id", None, "z", 3, "u"),
    (None, None, None, None, None, None),
]
LABELS = [(1, 1, 0), (2, 0, 1), (6, 1, 0), (None, 1, 1), (4, None, None)]

OPERATORS = {
    "dedup": dedup.exact_duplicates,
    "mixing": mixing.mix_sources,
    "licenses": licenses.scan_licenses,
    "bpe": lambda d: bpe.encoding_digests(d, TOKENIZER),
    "toxicity": lambda d: toxicity.score_toxicity(d, toxicity.fit(d, _labels(d))),
    "sharding": lambda d: sharding.assign_shards(d, [1.0, 2.0, 0.0]),
    "similarity": similarity.similar_components,
    "quality": lambda d: quality.classify_quality(d, _labels(d)),
    "rules": rules.compression_rules,
}
ROW_OPERATORS = {
    "dedup": dedup.drop_exact_duplicates,
    "similar": similarity.drop_similar,
    "mixed": mixing.mixed_rows,
    "toxic": lambda d: toxicity.drop_toxic(d, toxicity.fit(d, _labels(d))),
}


def _labels(docs):
    return docs.sparkSession.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(docs, name):
    found = OPERATORS[name](docs).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("name", ROW_OPERATORS)
def test_rows_keep_their_columns(spark, docs, name):
    assert ROW_OPERATORS[name](docs).columns == docs.columns
    empty = ROW_OPERATORS[name](spark.createDataFrame([], SCHEMA))
    assert empty.columns == docs.columns and empty.collect() == []


def test_exact_duplicates_of_odd_rows(docs):
    found = {(r.doc_id, r.kept): r for r in dedup.exact_duplicates(docs).collect()}
    assert found[1, True].group_size == 3 and found[1, False].keep_id == 1
    assert not found[2, False].kept
    # Null and the empty text are equal; a run of blanks is one blank.
    assert found[3, True].group_size == 3 and (4, False) in found and (5, True) in found
    assert found[6, True].group_size == 2 and (7, False) in found
    assert (None, True) in found and found[None, False].keep_id == 3
    kept = dedup.drop_exact_duplicates(docs).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "5", "6", "None"]


def test_similarity_of_odd_rows(docs):
    found = {r.doc_id: r for r in similarity.similar_components(docs).collect() if r.doc_id}
    assert [found[i].component_id for i in (1, 2, 3, 4, 5, 6, 7)] == [1, 1, 3, 4, 5, 6, 6]
    assert [found[i].n_shingles for i in (1, 3, 4, 5, 6)] == [3, 0, 0, 0, 5]


def test_empty_texts(docs):
    by = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert (by[3].n_words, by[3].n_base, by[3].first_word, by[3].labels, by[3].score) == (0, 0, None, "", 0.0)
    by = {r.doc_id: r for r in rules.compression_rules(docs).collect()}
    assert by[4].base_failed and not by[4].kept and by[4].ratio == 1.0
    by = {r.doc_id: r for r in bpe.encoding_digests(docs, TOKENIZER).collect()}
    assert by[3].n_tokens == 0 and by[3].ids_sha256 == by[5].ids_sha256
    by = {r.doc_id: r for r in mixing.mix_sources(docs).collect()}
    assert by[3].size == by[3].taken == 0


def test_chat_of_odd_rows(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, n_turns string"
    rows = [
        (1, 1, "assistant", "b", "x"), (1, 0, "user", None, "x"), (1, 1, "assistant", "a", "x"),
        (1, 1, "assistant", "a", "x"), (None, 0, None, "t", None), (2, None, "assistant", "", None),
    ]
    found = {r.conv_id: r for r in chat.conversation_digests(spark.createDataFrame(rows, schema)).collect()}
    assert {k: v.n_turns for k, v in found.items()} == {1: 4, None: 1, 2: 1}
    assert found[1].loss_chars == 3 and found[1].loss_sha256 == chat._sha256("aab")
    assert chat.conversation_digests(spark.createDataFrame([], schema)).collect() == []
    assert chat.format_conversations(spark.createDataFrame(rows, schema)).count() == 3
