"""Scalar goldens and equivalences of the text expressions."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from reviewlens.functions.text import (
    capital_ratio,
    normalized,
    normalized_tokens,
    strip_punctuation,
    tokens,
    word_count,
)

SHAPES = [
    ("", 1, 1.0),
    ("  ", 0, 1.0),
    (" a", 2, 0.0),
    ("a ", 1, 0.0),
    ("a  b", 3, 0.0),
    ("  a  b  ", 5, 0.0),
    ("Ab", 1, 0.5),
    ("a1!", 1, 0.67),
    ("abc d", 2, 0.0),
    ("a\tB\n", 1, 0.75),
    ("ß é É", 3, 0.33),
    ("a😀", 1, 0.67),
    ("😀", 1, 1.0),
    ("\U00010428", 1, 1.0),
    (None, None, None),
]


def pieces_between_blanks(text):
    """Pieces at single blanks, trailing empty ones dropped; '' is one piece."""
    if text == "":
        return 1
    pieces = text.split(" ")
    while pieces and pieces[-1] == "":
        pieces.pop()
    return len(pieces)


def test_shape_goldens(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in SHAPES], "t string")
    got = df.select("t", word_count("t"), capital_ratio("t")).collect()
    assert [tuple(r) for r in got] == SHAPES


def test_capital_ratio_of_every_single_character(spark):
    """One character is a capital exactly when upper-casing leaves it as it is."""
    chars = spark.createDataFrame([(chr(i),) for i in [*range(1, 0xD800), *range(0xE000, 0x10000)] if i != 32], "c string")
    wrong = chars.where(
        capital_ratio("c") != F.when(F.col("c") == F.upper("c"), 1.0).otherwise(0.0)
    )
    assert wrong.count() == 0


def test_capital_ratio_rounds_half_up(spark):
    """3 of 8 characters give 0.375 and 0.38; 1 of 200 gives 0.005 and 0.01."""
    df = spark.createDataFrame([("ABCdefgh",), ("A" + "b" * 199,)], "t string")
    assert [r[0] for r in df.select(capital_ratio("t")).collect()] == [0.38, 0.01]


@pytest.mark.parametrize(
    "text, stripped, kept",
    [
        ("end.Start it", "endStart it", "endstart"),
        ("A stopWord, stopword!", "A stopWord stopword", "stopword"),
        (",.!?:;", "", ""),
        ("", "", ""),
        ("a😀 😀 ab abc", "a😀 😀 ab abc", "a😀 abc"),
        (None, None, None),
    ],
)
def test_normalisation_goldens(spark, text, stripped, kept):
    df = spark.createDataFrame([(text,)], "t string")
    assert tuple(df.select(strip_punctuation("t"), normalized("t")).first()) == (stripped, kept)


def test_stop_words_are_case_sensitive_and_checked_before_lowering(spark):
    df = spark.createDataFrame([("The the THE fox",)], "t string")
    assert df.select(normalized("t", ["the"])).first()[0] == "the the fox"
    assert df.select(normalized("t", [])).first()[0] == "the the the fox"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=" \t\n,.abSTOé", max_size=14), min_size=40, max_size=60))
def test_generated_texts(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    words = Tokenizer(inputCol="t", outputCol="w").transform(df)
    got = words.select(
        "t", "w", word_count("t"), tokens("t"), normalized_tokens("t"), tokens(normalized("t"))
    )
    for text, ml_words, n, own_words, direct, via_text in got.collect():
        assert n == pieces_between_blanks(text)
        assert own_words == ml_words
        assert direct == via_text
