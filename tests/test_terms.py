"""Term counts and TF-IDF against brute force and MLlib."""

import math
from collections import Counter

import pytest
from pyspark.ml.feature import IDF, CountVectorizer
from pyspark.sql import functions as F

from conftest import plan_of, rows
from reviewlens.functions.text import tokens
from reviewlens.operators.terms import document_frequency, term_counts, tfidf_terms

TEXTS = ["a b a", "b  c", "", "A a a", " c", "d " * 50 + "a", "   "]


def corpus(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "k int, t string")


def brute_counts():
    out = {}
    for i, text in enumerate(TEXTS):
        words = text.lower().split(" ") if text else [""]
        while len(words) > 1 and words[-1] == "":
            words.pop()
        if words == [""] and text != "":
            words = []
        for term, n in Counter(words).items():
            out[i, term] = n
    return out


def test_counts_without_shuffle(spark):
    counts = term_counts(corpus(spark), "k", tokens("t"))
    assert {(r["id"], r["term"]): r["tf"] for r in counts.collect()} == brute_counts()
    assert "Exchange" not in plan_of(counts)


def test_null_text_has_no_terms(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "k int, t string")
    assert rows(term_counts(df, "k", tokens("t"))) == [(2, "x", 1)]


def test_weights(spark):
    brute = brute_counts()
    df = Counter(term for _, term in brute)
    got = tfidf_terms(corpus(spark), "k", tokens("t"))
    assert got.count() == len(brute)
    for r in got.collect():
        assert r["tf"] == brute[r["id"], r["term"]]
        assert r["df"] == df[r["term"]]
        expected = r["tf"] * math.log((len(TEXTS) + 1) / (df[r["term"]] + 1))
        assert r["weight"] == pytest.approx(expected)


def test_same_weights_as_mllib(spark):
    """With one vector slot per term the hashed weighting is the exact one."""
    words = corpus(spark).withColumn("w", tokens("t"))
    vectorizer = CountVectorizer(inputCol="w", outputCol="tf").fit(words)
    counted = vectorizer.transform(words)
    weighted = IDF(inputCol="tf", outputCol="x").fit(counted).transform(counted)
    expected = {}
    for r in weighted.select("k", "x").collect():
        for i, value in zip(r["x"].indices, r["x"].values):
            expected[r["k"], vectorizer.vocabulary[i]] = value
    got = tfidf_terms(corpus(spark), "k", tokens("t"))
    assert {(r["id"], r["term"]): r["weight"] for r in got.collect()} == pytest.approx(expected)


def test_staged_counts_give_the_same_result(spark):
    counts = term_counts(corpus(spark), "k", tokens("t"))
    a = tfidf_terms(corpus(spark), "k", tokens("t"))
    b = tfidf_terms(corpus(spark), "k", tokens("t"), counts=counts)
    assert rows(a) == rows(b)
    assert rows(document_frequency(counts).where("term = 'a'")) == [("a", 3)]
    assert a.agg(F.sum("tf")).first() == counts.agg(F.sum("tf")).first()
