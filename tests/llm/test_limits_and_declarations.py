"""Learned compression limits, and license declarations beside brute force."""

import base64
import random
from math import ceil

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.llm import licenses, rules


@pytest.fixture(scope="module")
def labelled(spark):
    sf = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_learned_limits_reject_low_quality(spark, labelled):
    docs, labels = labelled
    texts = _noise(docs.join(labels.where("quality = 1"), "doc_id"))
    extra = spark.createDataFrame([(-1 - i, t, None, None, len(t)) for i, t in enumerate(texts)], docs.schema)
    found = rules.compression_rules(docs.unionByName(extra), labels=labels)
    passed = found.where("not base_failed").join(labels, "doc_id").groupBy("quality")
    by = {r["quality"]: r for r in passed.agg(F.count("*").alias("n"), F.count_if("kept").alias("kept")).collect()}
    assert by[0]["n"] - by[0]["kept"] >= 150
    assert by[1]["n"] - by[1]["kept"] <= 0.015 * by[1]["n"]
    odd = {r["doc_id"]: r for r in found.where("doc_id < 0").collect()}
    assert len(odd) == len(texts) == 7 and not odd[-1]["base_failed"] and odd[-1]["kept"]
    assert not any(odd[-1 - i]["kept"] or odd[-1 - i]["base_failed"] for i in range(1, 7))


def _noise(docs):
    """Prose of ten chunks, three kinds of noise, and prose with two chunks of each."""
    rnd, size = random.Random(4), rules.CHUNK_BYTES
    good = docs.where("lang = 'en' and length(text) between 2000 and 9000").orderBy("doc_id").limit(40)
    prose = " ".join(r["text"] for r in good.collect()).encode()[: 10 * size].decode(errors="ignore").ljust(10 * size)
    cut = lambda s: " ".join(s[i : i + 80] for i in range(0, len(s), 80))
    kinds = [
        cut("".join(rnd.choice("0123456789abcdef") for _ in range(10 * size))),
        cut("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(10 * size))),
        cut(base64.b64encode(rnd.randbytes(10 * size)).decode()),
    ]
    mixed = [prose[: 2 * size] + k[:size] + prose[3 * size : 6 * size] + k[:size] + prose[7 * size :] for k in kinds]
    return [prose, *kinds, *mixed]


def test_limits_are_quantiles_of_good_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, False, int(b), float(r), [float(r) + 0.1]) for i, (b, r) in enumerate(zip(rng.integers(3000, 8000, 400), rng.normal(2.0, 0.1, 400)))]
    rows += [(1000, False, 100, 9.0, []), (1001, True, 5000, 9.0, [9.0]), (1002, False, 5000, 0.1, [0.1])]
    df = spark.createDataFrame(rows, "doc_id bigint, base_failed boolean, bytes bigint, ratio double, chunk_ratios array<double>")
    labels = spark.createDataFrame([(i, 1) for i in (*range(400), 1000, 1001)] + [(1002, 0)], "doc_id bigint, quality int")
    limits = rules.fit_limits(df, labels)
    ratios = [r[3] for r in rows[:400]]
    width = 2 ** (1 / rules.CELLS_PER_DOUBLING)
    low, high = limits.texts[3]
    assert low <= np.quantile(ratios, rules.TAIL) * 1.001 and low * width**2 >= np.quantile(ratios, rules.TAIL)
    assert high >= np.quantile(ratios, 1 - rules.TAIL) * 0.999 and high <= width**2 * np.quantile(ratios, 1 - rules.TAIL)
    assert limits.chunk[0] <= min(ratios) + 0.1 and limits.chunk[1] >= max(ratios) + 0.1 and limits.chunk[1] < 9
    # Too few good texts: the fixed bands.
    assert limits.texts[0] == rules.Limits().texts[0]
    assert rules.fit_limits(df, labels.where("false")) == rules.Limits()


def test_limits_of_odd_rows(spark):
    schema = "doc_id bigint, text string, ratio string, kept int"
    rows = [(1, None, "", 1), (1, "", "", 1), (None, "a b c " * 40, None, None), (2, "x " * 90_000, "", 1), (2, "x " * 90_000, "", 1)]
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, 1)], "doc_id bigint, quality int")
    found = rules.compression_rules(spark.createDataFrame(rows, schema), labels=labels)
    assert found.count() == 5 and found.where("kept").count() == 0
    assert rules.compression_rules(spark.createDataFrame([], schema), labels=labels).collect() == []


# --- licences --------------------------------------------------------------


@pytest.mark.parametrize(
    "line, label",
    [
        ("Released under the MIT License.", "mit"), ("SPDX-License-Identifier: MIT", "mit"),
        ("// SPDX-License-Identifier: Apache-2.0", "apache-2.0"), ("Distributed under the BSD 3-Clause license", "bsd"),
        ("ISC License", "isc"), ("Mozilla Public License, version 2.0", "mpl-2.0"), ("Licensed under GNU LGPL", "lgpl"),
        ("Creative Commons Attribution 4.0 International", "cc-by-4.0"), ("is under CC BY 4.0.", "cc-by-4.0"),
        ("GPLv3 or later", "gpl-3.0"),
        ("it under the terms of the GNU General Public License as published by the Free Software Foundation; "
         "either version 2 of the License, or (at your option) any later version.", "gpl-2.0"),
    ],
)
def test_declarations(spark, line, label):
    df = spark.createDataFrame([(1, f"some words {line} and more")], "doc_id bigint, text string")
    found = licenses.scan_licenses(df).first()
    assert label in found.labels.split(",") and found.score > 0
    other = {"gpl-2.0", "gpl-3.0", "mit", "isc", "bsd"} - {label}
    assert not other & set(found.labels.split(","))


def test_every_licence_line_has_a_label(labelled):
    docs = labelled[0]
    said = docs.where(F.col("text").rlike("(?i)licen[sc]ed? under|under the MIT|all rights reserved"))
    found = licenses.scan_licenses(said)
    assert found.count() > 200 and found.where("labels = ''").isEmpty()


def _brute(text, known):
    """(labels, score) by trying every template at every place."""
    words, labels, score = licenses.words_of(text), set(), 0.0
    for t in known:
        size = len(t.words)
        for start in range(-size + 1, len(words)):
            share = sum(0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(t.words)) / size
            window = b" ".join(words[max(0, start - 2) : max(0, start + size + 2)])
            keys = all(f" {window.decode()} ".find(f" {b' '.join(k).decode()} ") >= 0 for k in t.keys)
            if share == 1.0 if t.base else share >= licenses.MIN_SHARE and keys:
                labels.add(t.label)
                score = 1.0 if t.base else max(score, share)
    return ",".join(sorted(labels)), score


def test_labels_equal_brute_force(spark):
    rnd, known = random.Random(9), licenses.all_templates()
    vocabulary = sorted({w.decode() for t in known for w in t.words})
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(rnd.randint(1, 3)):
            own = [w.decode() for w in rnd.choice(known).words]
            for _ in range(rnd.choice([0, 0, 1, ceil(len(own) * 0.3)])):
                own[rnd.randrange(len(own))] = rnd.choice(vocabulary)
            parts += own + rnd.choices(vocabulary, k=rnd.randint(0, 4))
        texts.append(" ".join(parts))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in licenses.scan_licenses(df).collect():
        assert (r.labels, r.score) == _brute(texts[r.doc_id], known), texts[r.doc_id]
