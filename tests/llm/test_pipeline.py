"""The pipeline's stages on the smallest documents."""

import re
from collections import Counter

import corpus_pipeline as pipeline
from reviewlens.llm import bpe, mixing
from reviewlens.sources.staging import stage
from tests.llm.test_similarity import brute


def test_stages_do_what_they_say(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, left = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, function in pipeline.STAGES[:3]:
        docs = stage(function(spark, docs, sf), "stage")
        assert docs.columns == columns, name
        now = {r.doc_id: r.text for r in docs.collect()}
        assert len(now) == docs.count() and now.items() <= left.items()
        if name == "exact dedup":
            seen = {re.sub(r"[ \t-\r]+", " ", t) for t in now.values()}
            assert len(seen) == len(now) == len({re.sub(r"[ \t-\r]+", " ", t) for t in left.values()})
        if name == "n-gram Jaccard join":
            ids = sorted(left)
            roots, _ = brute([left[i] for i in ids], 5, 80)
            assert sorted(now) == [i for at, i in enumerate(ids) if roots[at] == at]
        left = now
    mixed = stage(pipeline.mixed(spark, docs, sf), "stage")
    assert mixed.columns == columns
    assert all(r.n_chars == len(r.text) for r in mixed.collect())
    out = pipeline.encoded(spark, mixed, sf).collect()
    encoder = bpe.Encoder(bpe.load_vocabulary(pipeline.TOKENIZER))
    wanted = Counter((r.doc_id, len(encoder.encode([r.text])[0]) // 4) for r in mixed.collect())
    assert Counter((r.doc_id, r.n_tokens) for r in out) == wanted
    assert [len(pipeline.STAGES), pipeline.ORACLE_SQL] == [5, None]


def test_run_repeats_itself(spark, sf):
    first, second = (sorted(map(tuple, pipeline.run(spark, sf).collect())) for _ in range(2))
    assert first == second and first


def test_mixed_texts_are_whole(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = pipeline.mixed(spark, docs, sf).collect()
    assert all(r.text == texts[r.doc_id] for r in out)
    took = [r for r in mixing.mix_sources(docs).collect() if r["size"]]
    assert any(r.taken % r["size"] for r in took)  # the budget is met inside some text
    times = {r.doc_id: (2 * r.taken + r["size"]) // (2 * r["size"]) for r in took}
    assert Counter(r.doc_id for r in out) == {i: n for i, n in times.items() if n}
