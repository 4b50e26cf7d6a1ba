"""The two trained classifiers: gradients, closed forms, held-out accuracy."""

import zlib

import numpy as np
import pytest

from reviewlens.llm import quality, toxicity


def test_network_gradients_match_differences():
    rng = np.random.default_rng(0)
    p = toxicity._first_parameters({"a": 0.0}, {"b": 0.0}, rng)
    p = {k: v.astype(np.float64) for k, v in p.items()}
    gates = rng.standard_normal((3, 5, 6 * toxicity.HIDDEN))
    mask = np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [1, 0, 0, 0, 0]], bool)
    wanted = np.array([1.0, 0.0, 1.0])

    def loss():
        logits = toxicity.forward(p, gates, mask)[0]
        return float(np.mean(np.logaddexp(0, logits) - wanted * logits))

    grads, d_gates = toxicity.gradients(p, gates, mask, wanted)
    for name, values in [*((k, p[k]) for k in grads), ("gates", gates)]:
        given = d_gates if name == "gates" else grads[name]
        for at in rng.integers(0, values.size, 4).tolist():
            flat, before = values.reshape(-1), values.reshape(-1)[at]
            flat[at] = before + 1e-4
            up = loss()
            flat[at] = before - 1e-4
            down = loss()
            flat[at] = before
            # States are kept in single precision.
            assert given.reshape(-1)[at] == pytest.approx((up - down) / 2e-4, abs=2e-3), name


def test_windows_cover_every_word():
    for size in (1, 31, 32, 33, 56, 57, 1000):
        covered = set()
        for start in toxicity.windows(size):
            covered |= set(range(start, min(size, start + toxicity.WINDOW)))
        assert covered == set(range(size))


def test_short_passages_stand_whole_in_a_window():
    for size in range(17, 120):
        for at in range(size - 16):
            assert any(s <= at and at + 17 <= s + toxicity.WINDOW for s in toxicity.windows(size))


def test_scores_do_not_depend_on_neighbours():
    net = toxicity.train(["you idiot fool", "a fine day", "idiot again", "fine words here"] * 5, [1, 0, 1, 0] * 5)
    texts = ["a fine idiot " + "word " * 100, "", "fine", "x " * 3000 + "idiot"]
    together = toxicity.Scorer(net)(texts)
    alone = [toxicity.Scorer(net)([t])[0] for t in texts]
    assert together == pytest.approx(alone) and together[1] == 0.0
    assert together[0] > 0.5 > together[2] and together[3] > 0.5


def _held_out_accuracy(found, labels, name):
    wanted = {r["doc_id"]: r[name] for r in labels.collect()}
    held = [r for r in found.collect() if r.held_out and wanted.get(r.doc_id) is not None]
    assert held
    return np.mean([r.predicted == wanted[r.doc_id] for r in held])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = toxicity.score_toxicity(docs, toxicity.fit(docs, labels))
    assert _held_out_accuracy(scored, labels, "toxic") >= 0.93
    scored = quality.classify_quality(docs, labels)
    assert _held_out_accuracy(scored, labels, "quality") >= 0.95
    row = scored.where("doc_id = 17").first()
    assert row.held_out == (zlib.crc32(b"17") % 4 == 2)


def test_discriminant_equals_the_closed_form(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    training = quality.training_rows(quality.described(docs), labels)
    model, rows = quality.fit(training), training.collect()
    x = np.array([r.x for r in rows])
    y = np.array([r.label for r in rows])
    ridge = quality.RIDGE * np.maximum(x.var(0), 1e-6)
    density = []
    for k in (0, 1):
        own = x[y == k]
        cov = np.cov(own.T, bias=True)
        cov = (1 - quality.SHRINKAGE) * cov + quality.SHRINKAGE * np.diag(np.diag(cov)) + np.diag(ridge)
        away = x - own.mean(0)
        distance = np.einsum("ni,ij,nj->n", away, np.linalg.inv(cov), away)
        density.append(np.log(len(own) / len(x)) - 0.5 * (np.linalg.slogdet(cov)[1] + distance))
    want = 1 / (1 + np.exp(-np.clip(density[1] - density[0], -500, 500)))
    assert model.score(x) == pytest.approx(want, abs=1e-6)
