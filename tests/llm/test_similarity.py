"""Signature-tree join against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from reviewlens.llm import similarity
from reviewlens.llm.components import components
from reviewlens.llm.signature_tree import Tree, join_trees, linked
from reviewlens.sources.staging import stage


def shingles(text, n):
    words = re.findall(rb"[^\x20\x09-\x0d]+", text.encode().lower())
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(texts, n, percent):
    sets, root = [shingles(t, n) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]) and both:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def corpus(seed):
    """Texts of all lengths, each with copies that differ in few words."""
    rnd, texts = random.Random(seed), []
    for _ in range(40):
        words = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.choice([1, 2, 5, 12, 30, 90, 300]))]
        texts.append(" ".join(words))
        for _ in range(rnd.randint(0, 3)):
            copy = list(words)
            for _ in range(rnd.randint(0, max(1, len(words) // 25))):
                copy[rnd.randrange(len(copy))] = f"w{rnd.randint(0, 400)}"
            if rnd.random() < 0.4:
                copy += [f"v{rnd.randint(0, 9)}" for _ in range(rnd.randint(1, max(1, len(words) // 15)))]
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize(("n", "percent", "block"), [(3, 90, 1024), (5, 80, 3)])
def test_components_equal_brute_force(spark, monkeypatch, n, percent, block):
    monkeypatch.setattr(similarity, "BLOCK_SETS", block)
    texts = corpus(n)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in similarity.similar_components(df, n=n, percent=percent).collect()}
    roots, sizes = brute(texts, n, percent)
    assert [found[i].component_id for i in range(len(texts))] == roots
    assert [found[i].n_shingles for i in range(len(texts))] == sizes
    assert len(set(roots)) < len(roots)


@pytest.mark.parametrize("percent", [80, 90])
def test_similar_sets_share_a_key(percent):
    rng = np.random.default_rng(percent)
    for size in [*range(1, 60), 85, 200, 777]:
        base = np.unique(rng.integers(0, 2**64, size, np.uint64))
        for _ in range(20):
            change = int(rng.integers(0, max(2, size * (100 - percent) // percent + 2)))
            gone = int(rng.integers(0, change + 1))
            kept = rng.permutation(base)[gone:]
            other = np.unique(np.concatenate([kept, rng.integers(0, 2**64, change - gone, np.uint64)]))
            if len(other) and not np.array_equal(other, base) and linked(base, other, percent):
                assert np.intersect1d(
                    similarity.set_keys(base, percent), similarity.set_keys(other, percent)
                ).size


def test_trees_find_every_component():
    rng = np.random.default_rng(5)
    pool = np.unique(rng.integers(0, 2**64, 4000, np.uint64))
    sets = [np.sort(rng.choice(pool, int(k), replace=False)) for k in rng.integers(5, 90, 60)]
    sets += [np.sort(rng.permutation(s)[1:]) for s in sets[:30]]
    tree, n = Tree(sets), len(sets)
    want = {i: i for i in range(n)}
    for i, j in combinations(range(n), 2):
        if linked(sets[i], sets[j], 90):
            a, b = want[i], want[j]
            want = {k: (min(a, b) if v in (a, b) else v) for k, v in want.items()}
    got = {i: i for i in range(n)}
    for i, j in join_trees(tree, None, 90):
        a, b = got[i], got[j]
        got = {k: (min(a, b) if v in (a, b) else v) for k, v in got.items()}
    assert got == want
    halves = Tree(sets[:45]), Tree(sets[45:])
    crossing = {(i, j + 45) for i, j in join_trees(*halves, 90)}
    assert all(linked(sets[i], sets[j], 90) for i, j in crossing)
    for i in range(45):
        for j in range(45, n):
            if linked(sets[i], sets[j], 90):
                assert any(want[i] == want[a] for a, _ in crossing)


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (7, 7), (200, 150), (150, 199)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.node: r.root for r in components(df).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 150: 150, 199: 150, 200: 150}


def described(spark, texts, n, percent):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return df, stage(similarity.described(df, n, percent))


def test_shared_passages_tie_nothing_together(spark):
    """100 common and 50 own words: no set is left with a partner to be compared."""
    rnd = random.Random(8)
    common = " ".join(f"c{i}" for i in range(100))
    texts = [f"{common} " + " ".join(f"o{rnd.random()}" for _ in range(50)) for _ in range(3000)]
    df, sets = described(spark, texts, 5, 80)
    assert similarity.cluster_members(sets, 80).count() < 150
    found = similarity.similar_components(df, n=5, percent=80).collect()
    assert all(r.component_id == r.doc_id for r in found)


def test_large_clusters_meet_in_few_blocks(spark, monkeypatch):
    """Near copies of one text: once neighbours have met, few blocks are left to meet."""
    monkeypatch.setattr(similarity, "BLOCK_SETS", 10)
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(300):
        words = list(base)
        # Some stand off the others: linked with few or with none.
        for _ in range(rnd.choice([0, 1, 1, 2, 3, 8])):
            words[rnd.randrange(200)] = f"v{rnd.random()}"
        texts.append(" ".join(words))
    met = []
    pairs = similarity.block_pairs
    monkeypatch.setattr(similarity, "block_pairs", lambda *a: met.append(pairs(*a).count()) or pairs(*a))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in similarity.similar_components(df, n=5, percent=80).collect()}
    roots, _ = brute(texts, 5, 80)
    assert [found[i] for i in range(len(texts))] == roots
    assert len(met) == 1 and met[0] < 30 * 31 // 2 // 2


def test_similar_sets_keep_enough_keys():
    """Similar sets share `needed` keys of either at least."""
    rng = np.random.default_rng(4)
    for percent in (80, 90):
        for size in [*range(4, 80), 301]:
            base = np.unique(rng.integers(0, 2**64, size, np.uint64))
            for _ in range(20):
                other = rng.permutation(base)[int(rng.integers(0, size // 4 + 1)) :]
                more = rng.integers(0, 2**64, int(rng.integers(0, size // 4 + 1)), np.uint64)
                other = np.unique(np.concatenate([other, more]))
                if np.array_equal(base, other) or not linked(base, other, percent):
                    continue
                same = np.intersect1d(similarity.set_keys(base, percent), similarity.set_keys(other, percent))
                assert len(same) >= max(similarity.needed(len(s), percent) for s in (base, other))


def test_hot_shared_shingles_are_ranked_alike(spark, monkeypatch):
    """A shingle that is hot in one partition and not in the next has one rank."""
    monkeypatch.setattr(similarity, "HOT_ROWS", 20)
    rnd = random.Random(10)
    common = [f"c{i}" for i in range(30)]
    texts = [" ".join(common[rnd.randrange(3) :] + [f"o{rnd.randrange(60)}" for _ in range(rnd.choice([1, 2, 6]))]) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in similarity.similar_components(df, n=2, percent=80).collect()}
    roots, _ = brute(texts, 2, 80)
    assert [found[i] for i in range(len(texts))] == roots
    assert len(set(roots)) < len(roots)


def test_a_third_of_the_shingles_is_dealt_out(spark):
    """What is staged and sorted of a set is bounded, whatever is shared."""
    _, sets = described(spark, corpus(6), 3, 90)
    large = sets.where("n_shingles > 50 and keys is not null").collect()
    assert 0 < sum(len(r["keys"]) for r in large) <= 0.34 * sum(r.n_shingles for r in large)
    assert sets.where("set_id is not null and lead is null").isEmpty()


def test_a_passage_of_most_of_a_text_ties_nothing_together(spark):
    """Of 300 words 264 are common: what is rare in a text is dealt out first."""
    rnd = random.Random(11)
    common = " ".join(f"c{i}" for i in range(264))
    texts = [f"{common} " + " ".join(f"o{rnd.random()}" for _ in range(36)) for _ in range(1000)]
    _, sets = described(spark, texts, 3, 90)
    assert similarity.cluster_members(sets, 90).count() < 50


def test_counts_order_shingles_alike_in_all_sets():
    rng = np.random.default_rng(12)
    counts = rng.integers(0, 5, 1 << similarity.CELL_BITS).astype(np.uint32)
    for percent in (80, 90):
        for size in (12, 40, 301):
            base = np.unique(rng.integers(0, 2**64, size, np.uint64))
            for _ in range(20):
                kept = rng.permutation(base)[int(rng.integers(0, size // 10 + 1)) :]
                other = np.unique(np.concatenate([kept, rng.integers(0, 2**64, 1, np.uint64)]))
                if not linked(base, other, percent):
                    continue
                same = np.intersect1d(*(similarity.set_keys(s, percent, counts) for s in (base, other)))
                assert len(same) >= max(similarity.needed(len(s), percent) for s in (base, other))


def test_cells_are_counted_over_all_texts(spark):
    texts = ["a b c d", "A b c", None, "", "x"] * 300
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    counts = similarity.cell_counts(similarity.narrow(df, "doc_id", "text"), 3)
    shingler = similarity.Shingler(3)
    [first], [alone] = shingler("a b c"), shingler("x")
    cells = similarity._cells(np.array([first, alone], np.uint64))
    assert counts.sum() == 300 * 4 and counts[cells[0]] == 600 and counts[cells[1]] == 300


def test_few_texts_are_sent_where_few_are_compared(spark, monkeypatch):
    """A text that no set is compared with is left out before texts are dealt by id."""
    rnd = random.Random(13)
    texts = [" ".join(f"o{rnd.random()}" for _ in range(40)) for _ in range(2000)]
    texts[7] = texts[1500] + " end"
    df = spark.createDataFrame([*enumerate(texts), (None, texts[3])], "doc_id bigint, text string")
    sent = []
    with_ids = similarity._with_ids
    monkeypatch.setattr(similarity, "_with_ids", lambda *a: sent.append(with_ids(*a)) or sent[-1])
    found = {r.doc_id: r.component_id for r in similarity.similar_components(df).collect()}
    assert found[1500] == 7 and found[None] == 3 and len(set(found.values())) == 1999
    assert len(sent) == 1 and {7, 1500} <= {r.doc_id for r in sent[0].collect()}
    assert sent[0].count() < 20
