"""Prefix trie, language identification and spelling groups beside brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from reviewlens.llm import bloom, language, spelling, trie
from reviewlens.llm.perfect_hash import PerfectHash

TALKS = "conv_id bigint, turn bigint, role string, text string, depth string, digest int"


# --- prefix trie ------------------------------------------------------------


def _brute_trie(rows, group=0, most=1):
    own = defaultdict(list)
    for c, turn, role, text, *_ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "")):
        own[c].append((role or "", text or ""))
    rebuilt = {}
    for c, said in own.items():
        lender, h = c, 0
        if group and c is not None:
            lender = c - int(np.fmod(c, group))
            h = zlib.crc32(str(c).encode()) % most
        rebuilt[c] = own.get(lender, [])[:h] + said[h:]
    members, children = defaultdict(list), defaultdict(set)
    for c, said in rebuilt.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
            if d:
                children[tuple(said[: d - 1])].add(tuple(said[:d]))
    smallest = {p: min((c for c in m if c is not None), default=None) for p, m in members.items()}
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        own_saved = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = sum(saved[k] for k in children[p]) + own_saved
        ends = sorted(c for c in members[p] if c is not None and len(rebuilt[c]) == len(p))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        above = smallest[p[:-1]] if p else None
        out.append((smallest[p], len(p), above, len(members[p]), len(children[p]), leaves[p], saved[p], digest))
    return sorted(out, key=repr)


def _trie(df, **options):
    return sorted(map(tuple, trie.prefix_trie(df, **options).collect()), key=repr)


@pytest.mark.parametrize("shard_nodes", [1_000_000, 4])
def test_trie_of_the_given_conversations(spark, sf, shard_nodes):
    given = spark.read.parquet(f"{sf}/conversations.parquet")
    want = _brute_trie(map(tuple, given.collect()), 5, 9)
    assert _trie(given, group=5, most=9, shard_nodes=shard_nodes) == want


def test_trie_of_shared_and_odd_conversations(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(c, t, "u", "ab"[int(rng.integers(2))] * 3, "x", 1) for c in range(-20, 60) for t in range(int(rng.integers(1, 7)))]
    rows += [(c, t, "user", "the same ü", None, None) for c in range(100, 140) for t in range(3)]
    rows += [(200, t, "user", f"{t}", None, None) for t in range(70)]
    rows += [(201, t, "user", f"{t if t < 40 else -t}", None, None) for t in range(60)]
    rows += [(300, None, None, None, None, None), (300, 0, "u", "aaa", None, None), (300, None, "a", "", None, None)]
    rows += [(None, 0, "u", "aaa", None, None), (None, 1, "u", "aaa", None, None), (301, 0, "", "", None, None)]
    df = spark.createDataFrame(rows, TALKS)
    for shard_nodes in (1000, 6):
        assert _trie(df, shard_nodes=shard_nodes) == _brute_trie(rows)
        assert _trie(df, group=5, most=9, shard_nodes=shard_nodes) == _brute_trie(rows, 5, 9)
    # Ids of a node in several pieces.
    monkeypatch.setattr(trie, "IDS_AT_ONCE", 7)
    assert _trie(df) == _brute_trie(rows)


def test_empty_conversations(spark):
    assert _trie(spark.createDataFrame([], TALKS), group=5, most=9) == []


def test_clashing_digests_are_an_error(spark):
    said = trie.turns(spark.createDataFrame([(1, 0, "u", "a", "", 1), (2, 0, "u", "b", "", 1)], TALKS), "conv_id", "turn", "role", "text")
    walked = trie.prefixes(said).withColumn("digest", F.when(F.col("depth") == 0, F.col("digest")).otherwise(F.lit(b"x" * 16)))
    with pytest.raises(ValueError, match="one digest"):
        trie.nodes(walked)


def test_slots_are_minimal_and_verified():
    keys = np.random.default_rng(0).integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    hashed = PerfectHash(keys)
    assert sorted(hashed.find(keys).tolist()) == list(range(5000))
    assert (hashed.find(keys + np.uint64(1)) == -1).all()
    assert PerfectHash(keys[:0]).find(keys[:3]).tolist() == [-1, -1, -1]
    with pytest.raises(ValueError):
        PerfectHash(np.zeros((2, 2), np.uint64))


# --- language identification ------------------------------------------------

SPOKEN = "doc_id bigint, text string, lang string, score string, held_out int"


def _plain_scores(rows, texts):
    """The same scores from plain counts, for models that hold everything."""
    bags = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        if text is not None and lang is not None:
            bags[lang].update(regex.findall(r"\p{L}+", text.lower()))
    bags = {lang: bag for lang, bag in bags.items() if bag}
    langs = sorted(bags)
    grams = {lang: Counter() for lang in langs}
    for lang in langs:
        for word, n in bags[lang].items():
            framed = f"<{word}>"
            for size in range(1, 6):
                for i in range(len(framed) - size + 1):
                    grams[lang][framed[i : i + size]] += n
    known_words = set().union(*bags.values())
    known_grams = set().union(*grams.values())
    all_tokens = sum(sum(b.values()) for b in bags.values())
    out = []
    for text in texts:
        words = regex.findall(r"\p{L}+", (text or "").lower())
        if not words:
            out.append(("und", 0.0))
            continue
        total = []
        for lang in langs:
            tokens = sum(bags[lang].values())
            s = np.log(tokens / all_tokens)
            for w in words:
                if w in known_words:
                    s += np.log((bags[lang][w] + 0.5) / (tokens + 0.5 * len(known_words)))
                    continue
                framed = f"<{w}>"
                for end in range(2, len(framed) + 1):
                    for size in range(min(5, end), 0, -1):
                        g = framed[end - size : end]
                        if g in known_grams:
                            same = [x for x in known_grams if len(x) == size]
                            of_size = sum(grams[lang][x] for x in same)
                            s += np.log((grams[lang][g] + 0.5) / (of_size + 0.5 * len(same))) / size
                            break
            total.append(s)
        best = int(np.argmax(total))
        out.append((langs[best], 1 / np.exp(np.array(total) - total[best]).sum()))
    return out


def test_language_scores_equal_plain_counts(spark):
    rows = [
        (1, "the cat and the dog, the end", "en", "a", 1), (2, "der Hund und die Katze", "de", None, None),
        (3, "le chien et le chat été", "fr", "b", 2), (4, None, "en", "c", 3), (6, "no language here", None, "", 4),
        (7, "123 456", "it", None, None), (8, "die die", "en", None, None),
    ]
    model = language.fit(spark.createDataFrame(rows, SPOKEN))
    assert model.languages == ["de", "en", "fr"]
    texts = ["the dog", "hundert katzen", "CHIENNE", "", None, "12 ½ ;", "x", "die", "ça va, catfish und ½t", "日本"]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(asked, model).collect()}
    for i, (lang, score) in enumerate(_plain_scores(rows, texts)):
        assert got[i][0] == lang and got[i][1] == pytest.approx(score, abs=1e-9), texts[i]


def test_language_model_has_a_bound(spark):
    rows = [(i, " ".join(f"w{chr(97 + i % 26)}{chr(97 + j)}" for j in range(26)), "ab"[i % 2], "", 1) for i in range(60)]
    model = language.fit(spark.createDataFrame(rows, SPOKEN), cells=200)
    assert len(model.word_rows) <= 100 and len(model.gram_rows) <= 100
    assert language.fit(spark.createDataFrame(rows, SPOKEN), languages=1).languages in (["a"], ["b"])


def test_unseen_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(language, "KEPT_WORDS", 3)
    logs = np.log([[0.9, 0.1], [0.2, 0.8]])
    scorer = language.Scorer(["a", "b"], np.zeros(2), {"x": 0}, logs[:1], {"y": 0}, logs[1:])
    texts = ["x y yy yyy yyyy", "x", "y x", "yyyyy yy y x x x x"] * 3
    assert scorer(texts)[1] == [s for t in texts for s in language.Scorer(["a", "b"], np.zeros(2), {"x": 0}, logs[:1], {"y": 0}, logs[1:])([t])[1]]


def test_language_of_odd_rows(spark):
    rows = [(None, "the end", "en", "", 1), (1, None, None, "", 1), (1, None, None, "", 1), (2, "", "en", "", 1), (3, "das " * 50000, "de", "", 1)]
    df = spark.createDataFrame(rows, SPOKEN)
    found = language.identify_languages(df)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"] and found.count() == 5
    assert {r.lang_pred for r in found.where("doc_id in (1, 2)").collect()} == {"und"}
    assert language.identify_languages(spark.createDataFrame([], SPOKEN)).collect() == []
    nothing = language.identify_languages(df.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.98
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found.collect())


# --- spelling groups --------------------------------------------------------

TEXTS = "doc_id bigint, text string, word string, n int, root double"


def _brute_groups(rows, min_length=7, every=None, times=10):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if every and h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    known = {w: n for w, n in counts.items() if len(w) >= min_length and n >= 2}
    letters = set().union(*known) if known else set()
    out = {}
    for w, n in known.items():
        near = {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        near |= {w[:i] + w[i + 1 :] for i in range(len(w))}
        near |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        near = (near & known.keys()) - {w}
        best = min(near, key=lambda x: (-known[x], x), default=None)
        form = best if best and known[best] >= times * n else None
        out[w] = [n, len(near), form, known[form] if form else None]
    for w in out:
        root = w
        while out[root][2]:
            root = out[root][2]
        out[w] = [*out[w], root]
    return {w: tuple(v) for w, v in out.items()}


def _groups(df, **options):
    found = spelling.spelling_groups(df, **options).collect()
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in found}


def test_groups_of_the_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    want = _brute_groups(map(tuple, docs.collect()), every=31)
    assert _groups(docs, every=31) == want and any(v[2] for v in want.values())


def test_groups_of_near_words(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = ["abcdefg", "aaaaaaa", "straßeé", "x" * 45, "ABCDEFG", "×÷×÷×÷×"]
    words = []
    for w in base:
        for k in range(120):
            i, kind, c = int(rng.integers(len(w))), int(rng.integers(3)), "abxzéß"[int(rng.integers(6))]
            words += [w, (w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :])[kind]]
    # A chain of forms: 2, 30 and 400 times.
    words += ["chainab"] * 2 + ["chainaa"] * 30 + ["chaina"] * 5 + ["chainaaa"] * 400
    rows = [(i // 7, w, None, 1, 0.5) for i, w in enumerate(words)]
    rows += [(None, "abcdefg abcdefh", "w", 2, None), (9, None, "w", 2, None), (9, "", "w", 2, None), (9, "y" * 3000 + " " + "y" * 2999, "", 1, 1.0)] * 2
    df = spark.createDataFrame(rows, TEXTS)
    want = _brute_groups(rows)
    assert want["chainab"][2:] == ("chainaa", 30, "chainaaa")
    assert _groups(df) == want
    assert _groups(df, every=3) == _brute_groups(rows, every=3)
    assert _groups(df, times=2, min_length=6) == _brute_groups(rows, 6, times=2)
    # Filters in many slices, counts handed on often, few places at once.
    monkeypatch.setattr(spelling, "FILTER_BYTES", 64)
    monkeypatch.setattr(spelling, "HELD_LETTERS", 30)
    monkeypatch.setattr(spelling, "PLACES_AT_ONCE", 50)
    monkeypatch.setattr(spelling, "EDITS_AT_ONCE", 3)
    assert _groups(df) == want


def test_no_words(spark):
    assert _groups(spark.createDataFrame([], TEXTS)) == {}
    assert _groups(spark.createDataFrame([(1, "one two", "", 1, 0.0)], TEXTS)) == {}


def test_filters_hold_their_words():
    words = [f"{a}{b}word" for a in "abcdefgh" for b in "ijklmnop"] + ["z" * 100]
    spelled = bloom.Spelled(words)
    layout = bloom.Layout.of(dict(Counter(bloom.shards(spelled.lengths).tolist())), 2)
    shard = bloom.shards(spelled.lengths)
    slices, block, bits = layout.places(spelled.hashes, shard)
    seen = []
    for part in range(2):
        filter_ = np.zeros(layout.size, np.uint64)
        np.bitwise_or.at(filter_, block[slices == part], bits[slices == part])
        seen += bloom.found(layout, filter_, part, spelled.hashes, shard).tolist()
    assert sorted(seen) == list(range(len(words)))
    # A shard without words lets nothing pass.
    assert not len(bloom.found(layout, filter_, 0, spelled.hashes, shard * 0 + 20))


def test_hashes_of_edits_equal_those_of_edited_words():
    words = ["hello", "aé", "zzzzz"]
    spelled = bloom.Spelled(words)
    at = np.arange(len(spelled.codes))
    gone, other = spelled.deleted(at), spelled.replaced(at, ord("q"))
    for i in at:
        w, p = words[spelled.owner[i]], spelled.place[i]
        assert gone[i] == bloom.Spelled([w[:p] + w[p + 1 :]]).hashes[0]
        assert other[i] == bloom.Spelled([w[:p] + "q" + w[p + 1 :]]).hashes[0]
