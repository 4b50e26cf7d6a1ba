"""BPE, licences, chat, rules, sharding and mixing against brute force."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from reviewlens.llm import bpe, chat, licenses, mixing, rules, sharding
from reviewlens.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


# --- BPE -------------------------------------------------------------------


def odd_texts():
    rnd = random.Random(2)
    letters = "aeinorst'hLDz"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 40))) for _ in range(400)]
    texts += ["".join(chr(rnd.choice([rnd.randint(1, 0x24F), rnd.randint(32, 126)])) for _ in range(50)) for _ in range(200)]
    return texts + [
        "", " \n\t", "ΑΣ ΑΣ.", "İ x​y \x1cz", "<|endoftext|>a<|startoftext|> <|ENDOFTEXT|>",
        "日本語 한글 ½² ٣ ́a 🤖🤖", "it's 'S 'll 2024 !!?? a_b", "é é",
    ]


def test_bpe_equals_the_library(docs):
    library = Tokenizer.from_file(TOKENIZER)
    encoder = bpe.Encoder(bpe.load_vocabulary(TOKENIZER))
    texts = odd_texts() + [r.text for r in docs.collect()]
    for text, got in zip(texts, encoder.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == want, text
        assert encoder.decode(got) == library.decode(want, skip_special_tokens=False)
    assert 0 < encoder.exactly_merged < len(encoder.words)


def test_bpe_takes_every_code_point_as_the_library_does():
    """Letters, numbers and lower case are the library's, also where Python knows others."""
    library = Tokenizer.from_file(TOKENIZER)
    encoder = bpe.Encoder(bpe.load_vocabulary(TOKENIZER))
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    texts = [
        " ".join(f"a{chr(c)}b" for c in points[at : at + 64]) for at in range(0, len(points), 64)
    ]
    expected = library.encode_batch(texts, add_special_tokens=False)
    for text, ids, right in zip(texts, encoder.encode(texts), expected):
        assert np.frombuffer(ids, "<u4").tolist() == right.ids, text


def test_bpe_documents_round_trip(docs):
    library = Tokenizer.from_file(TOKENIZER)
    encoded = bpe.encode_documents(docs, TOKENIZER)
    decoded = {r.doc_id: r.text for r in bpe.decode_documents(encoded, TOKENIZER).collect()}
    digests = {r.doc_id: r for r in bpe.encoding_digests(docs, TOKENIZER).collect()}
    for r in docs.collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert decoded[r.doc_id] == library.decode(ids, skip_special_tokens=False)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert digests[r.doc_id].ids_sha256 == hashlib.sha256(packed).hexdigest()


# --- licences --------------------------------------------------------------


def base_places(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    found = []
    for phrase, label in licenses.BASE.items():
        want = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    return words, sorted(found)


def test_base_places_equal_brute_force(spark, docs):
    extra = [
        (-1, "CC-BY cc by cc BY by cc"), (-2, "all rights reserved all rights all rights reserved"),
        (-3, "École ALL rights\nreserved general public license"), (-4, "ccby all rights-reserved"),
    ]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id bigint, text string"))
    texts = {r.doc_id: r.text for r in both.collect()}
    hits = 0
    for r in licenses.scan_licenses(both).collect():
        words, found = base_places(texts[r.doc_id])
        at = [i for i, _ in found]
        hits += bool(at)
        assert (r.n_words, r.n_base) == (len(words), len(found))
        assert (r.first_word, r.last_word) == (min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in found}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert hits >= 4


def test_templates_are_found_where_they_stand(spark):
    mit = licenses.TEMPLATES["mit"][0]
    broken = mit.replace("charge", "fee")  # a key phrase is missing
    texts = [
        "pad " * 50 + "Licensed under the Apache License, Version 2.0. " + "pad " * 9,
        f"x y {mit.upper()} z", broken, "Licensed under CC BY-NC 4.0", "apache version license the 2",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    assert found[0].labels == "apache-2.0" and found[0].spans == ["apache-2.0:50:8"] and found[0].score == 1.0
    assert found[1].labels == "mit" and found[2].labels == ""
    assert found[3].labels.split(",") == ["cc-by", "cc-by-nc"] and found[4].labels == ""


def test_places_are_found_when_the_rarest_words_stand_elsewhere(spark):
    mit = licenses.TEMPLATES["mit"][0]
    moved = ("obtaining", "associated", "documentation", "files")
    rest = " ".join(w for w in mit.split() if w not in moved)
    changed = " ".join("other" if w in moved else w for w in mit.split())
    texts = [f"{changed} {'pad ' * 30} {' '.join(moved)}", rest, rest]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = licenses.scan_licenses(df).where("doc_id = 0").first()
    assert (found.labels, found.spans, found.score) == ("mit", ["mit:0:20"], 0.8)


# --- chat ------------------------------------------------------------------


def test_chat_reads_back_control_strings(spark):
    texts = ["\\### Assistant: </turn> ok", "", "### user: \\\\</turn>\n", "a", ": : ###", "</turn>"]
    turns = [(["user", "assistant", "a: b"][i % 3], t) for i, t in enumerate(texts)]
    found = chat.locate(turns, chat.default_template)
    assert chat.read_back(found) == turns and not found.rewrites
    assert found.turns[0][0] == 0 and found.turns[-1][1] == len(found.output)
    rows = [(3, i, r, t) for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = chat.conversation_digests(df).first()
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    assert got.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
    assert (got.loss_chars, got.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    out = chat.format_conversations(df).first()
    spans = list(zip(out.loss_spans[::2], out.loss_spans[1::2]))
    assert "".join(chat.unescape(out.formatted[a:b]) for a, b in spans) == loss


def test_chat_detects_rewriting_templates():
    turns = [("user", "a"), ("assistant", "b"), ("user", "c")]
    last_only = lambda t: f"{len(t)} turns: " + "".join(x for _, x in t)
    assert chat.locate(turns, last_only).rewrites
    assert chat.locate(turns, last_only).output == "3 turns: abc"


# --- rules -----------------------------------------------------------------


def test_base_counts_equal_brute_force(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rules.compression_rules(docs).collect():
        text = texts[r.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        inside = {
            i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)
        }
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert r.n_words == len(words) and r.word_chars == sum(map(len, words))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert r.n_dup_lines == sum(x in lines[:i] for i, x in enumerate(lines))
        assert r.n_repeat_words == len(inside)
        assert r.base_failed == (len(words) < 50 or 100 * len(inside) > 50 * len(words))
        assert not (r.base_failed and r.kept)


def test_compression_bands(spark):
    rnd = random.Random(1)
    noise = " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(60)) for _ in range(80))
    words = [f"{a}{b}" for a in ("ta", "re", "mo", "li", "su") for b in ("n", "ral", "de", "ka", "ment", "s")]
    prose = " ".join(rnd.choice(words) + rnd.choice(["", "", ","]) + f"{rnd.choice(words)}" for _ in range(400))
    half = prose + " ".join(f"same words again and {i % 3} " for i in range(900))
    df = spark.createDataFrame(list(enumerate([noise, prose, half])), "doc_id bigint, text string")
    assert {r.doc_id: r.kept for r in rules.compression_rules(df).collect()} == {0: False, 1: True, 2: False}


def test_long_texts_hold_few_bad_chunks_and_the_remainder_counts(spark):
    rnd, size = random.Random(2), rules.CHUNK_BYTES
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(2, 9))) for _ in range(200)]
    prose = " ".join(rnd.choice(words) for _ in range(12_000))
    noise = "".join(chr(rnd.randint(33, 126)) for _ in range(size))
    line = ("the same line again\n" * size)[:size]

    def with_chunks(*bad):
        return "".join(dict(bad).get(i, prose[i * size : (i + 1) * size]) for i in range(10))

    texts = [
        with_chunks(), with_chunks((4, noise)), with_chunks((4, noise), (7, noise)),
        with_chunks((4, line), (7, line)), prose[: size * 3 // 2] + noise[:4048], prose[: 2 * size + 2000],
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r for r in rules.compression_rules(df).collect()}
    assert [found[i].kept for i in range(6)] == [True, True, False, False, False, True]
    assert [found[i].bad_chunks for i in (0, 2, 4)] == pytest.approx([0, 0.2, 1 / 3])


# --- sharding --------------------------------------------------------------


def draw(key, shard):
    """The hash of a long and a long, the second seeded with the first."""
    first = xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)
    bits = xxhash.xxh64_intdigest(struct.pack("<q", shard), seed=first) >> 11
    return -math.log((bits + 0.5) / (1 << 53))


def test_shards_equal_brute_force(docs):
    n, texts = 24, {r.doc_id: r.text for r in docs.collect()}
    rows = sharding.assign_shards(docs, [1.0] * n).collect()
    slots = defaultdict(list)
    for r in rows:
        draws = [draw(r.doc_id, i) for i in range(n + 1)]
        assert r.shard == draws.index(min(draws[:n])) and r.law == "key"
        assert r.grown_shard == draws.index(min(draws)) and r.grown_shard in (r.shard, n)
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
        slots[r.shard].append((r.slot, r.doc_id))
    for found in slots.values():
        assert [s for s, _ in sorted(found)] == list(range(len(found)))
        assert [i for _, i in sorted(found)] == sorted(i for _, i in found)


def test_weights_and_growth(spark):
    rows = spark.range(40_000).selectExpr("id as doc_id", "'t' as text")
    before = {r.doc_id: r for r in sharding.assign_shards(rows, [1.0, 3.0, 0.0]).collect()}
    share = sum(r.shard == 1 for r in before.values()) / len(before)
    assert abs(share - 0.75) < 0.01 and all(r.shard != 2 for r in before.values())
    after = {r.doc_id: r.shard for r in sharding.assign_shards(rows, [1.0, 3.0, 0.0, 1.0]).collect()}
    assert all(after[i] == before[i].grown_shard for i in after)
    with pytest.raises(ValueError):
        sharding.winner(rows.doc_id, [0.0])


def test_written_shards_hold_every_row(spark, docs, tmp_path):
    sharding.write_shards(docs, [1.0] * 4, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    placed = {r.doc_id: r.shard for r in sharding.assign_shards(docs, [1.0] * 4).collect()}
    assert {r.doc_id: r.shard for r in back.collect()} == placed


# --- mixing ----------------------------------------------------------------


def water_fill(sizes):
    """Share by weight, cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] if None in sizes else []
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not above:
            target.update({s: left * weight[s] / total for s in open_})
            break
        target.update({s: 2.0 * sizes[s] for s in above})
        left -= sum(2.0 * sizes[s] for s in above)
        open_ -= above
    return target


def test_targets_and_budgets(spark):
    rnd = random.Random(4)
    rows = [
        (i, " ".join(["w"] * rnd.choice([0, 1, 7, 40])), rnd.choice(["a", "B", "é", "z", None] + ["hot"] * 4))
        for i in range(600)
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = {r.doc_id: r for r in mixing.mix_sources(df).collect()}
    sizes, taken = Counter(), Counter()
    for i, text, source in rows:
        sizes[source] += len(text.split())
        taken[source] += found[i].taken
        assert found[i].size == len(text.split()) and 0 <= found[i].taken <= 2 * found[i].size
    want = water_fill(sizes)
    for i, _, source in rows:
        assert found[i].target == pytest.approx(want[source]) and found[i].source_size == sizes[source]
    assert {s: math.floor(t + 1e-9) for s, t in want.items()} == dict(taken)
    again = {r.doc_id: r.taken for r in mixing.mix_sources(df.repartition(7)).collect()}
    assert again == {i: r.taken for i, r in found.items()}


def test_mixed_rows_hold_the_words_taken(spark, docs):
    took = {r.doc_id: r for r in mixing.mix_sources(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    words, out = Counter(), mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        words[r.doc_id] += len(r.text.split())
        assert texts[r.doc_id].startswith(r.text)
    assert {i: r.taken for i, r in took.items() if r.taken} == dict(words)
