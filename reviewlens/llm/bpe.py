"""BPE encoding and decoding by speculation and verification.

Greedy longest match proposes the tokens of every new word. A proposal is right when
every adjacent pair is compatible, that is when merging the two alone gives just the
two back; all pairs of a batch are tested at once as integer codes. Only words with an
incompatible pair go through exact merging.

The tokenizer file (vocabulary, merges, special tokens, word-end mark) and the library's
letters are read on the driver and broadcast; their size does not depend on the data. Texts stay where they are.

Defined results: null and empty texts have no tokens and decode to the empty text;
strings of special tokens inside a text become those tokens, as the library does; rows
that repeat are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from dataclasses import dataclass
from functools import cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, normalizers

from reviewlens.llm.common import map_texts, narrow, shared_values

FIELDS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"

# White space of the normaliser, pieces of the pre-tokenizer.
_CHUNKS = regex.compile(r"[^\t-\r \x85\xa0  -     　]+")
_PIECES = "'s|'t|'re|'ve|'m|'ll|'d|[{0}]+|[{1}]|[^{0}{1}]+"
# Python's split() would also split at these.
_CONTROLS = regex.compile(r"[\x1c-\x1f]")
# Words remembered by one task.
REMEMBERED = 400_000


@dataclass(frozen=True)
class Vocabulary:
    """What the tokenizer file says, as plain values."""

    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    special: dict[str, int]
    end: str
    letters: str
    numbers: str
    lower: dict[int, str]


@cache
def library_letters() -> tuple[str, str, dict[int, str]]:
    """What the tokenizers library takes for letters and numbers, and its own lower case.

    Its Unicode tables are of another version than Python's, so it is asked for every code
    point, once on the driver. Letters and numbers come as ranges of a regular expression;
    the lower case holds only the letters that Python lowers otherwise.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))

    def ranges(kind: str) -> str:
        rest = normalizers.Replace(Regex(f"[{kind}]+"), "").normalize_str(every)
        other = np.zeros(0x110000 + 1, bool)
        other[0xD800:0xE000] = other[-1] = True
        other[np.frombuffer(rest.encode("utf-32-le"), "<u4")] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[True], other]))).tolist()
        return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2]))

    alone = "\n".join(every.replace("\n", ""))
    lowered = normalizers.Lowercase().normalize_str(alone)
    pairs = zip(alone.split("\n"), lowered.split("\n"))
    lower = {ord(c): low for c, low in pairs if low != c.lower()}
    return ranges(r"\p{L}"), ranges(r"\p{N}"), lower


def load_vocabulary(path: str) -> Vocabulary:
    """Read a word-end BPE tokenizer file (JSON) on the driver."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    return Vocabulary(
        model["vocab"],
        {tuple(p): rank for rank, p in enumerate(pairs)},
        {t["content"]: t["id"] for t in spec["added_tokens"]},
        model["end_of_word_suffix"] or "",
        *library_letters(),
    )


def byte_letters() -> list[str]:
    """The visible letter that stands for each byte in a byte-level vocabulary."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b if b in visible else next(other)) for b in range(256)]


class Encoder:
    """Encodes and decodes texts; remembers words and pair verdicts while it lives."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ids = vocabulary.ids
        self.letters = byte_letters()
        # Length of the longest token that begins with three given letters.
        self.longest: dict[str, int] = {}
        for token in self.ids:
            bare = len(token.removesuffix(vocabulary.end))
            self.longest[token[:3]] = max(self.longest.get(token[:3], 3), bare)
        names = {**self.ids, **vocabulary.special}
        self.tokens = [""] * (max(names.values()) + 1)
        for token, number in names.items():
            self.tokens[number] = token
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.exactly_merged = 0
        special = "|".join(map(regex.escape, vocabulary.special)) or r"(?!)"
        self.special = regex.compile(f"({special})")
        self.pieces = re.compile(_PIECES.format(vocabulary.letters, vocabulary.numbers))
        self.newer = re.compile("|".join(map(chr, vocabulary.lower)) or r"(?!)")

    # --- texts -------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token numbers of each text as little-endian unsigned 32-bit integers."""
        if len(self.chunks) > REMEMBERED or len(self.words) > REMEMBERED:
            self.chunks, self.words = {}, {}
        split = [self._split(text) for text in texts]
        new = {c for parts in split for part in parts if isinstance(part, list) for c in part}
        self._learn([c for c in new if c not in self.chunks])
        known = self.chunks.__getitem__
        return [
            b"".join(b"".join(map(known, p)) if isinstance(p, list) else p for p in parts)
            for parts in split
        ]

    def decode(self, ids: bytes) -> str:
        """Token strings with a blank between them; the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def _split(self, text: str) -> list:
        """Chunks between white space, lower-cased, and the bytes of special tokens."""
        if "<|" not in text:
            return [self._chunks(text)]
        parts: list = []
        for i, piece in enumerate(self.special.split(text)):
            if i % 2:
                parts.append(self.vocabulary.special[piece].to_bytes(4, "little"))
            else:
                parts.append(self._chunks(piece))
        return parts

    def _chunks(self, text: str) -> list[str]:
        # Lower-casing goes letter by letter: a sigma at a word's end is no exception.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        if self.newer.search(text):
            text = text.translate(self.vocabulary.lower)
        text = text.lower()
        return _CHUNKS.findall(text) if _CONTROLS.search(text) else text.split()

    def _learn(self, chunks: list[str]) -> None:
        pieces = {c: self.pieces.findall(c) for c in chunks}
        fresh = {w for found in pieces.values() for w in found if w not in self.words}
        self._encode_words(list(fresh))
        for chunk, found in pieces.items():
            self.chunks[chunk] = b"".join(map(self.words.__getitem__, found))

    # --- words -------------------------------------------------------------

    def _encode_words(self, words: list[str]) -> None:
        spelled = ["".join(map(self.letters.__getitem__, w.encode("utf-8"))) for w in words]
        proposed = [self._longest_match(s) for s in spelled]
        lengths = np.fromiter(map(len, proposed), np.int64, len(words))
        flat = np.fromiter((t for p in proposed for t in p), np.int64, int(lengths.sum()))
        ends = np.cumsum(lengths)
        word_of = np.repeat(np.arange(len(words)), lengths)
        # A word of one token pairs with nothing; -1 stands for "alone".
        left, right = flat[:-1], flat[1:]
        inside = word_of[:-1] == word_of[1:]
        codes = left[inside] << 32 | right[inside]
        alone = flat[(ends - lengths)[lengths == 1]] << 32 | 0xFFFFFFFF
        owners = np.concatenate([word_of[:-1][inside], np.flatnonzero(lengths == 1)])
        fits = self._compatible(np.concatenate([codes, alone]))
        failing = np.zeros(len(words), bool)
        failing[owners[~fits]] = True
        for word, letters, tokens, fails in zip(words, spelled, proposed, failing.tolist()):
            if fails:
                self.exactly_merged += 1
                tokens = [self.ids[t] for t in self._merge(self._symbols(letters, True))]
            self.words[word] = array("I", tokens).tobytes()

    def _longest_match(self, word: str) -> list[int]:
        ids, end, at, tokens = self.ids.get, self.vocabulary.end, 0, []
        size, longest = len(word), self.longest.get
        while at < size:
            for stop in range(min(size, at + longest(word[at : at + 3], 3)), at, -1):
                token = ids(word[at:stop] + end if stop == size else word[at:stop])
                if token is not None:
                    tokens.append(token)
                    at = stop
                    break
        return tokens

    def _compatible(self, codes: np.ndarray) -> np.ndarray:
        """For codes ``left << 32 | right``, whether merging leaves the two as they are."""
        distinct, which = np.unique(codes, return_inverse=True)
        if len(self.pairs) > 8 * REMEMBERED:
            self.pairs = {}
        verdicts = [self._verdict(c) for c in distinct.tolist()]
        return np.array(verdicts, bool)[which] if len(verdicts) else np.zeros(0, bool)

    def _verdict(self, code: int) -> bool:
        known = self.pairs.get(code)
        if known is None:
            pair = [self.tokens[code >> 32]]
            if code & 0xFFFFFFFF != 0xFFFFFFFF:
                pair.append(self.tokens[code & 0xFFFFFFFF])
            end = self.vocabulary.end
            last = bool(end) and pair[-1].endswith(end)
            bare = "".join(pair).removesuffix(end) if last else "".join(pair)
            known = self.pairs[code] = self._merge(self._symbols(bare, last)) == pair
        return known

    def _symbols(self, letters: str, last: bool) -> list[str]:
        symbols = list(letters)
        if last and symbols:
            symbols[-1] += self.vocabulary.end
        return symbols

    def _merge(self, symbols: list[str]) -> list[str]:
        """Exact merging: the pair of lowest rank first, the leftmost of equal ones."""
        rank, none = self.vocabulary.ranks.get, len(self.vocabulary.ranks)
        found = [rank(p, none) for p in zip(symbols, symbols[1:])]
        while found and (best := min(found)) != none:
            at = found.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del found[at]
            if at:
                found[at - 1] = rank((symbols[at - 1], symbols[at]), none)
            if at < len(found):
                found[at] = rank((symbols[at], symbols[at + 1]), none)
        return symbols


def encode_documents(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, ids): token numbers of every whole text."""
    shared = shared_values(docs.sparkSession, load_vocabulary(path))

    def make():
        encoder = Encoder(Vocabulary(**shared.value))
        return lambda texts: [[np.frombuffer(x, "<u4") for x in encoder.encode(texts)]]

    return map_texts(narrow(docs, key, text), make, "ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    shared = shared_values(encoded.sparkSession, load_vocabulary(path))
    joined = encoded.selectExpr("doc_id", "array_join(ids, ' ') as text")

    def make():
        encoder = Encoder(Vocabulary(**shared.value))
        return lambda texts: [
            [encoder.decode(np.array(x.split(), "<u4").tobytes()) for x in texts]
        ]

    decoded = map_texts(joined, make, "decoded string")
    return decoded.withColumnRenamed("decoded", "text")


def encoding_digests(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id and FIELDS): digests of the token numbers and of what they decode to."""
    shared = shared_values(docs.sparkSession, load_vocabulary(path))

    def make():
        encoder = Encoder(Vocabulary(**shared.value))

        def each(texts: list[str]):
            encoded = encoder.encode(texts)
            return [
                [len(x) // 4 for x in encoded],
                [hashlib.sha256(x).hexdigest() for x in encoded],
                [
                    hashlib.sha256(encoder.decode(x).encode("utf-8")).hexdigest()
                    for x in encoded
                ],
            ]

        return each

    return map_texts(narrow(docs, key, text), make, FIELDS)
