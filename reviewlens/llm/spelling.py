"""Spelling variant grouping by Bloom-guided neighbourhoods.

The words of all texts are counted, and every single edit of every word is probed against
Bloom filters of the vocabulary. Only edits that a filter lets pass are spelled out and
shuffled; a join with the vocabulary then removes the false ones. A word's form is its
near word of largest count, if that is large enough; following forms leads to its root.

An edit is probed from one side only: a deletion from the longer word, a replacement from
the word with the smaller code point. Letters that no word holds are not tried.

Bounds. Filters are broadcast in slices of at most `FILTER_BYTES`; a larger vocabulary is
probed slice by slice, and no word is left out. The driver gets one count per word length
(lengths from `bloom.LAST_SHARD` on together), the letters in use, the blocks of one
filter at a time, and one flag a round of the search for roots. Counts are added up inside
the tasks before they are shuffled, so a frequent word is no hot key.

Defined results: a null text has no words, a null id counts as an empty one; repeated rows
are counted as often as they stand; equal counts are settled by code-point order; no
words, or an empty table, give no rows. The operator runs jobs when it is called and
writes its tables to the shared folder.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewlens.llm import bloom
from reviewlens.llm.common import ROWS_AT_ONCE, narrow
from reviewlens.sources.staging import stage

MIN_LENGTH = 7
MIN_COUNT = 2
# A form stands at least this many times as often as the word.
TIMES = 10
FILTER_BYTES = 32 << 20
# Letters of distinct words that a task holds before it hands on their counts.
HELD_LETTERS = 4_000_000
# Places probed, and edits handed on, at once.
PLACES_AT_ONCE = 1 << 16
EDITS_AT_ONCE = 4096

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def lowered(word: str) -> str:
    """A-Z in lower case, all else as it is."""
    return word.lower() if word.isascii() else word.translate(_LOWER)


def misspelled(doc_id: object, word: str, every: int) -> str:
    """``word``, without one code point if a hash of the id and the word says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    every: int | None = None,
) -> DataFrame:
    """(word, n) of all words of at least ``min_length`` code points, in lower case.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF. With ``every``, one in so
    many pairs of document and word loses a code point, see `misspelled`.
    """
    # A shorter run gives no word: nothing is ever added to one.
    find = re.compile(f"[A-Za-zÀ-ÿ]{{{min_length},}}").findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = Counter(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                for doc_id, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for word, n in Counter(find(body)).items():
                        word = lowered(word)
                        if every:
                            word = misspelled(doc_id, word, every)
                            if len(word) < min_length:
                                continue
                        if word not in counts:
                            held += len(word)
                        counts[word] += n
                    if held > HELD_LETTERS:
                        yield _batch(counts.keys(), counts.values())
                        counts, held = Counter(), 0
        yield _batch(counts.keys(), counts.values())

    parts = narrow(docs, key, text).mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def _batch(words, counts) -> pa.RecordBatch:
    columns = [pa.array(list(words), pa.string()), pa.array(list(counts), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n"])


def _letters(vocabulary: DataFrame) -> list[int]:
    """Code points that the words hold, in order; the alphabet bounds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            seen.update(*batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(map(ord, seen)), pa.int32())], names=["code"])

    codes = vocabulary.select("word").mapInArrow(run, "code int").distinct().collect()
    return sorted(r["code"] for r in codes)


def _layout(vocabulary: DataFrame) -> bloom.Layout:
    """Filters that fit into FILTER_BYTES, in as many slices as that takes."""
    shard = F.least(F.length("word"), F.lit(bloom.LAST_SHARD)).alias("shard")
    sizes = {r["shard"]: r["n"] for r in vocabulary.groupBy(shard).agg(F.count("*").alias("n")).collect()}
    slices = max(1, -(-sum(sizes.values()) * bloom.BITS_PER_KEY // (8 * FILTER_BYTES)))
    return bloom.Layout.of(sizes, slices)


def _filter(vocabulary: DataFrame, layout: bloom.Layout, part: int) -> np.ndarray:
    """The filter of one slice: blocks are put together in tasks, the driver lays them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = bloom.Spelled(batch.column(0).to_pylist())
            slices, block, bits = layout.places(words.hashes, bloom.shards(words.lengths))
            own = slices == part
            columns = [pa.array(block[own]), pa.array(bits[own].view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "bits"])

    keys = vocabulary.select("word").mapInArrow(run, "block bigint, bits bigint")
    blocks = keys.groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(layout.size, np.uint64)
    out[blocks.column(0).to_numpy()] = blocks.column(1).to_numpy().view(np.uint64)
    return out


def _probed(
    vocabulary: DataFrame, layout: bloom.Layout, part: int, filter_: np.ndarray, letters: list[int]
) -> DataFrame:
    """(word, n, other): edits of every word that the filter takes for words."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(filter_)

    def edits(words: list[str], spelled: bloom.Spelled) -> Iterator[tuple[int, str]]:
        """(index of the word, its edit) of what the filter lets pass."""
        for first in range(0, len(spelled.codes), PLACES_AT_ONCE):
            at = np.arange(first, min(first + PLACES_AT_ONCE, len(spelled.codes)))
            lengths = spelled.lengths[spelled.owner[at]]
            codes = spelled.codes[at]
            # Of a run of equal letters, only the first is deleted.
            again = (spelled.place[at] > 0) & (codes == spelled.codes[np.maximum(at, 1) - 1])
            gone = at[~again]
            shard = bloom.shards(lengths[~again] - 1)
            for i in bloom.found(layout, shared.value, part, spelled.deleted(gone), shard):
                word, place = spelled.owner[gone[i]], spelled.place[gone[i]]
                yield word, words[word][:place] + words[word][place + 1 :]
            shard = bloom.shards(lengths)
            for letter in letters:
                less = codes < letter
                tried = at[less]
                for i in bloom.found(layout, shared.value, part, spelled.replaced(tried, letter), shard[less]):
                    word, place = spelled.owner[tried[i]], spelled.place[tried[i]]
                    yield word, words[word][:place] + chr(letter) + words[word][place + 1 :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            passed: list[tuple[int, str]] = []
            for edit in edits(words, bloom.Spelled(words)):
                passed.append(edit)
                if len(passed) >= EDITS_AT_ONCE:
                    yield _passed(batch, passed)
                    passed = []
            yield _passed(batch, passed)

    return vocabulary.select("word", "n").mapInArrow(run, "word string, n bigint, other string")


def _passed(batch: pa.RecordBatch, edits: list[tuple[int, str]]) -> pa.RecordBatch:
    own = batch.take(pa.array([i for i, _ in edits], pa.int64()))
    columns = [*own.columns, pa.array([e for _, e in edits], pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n", "other"])


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, n, other, other_n): words one insertion, deletion or replacement apart.

    Every pair stands once. ``vocabulary`` (word, n) holds distinct words; it is read once
    a slice of the filter, so stage it before.
    """
    layout, letters = _layout(vocabulary), _letters(vocabulary)
    passed = None
    for part in range(layout.slices):
        some = _probed(vocabulary, layout, part, _filter(vocabulary, layout, part), letters)
        passed = some if passed is None else passed.unionByName(some)
    words = vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    return passed.join(words, "other").select("word", "n", "other", "other_n")


def roots(links: DataFrame) -> DataFrame:
    """(word, root): where the links (word, form) lead. Links must have no cycle.

    Each round doubles the steps taken; counts grow along a link, so rounds are few.
    """
    reached = stage(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = reached.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        stepped = stage(stepped, "roots")
        reached = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return reached


def spelling_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    times: int = TIMES,
    every: int | None = None,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word that stands ``min_count`` times.

    ``form`` is the near word of largest count (the smallest such in code-point order), if
    it stands at least ``times`` times (over 1, so that forms make no cycle) as often as
    the word, else null. ``root`` is where forms lead.
    """
    if times <= 1:
        raise ValueError("times must be over 1")
    counted = word_counts(docs, key, text, min_length, every)
    vocabulary = stage(counted.where(F.col("n") >= min_count), "vocabulary")
    pairs = near_pairs(vocabulary)
    side = lambda a, b, n: F.struct(F.col(a).alias("word"), F.col(b).alias("other"), F.col(n).alias("other_n"))
    both = F.explode(F.array(side("word", "other", "other_n"), side("other", "word", "n")))
    near = pairs.select(both.alias("p")).select("p.*", F.lit(None).cast("bigint").alias("n"))
    alone = vocabulary.select(
        "word", F.lit(None).cast("string").alias("other"), F.lit(None).cast("bigint").alias("other_n"), "n"
    )
    first = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("other_n")).alias("less"), "other")))
    found = near.unionByName(alone).groupBy("word").agg(
        F.max("n").alias("n"), F.count("other").alias("n_near"), first.alias("first")
    )
    is_form = -F.col("first.less") >= times * F.col("n")
    formed = found.select(
        "word", "n", "n_near",
        F.when(is_form, F.col("first.other")).alias("form"),
        F.when(is_form, -F.col("first.less")).alias("form_n"),
    )
    formed = stage(formed, "forms")
    ends = roots(formed.where("form is not null"))
    return formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
