"""Language identification by words first, then by progressively shorter letter groups.

A word that the model knows scores its log frequency in each language. An unseen word is
read place by place: the longest known group of letters that ends there counts, first of
`GRAM` letters, then of fewer, down to single letters. A text's score in a language is the
sum over its words and the log share of the language; the posterior of the best is the
score.

Training counts the words of all training rows: counts are added up inside the tasks,
then by Spark, and letter groups are counted from the table of distinct words. The model
holds the words and groups of largest share in any language, at most `CELLS` numbers for
each table, and at most `LANGUAGES` languages, those with the most words; words longer than
`LONGEST` code points are scored by their groups. So what is broadcast has a bound, which
is a parameter of the model; every training row counts towards it.

A word is a run of letters in lower case.

Defined results: a text without letters, a null text, and any text where nothing was
learned, is `und` with score 0; a null id is not held out by chance but by its empty text;
rows without language train nothing; a language of the empty string is a language; equal
scores go to the language that comes first in code-point order; repeated rows train as
often as they stand; an empty table gives no rows. `fit` runs jobs when it is called.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.llm.common import ROWS_AT_ONCE, map_texts, narrow, shared_values
from reviewlens.sources.staging import stage

FOLDS, HELD_FOLD = 5, 0
UNKNOWN = "und"
GRAM = 5
LANGUAGES = 256
LONGEST = 64
# Numbers in the table of words and in that of letter groups.
CELLS = 1_000_000
SMOOTHING = 0.5
# Shares of words and groups are told apart to this part of a power of two.
SHARE_STEPS = 8
# Stand in front of and behind a word in its letter groups.
START, END = "<", ">"
# Distinct words, and letters of texts, that a task counts before it hands on the counts.
HELD_WORDS = 400_000
HELD_LETTERS = 64_000_000
# Unseen words whose scores a task keeps.
KEPT_WORDS = 100_000

_LETTERS = regex.compile(r"\p{L}+")


def word_bag(text: str) -> Counter:
    """How often each word stands in a text; most pieces between blanks are words."""
    found = Counter(text.lower().split())
    for piece in [p for p in found if not p.isalpha()]:
        n = found.pop(piece)
        for word in _LETTERS.findall(piece):
            found[word] += n
    return found


def held_out(key: Column, folds: int = FOLDS, fold: int = HELD_FOLD) -> Column:
    """Whether the remainder of crc32 of the id as text is the one kept from training."""
    number = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return number % folds == fold


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n) over all rows (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        letters = 0
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    counts.setdefault(lang, Counter()).update(word_bag(text))
                    letters += len(text)
                if letters > HELD_LETTERS or sum(map(len, counts.values())) > HELD_WORDS:
                    yield from _batches(counts)
                    counts, letters = {}, 0
        yield from _batches(counts)

    parts = rows.select("lang", "text").mapInArrow(run, "lang string, word string, n bigint")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _batches(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, own in counts.items():
        columns = [
            pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.string()),
            pa.array(list(own.values()), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])


def gram_counts(counted: DataFrame, size: int = GRAM) -> DataFrame:
    """(lang, gram, n): groups of 1 to ``size`` letters in the words (lang, word, n)."""
    framed = F.concat(F.lit(START), "word", F.lit(END))
    places = counted.select("lang", "n", framed.alias("w")).select(
        "lang", "n", "w", F.explode(F.sequence(F.lit(1), F.length("w"))).alias("at")
    )
    groups = [
        F.when(F.col("at") + (k - 1) <= F.length("w"), F.col("w").substr(F.col("at"), F.lit(k)))
        for k in range(1, size + 1)
    ]
    grams = places.select("lang", "n", F.explode(F.array(groups)).alias("gram")).where("gram is not null")
    return grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _most_telling(counted: DataFrame, item: str, languages: list[str], totals: np.ndarray, most: int) -> tuple[list[str], np.ndarray]:
    """Items of largest share in any language, at most ``most``, and their counts by language.

    Shares are compared in steps, and whole steps are taken, so no row is ranked against all.
    """
    pairs = [F.lit(x) for i, (lang, n) in enumerate(zip(languages, totals.tolist())) for x in (lang, F.struct(F.lit(i).alias("at"), F.lit(n).alias("n")))]
    own = F.create_map(*pairs)[F.col("lang")]
    known = counted.where(F.col("lang").isin(languages) & (F.length(item) <= LONGEST))
    step = F.floor(-F.log2(F.max(F.col("n") / own["n"])) * SHARE_STEPS).cast("int")
    # One entry a language.
    counts = F.collect_list(F.struct(own["at"].alias("at"), F.col("n").cast("double").alias("n")))
    items = stage(known.groupBy(item).agg(step.alias("step"), counts.alias("counts")), item)
    # A share is at least 2^-63, so there are few hundred steps.
    sizes = items.groupBy("step").agg(F.count("*").alias("n")).orderBy("step").collect()
    last, taken = -1, 0
    for row in sizes:
        taken += row["n"]
        if taken > most:
            break
        last = row["step"]
    chosen = items.where(F.col("step") <= last).select(item, "counts").orderBy(item).toArrow()
    table = np.zeros((chosen.num_rows, len(languages)))
    if chosen.num_rows:
        lists = chosen.column(1).combine_chunks()
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        at, n = (c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())
        table[row, at] = n
    return chosen.column(0).to_pylist(), table


@dataclass(frozen=True)
class Model:
    """Languages, and per word and letter group one row of log frequencies."""

    languages: list[str]
    prior: np.ndarray
    word_rows: dict[str, int]
    word_logs: np.ndarray
    gram_rows: dict[str, int]
    gram_logs: np.ndarray


def _logs(table: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Smoothed log frequencies of the rows of a table of counts."""
    return np.log((table + SMOOTHING) / (totals + SMOOTHING * max(1, len(table))))


def fit(training: DataFrame, lang: str = "lang", text: str = "text", cells: int = CELLS, languages: int = LANGUAGES) -> Model:
    """The model of all rows of ``training`` that have a language and a text."""
    rows = training.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counted = stage(word_counts(rows.where("lang is not null and text is not null")), "words")
    sizes = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    totals = {r["lang"]: r["n"] for r in sizes.orderBy(F.desc("n"), "lang").limit(languages).collect()}
    if not totals:
        return Model([], np.zeros(0), {}, np.zeros((0, 0)), {}, np.zeros((0, 0)))
    names = sorted(totals)
    tokens = np.array([totals[x] for x in names], np.float64)
    known, counts = _most_telling(counted, "word", names, tokens, cells // len(names))
    grams, gram_table = _most_telling(gram_counts(counted), "gram", names, tokens, cells // len(names))
    gram_logs, sizes = np.zeros_like(gram_table), np.array([len(g) for g in grams], np.int64)
    for size in range(1, GRAM + 1):
        own = gram_table[sizes == size]
        gram_logs[sizes == size] = _logs(own, own.sum(0))
    return Model(
        names, np.log(tokens / tokens.sum()),
        {w: i for i, w in enumerate(known)}, _logs(counts, tokens),
        {g: i for i, g in enumerate(grams)}, gram_logs,
    )


def backed_off(word: str, gram_rows: dict[str, int], gram_logs: np.ndarray) -> np.ndarray:
    """Scores of an unseen word: the longest known group that ends at each place.

    Groups overlap, so each counts by one part in its length.
    """
    framed = f"{START}{word}{END}"
    out = np.zeros(gram_logs.shape[1])
    for end in range(2, len(framed) + 1):
        for size in range(min(GRAM, end), 0, -1):
            row = gram_rows.get(framed[end - size : end])
            if row is not None:
                out += gram_logs[row] / size
                break
    return out


class Scorer:
    """Language and score of texts; built once a task from the model's plain values."""

    def __init__(self, languages, prior, word_rows, word_logs, gram_rows, gram_logs):
        self.languages, self.prior = languages, prior
        self.known, self.known_logs = word_rows, word_logs
        self.grams = gram_rows, gram_logs
        self._forget()

    def _forget(self) -> None:
        """Drop the scores of unseen words, which stand behind those of the known ones."""
        self.rows = dict(self.known)
        self.logs = np.concatenate([self.known_logs, np.zeros((1024, len(self.languages)))])

    def _add(self, word: str) -> int:
        row = self.rows[word] = len(self.rows)
        if row == len(self.logs):
            self.logs = np.concatenate([self.logs, np.zeros((len(self.logs) // 2, len(self.languages)))])
        self.logs[row] = backed_off(word, *self.grams)
        return row

    def score(self, text: str) -> tuple[str, float]:
        found = word_bag(text) if self.languages else None
        if not found:
            return UNKNOWN, 0.0
        if len(self.rows) - len(self.known) > KEPT_WORDS:
            self._forget()
        at = list(map(self.rows.get, found))
        if None in at:
            at = [self._add(w) if row is None else row for w, row in zip(found, at)]
        n = np.fromiter(found.values(), np.float64, len(found))
        total = self.prior + n @ self.logs[at]
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())

    def __call__(self, texts: list[str]) -> tuple[list[str], list[float]]:
        scored = [self.score(t) for t in texts]
        return [s[0] for s in scored], [s[1] for s in scored]


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs``."""
    shared = shared_values(docs.sparkSession, model)
    rows = narrow(docs, key, text).withColumn("held_out", held_out(F.col("doc_id")))
    make = lambda: Scorer(**shared.value)
    return map_texts(rows, make, "lang_pred string, score double", ("doc_id", "held_out"))


def identify_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """`predict` by a model of the rows of ``docs`` that are not held out."""
    own = docs.where(~held_out(F.col(key)))
    return predict(docs, fit(own, lang, text), key, text)
