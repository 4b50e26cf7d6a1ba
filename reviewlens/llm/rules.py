"""Quality rules by bands of compression ratio.

A text is compressed as a whole and in fixed chunks. Repetitive text compresses too
well and noise too little; what is usual depends on the length, so the limits do too.

With labels, the limits of a length class are what all but a small share of the texts
labelled good reach (`TAIL` at either end), and so are those of the chunks (`CHUNK_TAIL`);
all labelled rows count, as histograms, of which at most `CELLS` numbers a class reach the
driver. A class with fewer than `LEAST_ROWS` good texts, or any text without labels, is
judged by the fixed `BANDS` and `CHUNK_BAND`. Measures are then written to the shared
folder when this is called. Labels of rows whose id has none, or several, count for each
row with that id.

Defined results: null and empty texts have zero counts, ratio 1 and fail the base
rule; a text of one chunk or less is judged as a whole only, and the last chunk of a
longer text is its last ``CHUNK_BYTES``; rows that repeat are rows of their own; an
empty table gives no rows. Texts of any length are processed whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.llm.common import map_texts, narrow
from reviewlens.sources.staging import stage

MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, bytes bigint, ratio double, "
    "chunk_ratios array<double>"
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
CHUNK_BYTES = 4096
LEVEL = 3
# (bytes up to, least ratio, most ratio) of a whole text; the last holds for longer ones.
BANDS = (
    (256, 0.5, 2.5),
    (512, 1.1, 2.6),
    (2048, 1.3, 3.0),
    (8192, 1.5, 3.4),
    (float("inf"), 1.6, 4.5),
)
CHUNK_BAND = (1.3, 3.6)
# (chunks up to, chunks that may lie outside their band); the last holds for longer texts.
BAD_CHUNKS = ((3, 0), (float("inf"), 1))
# Shares of good texts, and of their chunks, that may lie beyond a learned limit.
TAIL, CHUNK_TAIL = 0.005, 0.0005
LEAST_ROWS = 100
# Cells of a histogram for each doubling of the ratio, and in all.
CELLS_PER_DOUBLING, CELLS = 64, 1024


def repeated_words(words: list) -> int:
    """Words inside three-word windows that the text holds twice or more."""
    if len(words) < 4:
        return 0
    seen: dict = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
    _, which, counts = np.unique(
        pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True
    )
    again = counts[which] > 1
    mark = np.zeros(len(words), bool)
    for shift in range(3):
        mark[shift : len(words) - 2 + shift] |= again
    return int(mark.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # of bytes: splits at the six blanks of ASCII alone
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def base_fails(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def compression(text: str, compress) -> tuple[int, float, list[float]]:
    """(bytes, ratio of the whole, ratios of the chunks of a text of more than one)."""
    data = text.encode("utf-8", "surrogatepass")
    if not data:
        return 0, 1.0, []
    ratio = len(data) / len(compress(data))
    if len(data) <= CHUNK_BYTES:
        return len(data), ratio, []
    last = len(data) - CHUNK_BYTES
    chunks = [data[at : at + CHUNK_BYTES] for at in (*range(0, last, CHUNK_BYTES), last)]
    return len(data), ratio, [len(c) / len(compress(c)) for c in chunks]


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id and MEASURES) of every whole text, in one pass."""

    def make():
        compress = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False).compress

        def one(whole: str) -> tuple:
            counts = base_counts(whole)
            return (*counts, base_fails(counts[0], counts[4]), *compression(whole, compress))

        return lambda texts: list(zip(*map(one, texts)))

    return map_texts(narrow(docs, key, text), make, MEASURES)


@dataclass(frozen=True)
class Limits:
    """(least, most) ratio of a text of each length class, and of a chunk."""

    texts: tuple[tuple[float, float], ...] = tuple((low, high) for _, low, high in BANDS)
    chunk: tuple[float, float] = CHUNK_BAND


def length_class(size: Column) -> Column:
    out = F.lit(len(BANDS) - 1)
    for i in range(len(BANDS) - 2, -1, -1):
        out = F.when(size <= BANDS[i][0], i).otherwise(out)
    return out


def _cell(ratio: Column) -> Column:
    """The histogram cell of a ratio; cells are equally wide in its logarithm."""
    cell = F.floor(F.log2(F.greatest(ratio, F.lit(2.0**-4))) * CELLS_PER_DOUBLING) + 4 * CELLS_PER_DOUBLING
    return F.least(cell, F.lit(CELLS - 1)).cast("int")


def _between(cells: dict[int, int], tail: float) -> tuple[float, float]:
    """Borders of the cells that hold all but a share ``tail`` at either end."""
    total, seen = sum(cells.values()), 0
    edge = lambda c: 2.0 ** (c / CELLS_PER_DOUBLING - 4)
    low = high = None
    for cell in sorted(cells):
        seen += cells[cell]
        if low is None and seen > tail * total:
            low = edge(cell)
        if high is None and seen >= (1 - tail) * total:
            high = edge(cell + 1)
    return low, high


def fit_limits(rows: DataFrame, labels: DataFrame, label: str = "quality") -> Limits:
    """Limits of the rows of `measured` that ``labels`` (doc_id, label) call good (1)."""
    good = labels.where(F.col(label) == 1).select(F.col("doc_id").alias("label_id"))
    own = rows.where(~F.col("base_failed")).join(good, F.col("doc_id") == F.col("label_id"))
    texts = own.select(length_class(F.col("bytes")).alias("kind"), _cell(F.col("ratio")).alias("cell"))
    chunks = own.select(F.explode("chunk_ratios").alias("r")).select(F.lit(-1).alias("kind"), _cell(F.col("r")).alias("cell"))
    counts = texts.unionByName(chunks).groupBy("kind", "cell").agg(F.count("*").alias("n")).collect()
    found: dict[int, dict[int, int]] = {}
    for r in counts:
        found.setdefault(r["kind"], {})[r["cell"]] = r["n"]
    fixed = Limits()
    learned = lambda kind, tail, other: (
        _between(found[kind], tail) if sum(found.get(kind, {}).values()) >= LEAST_ROWS else other
    )
    return Limits(
        tuple(learned(i, TAIL, band) for i, band in enumerate(fixed.texts)),
        learned(-1, CHUNK_TAIL, fixed.chunk),
    )


def judged(rows: DataFrame, limits: Limits) -> DataFrame:
    """Verdicts on rows of `measured`: kept, ratio, worst_chunk_ratio and bad_chunks."""
    low, high = (
        F.get(F.array(*[F.lit(pair[i]) for pair in limits.texts]), length_class(F.col("bytes"))) for i in (0, 1)
    )
    least, most = limits.chunk
    bad = F.size(F.filter("chunk_ratios", lambda r: (r < least) | (r > most)))
    chunks = F.greatest(F.size("chunk_ratios"), F.lit(1))
    allowed = F.lit(BAD_CHUNKS[-1][1])
    for up_to, n in reversed(BAD_CHUNKS[:-1]):
        allowed = F.when(chunks <= up_to, n).otherwise(allowed)
    fits = F.col("ratio").between(low, high) & (bad <= allowed)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (fits & ~F.col("base_failed")).alias("kept"), "ratio",
        F.coalesce(F.array_max("chunk_ratios"), F.col("ratio")).alias("worst_chunk_ratio"),
        (bad / chunks).alias("bad_chunks"),
    )


def compression_rules(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    labels: DataFrame | None = None,
    label: str = "quality",
) -> DataFrame:
    """One row per row: base counts, the verdict ``kept``, and the ratios behind it.

    (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, ratio, worst_chunk_ratio, bad_chunks); the last is the share of bad chunks.
    """
    rows = measured(docs, key, text)
    if labels is None:
        return judged(rows, Limits())
    rows = stage(rows, "measures")
    return judged(rows, fit_limits(rows, labels, label))
