"""Text shape, normalisation and tokens as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from reviewlens.schema import MIN_TOKEN_LENGTH, PUNCTUATION, STOP_WORDS

# The JVM's `\s`, spelled out because engines differ on the vertical tab.
WHITESPACE = r"[ \t\n\x0B\f\r]"
# Characters that count as two where text is measured in 16-bit units.
_TWO_UNITS = r"[\x{10000}-\x{10FFFF}]"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def word_count(text: Column | str) -> Column:
    """Pieces of ``text`` between single spaces, trailing empty pieces dropped.

    Leading and inner empty pieces count, the empty text has one piece, a text
    of spaces only has none. Only the space separates, not tab or newline.
    """
    text = _col(text)
    body = F.rtrim(text)
    spaces = F.length(body) - F.length(F.replace(body, F.lit(" "), F.lit("")))
    return (
        F.when(text.isNull(), F.lit(None))
        .when(text == "", 1)
        .when(body == "", 0)
        .otherwise(spaces + 1)
        .cast("int")
    )


def capital_ratio(text: Column | str) -> Column:
    """Share of non-space characters equal to their own upper case, 2 decimals.

    Digits, symbols and caseless letters count as capitals; a text without
    non-space characters has ratio 1. A character of two 16-bit units counts as
    two capitals, since its halves have no case. ASCII is counted by removing
    runs, so only the remaining characters are compared one by one.
    """
    text = _col(text)
    others = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    single = F.regexp_replace(others, _TWO_UNITS + "+", "")
    doubled = F.length(others) - F.length(single)
    total = F.length(F.replace(text, F.lit(" "), F.lit(""))) + doubled
    ascii_small = F.length(text) - F.length(F.regexp_replace(text, "[a-z]+", ""))
    other_small = F.size(F.filter(F.split(single, ""), lambda c: c != F.upper(c)))
    ratio = F.try_divide(total - ascii_small - other_small, total)
    return F.round(F.coalesce(ratio, F.when(total == 0, 1.0)), 2)


def strip_punctuation(text: Column | str) -> Column:
    """Remove sentence marks; the neighbours of a removed mark are joined."""
    return F.regexp_replace(_col(text), f"[{PUNCTUATION}]+", "")


def surface_tokens(text: Column | str) -> Column:
    """Tokens of the punctuation-free text; an edge blank yields an empty token."""
    return F.split(strip_punctuation(text), WHITESPACE + "+")


def kept_tokens(tokens: Column, stop: Iterable[str] = STOP_WORDS) -> Column:
    """Tokens long enough and not in ``stop`` (case-sensitive), then lower-cased."""
    stop = list(stop)

    def keep(token: Column) -> Column:
        size = F.length(token)
        # Length is meant in 16-bit units; a shorter text of them may reach it.
        wide = (size == MIN_TOKEN_LENGTH - 1) & token.rlike(_TWO_UNITS)
        long_enough = (size >= MIN_TOKEN_LENGTH) | wide
        return long_enough & ~token.isin(stop) if stop else long_enough

    return F.transform(F.filter(tokens, keep), F.lower)


def normalized(text: Column | str, stop: Iterable[str] = STOP_WORDS) -> Column:
    """Normalised text without lemma substitution: one expression, no shuffle."""
    return F.array_join(kept_tokens(surface_tokens(text), stop), " ")


def normalized_tokens(text: Column | str, stop: Iterable[str] = STOP_WORDS) -> Column:
    """``tokens(normalized(text))`` without joining and splitting again."""
    kept = kept_tokens(surface_tokens(text), stop)
    # A one-element transform binds the tokens, so they are computed once.
    padded = F.transform(
        F.array(kept),
        lambda words: F.when(F.size(words) == 0, F.array(F.lit(""))).otherwise(words),
    )
    return F.get(padded, F.lit(0))


def _no_tokens() -> Column:
    return F.array().cast("array<string>")


def tokens(text: Column | str) -> Column:
    """Lower-cased pieces between single whitespace characters.

    The same words as ``pyspark.ml.feature.Tokenizer``: trailing empty pieces
    are dropped, and the empty text has one empty piece.
    """
    lowered = F.lower(_col(text))
    body = F.regexp_replace(lowered, WHITESPACE + "+$", "")
    return (
        F.when(lowered == "", F.array(F.lit("")))
        .when(body == "", _no_tokens())
        .otherwise(F.split(body, WHITESPACE))
    )
