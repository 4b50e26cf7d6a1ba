"""Reproducible split and fold assignment from a row key.

The assignment is a function of the key alone: it needs no shuffle and does
not change with partitioning, retries or cluster size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.schema import SPLIT_WEIGHTS

_DIGITS = 8
_RANGE = 16**_DIGITS


def _digest(key: Column | str, seed: str | None) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    text = key.cast("string")
    if seed is not None:
        text = F.concat(F.lit(f"{seed}:"), text)
    return F.substring(F.md5(text), 1, _DIGITS)


def split_part(
    key: Column | str,
    weights: Sequence[float] = SPLIT_WEIGHTS,
    seed: str | None = None,
) -> Column:
    """Index of the part a row belongs to; parts take ``weights`` of the key space."""
    if not weights or min(weights) < 0 or sum(weights) <= 0:
        raise ValueError("weights must be non-negative and not all zero")
    digest = _digest(key, seed)
    part = F.lit(len(weights) - 1)
    covered = float(sum(weights))
    for index in range(len(weights) - 2, -1, -1):
        covered -= weights[index + 1]
        bound = round(covered / sum(weights) * _RANGE)
        below = digest < f"{bound:0{_DIGITS}x}" if bound < _RANGE else F.lit(True)
        part = F.when(below, index).otherwise(part)
    return part


def random_split(
    df: DataFrame,
    key: str,
    weights: Sequence[float] = SPLIT_WEIGHTS,
    seed: str | None = None,
) -> list[DataFrame]:
    """Disjoint parts of ``df`` that together hold every row with a non-null key."""
    part = split_part(key, weights, seed)
    return [df.where(part == index) for index in range(len(weights))]


def fold_number(key: Column | str, folds: int, seed: str = "fold") -> Column:
    """Cross-validation fold of a row, independent of the train/test split."""
    number = F.conv(_digest(key, seed), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(folds)).cast("int")
