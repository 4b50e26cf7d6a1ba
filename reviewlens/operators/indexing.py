"""Consecutive row numbers and running totals over a distributed table."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens.operators.lookup import lookup_join
from reviewlens.sources.staging import stage

_MARK, _PART = "_mark", "_part"
# monotonically_increasing_id keeps the partition number above this many bits.
_POSITION_BITS = 33


def _range_staged(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` range-partitioned and sorted, each row tagged and written once."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    tagged = ranged.withColumn(_MARK, F.monotonically_increasing_id())
    part = F.shiftright(_MARK, _POSITION_BITS).cast("int")
    return stage(tagged.withColumn(_PART, part), "ranged")


def _part_offsets(staged: DataFrame, amount: Column) -> Column:
    """Total ``amount`` of all partitions before the row's own.

    Only one number per partition reaches the driver.
    """
    totals = staged.groupBy(_PART).agg(amount.alias("n")).collect()
    by_part = {row[_PART]: row["n"] for row in totals}
    sizes = [by_part.get(part, 0) for part in range(max(by_part, default=-1) + 1)]
    starts = list(accumulate(sizes, initial=0))
    return F.get(F.expr(f"array({', '.join(f'{s}L' for s in starts)})"), F.col(_PART))


def contiguous_index(
    df: DataFrame, order: Sequence[Column | str], name: str = "row_index"
) -> DataFrame:
    """Number rows 0, 1, 2, … in the total order given by ``order``.

    One range exchange sorts the rows into partitions, the tagged result is
    written once, and the numbers follow from the partition sizes. The whole
    table never meets in one task.
    """
    staged = _range_staged(df, order)
    position = F.col(_MARK).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    offset = _part_offsets(staged, F.count("*"))
    return staged.select(*df.columns, (offset + position).alias(name))


def running_start(
    df: DataFrame, order: Sequence[Column | str], amount: str, name: str
) -> DataFrame:
    """Add the total of ``amount`` over all rows before each row in ``order``."""
    staged = _range_staged(df, order)
    before = Window.partitionBy(_PART).orderBy(_MARK)
    earlier = F.sum(amount).over(before) - F.col(amount)
    offset = _part_offsets(staged, F.sum(amount))
    return staged.select(*df.columns, (offset + earlier).alias(name))


def string_index(df: DataFrame, column: str, name: str = "index") -> DataFrame:
    """(value, n, index): distinct values by falling frequency, then by value."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    ranked = contiguous_index(counts, [F.desc("n"), F.col("value")], name)
    return ranked.withColumn(name, F.col(name).cast("double"))


UNSEEN = ("error", "keep", "skip")


def apply_index(
    df: DataFrame, column: str, index: DataFrame, name: str = "index", unseen: str = "error"
) -> DataFrame:
    """Add ``name``: the number of each value of ``column`` in a table of `string_index`.

    A value that the table does not hold, and null, is an error, found by a job when this
    is called; with ``unseen="keep"`` it gets the number after the last one, with "skip"
    the row is left out. Hot values pass no exchange.
    """
    if unseen not in UNSEEN:
        raise ValueError(f"unseen must be one of {UNSEEN}")
    if name in df.columns:
        raise ValueError(f"there is a column {name} already")
    value, rows_of_value = "_value", "_n"
    rows = df.withColumn(value, F.col(column).cast("string"))
    numbers = index.select(
        F.col("value").alias(value), F.col("n").alias(rows_of_value), F.col(index.columns[-1]).alias(name)
    )
    seen = lookup_join(rows, numbers, value, rows_of_value).drop(value)
    if unseen == "skip":
        return seen
    rest = rows.join(numbers.select(value), value, "left_anti").drop(value)
    if unseen == "error":
        found = rest.select(column).first()
        if found is not None:
            raise ValueError(f"{column} has a value without index: {found[0]!r}")
        return seen
    last = index.agg(F.count("*").cast("double")).scalar()
    return seen.unionByName(rest.withColumn(name, last))
