"""Join of many rows to one row per key, safe when few keys own most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# There are fewer hot keys than this, or than shuffle partitions if those are more.
LEAST_SLOTS = 1000


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str | Sequence[str],
    rows_per_key: str,
    slots: int | None = None,
    total: Column | None = None,
) -> DataFrame:
    """Inner join ``rows`` to ``lookup`` (one row per ``key``) with hot keys apart.

    ``lookup[rows_per_key]`` tells how many of ``total`` rows carry the key; by
    default ``total`` is the sum over the lookup. Pass it when the lookup has
    many columns, so that the lookup is not aggregated once more for the sum.

    A key is hot when it owns more than ``total / slots`` rows; by default there is a
    slot for each shuffle partition, so no other key fills more than the average
    task. Hot keys, fewer than ``slots``, are broadcast by hint and their rows pass no
    exchange. The other rows meet the lookup by key; how is left to the optimizer,
    which broadcasts the lookup only when its measured size allows. ``rows`` is read
    for either part; stage it before if it is costly. ``rows_per_key`` is not part of
    the result.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if slots is None:
        partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        slots = max(LEAST_SLOTS, partitions)
    # Rows without key match nothing and would meet in one task. The same filter
    # in every use of the lookup lets its exchange be reused.
    for name in keys:
        rows = rows.where(F.col(name).isNotNull())
        lookup = lookup.where(F.col(name).isNotNull())
    if total is None:
        total = lookup.agg(F.sum(rows_per_key)).scalar()
    is_hot = F.coalesce(F.col(rows_per_key) * slots > total, F.lit(False))
    values = [c for c in lookup.columns if c not in keys and c != rows_per_key]
    hot = lookup.where(is_hot).select(*keys, *values)
    cold = lookup.where(~is_hot).select(*keys, *values)
    columns = [*rows.columns, *values]
    few = rows.join(F.broadcast(hot), keys).select(columns)
    rest = rows.join(F.broadcast(hot.select(keys)), keys, "left_anti")
    return few.unionByName(rest.join(cold, keys).select(columns))
