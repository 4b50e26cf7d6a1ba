"""Integer names for binary values by one range sort, and runs in sorted partitions.

Equal values meet in sorted order. A value with very many rows spreads over several
partitions, because the range is cut by value hash and row; the few values at the
borders of partitions are compared by content afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from reviewlens.sources.staging import stage

# A name is the number of a partition above this many bits, and the place in it.
PLACE_BITS = 40


def name_values(rows: DataFrame, value: str, carry: Sequence[str], spread: Sequence[str]) -> DataFrame:
    """Columns ``carry`` and ``name``: equal for equal values of ``value`` alone.

    ``value`` is binary; ``spread`` are columns of ``carry`` that tell rows of one value
    apart. The values pass one exchange, and the named rows are written to the shared
    folder, so a lost executor cannot change a name that was read already.
    """
    hashed = rows.select(F.xxhash64(value).alias("value_hash"), F.col(value).alias("value"), *carry)
    ordered = hashed.repartitionByRange("value_hash", *spread).sortWithinPartitions(
        "value_hash", "value"
    )
    kept = [ordered.schema[c] for c in carry]
    extra = T.StructType.fromDDL("part int, place bigint, border_hash bigint, border_value binary")
    nullable = [T.StructField(f.name, f.dataType, True) for f in kept]
    schema = T.StructType([*nullable, *extra.fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        place, last = -1, None
        # Values whose hash is the first or the last one of this partition.
        first_hash, last_hash, head, tail = None, None, {}, {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            hashes, values = batch.column(0).to_numpy(), batch.column(1)
            new = np.ones(n, bool)
            new[1:] = pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
            new[0] = values[0].as_py() != last
            places = place + np.cumsum(new)
            if first_hash is None:
                first_hash = hashes[0]
            for i in np.flatnonzero(new & (hashes == first_hash)).tolist():
                head[values[i].as_py()] = int(places[i])
            if hashes[-1] != last_hash:
                last_hash, tail = hashes[-1], {}
            for i in np.flatnonzero(new & (hashes == last_hash)).tolist():
                tail[values[i].as_py()] = int(places[i])
            place, last = int(places[-1]), values[n - 1].as_py()
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[2:], pa.array(np.full(n, part, np.int32)), pa.array(places),
                    pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
                ],
                names=names,
            )
            carried = [c.type for c in batch.columns[2:]]
        if first_hash is None:
            return
        border = [(v, p, first_hash) for v, p in head.items()]
        border += [(v, p, last_hash) for v, p in tail.items() if v not in head]
        size = len(border)
        yield pa.RecordBatch.from_arrays(
            [
                *[pa.nulls(size, kind) for kind in carried],
                pa.array([part] * size, pa.int32()),
                pa.array([p for _, p, _ in border], pa.int64()),
                pa.array([int(h) for _, _, h in border], pa.int64()),
                pa.array([v for v, _, _ in border], pa.binary()),
            ],
            names=names,
        )

    written = stage(ordered.mapInArrow(run, schema), "names")
    # One or two values a partition: the first place of each is its name everywhere.
    border = written.where(F.col("border_hash").isNotNull())
    own = F.struct("part", "place")
    owners = border.groupBy("border_hash", "border_value").agg(F.min(own).alias("owner"))
    moved = (
        border.join(owners, ["border_hash", "border_value"])
        .where(own != F.col("owner"))
        .select("part", "place", "owner")
    )
    named = written.where(F.col("border_hash").isNull()).join(
        F.broadcast(moved), ["part", "place"], "left"
    )
    owner = F.coalesce("owner", own)
    return named.select(*carry, (F.shiftleft(owner["part"].cast("bigint"), PLACE_BITS) + owner["place"]).alias("name"))
