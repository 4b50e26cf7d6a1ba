"""Batch-wise Python over (id, text) rows, shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

# Rows handed to a function at once; bounds what Python holds besides one Arrow batch.
ROWS_AT_ONCE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, text) alone, so that other columns of any name cannot clash."""
    return docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def shared_values(spark: SparkSession, record: object) -> Broadcast:
    """The fields of a record, broadcast as plain values: a broadcast carries no classes."""
    return spark.sparkContext.broadcast(vars(record))


def map_texts(
    rows: DataFrame,
    make: Callable[[], Callable[[list[str]], Sequence]],
    fields: str,
    carry: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Columns ``carry`` of ``rows`` and the ``fields`` that a function gives per text.

    ``make()`` runs once per task and returns a function from a list of texts to
    one sequence per field. Nothing is shuffled and a task holds one batch.
    """
    made = T.StructType.fromDDL(fields)
    schema = T.StructType([rows.schema[c] for c in carry] + list(made))
    kinds = [_arrow(f.dataType) for f in made]
    names, n = schema.names, len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                columns = each(part.column(n).to_pylist())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *arrays], names=names)

    return rows.select(*carry, "text").mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    plain = {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(),
        "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(),
    }
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return plain[kind.simpleString()]
