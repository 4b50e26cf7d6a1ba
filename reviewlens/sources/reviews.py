"""Labelled reviews as CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from reviewlens.schema import REVIEW_SCHEMA

# Quotes are doubled inside quoted fields and blanks are part of the text.
_CSV_FORMAT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
BAD_RECORD = "_bad_record"
# What a bare empty field is read as before it becomes null. It must differ from
# the empty text, which stands in the file as a quoted empty field.
_BARE_EMPTY = "\u0000"


def read_labeled_reviews(
    spark: SparkSession,
    root: str,
    dataset: str,
    multi_line: bool = False,
    check_header: bool = True,
    keep_bad_record: bool = False,
) -> DataFrame:
    """Reviews in ``<root>/<dataset>/*.csv``, columns by position.

    The schema is fixed, so the files are scanned once, large ones in parallel
    pieces. Ask for ``multi_line`` when texts hold line breaks: each file is then read
    by one task. ``check_header`` makes a header with other names, or names in another
    order, an error; pass ``False`` for files that name their columns differently.

    A field that does not fit its type is null, and a row may have too few or too
    many fields. ``keep_bad_record`` adds column `BAD_RECORD` with such rows as they
    stand in the file; `bad_records` counts them.
    """
    schema = REVIEW_SCHEMA
    if keep_bad_record:
        schema = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])
    return (
        spark.read.schema(schema)
        .options(
            **_CSV_FORMAT,
            multiLine=multi_line,
            nullValue=_BARE_EMPTY,
            enforceSchema=not check_header,
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=BAD_RECORD,
        )
        .csv(f"{root.rstrip('/')}/{dataset}/*.csv")
    )


def bad_records(
    spark: SparkSession, root: str, dataset: str, multi_line: bool = False, **options
) -> DataFrame:
    """(records, bad, fields): rows of the files, rows that do not fit, fields read.

    Every field is read, because a record is found bad by the fields that are.
    """
    rows = read_labeled_reviews(
        spark, root, dataset, multi_line, keep_bad_record=True, **options
    )
    fields = sum(F.col(c).isNotNull().cast("bigint") for c in REVIEW_SCHEMA.names)
    return rows.agg(
        F.count("*").alias("records"),
        F.count(BAD_RECORD).alias("bad"),
        F.coalesce(F.sum(fields), F.lit(0)).alias("fields"),
    )


def write_labeled_reviews(df: DataFrame, root: str, dataset: str) -> None:
    """Write reviews in the form `read_labeled_reviews` reads.

    Columns missing in ``df`` are written empty.
    """
    columns = [
        (F.col(f.name) if f.name in df.columns else F.lit(None))
        .cast(f.dataType)
        .alias(f.name)
        for f in REVIEW_SCHEMA.fields
    ]
    df.select(*columns).write.options(**_CSV_FORMAT).csv(
        f"{root.rstrip('/')}/{dataset}"
    )


def null_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, nulls): rows whose key or text is missing, by column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "nulls")
