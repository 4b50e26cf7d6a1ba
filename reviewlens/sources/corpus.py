"""Line corpora: one directory of text files per class."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlens.operators.indexing import running_start
from reviewlens.schema import EXPECTED_FILES
from reviewlens.sources.staging import stage

_FILE, _BLOCK, _LINE = "_file", "_block", "_line"


def read_line_corpus(
    spark: SparkSession,
    path: str,
    prefix: str,
    label: int,
    whole_text: bool = False,
) -> DataFrame:
    """(id, value, label): one row per line, blank lines kept.

    Ids are ``prefix`` and a running number over all lines, by file path and
    then by line. A file piece is read by one task from top to bottom, so the
    lines are tagged while scanning and written once, when this is called; only one
    row per piece is sorted. ``whole_text`` makes every file one row.

    The lines then meet one row per scan task, which holds where each of the task's
    pieces begins, by the task's number. Where these rows are too many to be
    broadcast, the lines are dealt by that number, in shares as even as the tasks were.
    """
    tagged = stage(
        spark.read.text(path, wholetext=whole_text).select(
            "value",
            F.col("_metadata.file_path").alias(_FILE),
            F.col("_metadata.file_block_start").alias(_BLOCK),
            F.monotonically_increasing_id().alias(_LINE),
        ),
        "lines",
    )
    pieces = tagged.groupBy(_FILE, _BLOCK).agg(
        F.count("*").alias("_lines"), F.min(_LINE).alias("_first")
    )
    starts = running_start(pieces, [_FILE, _BLOCK], "_lines", "_start")
    # monotonically_increasing_id keeps the task's number above 33 bits.
    task = F.shiftright(F.col("_first"), 33).cast("int").alias("_task")
    begin = F.struct("_first", (F.col("_start") - F.col("_first")).alias("_shift"))
    tasks = starts.groupBy(task).agg(F.array_sort(F.collect_list(begin)).alias("_begins"))
    placed = tagged.withColumn("_task", F.shiftright(F.col(_LINE), 33).cast("int")).join(tasks, "_task")
    own = F.element_at(F.filter("_begins", lambda b: b["_first"] <= F.col(_LINE)), -1)
    number = own["_shift"] + F.col(_LINE)
    return placed.select(
        F.concat(F.lit(prefix), number.cast("string")).alias("id"),
        "value",
        F.lit(label).alias("label"),
    )


def union_corpora(deceptive: DataFrame, truthful: DataFrame) -> DataFrame:
    """All lines of both corpora, duplicates kept."""
    return deceptive.unionByName(truthful)


def class_files(spark: SparkSession, root: str) -> DataFrame:
    """(class, file): entries of ``<root>/<class>/``, empty files as well.

    The driver lists names, as it does before any scan; contents are not read.
    """
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    entries = [
        (folder.getPath().getName(), entry.getPath().toString())
        for folder in files.listStatus(top)
        if folder.isDirectory()
        for entry in files.listStatus(folder.getPath())
        # Marks that Spark leaves beside its output are no part of the corpus.
        if not entry.getPath().getName().startswith(("_", "."))
    ]
    return spark.createDataFrame(entries, "class string, file string")


def corpus_completeness(
    units: DataFrame,
    expected: Mapping[str, int] = EXPECTED_FILES,
    class_col: str = "class",
    unit_col: str = "file",
) -> DataFrame:
    """(class, found, expected, ok): distinct units per class against the plan."""
    classes = list(expected)
    wanted = F.create_map(*[F.lit(x) for kv in expected.items() for x in kv])
    spark = units.sparkSession
    plan = spark.range(1).select(F.explode(wanted).alias("class", "expected"))
    found = (
        units.where(F.col(class_col).isin(classes))
        .groupBy(F.col(class_col).alias("class"))
        .agg(F.count_distinct(unit_col).alias("found"))
    )
    counted = F.coalesce("found", F.lit(0))
    return plan.join(found, "class", "left").select(
        "class",
        counted.alias("found"),
        F.col("expected").cast("bigint"),
        (counted == F.col("expected")).alias("ok"),
    )
