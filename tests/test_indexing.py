"""Contiguous numbers, running totals and string indexes."""

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from checks import fixtures as fx
from conftest import rows
from reviewlens.operators.indexing import contiguous_index, running_start, string_index


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_index_is_dense_and_independent_of_partitioning(spark, shuffled, partitions):
    shuffled(partitions)
    df = spark.range(1000).select(
        ((F.col("id") * 7919) % 1000).alias("v"), (F.col("id") % 3).alias("g")
    ).repartition(partitions)
    got = contiguous_index(df, ["g", F.desc("v")]).collect()
    ordered = sorted(got, key=lambda r: r["row_index"])
    assert [r["row_index"] for r in ordered] == list(range(1000))
    assert [(r["g"], -r["v"]) for r in ordered] == sorted((r["g"], -r["v"]) for r in got)


def test_index_of_an_empty_table(spark):
    assert contiguous_index(spark.range(0), ["id"]).count() == 0


def test_index_needs_no_window(spark):
    plan = contiguous_index(spark.range(100), ["id"])._jdf.queryExecution().executedPlan()
    assert "Window" not in plan.toString()


@pytest.mark.parametrize("partitions", [1, 8])
def test_running_start(spark, shuffled, partitions):
    shuffled(partitions)
    df = spark.range(200).select("id", (F.col("id") % 5).alias("n"))
    expected, total = [], 0
    for i in range(200):
        expected.append((i, i % 5, total))
        total += i % 5
    assert sorted(tuple(r) for r in running_start(df, ["id"], "n", "s").collect()) == expected


def test_string_index_equals_the_ml_indexer(spark, sf):
    df = fx.table(spark, sf, "documents").select("source").withColumn(
        "source", F.when(F.col("source") < "src15", "src1").otherwise(F.col("source"))
    )
    labels = StringIndexer(inputCol="source", outputCol="i").fit(df).labels
    own = sorted(string_index(df, "source").collect(), key=lambda r: r["index"])
    assert [r["value"] for r in own] == list(labels)
    assert [r["index"] for r in own] == [float(i) for i in range(len(labels))]


def test_string_index_of_numbers_and_nulls(spark):
    df = spark.createDataFrame([(1,), (0,), (1,), (None,)], "c int")
    assert rows(string_index(df, "c")) == [("0", 1, 1.0), ("1", 2, 0.0)]
