"""Splits and folds are functions of the key."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from reviewlens.operators.folds import stratified_folds
from reviewlens.functions.split import fold_number, random_split, split_part


def test_parts_are_disjoint_complete_and_near_their_weight(spark):
    df = spark.range(20000)
    train, test = random_split(df, "id")
    assert train.intersect(test).count() == 0
    assert train.unionByName(test).distinct().count() == 20000
    assert abs(train.count() / 20000 - 0.6) < 0.02


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(2000)
    parts = [rows(random_split(df.repartition(n), "id")[0]) for n in (1, 4, 16)]
    assert parts[0] == parts[1] == parts[2]


def test_three_weights_and_seed(spark):
    df = spark.range(9000)
    sizes = [p.count() for p in random_split(df, "id", (1, 1, 2))]
    assert sum(sizes) == 9000
    assert abs(sizes[2] - 4500) < 300
    assert rows(random_split(df, "id", seed="a")[0]) != rows(random_split(df, "id")[0])


def test_degenerate_weights(spark):
    df = spark.range(100)
    assert [p.count() for p in random_split(df, "id", (1.0, 0.0))] == [100, 0]
    assert [p.count() for p in random_split(df, "id", (0.0, 1.0))] == [0, 100]
    with pytest.raises(ValueError):
        split_part("id", (0.0, 0.0))


def test_row_without_key_belongs_to_exactly_one_part(spark):
    df = spark.createDataFrame([(None,), (1,)], "id int")
    assert sum(p.count() for p in random_split(df, "id")) == 2


def test_folds_are_balanced_and_independent_of_the_split(spark):
    df = spark.range(14000).select(fold_number("id", 7).alias("f"), split_part("id").alias("p"))
    counts = {(r["f"], r["p"]): r["count"] for r in df.groupBy("f", "p").count().collect()}
    assert {f for f, _ in counts} == set(range(7))
    for f in range(7):
        share = counts[f, 0] / (counts[f, 0] + counts[f, 1])
        assert abs(share - 0.6) < 0.05
    assert df.where(F.col("f").isNull()).count() == 0


def test_stratified_folds_hold_every_class(spark):
    rows_ = [(i, float(i % 10 == 0)) for i in range(200)] + [(900, None)]
    df = spark.createDataFrame(rows_, "k int, y double")
    found = stratified_folds(df, "k", "y", 7).groupBy("y", "fold").count().collect()
    assert len(found) == 14 and {r["count"] for r in found if r["y"]} == {2, 3}
    assert sum(r["count"] for r in found) == 200
