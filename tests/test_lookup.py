"""The lookup join under skew."""

import re

from pyspark.sql import functions as F

from conftest import rows
from reviewlens.operators.lookup import lookup_join


def skewed(spark, n=20000):
    """Half of the rows share one key, the others are spread over 500 keys."""
    ids = spark.range(0, n)
    key = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 1000).cast("string"))
    )
    return ids.select("id", key.alias("key"))


def lookup_of(facts):
    return facts.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("top"))


def test_same_rows_as_a_plain_join(spark):
    facts = skewed(spark).unionByName(
        spark.createDataFrame([(-1, None)], "id long, key string")
    )
    lookup = lookup_of(facts)
    plain = facts.join(lookup.drop("n"), "key").select("id", "key", "top")
    assert rows(lookup_join(facts, lookup, "key", "n")) == rows(plain)
    few = lookup_join(facts, lookup, "key", "n", slots=3)
    assert rows(few) == rows(plain)
    all_hot = lookup_join(facts, lookup, "key", "n", slots=10**6)
    assert rows(all_hot) == rows(plain)
    given = lookup_join(facts, lookup, "key", "n", total=F.lit(20000))
    assert rows(given) == rows(plain)
    assert given.columns == ["id", "key", "top"]


def test_many_rows_without_key(spark):
    facts = skewed(spark)
    many = facts.withColumn("key", F.when(F.col("id") % 3 != 0, F.col("key")))
    joined = lookup_join(many, lookup_of(many), "key", "n")
    assert joined.count() == many.where("key is not null").count()


def test_keys_absent_from_the_lookup_drop_out(spark):
    facts = skewed(spark)
    lookup = lookup_of(facts).where("key != 'hot'")
    assert lookup_join(facts, lookup, "key", "n").count() == 10000


def test_empty_lookup(spark):
    facts = skewed(spark)
    assert lookup_join(facts, lookup_of(facts).where("false"), "key", "n").count() == 0


def test_two_key_columns(spark):
    facts = skewed(spark).withColumn("half", F.col("id") % 2)
    lookup = facts.groupBy("key", "half").agg(F.count("*").alias("n"))
    joined = lookup_join(facts, lookup.withColumn("x", F.lit(1)), ["key", "half"], "n")
    assert joined.count() == 20000


def without_broadcast(spark, make):
    """Physical plan and result of ``make()`` with automatic broadcasts switched off."""
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        df = make()
        return df._jdf.queryExecution().executedPlan().toString(), df.groupBy(
            F.spark_partition_id().alias("part")
        ).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_no_task_gets_much_more_than_its_share(spark, shuffled):
    """As data grows by ten, the largest task still has about its share of the rows."""
    shuffled(16)
    for factor in (1, 10):
        facts = skewed(spark, 20000 * factor)
        _, sizes = without_broadcast(
            spark, lambda: lookup_join(facts, lookup_of(facts), "key", "n")
        )
        assert sum(r["count"] for r in sizes) == 20000 * factor
        # Hot rows stay in the tasks that read them, at most half of a table over 4 tasks.
        assert max(r["count"] for r in sizes) <= 20000 * factor / 4
        plain, parts = without_broadcast(spark, lambda: facts.join(lookup_of(facts), "key"))
        assert max(r["count"] for r in parts) >= 10000 * factor


def test_hot_rows_pass_no_exchange(spark):
    facts = skewed(spark)
    plan, _ = without_broadcast(spark, lambda: lookup_join(facts, lookup_of(facts), "key", "n"))
    first, second = plan.split("SortMergeJoin", 1)
    assert "BroadcastHashJoin" in first and "LeftAnti" in second
    assert len(re.findall(r"SortMergeJoin|CartesianProduct|NestedLoop", plan)) == 1


def test_slots_follow_the_shuffle_partitions(spark, shuffled):
    facts = skewed(spark)
    for partitions, hot_keys in ((4, 1), (100_000, 501)):
        shuffled(partitions)
        text = lookup_join(facts, lookup_of(facts), "key", "n")._jdf.queryExecution().analyzed().toString()
        slots = max(1000, partitions)
        assert str(slots) in text
        assert lookup_of(facts).where(F.col("n") * slots > 20000).count() == hot_keys
