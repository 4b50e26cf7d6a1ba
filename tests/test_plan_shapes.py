"""What the plans of the queries must and must not contain."""

import re

import pytest
from pyspark.sql import Window, functions as F

from checks import fixtures as fx
from checks.queries import QUERIES
from conftest import plan_of
from reviewlens.operators import profiles
from reviewlens.plans import features

RELATIONAL = [
    "product_star_profile", "user_star_profile_lineitem", "user_review_rate",
    "user_review_rate_orders", "attach_profiles", "text_shape", "feature_table",
    "features_as_text", "normalize_text", "text_features_frame", "term_counts",
    "document_frequency", "tfidf_terms", "random_split", "classification_metrics",
    "confusion_matrix", "majority_labels", "wssse", "contiguous_index", "running_start",
]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def single_task_windows(plan):
    """Windows whose input was gathered in one partition."""
    lines = plan.splitlines()
    bad = []
    for i, line in enumerate(lines):
        if re.search(r"[+:*)] ?Window \[", line) or line.lstrip(" :+-").startswith("Window ["):
            feeding = next((x for x in lines[i:] if "Exchange" in x), "")
            if "SinglePartition" in feeding:
                bad.append(line)
    return bad


def test_single_task_window_is_recognised(spark):
    ranked = spark.range(10).withColumn("r", F.row_number().over(Window.orderBy("id")))
    assert single_task_windows(physical(ranked))
    apart = spark.range(10).withColumn(
        "r", F.row_number().over(Window.partitionBy(F.col("id") % 3).orderBy("id"))
    )
    assert not single_task_windows(physical(apart))


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_python_no_cross_join_no_single_task_window(spark, sf, name):
    plan = physical(QUERIES[name](spark, sf))
    for word in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    assert not single_task_windows(plan)


def test_profile_has_one_hash_exchange_and_no_join(spark, sf):
    profile = profiles.product_star_profile(fx.rated_lines(spark, sf), "l_partkey", "rating")
    plan = physical(profile)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_linenumber:int>" in plan


def test_rate_has_one_exchange_and_reads_two_columns(spark, sf):
    plan = physical(QUERIES["user_review_rate_orders"](spark, sf))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "PushedFilters: [IsNotNull(o_custkey)]" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_text_never_enters_an_exchange_of_the_feature_table(spark, tmp_path, sf):
    """Over a plain review table only narrow rows are shuffled."""
    path = str(tmp_path / "reviews")
    fx.reviews(spark, sf).write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = features.feature_table(spark.read.parquet(path))
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Two numbers stand for the text in the narrow rows, which are written first.
    assert "reviewText" not in text and "Exchange" in text


def test_one_projection_queries_have_no_exchange(spark, tmp_path, sf):
    path = str(tmp_path / "docs")
    fx.documents(spark, sf).write.parquet(path)
    docs = spark.read.parquet(path).select("doc_id", "text")
    assert "Exchange" not in physical(features.text_shape(docs, "text"))
    assert "Exchange" not in plan_of(features.text_shape(docs, "text"))


def test_text_passes_one_exchange_of_the_profiles(spark, tmp_path, sf):
    path = str(tmp_path / "reviews")
    fx.reviews(spark, sf).write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = physical(profiles.attach_profiles(spark.read.parquet(path)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The text is read once, right below the one exchange that carries it.
    assert text.count("reviewText:string") == 1
