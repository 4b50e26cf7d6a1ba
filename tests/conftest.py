import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("reviewlens-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def shuffled(spark):
    """Run with another number of shuffle partitions and put it back."""
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def set_partitions(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))

    yield set_partitions
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="session")
def sf():
    return SF


def rows(df, *order):
    """Rows as sorted tuples."""
    data = [tuple(r) for r in df.collect()]
    return sorted(data, key=repr) if not order else data


def plan_of(df):
    """The physical plan before execution."""
    return df._jdf.queryExecution().sparkPlan().toString()


def executed_plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
