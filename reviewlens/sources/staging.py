"""Written tables in the cluster's shared folder, used to cut lineage.

A staged table is read back from storage, so it survives the loss of any
executor and every later pass sees exactly the same rows and tags.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, one subfolder per application.

    Without that setting a local session gets a temporary folder; on a cluster
    it is an error, because executors do not share a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all executors share"
            )
        root = tempfile.mkdtemp(prefix="reviewlens-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/reviewlens-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
