"""Run queries beside their SQL and report differences.

Usage: python -m checks.compare SF_DIR [query ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
import traceback

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Empty when query and SQL agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    got = _rows(df.columns, df.collect())
    if name not in ORACLES:
        return "" if got else "no rows"
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as from '{sf_dir}/{table}.parquet'")
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    wanted = _rows(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)}"
    unlike = [(a, b) for a, b in zip(got, wanted) if a != b]
    return f"{len(unlike)} rows differ, first {str(unlike[0])[:600]}" if unlike else ""


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    # Tables that queries write live as long as this run.
    with tempfile.TemporaryDirectory(prefix="reviewlens-checks-") as shared:
        return compare(sf_dir, names, shared)


def compare(sf_dir: str, names: list[str], shared: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", shared)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            traceback.print_exc()
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        kind = "sql" if name in ORACLES else "rows"
        print(f"{name:36s} {kind:5s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
