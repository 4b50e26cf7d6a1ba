"""The driver contract."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as contract


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "reviewID" and len(df.columns) == 17
    assert df.count() > 0


def test_queries_and_sql_are_keyed_alike():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_queries_are_left_without_an_operators_dependency():
    code = (
        "import sys; sys.modules['zstandard'] = None\n"
        "import __spark_entry__ as contract\n"
        "from checks.queries import QUERIES\n"
        "assert set(contract.queries()) == set(QUERIES), set(contract.queries()) ^ set(QUERIES)\n"
        "assert set(contract.oracle_sql()) <= set(QUERIES)\n"
    )
    root = Path(contract.__file__).resolve().parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
