"""Queries of the package beside their SQL, and their contract columns."""

import duckdb
import pytest

from checks.compare import TABLES, _rows
from reviewlens.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    df = QUERIES[name](spark, sf)
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as from '{sf}/{table}.parquet'")
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, result.fetchall())


def test_added_conversation(spark, sf):
    df = QUERIES["op6_chat_formatting"](spark, sf)
    assert df.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert df.where("conv_id = -7").first().n_turns == 2
