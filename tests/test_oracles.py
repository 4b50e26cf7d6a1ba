"""Every query beside its SQL on the smallest tables."""

import pytest

from checks.compare import difference
from checks.oracles import ORACLES
from checks.queries import QUERIES


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    assert difference(spark, sf, name) == ""
