"""Every registered query with SQL gives the SQL's rows."""

import pytest

from compare import connect, difference, duck_rows, spark_rows
from suite.oracles import ORACLES
from suite.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    assert difference(spark_rows(QUERIES[name](spark, sf)), duck_rows(duck, ORACLES[name])) is None


def test_entry(spark):
    from __spark_entry__ import entry

    rows = {r["feature"]: r for r in entry(spark).collect()}
    assert rows["drift_half"]["psi"] == 10.0
    assert rows["total_price"]["psi"] < 0.1
    assert rows["drift_up"]["out_of_range_share"] > 0.2
