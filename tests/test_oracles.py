"""Every query of the reference's capabilities against its SQL."""

import pytest
from support import SF, rows

from fragloom.plans.oracles import ORACLES
from fragloom.plans.queries import QUERIES


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, tables, name):
    found, expected = QUERIES[name](spark, SF).toPandas(), tables.sql(ORACLES[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found) == rows(expected)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
