"""Every registered query against its SQL on the smallest tables."""

import pytest

from parity import compare
from parity.statements import STATEMENTS
from tillstone.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    result = compare.compare(spark, connection, SF, name)
    assert result.problem is None
    assert result.rows > 0 or name == "top_products_selling_out"
