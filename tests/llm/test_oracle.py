"""The operators that have an SQL twin, against it."""

import pytest

import __spark_entry__ as entry_points
from admitflow.llm.queries import ORACLE
from tests.compare import connect, differences

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_twin(spark, connection, name):
    assert entry_points.oracle_sql()[name] == ORACLE[name]
    assert differences(entry_points.queries()[name](spark, SF), connection, ORACLE[name]) == []
