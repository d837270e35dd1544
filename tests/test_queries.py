"""Every registered query against its SQL twin on the driver's smallest tables."""

import pytest

import __spark_entry__ as entry_points
from tests.compare import connect, differences
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, connection, name):
    result = entry_points.queries()[name](spark, SF)
    assert differences(result, connection, entry_points.oracle_sql()[name]) == []


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns[:3] == ["calendar_date", "channel_code", "application_type"]
    assert not result.isEmpty()
