"""Every query beside its SQL in another engine, over whole tables."""

import pytest

from __spark_entry__ import entry
from compare import difference, oracle
from spanwatch.plans.oracle import ORACLE
from spanwatch.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle(SF)


@pytest.mark.filterwarnings("ignore:tolerance of")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SF), connection, ORACLE[name]) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() == 128 + 116


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
