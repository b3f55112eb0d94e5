"""Every query of the catalog against its SQL restatement, on whole tables."""

import pytest

import __spark_entry__ as entry_file
from cardpulse.plans.catalog import QUERIES
from cardpulse.plans.oracle import ORACLE
from compare import connect, duck_bag, spark_bag


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_restatement():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_file.queries()) and set(ORACLE) <= set(entry_file.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    names, rows = spark_bag(entry_file.queries()[name](spark, sf_dir))
    expected_names, expected = duck_bag(con, entry_file.oracle_sql()[name])
    assert names == expected_names
    assert sum(rows.values()) > 0
    assert rows == expected


def test_entry_runs(spark):
    assert entry_file.entry(spark).limit(1).count() == 1
