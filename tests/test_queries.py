"""Every registered query gives the rows of its SQL, on whole tables."""

import pytest

import __spark_entry__ as contract
from tallyspark.registry import all_queries
from compare import differences, duck

FOLDER = "/root/testdata/sf0.001"
STATEMENTS = contract.oracle_sql()


@pytest.fixture(scope="module")
def database():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_same_rows_as_sql(spark, database, name):
    problem = differences(spark, database, FOLDER, contract.queries()[name], STATEMENTS[name])
    assert not problem, problem


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
