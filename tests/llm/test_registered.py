"""Registered queries against their SQL, over whole tables."""

import pytest
from compare import differences, duck

import corpus_pipeline
from tallyspark.llm import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_rows_as_sql(spark, database, name):
    problem = differences(spark, database, FOLDER, registry.QUERIES[name], registry.SQL[name])
    assert not problem, problem


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14))


def test_pipeline_stages_named():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "exact_duplicates", "near_duplicates", "benchmark_free", "packed",
    ]
