"""Rules checked against straightforward Python on random small cases."""

import random

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import sampling


def drawn_by_loop(pairs, quotas):
    """Visit accounts by weight; each takes a place of every open quota among its concepts."""
    held = {}
    for account, concept in set(pairs):
        if concept in quotas:
            held.setdefault(account, set()).add(concept)
    weight = {a: sum(10**15 // quotas[c] for c in concepts) for a, concepts in held.items()}
    left, chosen = dict(quotas), set()
    for account in sorted(held, key=lambda a: (-weight[a], a)):
        for concept in held[account]:
            if left[concept] > 0:
                left[concept] -= 1
                chosen.add(account)
    return chosen, not any(left.values())


def test_sample_equals_the_loop(spark):
    """Many cases in one Spark job: each case has its own concepts."""
    random.seed(7)
    pairs, quotas, expected = [], [], {}
    for case in range(60):
        size = {100 * case + c: random.randint(1, 6) for c in range(random.randint(1, 5))}
        drawn = [
            (10_000 * case + random.randint(1, 25), random.choice([*size, 100 * case + 77]))
            for _ in range(random.randint(5, 80))
        ]
        expected[case] = drawn_by_loop(drawn, size)
        pairs += drawn
        quotas += size.items()
    concepts = spark.createDataFrame(pairs, "account_id long, regulator_id int")
    config = spark.createDataFrame(quotas, "regulator_id int, quantity int")
    found = {row.account_id for row in sampling.quota_sample(concepts, config).collect()}
    assert found == set().union(*(accounts for accounts, _ in expected.values()))
    unmet = sampling.quota_check(concepts, config).filter(~F.col("is_satisfied")).select("regulator_id").collect()
    assert {row[0] // 100 for row in unmet} == {case for case, (_, met) in expected.items() if not met}


def test_one_hot_concept_and_few_salts_give_the_same_sample(spark):
    concepts = spark.range(5000).select(F.col("id").alias("account_id"), F.lit(1).alias("regulator_id")).union(
        spark.range(0, 5000, 97).select("id", F.lit(2))
    )
    config = spark.createDataFrame([(1, 40), (2, 3)], "regulator_id int, quantity int")
    results = {
        salts: sorted(map(tuple, sampling.quota_ranks(concepts, config, salts=salts).collect())) for salts in (1, 7, 64)
    }
    assert results[1] == results[7] == results[64]
    assert len(results[1]) == 43


def test_quota_shortfall_and_unusable_configuration_are_errors(spark):
    concepts = spark.createDataFrame([(1, 1)], "account_id long, regulator_id int")
    for quotas in ([(1, 2)], [(1, 0)], [(1, 1), (1, 1)], [(1, 1), (2, 1)]):
        config = spark.createDataFrame(quotas, "regulator_id int, quantity int")
        with pytest.raises(ValueError):
            sampling.require_quotas(concepts, config)
    sampling.require_quotas(concepts, spark.createDataFrame([(1, 1)], "regulator_id int, quantity int"))
