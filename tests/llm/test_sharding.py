from collections import Counter

import numpy as np

from tallyspark.llm.sharding import communication_matrix, exact_shards, hypergeometric, shuffle_into_shards


def test_draws_follow_the_law():
    rng = np.random.default_rng(1)
    draws = [hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert abs(np.mean(draws) - 6) < 0.1
    assert abs(np.var(draws) - 20 * 0.3 * 0.7 * 80 / 99) < 0.25
    assert hypergeometric(rng, 0, 5, 3) == 0 and hypergeometric(rng, 5, 0, 3) == 3
    large = hypergeometric(rng, 10**12, 10**12, 10**11)
    assert abs(large - 5 * 10**10) < 10**7


def test_matrix_is_exact():
    sizes = exact_shards(1003, 7)
    matrix = np.array(communication_matrix([500, 0, 3, 500], sizes, 5))
    assert matrix.sum(axis=1).tolist() == [500, 0, 3, 500]
    assert matrix.sum(axis=0).tolist() == sizes


def test_shards(odd_docs, no_docs):
    placed = shuffle_into_shards(odd_docs, 3, seed=4)
    assert placed.columns == [*odd_docs.columns, "shard", "slot"]
    rows = placed.collect()
    assert Counter(map(tuple, odd_docs.collect())) == Counter(tuple(row)[:-2] for row in rows)
    slots = {}
    for row in rows:
        slots.setdefault(row.shard, []).append(row.slot)
    assert sorted(map(len, slots.values())) == [3, 3, 4]
    assert all(sorted(values) == list(range(len(values))) for values in slots.values())
    assert shuffle_into_shards(no_docs, 3).count() == 0


def test_uniform_and_repeatable(spark):
    numbers = spark.range(0, 4000, numPartitions=5)
    first = {row.id: (row.shard, row.slot) for row in shuffle_into_shards(numbers, 4, seed=1).collect()}
    again = {row.id: (row.shard, row.slot) for row in shuffle_into_shards(numbers, 4, seed=1).collect()}
    assert first == again
    from_first_part = Counter(shard for key, (shard, _) in first.items() if key < 800)
    assert all(150 < count < 250 for count in from_first_part.values())
    places = [slot for key, (_, slot) in first.items() if key < 800]
    assert abs(np.mean(places) - 499.5) < 40
