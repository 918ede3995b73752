import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.llm import components, ngram_join
from tallyspark.llm.components import connected_components
from tallyspark.llm.ngram_join import (
    SKETCH_BITS, bitmap, bounded_pairs, differing_bits_of, folded, in_order, jaccard_components, keep_one_per_component, levels_of,
    may_start, possible, prefix_length, shingles,
)
from tallyspark.sources.shared import BATCH_SETTING, small_batches


def brute(rows, words=5):
    sets = []
    for _, text in rows:
        found = (text or "").encode().lower().split()
        sets.append({tuple(found[at : at + words]) for at in range(max(1, len(found) - words + 1))} if found else set())
    root = list(range(len(rows)))

    def find(at):
        while root[at] != at:
            at = root[at]
        return at

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = {}
    for at in range(len(rows)):
        groups.setdefault(find(at), []).append(at)
    label = {}
    for members in groups.values():
        lowest = min((rows[at][0] for at in members if rows[at][0] is not None), default=None)
        label |= dict.fromkeys(members, lowest)
    return Counter((rows[at][0], len(sets[at]), label[at]) for at in range(len(rows))), len(groups)


def corpus(seed, groups=12, plain=40):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([4, 6, 30, 60, 200, 1500]))]
        for _ in range(rng.randrange(1, 9)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 8])):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.3:
                text += [word() for _ in range(rng.randrange(1, 1 + len(base) // 4))]
            rows.append((len(rows), " ".join(text)))
    shared = " ".join(word() for _ in range(25))
    rows += [(len(rows) + at, f"{word()} {shared} " + " ".join(word() for _ in range(30))) for at in range(plain)]
    rng.shuffle(rows)
    return rows


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=60), st.sets(st.integers(0, 2**64 - 1), max_size=60), st.floats(0, 1))
def test_bounds_lose_nothing(one, more, part):
    a = np.array(sorted(one | {x for x in more if x % 100 < part * 100}), np.uint64)
    b = np.array(sorted(one), np.uint64)
    similar = 100 * len(one & set(a.tolist())) >= 80 * len(set(a.tolist()) | one)
    bits = [bitmap(a), bitmap(b)]
    if similar:
        assert possible(len(a), len(b), differing_bits_of(*bits))
        sizes = np.array([len(a), len(b)])
        assert len(bounded_pairs(sizes, bits, folded(bits), np.array([0]), np.array([1]), 80)[0]) == 1
        counts = np.zeros(1 << SKETCH_BITS)
        counts[(a[::3] >> np.uint64(64 - SKETCH_BITS)).astype(int)] = 5000
        a, b = in_order(a, levels_of(counts)).tolist(), in_order(b, levels_of(counts)).tolist()
        shared = [one for one in a[: prefix_length(len(a))] if one in b[: prefix_length(len(b))]]
        assert shared and may_start(len(a), a.index(shared[0]), len(b), b.index(shared[0]), 80)


def test_bitmaps_of_different_width():
    rng = np.random.default_rng(1)
    large = np.unique(rng.integers(0, 2**63, 1200).astype(np.uint64))
    small = large[:400]
    assert len(bitmap(large)) != len(bitmap(small))
    assert 0 < differing_bits_of(bitmap(large), bitmap(small)) <= len(large) - 400
    one, other = folded([bitmap(large), bitmap(small)])
    assert np.bitwise_count(one ^ other).sum() == differing_bits_of(bitmap(large), bitmap(small))


@pytest.mark.parametrize("block", [512, 3])
def test_as_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = corpus(7)
    want, _ = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_components(docs).collect()
    assert Counter(map(tuple, found)) == want


def test_without_the_quick_pass(spark, monkeypatch):
    """The full search alone finds everything."""
    monkeypatch.setattr(ngram_join, "NEIGHBOURS", 0)
    rows = corpus(8, groups=8, plain=10)
    want, _ = brute(rows)
    assert Counter(map(tuple, jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())) == want


def test_odd_rows(odd_docs, no_docs):
    rows = [(row.doc_id, row.text) for row in odd_docs.collect()]
    want, groups = brute(rows)
    assert Counter(map(tuple, jaccard_components(odd_docs).collect())) == want
    kept = keep_one_per_component(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == groups
    assert jaccard_components(no_docs).count() == 0
    assert keep_one_per_component(no_docs).count() == 0
    assert len(shingles(None)) == len(shingles(b" \n")) == 0 and len(shingles(b"a b")) == 1


def test_components(spark):
    rng = random.Random(3)
    edges = [(at, at + 1) for at in range(100)] + [(1000, rng.randrange(1001, 3000)) for _ in range(500)] + [(5000, 5000), (4000, 4001)]
    rng.shuffle(edges)
    found = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {found[at] for at in range(101)} == {0}
    assert {root for vertex, root in found.items() if 1000 <= vertex < 3000} == {1000}
    assert found[4001] == 4000 and 5000 not in found
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rounds_of_few_edges_take_few_tasks(spark, monkeypatch):
    """A path of few edges: the tables of its rounds do not follow the number of shuffle partitions."""
    parts = []

    def counted(df, name):
        found = written_once(df, name)
        parts.append(len(found.inputFiles()))
        return found

    written_once = components.written_once
    monkeypatch.setattr(components, "written_once", counted)
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in held}
    for key, value in held.items():
        spark.conf.set(key, value)
    try:
        edges = spark.range(500).selectExpr("id AS a", "id + 1 AS b")
        found = dict(connected_components(edges).collect())
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert set(found.values()) == {0} and len(found) == 501
    assert max(parts[1:]) <= spark.sparkContext.defaultParallelism


def test_links_are_joined_to_components_once(spark, monkeypatch):
    """A later search starts from the components of the links before, not from all links again."""
    given = []

    def noted(edges):
        given.append(edges.count())
        return connected_components(edges)

    monkeypatch.setattr(ngram_join, "connected_components", noted)
    join = ngram_join._Join.__new__(ngram_join._Join)
    join.classes, join._labels = spark.range(0), None
    join.links = spark.range(2, 60).selectExpr("id AS a", "explode(sequence(1L, id - 1)) AS b")
    assert {row.component for row in join.labels().collect()} == {1}
    assert join.labels().count() == 59
    join.links = spark.createDataFrame([(1, 0), (100, 99)], "a long, b long")
    label = dict(join.labels().collect())
    assert label == dict.fromkeys(range(60), 0) | {99: 99, 100: 99}
    assert given == [58 * 59 // 2, 59 + 2]


def test_key_of_many_sets_is_cut_in_many_tasks(spark, monkeypatch):
    """The first look for partners has no task with all sets of a frequent key."""
    join = ngram_join._Join.__new__(ngram_join._Join)
    join.percent = 80
    join.classes = spark.range(4000).selectExpr("id AS cid", "100L AS n", "array(7L) AS lowest")
    monkeypatch.setattr(ngram_join, "NEIGHBOURS", 1)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = join._likely_pairs().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert 4000 - 9 <= pairs < 3999  # a pair is left to the full search at each limit of a task


def test_batches_are_bounded_by_bytes(spark):
    """Sets and texts go to Python in small batches while the join runs; the session's own setting stays."""
    def size(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    wide = spark.range(0, 6000, 1, 1).selectExpr("repeat('x', 2000) AS text")
    with small_batches(spark):
        seen = [row.size for row in wide.mapInArrow(size, "size long").collect()]
    assert len(seen) > 1 and max(seen) < 5 << 20
    assert spark.conf.get(BATCH_SETTING, None) is None
    spark.conf.set(BATCH_SETTING, "1m")
    try:
        with small_batches(spark):
            assert spark.conf.get(BATCH_SETTING) == "1m"
        assert spark.conf.get(BATCH_SETTING) == "1m"
    finally:
        spark.conf.unset(BATCH_SETTING)


def test_rows_with_unique_identifiers_are_kept_in_place(spark):
    rows = corpus(9, groups=6, plain=5)
    _, groups = brute(rows)
    docs = spark.createDataFrame([(*row, "x") for row in rows], "doc_id long, text string, times string")
    kept = keep_one_per_component(docs)
    assert kept.columns == docs.columns and kept.count() == groups
    want, _ = brute(rows)
    assert {row.doc_id for row in kept.collect()} == {lowest for _, _, lowest in want}


def test_frequent_key_is_cut_in_many_tasks(spark, monkeypatch):
    """One key in many components: no task holds it, and every pair that can be similar meets in a tile."""
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = random.Random(4)
    rows = [(5, rng.randrange(100, 200), rng.randrange(3), cid, cid // 2) for cid in range(600)]
    rows += [(key, 100, 0, 1000 + cid, cid) for key in range(6, 90) for cid in range(key % 4 + 1)]
    columns = "key long, n long, place long, cid long, component long"
    sized = spark.createDataFrame(rows, columns).selectExpr(
        "key", f"shiftleft(n, {ngram_join.PLACE_BITS}) + place AS sized", "cid", "component - cid AS to_component"
    )
    ordered = sized.repartitionByRange(6, "key", "sized", "cid").sortWithinPartitions("key", "sized", "cid")
    blocks = ordered.mapInArrow(
        ngram_join._blocks(80), "key long, block long, n long, place int, cid long, component long, whole boolean"
    ).localCheckpoint()
    tasks = {row.block >> 32 for row in blocks.filter("key = 5").collect()}
    assert len(tasks) > 1
    join = ngram_join._Join.__new__(ngram_join._Join)
    join.percent = 80
    tiles = {}
    for row in join._tiled(blocks).collect():
        tiles.setdefault((row.key, row.first, row.second), []).append(row)
    assert max(map(len, tiles.values())) <= 32
    met = {
        (key, *sorted((a.cid, b.cid))) for (key, *_), members in tiles.items() for a in members for b in members if a.cid < b.cid
    }
    for at, (key, n, place, cid, component) in enumerate(rows):
        for key_b, n_b, place_b, cid_b, component_b in rows[at + 1 :]:
            if key == key_b and component != component_b and 80 * max(n, n_b) <= 100 * min(n, n_b):
                if ngram_join.may_start(n, place, n_b, place_b, 80):
                    assert (key, *sorted((cid, cid_b))) in met
