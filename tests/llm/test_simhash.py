import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.llm import registry, simhash
from tallyspark.llm.simhash import class_labels, close_pairs, fingerprint, segments, simhash_components, smallest_linked

FOLDER = "/root/testdata/sf0.001"


def brute_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    hashes = [
        xxhash.xxh64(" ".join(words[i : i + 4]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - 3))
    ]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_groups(prints, difference=4):
    """Group of each print, by comparing all of them."""
    values = np.array(sorted(set(prints)), np.uint64)
    group = list(range(len(values)))

    def root(i):
        while group[i] != i:
            group[i] = i = group[group[i]]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= difference).tolist():
            a, b = root(i), root(i + 1 + j)
            group[max(a, b)] = min(a, b)
    return {int(value): root(i) for i, value in enumerate(values.tolist())}


def brute(rows):
    prints = [brute_print(text) for _, text in rows]
    groups = brute_groups(prints)
    lowest = {}
    for (key, _), one in zip(rows, prints, strict=True):
        if key is not None:
            lowest[groups[one]] = min(key, lowest.get(groups[one], key))
    return Counter((key, f"{one:016x}", lowest.get(groups[one])) for (key, _), one in zip(rows, prints, strict=True))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aB é\t\n\x0b\x1f　", max_size=60))
def test_fingerprint(text):
    assert fingerprint(text.encode()) == brute_print(text)


def test_fingerprint_of_long_text(monkeypatch):
    text = " ".join(f"word{i % 977}" for i in range(3000))
    whole = fingerprint(text.encode())
    monkeypatch.setattr(simhash, "PART", 100)
    assert fingerprint(text.encode()) == whole == brute_print(text)


def test_odd_rows(odd_docs, no_docs):
    rows = [(row.doc_id, row.text) for row in odd_docs.collect()]
    found = simhash_components(odd_docs)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(map(tuple, found.collect())) == brute(rows)
    assert simhash_components(no_docs).count() == 0


def test_registered_query_as_brute_force(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = registry.QUERIES["op12_simhash_variants"](spark, FOLDER).collect()
    assert Counter(map(tuple, found)) == brute(rows)


def test_one_segment_differs_in_at_most_one_bit():
    random = np.random.default_rng(1)
    cuts = segments(4)
    assert len(cuts) == 3 and sum(length for _, length in cuts) == 64
    for _ in range(2000):
        bits = random.choice(64, 4, replace=False)
        assert min(sum(first <= bit < first + length for bit in bits) for first, length in cuts) <= 1


def test_small_helpers():
    fps = np.array([0, 1, 3, 255, 7, 15], np.int64)
    left, right = close_pairs(fps, np.array([0, 0, 0, 0, 1, 1]), 1)
    assert set(zip(left.tolist(), right.tolist())) == {(0, 1), (1, 2), (4, 5)}
    assert smallest_linked(7, np.array([5, 4, 2]), np.array([6, 5, 1])).tolist() == [0, 1, 1, 3, 4, 4, 4]


@pytest.mark.parametrize("block", [512, 16])
def test_crowded_variant(spark, monkeypatch, block):
    """Fingerprints that all share a segment, in many components, with links between distant blocks of a variant."""
    random = np.random.default_rng(7)
    base = random.integers(0, 1 << 43, 700, dtype=np.int64) << 21
    far = base[:300] ^ (1 << 63 - 1) ^ (1 << 30)  # sorted far away
    chained = far[:100] ^ (1 << 25) ^ (1 << 45) ^ (1 << 50) ^ (1 << 22)
    crowd = 5 ^ np.cumsum(np.zeros(1, np.int64))
    for bit in range(21, 61):
        crowd = np.concatenate([crowd, crowd[:40] ^ (1 << bit)])
    fps = np.unique(np.concatenate([base, far, chained, crowd]))
    monkeypatch.setattr(simhash, "BLOCK", block)
    df = spark.createDataFrame([(int(value),) for value in fps], "fp long")
    found = {row.fp: row.component for row in class_labels(df, 4).collect()}
    want = brute_groups(fps.view(np.uint64).tolist())
    ours = {}
    for value in fps.tolist():
        ours.setdefault(found.get(value, value), set()).add(value & (1 << 64) - 1)
    theirs = {}
    for value, group in want.items():
        theirs.setdefault(group, set()).add(value)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_copies_cost_one_class(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same four words again").alias("text"))
    assert simhash_components(docs).select("component_id").distinct().collect() == [(0,)]
