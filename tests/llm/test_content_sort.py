from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyspark.llm.content_sort import drop_exact_duplicates, exact_duplicates


def expected(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault((text or "").encode().lower(), []).append(key)
    out = Counter()
    for keys in groups.values():
        best = max((key for key in keys if key is not None), default=None)
        for key in keys:
            out[(key, best, len(keys))] += 1
    return out, len(groups)


def test_groups_as_brute_force(odd_docs):
    rows = [(row.doc_id, row.text) for row in odd_docs.collect()]
    found = exact_duplicates(odd_docs).collect()
    want, groups = expected(rows)
    assert Counter((row.doc_id, row.keep_id, row.group_size) for row in found) == want
    assert sum(row.kept for row in found) == groups
    assert all(row.doc_id == row.keep_id for row in found if row.kept)


def test_other_direction(odd_docs):
    found = exact_duplicates(odd_docs, keep="smallest").filter("kept").collect()
    assert {row.keep_id for row in found} == {1, 3, 7, 8, 9}
    with pytest.raises(ValueError):
        exact_duplicates(odd_docs, keep="first")


def test_kept_rows_are_whole(odd_docs):
    kept = drop_exact_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert len(rows) == 5
    assert set(map(tuple, rows)) <= set(map(tuple, odd_docs.collect()))


def test_group_over_many_partitions(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 4 > 0, "the SAME").otherwise(F.col("id").cast("string")).alias("text")
    )
    found = exact_duplicates(docs)
    hot = found.filter("group_size > 1")
    assert hot.count() == 3000
    assert hot.select("keep_id", "group_size").distinct().collect() == [(3999, 3000)]
    assert found.filter("kept").count() == 1001
    assert drop_exact_duplicates(docs).count() == 1001


def test_empty(no_docs):
    assert exact_duplicates(no_docs).count() == 0
    assert drop_exact_duplicates(no_docs).columns == no_docs.columns


def test_any_names(spark):
    rows = [(1, "a", 1, 2, 3, 4, 5), (2, "A", 6, 7, 8, 9, 0), (3, None, 1, 1, 1, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int, ID int, SHA int, c0 int, there int")
    kept = drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == rows[1:]
