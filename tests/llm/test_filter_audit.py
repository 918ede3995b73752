import re
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.llm.filter_audit import CONDITIONS, audit_filters, survivors

LABELS = "doc_id long, quality int, toxic int"


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = set()
    if len(words) < 100:
        out.add("A")
    if 100 * len(set(words)) < 80 * len(words):
        out.add("B")
    if 100 * sum("A" <= char <= "Z" for char in text) > 10 * len(text):
        out.add("C")
    if any(char in "#$%&*|" for char in text):
        out.add("D")
    return out


def brute(rows, labels, names="ABCDE"):
    """Every order applied filter by filter to every document."""
    docs = []
    for key, text, part in rows:
        failed = fails(text or "")
        if key is not None and any(k is not None and k < key and (t or "") == (text or "") for k, t, _ in rows):
            failed.add("E")
        marks = [mark for mark in labels if key is not None and mark[0] == key]
        docs.append((part or "", failed, any(m[1] == 1 for m in marks), any(m[2] == 1 for m in marks)))
    out, credit = {}, {}
    for part in {doc[0] for doc in docs}:
        for order in permutations(names):
            left = [doc for doc in docs if doc[0] == part]
            gone = []
            for step, name in enumerate(order, 1):
                here = [doc for doc in left if name in doc[1]]
                redundant = sum(name in doc[1] for doc in gone)
                left = [doc for doc in left if name not in doc[1]]
                gone += here
                alone = sum(doc[0] == part and doc[1] == {name} for doc in docs)
                credit[part, name] = credit.get((part, name), 0) + len(here)
                out[part, "".join(order), step] = [
                    len(left), len(here), redundant, alone, sum(d[2] for d in here), sum(d[3] for d in here), name
                ]
    return {key: tuple(row[:-1]) + (credit[key[0], row[-1]],) for key, row in out.items()}


def rows_of(found):
    return {
        (r.part, r.filter_order, r.step): (
            r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley
        )
        for r in found.collect()
    }


MANY = " ".join(f"w{i}" for i in range(120))
ODD = [
    (1, MANY, "en"), (2, MANY, "en"), (2, MANY, "en"), (3, MANY, "de"), (4, None, None), (5, "", "en"), (6, "", ""),
    (None, MANY, "en"), (None, None, None), (7, "word " * 30_000, "de"), (8, "LOUD WORDS # here", "en"),
    (9, MANY + " $", "fr"), (10, MANY.upper(), "fr"), (11, "a\tb\x0bc\fd\re\n" * 30, "fr"), (12, MANY + " x", "fr"),
]
MARKS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, 0, 1), (8, None, 1), (9, 1, None), (None, 1, 1), (99, 1, 1), (5, 1, 0)]


def test_as_brute_force(spark):
    docs = spark.createDataFrame([(*row, 1, "x") for row in ODD], "doc_id long, text string, lang string, mask int, id string")
    assert rows_of(audit_filters(docs, spark.createDataFrame(MARKS, LABELS))) == brute(ODD, MARKS)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 31), st.integers(0, 9)), max_size=40))
def test_walk_as_counting(cells):
    masks = np.array([mask for mask, _ in cells], np.int64)
    weights = np.array([[weight] for _, weight in cells], np.int64).reshape(-1, 1)
    states = survivors(masks, weights, 5)
    assert states[:, 0].tolist() == [sum(w for m, w in cells if not m & subset) for subset in range(32)]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], LABELS)
    assert audit_filters(docs, labels).count() == 0
    one = spark.createDataFrame([(1, None, None)], docs.schema)
    found = rows_of(audit_filters(one, labels))
    assert len(found) == 600 and found["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)


def test_other_filters(spark):
    docs = spark.createDataFrame([(1, "x", "p"), (2, "x", "p"), (3, "yy", "p")], "key long, body string, source string")
    found = audit_filters(
        docs, spark.createDataFrame([], LABELS), {"L": lambda text: F.length(text) > 1}, "R", "key", "body", "source"
    )
    assert rows_of(found) == {
        ("p", "LR", 1): (2, 1, 0, 1, 0, 0, 2), ("p", "LR", 2): (1, 1, 0, 1, 0, 0, 2),
        ("p", "RL", 1): (2, 1, 0, 1, 0, 0, 2), ("p", "RL", 2): (1, 1, 0, 1, 0, 0, 2),
    }
    with pytest.raises(ValueError):
        audit_filters(docs, docs, CONDITIONS, "A")


def test_plan_reads_texts_once_and_moves_digests_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    plan = audit_filters(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("text#") and plan.count("Relation") == 2
