import re

from pyspark.sql import functions as F

from tallyspark.llm.decontamination import contamination, decontaminate

ITEMS = [
    ("a", "one two three four five six seven eight nine ten eleven twelve"), ("b", "Tiny item"), ("c", None), (None, "null id here"),
    ("d", "..."), ("b2", "tiny ITEM"),
]
TEXTS = [
    (1, "x ONE two three, four five six seven eight nine ten Eleven y"), (2, "a tiny item, and tiny-item again"),
    (2, "a tiny item, and tiny-item again"), (3, None), (None, "null id here"), (4, ""), (5, "one two three four five six"),
    (6, "ONE TWO THREE FOUR FIVE SIX SEVEN EIGHT NINE TEN ELEVEN TWELVE ÀÉ tiny"), (7, "w " * 20_000),
]


def words(text):
    return [word.encode().lower().decode() for word in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(items, text):
    found, hit, names = words(text), set(), set()
    for item, body in items:
        item_words = words(body)
        size = min(10, len(item_words))
        if not size:
            continue
        for at in range(len(item_words) - size + 1):
            for place in range(len(found) - size + 1):
                if found[place : place + size] == item_words[at : at + size]:
                    hit |= set(range(place, place + size))
                    if item is not None:
                        names.add(item)
    return len(found), len(hit), sorted(names)


def tables(spark):
    docs = spark.createDataFrame([(*row, "w") for row in TEXTS], "doc_id long, text string, words string")
    return docs, spark.createDataFrame(ITEMS, "item_id string, text string")


def test_as_brute_force(spark):
    docs, items = tables(spark)
    want = sorted(((key, *brute(ITEMS, text)) for key, text in TEXTS), key=str)
    for bound in (1 << 21, 1):  # 1: more windows than the bits can tell apart
        found = contamination(docs, items, most_longs=bound).collect()
        assert sorted(((row.doc_id, row.n_words, row.n_hit, row["items"]) for row in found), key=str) == want
        assert all(row.contaminated == (row.n_hit > 0) and row.n_items == len(row["items"]) for row in found)


def test_removal(spark):
    docs, items = tables(spark)
    kept = decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=str) == sorted(
        [(*row, "w") for row in TEXTS if not brute(ITEMS, row[1])[1]], key=str
    )
    cut = {row.doc_id: row.text for row in decontaminate(docs, items, remove="spans").collect()}
    assert cut[1] == "x y" and cut[2] == "a, and again" and cut[3] is None and cut[6] == " ÀÉ tiny" and cut[None] == ""


def test_empty(spark, no_docs):
    docs, items = tables(spark)
    assert contamination(no_docs, items).count() == 0
    assert contamination(docs, items.limit(0)).filter("contaminated").count() == 0
    assert decontaminate(docs, items.limit(0)).count() == len(TEXTS)


def test_same_plan_at_any_size_of_the_benchmark(spark):
    """A thousand and half a million windows: the same operators, and no hit is lost or made up."""
    docs = spark.range(40).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(30)), lambda at: F.concat(F.lit("w"), F.col("id") * 1000 + at))).alias("text"),
    )
    shapes = []
    for count in (1_000, 500_000):
        items = spark.range(count).select(
            F.col("id").alias("item_id"),
            F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(9)), lambda at: F.concat(F.lit("w"), F.col("id") * 10 + at))).alias("text"),
        )
        found = contamination(docs, items)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        shapes.append(re.findall(r"^[ :+-]*([A-Z]\w+)", plan, re.M))
        hit = {row.doc_id: (row.n_hit, row.n_items) for row in found.collect()}
        # a document begins with item 100 * id, and holds the two after it and no more whole ones
        assert all(one == ((30, 3) if 100 * key + 2 < count else (0, 0)) for key, one in hit.items())
    assert shapes[0] == shapes[1]
