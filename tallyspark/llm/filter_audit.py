"""Filter interaction audit: what every order of a set of filters removes, from a Gray-code walk over their subsets."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_FILTERS = 7  # the result has a row per order and step: 7! * 7 rows a part
_BREAKS = "\t\n\x0b\f\r"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MEASURES = ("documents", "good", "toxic")


def words_of(text: Column) -> Column:
    """Maximal runs of other characters than space and 0x09 to 0x0D."""
    return F.array_remove(F.split(F.translate(text, _BREAKS, " " * len(_BREAKS)), " "), "")


def few_words(text: Column) -> Column:
    return F.size(words_of(text)) < 100


def repetitive(text: Column) -> Column:
    """Fewer than 80 different words in 100."""
    words = words_of(text)
    return 100 * F.size(F.array_distinct(words)).cast("bigint") < 80 * F.size(words).cast("bigint")


def shouting(text: Column) -> Column:
    """More than one capital letter A-Z in 10 code points."""
    length = F.length(text).cast("bigint")
    return 100 * (length - F.length(F.translate(text, _CAPITALS, ""))) > 10 * length


def symbols(text: Column) -> Column:
    return text.rlike("[#$%&*|]")


CONDITIONS: dict[str, Callable[[Column], Column]] = {
    "A": few_words, "B": repetitive, "C": shouting, "D": symbols,
}


# ---- the walk over subsets

def survivors(masks: np.ndarray, weights: np.ndarray, filters: int) -> np.ndarray:
    """Totals of the rows that each subset of the filters leaves: row ``s`` belongs to the subset of the bits of ``s``.

    ``masks`` are the failed filters of each cell, ``weights`` the totals of each cell. Subsets are visited in Gray-code
    order, so one filter is switched on or off at a time: the cells that fail it count one active failure more or less,
    and those that leave or come back to zero are taken from the running totals or added to them.
    """
    states = np.empty((1 << filters, weights.shape[1]), np.int64)
    failing = [np.flatnonzero(masks >> bit & 1) for bit in range(filters)]
    active = np.zeros(len(masks), np.int64)
    running = weights.sum(axis=0, dtype=np.int64)
    states[0] = running
    subset = 0
    for step in range(1, 1 << filters):
        bit = (step & -step).bit_length() - 1
        subset ^= 1 << bit
        cells = failing[bit]
        if subset >> bit & 1:
            running = running - weights[cells[active[cells] == 0]].sum(axis=0, dtype=np.int64)
            active[cells] += 1
        else:
            active[cells] -= 1
            running = running + weights[cells[active[cells] == 0]].sum(axis=0, dtype=np.int64)
        states[subset] = running
    return states


def audit_rows(states: np.ndarray, names: str) -> dict[str, list]:
    """One row per order and step from the totals of all subsets; all figures are differences of two states."""
    count = len(names)
    full = (1 << count) - 1
    failed = [int(states[0, 0] - states[1 << bit, 0]) for bit in range(count)]
    alone = [int(states[full ^ 1 << bit, 0] - states[full, 0]) for bit in range(count)]
    shapley = [
        sum(
            factorial(before.bit_count()) * factorial(count - 1 - before.bit_count())
            * int(states[before, 0] - states[before | 1 << bit, 0])
            for before in range(full + 1) if not before >> bit & 1
        )
        for bit in range(count)
    ]
    out = {name: [] for name in (
        "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )}
    for order in permutations(range(count)):
        label = "".join(names[bit] for bit in order)
        subset = 0
        for step, bit in enumerate(order, 1):
            after = subset | 1 << bit
            lost = states[subset] - states[after]
            row = (
                label, step, states[after, 0], lost[0], failed[bit] - lost[0], alone[bit], lost[1], lost[2], shapley[bit]
            )
            for column, value in zip(out.values(), row, strict=True):
                column.append(value)
            subset = after
    return out


# ---- cells

def failure_cells(
    docs: DataFrame, labels: DataFrame, conditions: Mapping[str, Callable[[Column], Column]], id_col: str, text_col: str,
    part_col: str,
) -> DataFrame:
    """``part, mask, documents, good, toxic``: documents of each part by the filters they fail.

    Bit ``i`` is the condition ``i``; the bit after the last one marks texts that a smaller identifier has too. Only a
    digest and the mask of each text travel. Equal texts fail the same conditions, so each group of them is counted per
    part and label before the rows of its smallest identifier are told from the others: a text that a third of all
    documents share costs a few rows per task.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    mask = F.lit(0)
    for bit, condition in enumerate(conditions.values()):
        mask = mask + F.when(condition(text), 1 << bit).otherwise(0)
    light = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        F.sha2(text, 256).alias("digest"), mask.cast("int").alias("mask"),
    )
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    marked = light.join(marks, "id", "left").fillna(False, ["good", "toxic"])
    kind = ["part", "mask", "digest", "good", "toxic"]
    same_id = marked.groupBy("id", *kind).agg(F.count(F.lit(1)).alias("rows"))
    known = F.col("id").isNotNull()
    groups = same_id.groupBy(*kind).agg(
        F.sum("rows").alias("rows"), F.min(F.when(known, F.struct("id", "rows"))).alias("first"),
        F.sum(F.when(known, 0).otherwise(F.col("rows"))).alias("unknown"),
    )
    lowest = F.min("first.id").over(Window.partitionBy("digest"))  # a row per part and label here
    own = F.when(F.col("first.id") == lowest, F.col("first.rows")).otherwise(0)
    split = groups.select("part", "mask", "good", "toxic", "rows", (own + F.col("unknown")).alias("firsts"))
    repeat = F.lit(1 << len(conditions))
    both = split.select(
        "part", "good", "toxic",
        F.explode(
            F.array(
                F.struct(F.col("mask").alias("mask"), F.col("firsts").alias("n")),
                F.struct((F.col("mask") + repeat).alias("mask"), (F.col("rows") - F.col("firsts")).alias("n")),
            )
        ).alias("cell"),
    )
    count = F.col("cell.n")
    return both.groupBy("part", F.col("cell.mask").alias("mask")).agg(
        F.sum(count).alias("documents"), F.sum(F.when(F.col("good"), count).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), count).otherwise(0)).alias("toxic"),
    )


def audit_filters(
    docs: DataFrame, labels: DataFrame, conditions: Mapping[str, Callable[[Column], Column]] = CONDITIONS,
    duplicates: str = "E", id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
) -> DataFrame:
    """What each filter does at each step of every order of the filters, one row per part, order and step.

    ``conditions`` name a filter by one character and say when a text fails it; ``duplicates`` names the filter that
    texts of a smaller identifier's text fail, wherever in the table that is. Columns: ``part, filter_order, step,
    kept, removed, redundant`` (fail this filter, removed earlier), ``unique_fails`` (fail this filter only),
    ``good_lost, toxic_lost`` (removed here, with that label) and ``shapley`` (removed by this filter, summed over all
    orders).

    Null texts are empty, null parts are the part of the empty string. Rows that share the smallest identifier of a
    text are all first; a null identifier is neither smaller nor repeated, and has no label. Repeated labels of a
    document count if one of them does. An empty table has no parts and gives no rows. Other columns are not read, so
    clashing names do not matter. Texts are read once; at most ``2 ** filters`` cells of a part meet in one task.
    """
    names = "".join(conditions) + duplicates
    if len(set(names)) != len(names) or len(names) != len(conditions) + 1:
        raise ValueError("filters are named by different single characters")
    if len(names) > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters have all their orders listed")
    cells = failure_cells(docs, labels, conditions, id_col, text_col, part_col)
    longs = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    schema = T.StructType(
        [T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()),
         T.StructField("step", T.IntegerType()), *[T.StructField(name, T.LongType()) for name in longs]]
    )

    def walk(key, found):
        states = survivors(found["mask"].to_numpy(), found[list(MEASURES)].to_numpy(), len(names))
        rows = pd.DataFrame(audit_rows(states, names))
        rows.insert(0, "part", key[0])
        return rows

    return cells.groupBy("part").applyInPandas(walk, schema)


SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
f AS (
    SELECT doc_id, part,
           CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
           + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 16 ELSE 0 END AS mask
    FROM d),
l AS (
    SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
    FROM labels GROUP BY doc_id),
c AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE toxic) AS x
    FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
s AS (
    SELECT part, subset, coalesce(sum(n) FILTER (WHERE mask & subset = 0), 0)::BIGINT AS n,
           coalesce(sum(g) FILTER (WHERE mask & subset = 0), 0)::BIGINT AS g,
           coalesce(sum(x) FILTER (WHERE mask & subset = 0), 0)::BIGINT AS x
    FROM c, range(32) AS r(subset) GROUP BY part, subset),
letter AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(name, bit)),
o AS (
    SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letter a, letter b, letter c, letter d, letter e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
p AS (
    SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS BIGINT) AS before
    FROM o, range(1, 6) AS r(step)),
q AS (
    SELECT b.part, filter_order, step, bit, a.n AS kept, b.n - a.n AS removed, b.g - a.g AS good_lost,
           b.x - a.x AS toxic_lost
    FROM p JOIN s b ON b.subset = p.before JOIN s a ON a.part = b.part AND a.subset = p.before + p.bit),
h AS (SELECT part, bit, sum(removed)::BIGINT AS shapley FROM q GROUP BY part, bit),
k AS (
    SELECT part, bit, sum(CASE WHEN mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS failed,
           sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS alone
    FROM c, letter GROUP BY part, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, failed - removed AS redundant,
       alone AS unique_fails, good_lost, toxic_lost, shapley
FROM q JOIN h USING (part, bit) JOIN k USING (part, bit)"""


def op13_filter_audit(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    return audit_filters(docs, spark.read.parquet(f"{folder}/labels.parquet"))
