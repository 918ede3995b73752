"""As-of joins for many dates, and balances of all periods, against brute force; skew and plans."""

import contextlib
import io
import random
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import valuation
from tallyspark.operators.asof import asof_join


def brute(probes, values, strict, forward):
    out = Counter()
    for number, key, at in probes:
        best = None
        for known, since, price in values:
            if key is None or at is None or known != key or since is None:
                continue
            if since == at and strict or (since < at if forward else since > at):
                continue
            rank = (-since if forward else since, price)
            if best is None or rank > best[0]:
                best = (rank, since, price)
        out[(number, key, at, *(best[1:] if best else (None, None)))] += 1
    return out


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("hot", [0, 400])
def test_asof_join_as_brute_force(spark, strict, forward, hot):
    """Ties, null keys and moments, repeated probes; with ``hot``, one key is spread over all partitions."""
    dice = random.Random(3)
    probes = [(n, dice.choice([1, 2, 3, None]), dice.choice([*range(30), None])) for n in range(120)]
    probes += [(1000, 7, dice.randrange(30)) for n in range(hot)] + [(1, 1, 5)] * 2
    values = [(dice.choice([1, 2, 4, None]), dice.choice([*range(0, 30, 3), None]), dice.randrange(5)) for _ in range(60)]
    values += [(7, at, at) for at in (3, 11, 12)]
    left = spark.createDataFrame(probes, "number int, key int, at int").repartition(5)
    right = spark.createDataFrame(values, "key int, since int, price int").repartition(3)
    found = asof_join(left, right, ["key"], "at", "since", ["price"], strict=strict, forward=forward)
    assert found.columns == ["number", "key", "at", "since", "price"]
    assert Counter(map(tuple, found.collect())) == brute(probes, values, strict, forward)


def test_empty_sides(spark):
    left = spark.createDataFrame([(1, 2)], "key int, at int")
    right = spark.createDataFrame([], "key int, since int, price int")
    assert asof_join(left, right, ["key"], "at", "since", ["price"]).collect() == [(1, 2, None, None)]
    assert asof_join(left.limit(0), right, ["key"], "at", "since", ["price"]).count() == 0


def test_hot_key_is_spread(spark):
    """No partition of the merged rows holds more than a share of the one key that all rows have."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small, it would be put together again
    probes = spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("key"), (F.col("id") % 3).alias("at"), "id")
    values = spark.createDataFrame([(1, 0, "a"), (1, 2, "b")], "key int, since long, name string")
    found = asof_join(probes, values, ["key"], "at", "since", ["name"])
    assert {(row.at, row.name): row["count"] for row in found.groupBy("at", "name").count().collect()} == {
        (0, "a"): 13334, (1, "a"): 13333, (2, "b"): 13333,
    }
    sizes = [len(part) for part in found.rdd.glom().collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 20_000


def rows_of(spark, count, seed):
    dice = random.Random(seed)
    start = datetime(2020, 1, 1)
    return [
        (
            dice.choice([1, 1, 2, 3]), dice.choice("AB"), dice.choice("FO"),
            start + timedelta(days=dice.randrange(200), hours=dice.choice([0, 0, 9])), Decimal(dice.randrange(1, 50)),
        )
        for _ in range(count)
    ]


HISTORY = "account_id long, fund_id string, subaccount_id string, settled_at timestamp_ntz, units decimal(18,6)"


@pytest.fixture(scope="module")
def tables(spark):
    history = spark.createDataFrame(rows_of(spark, 400, 1), HISTORY)
    kinds = spark.createDataFrame([("F", 1), ("O", 2)], "subaccount_id string, regime_id int")
    prices = spark.createDataFrame(
        [(fund, regime, date(2020, 1, 5) + timedelta(days=9 * n), Decimal(n + regime)) for fund in "AB" for regime in (1, 2)
         for n in range(20)],
        "fund_id string, regime_id int, price_date date, price decimal(18,2)",
    )
    starts = [date(2019, 12, 1), date(2020, 1, 1), date(2020, 2, 1), date(2020, 2, 2), date(2020, 5, 1), date(2020, 12, 1)]
    terms = spark.createDataFrame(
        [(n, start, start - timedelta(days=1)) for n, start in enumerate(starts)],
        "period_id int, next_start date, price_date date",
    )
    return history, kinds, prices, terms


def test_all_terms_as_one_by_one(spark, tables):
    history, kinds, prices, terms = tables
    dated = valuation.cutoff_dates(history, terms)
    together = Counter(map(tuple, valuation.balances_of_terms(history, kinds, prices, dated).collect()))
    single = Counter()
    for row in dated.collect():
        assert row.cutoff == valuation.cutoff_date(history, row.next_start).first()[0]
        one = valuation.value_balances(history, kinds, prices, F.lit(row.cutoff), F.lit(row.price_date))
        single.update((row.period_id, *found) for found in map(tuple, one.collect()))
    assert together == single and len(single) > 20


def test_history_is_read_once_and_cut_down_first(spark, tables, tmp_path):
    history, _, _, terms = tables
    history.write.parquet(str(tmp_path / "history"))
    stored = spark.read.parquet(str(tmp_path / "history"))
    slices = valuation.cutoff_slices(valuation.cutoff_dates(history, terms))
    text = io.StringIO()
    summed = valuation.sliced(stored, slices)
    with contextlib.redirect_stdout(text):
        valuation._latest_day(summed, [*valuation.BALANCE_KEYS, "slice"], "settled_at").explain("simple")
    assert text.getvalue().count(str(tmp_path)[:40]) <= 2 and "WindowGroupLimit" in text.getvalue()
    assert "CartesianProduct" not in text.getvalue() and "NestedLoop" not in text.getvalue()


def test_odd_rows_of_all_terms(spark, tables):
    """Null keys, moments and units, repeated rows, terms that share a cut-off, and the history summed beforehand."""
    _, kinds, prices, terms = tables
    rows = rows_of(spark, 60, 5)
    rows += rows[:20] + [(None, *row[1:]) for row in rows[20:30]] + [(*row[:3], None, row[4]) for row in rows[30:35]]
    rows += [(*row[:4], None) for row in rows[35:40]] + [(1, None, "F", *row[3:]) for row in rows[40:45]]
    history = spark.createDataFrame(rows, HISTORY)
    terms = terms.unionByName(terms.withColumn("period_id", F.col("period_id") + 10))
    dated = valuation.cutoff_dates(history, terms)
    together = Counter(map(tuple, valuation.balances_of_terms(history, kinds, prices, dated).collect()))
    units = valuation.units_by_moment(history)
    again = valuation.balances_of_terms(units, kinds, prices, valuation.cutoff_dates(units, terms), summed=True)
    single = Counter()
    for row in dated.collect():
        one = valuation.value_balances(history, kinds, prices, F.lit(row.cutoff), F.lit(row.price_date))
        single.update((row.period_id, *found) for found in map(tuple, one.collect()))
    assert together == single and single == Counter(map(tuple, again.collect()))
    assert {row[1] for row in single} == {None, 1, 2, 3}


def test_rows_of_the_result_are_not_joined(spark, tables):
    """Prices are joined to the balances before these are told for their terms, and no exchange comes after."""
    history, kinds, prices, terms = tables
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        valuation.balances_of_terms(history, kinds, prices, valuation.cutoff_dates(history, terms)).explain("simple")
    plan = text.getvalue()
    assert 0 < plan.index("Generate") < min(plan.index("Join"), plan.index("Exchange"))
