"""What loads keep between runs: keyed buckets, balance states, client bitmaps; and rules that share a scan."""

import contextlib
import io
import random
from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import bitmaps, rules, valuation
from tallyspark.plans import balance_state
from tallyspark.plans.warehouse import Warehouse
from tallyspark.registry import selection
from tallyspark.registry.base import TERM
from tallyspark.sources import roles

FOLDER = "/root/testdata/sf0.001"
HISTORY = "account_id long, fund_id string, subaccount_id string, settled_at timestamp_ntz, units decimal(18,6)"


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("simple")
    return text.getvalue()


def files_of(folder):
    return {str(path.relative_to(folder)) for path in folder.rglob("*.parquet")}


# ---- keyed buckets

def test_only_buckets_of_the_source_are_rewritten(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    rows = spark.range(5000).select("id", F.col("id").cast("string").alias("value"))
    assert store.upsert_buckets("t", rows, ["id"], buckets=32) == 32
    before = files_of(tmp_path / "t")
    source = spark.createDataFrame([(7, "new"), (7, "newer"), (-1, "added")], "id int, value string")
    touched = store.upsert_buckets("t", source, ["id"])
    assert touched == 2
    kept = before & files_of(tmp_path / "t")
    folders = {name.rsplit("/", 1)[0] for name in before}
    assert len({name.rsplit("/", 1)[0] for name in kept}) == len(folders) - touched
    found = {row.id: row.value for row in store.table("t").collect()}
    assert len(found) == 5001 and found[7] == "new" and found[-1] == "added" and found[8] == "8"
    assert store.table("t").columns == ["id", "value"]
    assert store.upsert_buckets("t", source.limit(0), ["id"]) == 0


def test_merge_is_repeatable_and_reads_its_buckets_only(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    rows = spark.range(1000).select("id", F.lit("old").alias("value"))
    store.upsert_buckets("t", rows, ["id"], buckets=8)
    source = rows.filter("id < 3").withColumn("value", F.lit("new"))
    for _ in range(2):
        store.upsert_buckets("t", source, ["id"])
    assert {r.value: r["count"] for r in store.table("t").groupBy("value").count().collect()} == {"old": 997, "new": 3}
    store.rebucket("t", 3, ["id"])
    assert store.bucket_count("t") == 3 and store.table("t").count() == 1000
    store.upsert_buckets("t", source, ["id"])
    assert store.table("t").filter("value = 'new'").count() == 3
    with pytest.raises(ValueError):
        store.replace("plain", rows)
        store.upsert_buckets("plain", rows, ["id"])


def test_null_keys_and_missing_columns(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, kind string, n int")
    store.upsert_buckets("t", first, ["id", "kind"], buckets=4)
    store.upsert_buckets("t", spark.createDataFrame([(1, "a"), (3, "c")], "id long, kind string"), ["id", "kind"])
    store.upsert_buckets("t", spark.createDataFrame([(None, "a", 9)], "id long, kind string, n int"), ["id", "kind"])
    assert {tuple(r) for r in store.table("t").select("id", "kind", "n").collect()} == {
        (1, "a", None), (2, "b", 2), (3, "c", None), (None, "a", 9)
    }


# ---- balance states

def loads_of(seed, periods):
    """Rows by load; a load also brings rows of days long past and of days to come."""
    dice = random.Random(seed)
    out = {}
    for period in periods:
        start = datetime(2020, 1, 1) + timedelta(days=30 * period)
        out[period] = [
            (
                dice.randrange(12), dice.choice("AB"), "F",
                start + timedelta(days=dice.choice([-60, -20, -1, 0, 5, 12, 29, 45]), hours=dice.choice([0, 7])),
                Decimal(dice.randrange(1, 9)),
            )
            for _ in range(60)
        ]
    return out


def cutoff_of(period):
    return datetime(2020, 1, 31) + timedelta(days=30 * period)


def test_state_is_the_full_computation(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    loads = loads_of(4, range(5))

    def delta(period):
        return spark.createDataFrame(loads[period], HISTORY)

    def check(upto):
        every = spark.createDataFrame([row for period in range(upto + 1) for row in loads[period]], HISTORY)
        want = valuation.latest_units(every, F.lit(cutoff_of(upto)).cast("timestamp_ntz"))
        columns = [*valuation.BALANCE_KEYS, "settled_at", "units"]
        found = Counter(map(tuple, balance_state.balances_at(store, upto).select(*columns).collect()))
        assert found == Counter(map(tuple, want.select(*columns).collect())) and found

    for period in range(5):
        balance_state.advance(store, delta(period), period, cutoff_of(period))
        check(period)
    balance_state.advance(store, delta(4), 4, cutoff_of(4))
    check(4)
    with pytest.raises(ValueError):
        balance_state.advance(store, delta(2), 2, cutoff_of(2))
    loads[2] = loads[2][:20] + loads_of(9, [2])[2]
    balance_state.restate(store, delta, cutoff_of, 2)
    for period in range(5):
        check(period)


def test_a_step_reads_the_state_and_the_delta_only(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    rows = spark.createDataFrame(loads_of(1, [0])[0], HISTORY)
    for period in range(3):
        rows.withColumn("period_id", F.lit(period)).write.mode("append").partitionBy("period_id").parquet(store.path("h"))
        balance_state.advance(store, rows, period, cutoff_of(period))
    delta = store.table("h").filter("period_id = 3")
    state = balance_state.state_before(store, delta, 3)
    plan = valuation.advanced_state(state, delta, F.lit(cutoff_of(3)))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    scans = [line for line in plan_of(plan).splitlines() if "FileScan" in line]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert len(scans) == 2
    assert sum("= 2)" in scan for scan in scans) == 1 and sum("= 3)" in scan for scan in scans) == 1


# ---- bitmaps

def test_bitmaps_count_exactly(spark):
    dice = random.Random(2)
    rows = [
        (dice.choice("ab"), dice.choice([1, 2, None]), dice.choice([None, 0, -5, 1, 32768, 32769, -32768, dice.randrange(10**9)]))
        for _ in range(600)
    ] + [("empty", 1, None)]
    df = spark.createDataFrame(rows, "a string, b int, id long")
    base = bitmaps.id_bitmaps(df, ["a", "b"], "id")
    found = Counter(map(tuple, bitmaps.distinct_subtotals(base, [["a", "b"], ["a"], []]).collect()))
    want = Counter()
    for level, key in enumerate((lambda r: (r[0], r[1]), lambda r: (r[0], None), lambda r: (None, None))):
        groups = {}
        for row in rows:
            groups.setdefault(key(row), set()).update([row[2]] if row[2] is not None else [])
        want.update((*group, level, len(ids)) for group, ids in groups.items())
    assert found == want
    with pytest.raises(ValueError):
        bitmaps.distinct_subtotals(base, [["a"], ["b"]])


def test_several_periods_from_stored_bitmaps(spark, tmp_path):
    """Accounts that are in two periods count once, and the rows are not read again."""
    store = Warehouse(spark, str(tmp_path))
    for period in (1, 2):
        rows = spark.range(period * 10, period * 10 + 15).select(F.lit("x").alias("fund_id"), "id")
        store.load("bits", bitmaps.id_bitmaps(rows, ["fund_id"], "id"), replace(TERM, period_id=period))
    counted = bitmaps.distinct_counts(store.table("bits"), ["fund_id"])
    assert counted.collect() == [("x", 25)]


# ---- rules

def test_fifty_rules_read_their_table_once(spark):
    assert plan_of(selection.indicator_rules_one_scan(spark, FOLDER)).count("FileScan") == 1


def test_other_rules_run_by_themselves(spark):
    """Each form gives what the statement alone gives, fused or not."""
    spark.range(20).select("id", (F.col("id") % 3).alias("kind")).createOrReplaceTempView("plain_rows")
    table = spark.table("plain_rows")
    texts = {
        "SELECT id FROM t": True,
        "SELECT id + 1 AS x, kind FROM t WHERE kind = 1": True,
        "SELECT t.id FROM t WHERE kind IN (0, 2) AND NOT (id < 5) AND :term = 39": True,
        "SELECT id FROM (SELECT * FROM t WHERE id > 3) WHERE kind = 0": False,
        "SELECT u.id FROM t AS u WHERE u.kind = 2": False,
        "SELECT DISTINCT kind FROM t": False,
        "SELECT max(id) FROM t GROUP BY kind": False,
        "SELECT id FROM t WHERE kind = (SELECT min(kind) FROM t)": False,
        "SELECT a.id FROM t a JOIN t b ON a.id = b.kind": False,
        "SELECT id FROM t LIMIT 3": False,
        "SELECT explode(array(id, kind)) FROM t WHERE id = 4": False,
    }
    listed = [rules.IndicatorRule(n, text, "S") for n, text in enumerate(texts)]
    found = Counter(
        (row.indicator_id, row.account_id)
        for row in rules.run_indicator_rules(spark, listed, {"S": {"t": table}}, TERM).collect()
    )
    want = Counter()
    with rules.source_views(spark, {"t": table}):
        for n, (text, fused) in enumerate(texts.items()):
            alone = spark.sql(text, args={"term": TERM.period_id})
            assert (rules.row_test(alone) is not None) == fused, text
            want.update((n, row[0]) for row in alone.collect())
    assert found == want


def test_rules_of_several_sources(spark):
    one, two = spark.range(3).toDF("id"), spark.range(5).toDF("id")
    listed = [
        rules.IndicatorRule(1, "SELECT id FROM t", "A"), rules.IndicatorRule(2, "SELECT id FROM t", "B"),
        rules.IndicatorRule(3, "SELECT id FROM t WHERE id = 1", "elsewhere"),
    ]
    found = rules.run_indicator_rules(spark, listed, {"A": {"t": one}, "B": {"t": two}, "WAREHOUSE": {"t": two}}, TERM)
    assert Counter(row.indicator_id for row in found.collect()) == {1: 3, 2: 5, 3: 1}
