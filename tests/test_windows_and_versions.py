"""Windows from running sums, versioned period tables, and loads that count while they write."""

import contextlib
import io
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import changes, statements
from tallyspark.operators.reports import load_summary
from tallyspark.operators.terms import Term
from tallyspark.plans import running_sums
from tallyspark.plans.warehouse import Warehouse
from tallyspark.sources import tables
from tallyspark.sources.versions import VersionedTable

TERM = Term(
    period_id=14, label="02/2020", start=date(2020, 2, 1), end=date(2020, 2, 29), next_start=date(2020, 3, 1),
    price_date=date(2020, 2, 29), previous_cutoff=date(2020, 2, 1), previous_price_date=date(2020, 1, 31),
)
FACTS = (
    "account_id long, period_id int, subaccount_id string, initial decimal(18,4), final decimal(18,4), "
    "credit decimal(18,4), charge decimal(18,4), commission decimal(18,4)"
)


@pytest.fixture(scope="module")
def setting(spark):
    months = [(n, f"{(n - 1) % 12 + 1:02d}/{2019 + (n - 1) // 12}") for n in range(1, 16)]
    periods = spark.createDataFrame(months, "period_id int, period string")
    rows = [
        (account, period, sub, *[Decimal(account * 7 + period * k + len(sub)) for k in range(1, 6)])
        for account in range(1, 9) for period in range(1, 16) for sub in ("F", "O")
        if (account + period) % 3 and not (account == 5 and period > 9) and not (sub == "O" and account % 2)
    ]
    formats = spark.createDataFrame(
        [(1, 2, 1, 1), (2, 2, 1, 3), (3, 3, 1, 12), (4, 3, 3, 3)],
        "format_id int, generation_id int, generation_months int, front_months int",
    )
    chosen = formats.crossJoin(spark.range(1, 9).withColumnRenamed("id", "account_id"))
    lines = spark.createDataFrame(
        [(2, "A", "a", "AHO", ["F"]), (3, "B", "b", "TOT", ["F", "O"]), (3, "C", "c", "VIV", ["X"])],
        "generation_id int, savings_type string, concept string, section string, subaccounts array<string>",
    )
    return spark.createDataFrame(rows, FACTS), chosen, formats, lines, periods


def rows_of(df):
    columns = sorted(set(df.columns) - {"created_at"})
    return sorted(map(str, df.select(*columns).collect()))


@pytest.mark.parametrize("steps", [range(1, 15), [1, 10, 12, 14]])
def test_front_from_sums_is_the_front(spark, setting, tmp_path, steps):
    returns, chosen, formats, lines, periods = setting
    store = Warehouse(spark, str(tmp_path))
    returns.write.partitionBy("period_id").parquet(store.path("facts"))
    for period_id in steps:
        running_sums.advance_sums(store, store.table("facts"), period_id)
    running_sums.advance_sums(store, store.table("facts"), 14)
    windows = statements.front_windows(formats, periods, TERM, store.periods("facts"), store.periods(running_sums.SUMS))
    assert windows[12]["before"] == 1 and windows[1] == {"first": 13, "last": 14, "upto": 14, "before": 12}
    got = statements.statement_front_from_sums(
        store.table("facts"), store.table(running_sums.SUMS), windows, chosen, lines, TERM
    )
    want = statements.statement_front(returns, chosen, formats, lines, periods, TERM)
    assert rows_of(got) == rows_of(want) and got.count() > 10
    text = io.StringIO()
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    with contextlib.redirect_stdout(text):
        got.explain("simple")
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in text.getvalue().splitlines() if "FileScan" in line and "facts" in line]
    assert scans and all("period_id" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)


# ---- versions

def test_readers_see_whole_loads(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    rows = spark.range(10)
    with pytest.raises(ValueError):
        table.read()
    assert table.load(rows, 1) == 10 and table.load(rows.limit(3), 2) == 3
    open_reader = table.read()
    before = table.loads()
    with pytest.raises(Exception, match="stop"):
        table.load(rows.withColumn("id", F.expr("raise_error('stop')").cast("long")), 1)
    assert table.loads() == before and table.read().count() == 13
    assert table.load(rows.limit(0), 2) == 0
    assert open_reader.count() == 13 and table.read().count() == 10
    assert table.read(as_of=1).count() == 10 and set(table.read().columns) == {"id", "period_id"}
    table.drop(1)
    assert table.read().count() == 0 and table.read(as_of=2).filter("period_id = 2").count() == 3


def test_two_loads_at_once_and_forgetting(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.load(spark.range(4), 1)
    stale = table._newest()
    table.load(spark.range(5), 1)
    monkeypatch.setattr(VersionedTable, "_newest", lambda self: stale)
    with pytest.raises(RuntimeError):
        table.load(spark.range(9), 1)
    monkeypatch.undo()
    assert table.read().count() == 5 and table.loads() == [1, 2]
    table.load(spark.range(2), 3)
    table.forget(before=3)
    assert table.loads() == [3] and table.read().count() == 7
    with pytest.raises(ValueError):
        table.forget(before=9)
    assert sorted(path.name[:8] for path in (tmp_path / "t" / "data").iterdir()) == ["_load=2-", "_load=3-"]


# ---- loads

def test_summary_of_a_load_as_of_its_rows(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, "a"), (2, 5, None), (None, None, "b")], "id long, n int, `odd name` string")
    found = tables.replace_period_with_summary(rows, str(tmp_path / "t"), 7)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, load_summary(rows).collect()))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    empty = tables.replace_period_with_summary(rows.limit(0), str(tmp_path / "t"), 7)
    assert {(row.row_count, row.non_null) for row in empty.collect()} == {(0, 0)}
    assert spark.read.parquet(str(tmp_path / "t")).count() == 0


def test_row_limit_of_a_load(spark, tmp_path):
    source = tables.Table("parquet", "/root/testdata/sf0.001/nation.parquet")
    target = tables.Table("parquet", str(tmp_path / "t"))
    assert tables.transfer(spark, source, target, term_id=1, limit=4) == 4
    assert tables.transfer(spark, source, target, term_id=2, limit=0) == 0
    assert tables.read_table(spark, source, 6).count() == 6
    assert tables.transfer(spark, source, target, term_id=1) == 25


# ---- tables clustered by account

def test_clustered_tables_join_without_an_exchange(spark, setting, tmp_path):
    """Neither the returns nor the formats are shuffled by account: not for the join, and not for the sums after it."""
    returns, chosen, formats, lines, periods = setting
    store = Warehouse(spark, str(tmp_path))
    facts = store.cluster("facts", returns, "account_id", 4, "period_id")
    of_clients = store.cluster("chosen", chosen, "account_id", 4)
    text = io.StringIO()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = facts.join(of_clients, "account_id").groupBy("account_id", "format_id", "subaccount_id").agg(F.sum("credit"))
        with contextlib.redirect_stdout(text):
            joined.explain("simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in text.getvalue() and "SortMergeJoin" in text.getvalue()
    got = statements.statement_front(facts, of_clients, formats, lines, periods, TERM)
    assert rows_of(got) == rows_of(statements.statement_front(returns, chosen, formats, lines, periods, TERM))


def test_clustered_tables_are_found_again(spark, setting, tmp_path):
    returns = setting[0]
    store = Warehouse(spark, str(tmp_path))
    store.cluster("facts", returns, "account_id", 4, "period_id")
    spark.sql(f"DROP TABLE {store._catalog_name('facts', 'clustered')}")  # as in another session
    again = store.clustered("facts", "account_id", 4, "period_id")
    assert again.count() == returns.count()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        again.groupBy("account_id").agg(F.sum("credit")).explain("simple")
    assert "Exchange" not in text.getvalue()
    smaller = store.cluster("facts", returns.filter("period_id = 1"), "account_id", 2)
    assert smaller.count() == returns.filter("period_id = 1").count()


# ---- indicators

def test_indicators_are_merged_into_one_object(spark):
    clients = spark.createDataFrame([(1,), (2,), (3,)], "account_id long")
    updates = {
        "3": spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (9, "x")], "account_id long, value string"),
        "odd key'": spark.createDataFrame([(1, 5), (2, 7)], "account_id long, value int"),
    }
    found = changes.indicator_objects(clients, updates)
    assert found.schema["indicators"].dataType.simpleString() == "variant"
    texts = {row.account_id: row.text for row in found.select("account_id", F.to_json("indicators").alias("text")).collect()}
    assert texts == {1: '{"3":"a","odd key\'":"5"}', 2: '{"odd key\'":"7"}', 3: "{}"}
    assert changes.indicator_objects(clients.limit(0), updates).count() == 0
