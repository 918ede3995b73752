"""Plans and skew: what must hold when the data is a thousand times larger."""

import contextlib
import io
import re
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallyspark.operators import valuation
from tallyspark.operators import statements
from tallyspark.registry import all_queries
from tallyspark.registry.base import TERM
from tallyspark.sources import roles

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("simple")
    return text.getvalue()


@pytest.fixture
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_cross_join_and_no_single_task_window(spark, no_auto_broadcast, name):
    plan = plan_of(contract.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    for number, line in enumerate(lines):
        if re.search(r"- Window \[", line) and "_part#" not in line:  # offsets of partitions, one row each
            assert "SinglePartition" not in "".join(lines[number:number + 4]), line


def test_movement_switches_do_not_shuffle_the_movements(spark):
    plan = plan_of(contract.queries()["switch_mapping"](spark, FOLDER))
    movements = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in movements


def test_history_is_read_once_and_cut_down_before_the_shuffle(spark):
    history = roles.withdrawal_history(spark, FOLDER)
    plan = plan_of(valuation.latest_units(history, F.lit(datetime(1998, 3, 1)).cast("timestamp_ntz")))
    assert plan.count("lineitem.parquet") == 1
    assert re.search(r"WindowGroupLimit.*Partial", plan)


def test_period_and_columns_reach_the_scan(spark):
    lines = roles.table(spark, FOLDER, "lineitem").filter(TERM.covers(F.col("l_shipdate"))).select("l_orderkey")
    plan = plan_of(lines)
    assert "GreaterThanOrEqual(l_shipdate,1998-03-01T00:00)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in plan


@pytest.mark.parametrize("salts", [1, 8, 64])
def test_one_account_with_most_rows(spark, salts):
    """A third of the rows on one key, most of them on its latest day."""
    hot = spark.range(30_000).select(
        F.lit(1).cast("long").alias("account_id"), F.lit(1).alias("fund_id"), F.lit(1).alias("subaccount_id"),
        F.when(F.col("id") < 10_000, F.lit(datetime(2023, 3, 1))).otherwise(F.lit(datetime(2023, 3, 2)))
        .cast("timestamp_ntz").alias("settled_at"),
        F.lit(1).cast("decimal(18,6)").alias("units"),
    )
    rest = spark.range(2, 60_000).select(
        F.col("id").alias("account_id"), F.lit(1).alias("fund_id"), F.lit(1).alias("subaccount_id"),
        F.lit(datetime(2023, 3, 1)).cast("timestamp_ntz").alias("settled_at"),
        F.lit(2).cast("decimal(18,6)").alias("units"),
    )
    latest = valuation.latest_units(
        hot.unionByName(rest), F.lit(datetime(2023, 3, 31)).cast("timestamp_ntz"), salts=salts
    )
    assert latest.count() == 59_999
    salted = hot.select(F.pmod(F.monotonically_increasing_id(), F.lit(salts)).alias("salt")).groupBy("salt").count()
    assert max(row["count"] for row in salted.collect()) <= 30_000 / salts + 8
    row = latest.filter("account_id = 1").first()
    assert (row.settled_at, row.units) == (datetime(2023, 3, 2), Decimal(20_000))


@pytest.mark.parametrize("product", ["front", "back"])
def test_statement_windows_prune_partitions(spark, tmp_path, product):
    periods = roles.period(spark, FOLDER)
    formats = spark.createDataFrame([(1, 2, 1, 3, 3)], "format_id int, generation_id int, generation_months int, "
                                    "front_months int, back_months int")
    chosen = formats.withColumn("account_id", F.lit(1).cast("long"))
    facts = roles.return_fact(spark, FOLDER) if product == "front" else roles.dated_movement(spark, FOLDER)
    facts.write.partitionBy("period_id").parquet(str(tmp_path / "facts"))
    stored = spark.read.parquet(str(tmp_path / "facts"))
    if product == "front":
        made = statements.statement_front(stored, chosen, formats, roles.front_line(spark, FOLDER), periods, TERM)
    else:
        made = statements.statement_back(
            stored, chosen, roles.concept_bridge(spark, FOLDER), roles.regulator_concept(spark, FOLDER), periods, TERM
        )
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    scan = next(line for line in plan_of(made).splitlines() if "PartitionFilters" in line and str(tmp_path) in line)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan).group(1)
    assert re.search(r"period_id#\d+ >= 36\b", filters) and re.search(r"period_id#\d+ <= 39\b", filters)


def test_only_local_sessions_may_go_without_a_shared_folder():
    pattern = r"local(\[[^\]]*\])?"
    assert re.fullmatch(pattern, "local[8]") and re.fullmatch(pattern, "local")
    assert not re.fullmatch(pattern, "local-cluster[3,2,1024]")


def test_shared_folder_is_the_configured_one(spark):
    from tallyspark.sources.shared import new_table_path, shared_folder

    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_table_path(spark, "x") != new_table_path(spark, "x")
