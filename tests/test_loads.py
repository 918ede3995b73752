"""A whole month, load by load, on the smallest test tables."""

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import codes
from tallyspark.operators import clients
from tallyspark.plans import loads
from tallyspark.plans.statements import StatementConfig, build_statements
from tallyspark.plans.warehouse import Warehouse
from tallyspark.registry import clients as client_queries
from tallyspark.registry import movements as movement_queries
from tallyspark.registry import withdrawals as withdrawal_queries
from tallyspark.registry.base import TERM
from tallyspark.sources import roles, tables
from tallyspark.sources.shared import new_table_path

FOLDER = "/root/testdata/sf0.001"


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    left, right = left.select(*columns), right.select(*columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture(scope="module")
def warehouse(spark):
    return Warehouse(spark, new_table_path(spark, "warehouse"))


def load_month(warehouse):
    spark = warehouse.spark

    def role(function, **options):
        return function(spark, FOLDER, **options)

    subaccounts, funds = role(roles.subaccount_type), role(roles.fund)
    catalog = role(roles.catalog)
    results = {}
    holdings = clients.history_profile(
        role(roles.balance_history), subaccounts, client_queries.TEST_BOND_FUND
    )
    results["clients"] = loads.load_clients(
        warehouse,
        client_queries.master(spark, FOLDER),
        role(roles.account_indicator),
        role(roles.indicator_config),
        holdings,
        clients.pension_type(role(roles.payment), role(roles.payment_subaccount), catalog, TERM),
        clients.investment_profile(role(roles.investment_group), catalog),
        TERM,
    )
    every = role(roles.movement)
    families = {
        name: every.filter(F.col("family") == number).drop("family")
        for number, name in movement_queries.FAMILIES.items()
    }
    results["movements"] = loads.load_movements(
        warehouse, families, role(roles.concept_bridge), role(roles.regulator_concept), funds, subaccounts, TERM
    )
    results["balances"] = loads.load_balances(
        warehouse, role(roles.balance_history), subaccounts, role(roles.share_price), funds, TERM
    )
    results["commissions"] = loads.load_commissions(
        warehouse, role(roles.commission_src), role(roles.concept_config), role(roles.concept_subaccount), subaccounts,
        TERM,
    )
    results["returns"] = loads.load_returns(
        warehouse, role(roles.balance_history), subaccounts, role(roles.share_price), funds, role(roles.concept), TERM
    )
    loads.load_history(warehouse, role(roles.contribution), TERM)
    loads.load_sample(
        warehouse, role(roles.manual_upload), role(roles.concept_bridge), role(roles.sample_quota), TERM, 34, 5,
        "https://example.org/",
    )
    return results


def test_loading_a_month_twice_changes_nothing(warehouse):
    load_month(warehouse)
    names = ("client", "client_fact", "movement", "balance", "commission", "return_fact", "contribution_history")
    first = {name: warehouse.table(name).collect() for name in names}
    assert all(first.values())
    results = load_month(warehouse)
    for name in names:
        assert sorted(map(str, warehouse.table(name).collect())) == sorted(map(str, first[name])), name
    assert warehouse.table("sample").count() == warehouse.table("sample").select("account_id").distinct().count()
    assert same(warehouse.of_term("movement", TERM), movement_queries.movement_union(warehouse.spark, FOLDER))
    report = results["returns"]["by_client"]
    totals = report.filter("row_kind = 'total'").first()
    details = report.filter("row_kind = 'detail'").agg(F.sum("final"), F.sum("clients")).first()
    assert (totals.final, totals.clients) == (details[0], details[1])


def test_returns_hold_the_identity(warehouse):
    broken = warehouse.table("return_fact").filter(
        F.col("computed_return")
        != F.col("final") - F.col("credit") - F.col("initial") + F.col("commission") + F.col("charge")
    )
    assert broken.isEmpty()


def test_json_breakdown_from_seeded_clients(warehouse):
    spark = warehouse.spark
    labels = clients.indicator_values(
        roles.account_indicator(spark, FOLDER), roles.indicator_config(spark, FOLDER), codes.INDICATOR_CLIENT_TYPE,
        codes.CLIENT_TYPE_LABELS,
    ).withColumn("value", F.concat(F.lit('{"3": "'), "value", F.lit('"}')))
    validity = clients.indicator_values(
        roles.account_indicator(spark, FOLDER), roles.indicator_config(spark, FOLDER), codes.INDICATOR_VALIDITY,
        codes.VALIDITY_LABELS,
    )
    loads.load_client_indicators(warehouse, [(labels, "indicators"), (validity, "validity")], TERM)
    found = loads.return_breakdown(warehouse, roles.subaccount_type(spark, FOLDER), TERM).collect()
    assert "Afiliado" in {row.affiliation for row in found}


def test_statements_of_the_sample(warehouse):
    spark = warehouse.spark
    config = StatementConfig(
        roles.statement_format(spark, FOLDER), roles.periodicity(spark, FOLDER), roles.format_indicator(spark, FOLDER),
        roles.front_line(spark, FOLDER), roles.concept_bridge(spark, FOLDER), roles.regulator_concept(spark, FOLDER),
        roles.period(spark, FOLDER),
    )
    everyone = warehouse.of_term("client_fact", TERM).select("account_id", "period_id")
    made = build_statements(
        warehouse.table("client_fact"), warehouse.table("client"), warehouse.table("return_fact"),
        warehouse.table("movement"), config, everyone, TERM,
    )
    headers = made.header.collect()
    assert headers and len({row.statement_id for row in headers}) == len(headers) == len({r.folio for r in headers})
    assert made.back.join(made.header, "statement_id", "left_anti").isEmpty()
    assert made.front.join(made.header, "statement_id", "left_anti").isEmpty()
    nobody = build_statements(
        warehouse.table("client_fact"), warehouse.table("client"), warehouse.table("return_fact"),
        warehouse.table("movement"), config, everyone.limit(0), TERM,
    )
    assert nobody.header.isEmpty()


def test_statements_are_stored_and_linked(warehouse):
    """Storing twice leaves the same rows, and every statement's sample row has its address."""
    spark = warehouse.spark
    config = StatementConfig(
        roles.statement_format(spark, FOLDER), roles.periodicity(spark, FOLDER), roles.format_indicator(spark, FOLDER),
        roles.front_line(spark, FOLDER), roles.concept_bridge(spark, FOLDER), roles.regulator_concept(spark, FOLDER),
        roles.period(spark, FOLDER),
    )
    everyone = warehouse.of_term("client_fact", TERM).select(
        "account_id", F.lit(1).alias("user_id"), F.lit(5).alias("area_id"), F.lit("Pendiente").alias("status"),
        F.lit("none").alias("url"),
    )
    store = Warehouse(spark, new_table_path(spark, "statement-store"))
    for name in ("client_fact", "return_fact", "movement"):
        store.load(name, warehouse.of_term(name, TERM), TERM)
    store.replace("client", warehouse.table("client"))
    store.load("sample", everyone, TERM)
    counts = [loads.load_statements(store, config, TERM, "u/") for _ in range(2)]
    assert counts[0] == counts[1] and counts[0]["statement_header"] > 0
    for name, rows in counts[1].items():
        assert store.of_term(name, TERM).count() == rows
    linked = store.table("sample").filter("url <> 'none'").select("url").distinct().count()
    assert linked == counts[1]["statement_header"]


def test_withdrawals_are_paged(warehouse):
    spark = warehouse.spark
    inputs = dict(
        current_requests=roles.settled_request(spark, FOLDER, historic=False),
        historic_requests=roles.settled_request(spark, FOLDER, historic=True),
        movements=roles.withdrawal_movement(spark, FOLDER),
        procedures=roles.procedure(spark, FOLDER),
        transfers=roles.transfer(spark, FOLDER, historic=False),
        historic_transfers=roles.transfer(spark, FOLDER, historic=True),
        procedure_map=roles.procedure_map(spark, FOLDER),
        payments=roles.payment(spark, FOLDER),
        catalog=roles.catalog(spark, FOLDER),
        history=roles.withdrawal_history(spark, FOLDER),
        subaccounts=roles.withdrawal_subaccount(spark, FOLDER),
        prices=roles.share_price(spark, FOLDER),
    )
    paged = loads.load_withdrawals(warehouse, TERM, page_size=2, **inputs).collect()
    assert len(paged) == withdrawal_queries.withdrawn(spark, FOLDER).count()
    assert {row.id // 2 for row in paged} == {row.page for row in paged}


def test_catalogs_are_merged(warehouse):
    spark = warehouse.spark
    inputs = (
        roles.fund_source(spark, FOLDER), roles.subaccount_source(spark, FOLDER), roles.supplier_catalog(spark, FOLDER),
        roles.concept_source(spark, FOLDER), roles.concept_subaccount_source(spark, FOLDER),
    )
    loads.load_catalogs(warehouse, *inputs)
    first = {name: warehouse.table(name).count() for name in ("fund", "subaccount_type", "concept")}
    loads.load_catalogs(warehouse, *inputs)
    assert first == {name: warehouse.table(name).count() for name in first}
    concepts = warehouse.table("concept")
    assert concepts.count() == concepts.select("code", "slot").distinct().count()


def test_catalog_load_feeds_the_legacy_load(warehouse):
    """The switches come from the catalog that the catalog load has stored."""
    spark = warehouse.spark
    loads.load_catalogs(
        warehouse, roles.fund_source(spark, FOLDER), roles.subaccount_source(spark, FOLDER),
        roles.supplier_catalog(spark, FOLDER), roles.concept_source(spark, FOLDER),
        roles.concept_subaccount_source(spark, FOLDER),
    )
    concepts = warehouse.table("concept")
    code = concepts.filter("is_switch AND slot = 3").agg(F.min("code")).first()[0]
    wide = roles.legacy_wide(spark, FOLDER).withColumn("code", F.lit(code))
    for _ in range(2):
        report = loads.load_legacy_movements(warehouse, {"RCV": wide}, concepts, TERM, movement_codes=None)
    found = warehouse.table("legacy_movement")
    switched = found.filter("subaccount_id > 0")
    kept_code = (F.col("employer_tag") == "OTHER") | (F.lit(code) < codes.RECODE_FROM)
    assert switched.count() == wide.filter(
        F.col("booked").between(*TERM.yyyymmdd_bounds) & (F.col("slot_3") > 0) & kept_code
    ).count()
    total = report.filter("row_kind = 'total'").first().amount
    assert total == found.agg(F.sum("amount")).first()[0]


def test_upsert_never_loses_a_table(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    ten = spark.range(10).select("id", F.lit("old").alias("value"))
    store.upsert("t", ten, ["id"])
    broken = spark.range(1).select("id", F.expr("raise_error('stop')").cast("string").alias("value"))
    with pytest.raises(Exception, match="stop"):
        store.upsert("t", broken, ["id"])
    assert store.table("t").count() == 10
    (tmp_path / "t").rename(tmp_path / "t__aside")  # stopped between the two moves
    assert store.exists("t") and store.table("t").count() == 10
    (tmp_path / "bad").mkdir()
    with pytest.raises(Exception):
        store.upsert("bad", ten, ["id"])
    assert not store.exists("none")


def test_every_load_covers_the_last_day(spark):
    from datetime import datetime

    late = datetime(1998, 3, 31, 23, 59)
    rows = spark.createDataFrame([(late,), (datetime(1998, 4, 1),)], "t timestamp_ntz")
    assert rows.filter(TERM.covers(F.col("t"))).count() == 1


def test_rules_are_loaded_and_published(warehouse):
    spark = warehouse.spark
    from tallyspark.registry.selection import _rule_catalog

    indicators, statements = _rule_catalog(spark)
    sources = {
        "CORE": {"movement": roles.movement(spark, FOLDER)},
        "CRM": {"client": roles.client(spark, FOLDER)},
        "WAREHOUSE": {"uploads": roles.manual_upload(spark, FOLDER)},
    }
    target = tables.Table("parquet", new_table_path(spark, "published"))
    for _ in range(2):
        loads.load_indicator_rules(
            warehouse, spark, indicators, statements, sources, roles.manual_upload(spark, FOLDER), TERM
        )
    for _ in range(2):
        loads.load_indicator_rules(
            warehouse, spark, indicators, statements, sources, roles.manual_upload(spark, FOLDER), TERM, publish=target
        )
    assert tables.read_table(spark, target).count() == warehouse.table("client_indicator").count()


# --- sources -----------------------------------------------------------------------------------
def test_period_reload_leaves_other_periods_and_clears_an_empty_one(spark):
    path = new_table_path(spark, "periods")
    rows = spark.range(10).select("id", F.lit(1).alias("period_id"))
    assert tables.replace_period(rows, path, 1) == 10
    assert tables.replace_period(rows.limit(4), path, 2) == 4
    assert tables.replace_period(rows.limit(3), path, 1) == 3
    counts = {r.period_id: r["count"] for r in spark.read.parquet(path).groupBy("period_id").count().collect()}
    assert counts == {1: 3, 2: 4}
    assert tables.replace_period(rows.limit(0), path, 2) == 0
    assert spark.read.parquet(path).filter("period_id = 2").count() == 0
    assert spark.read.parquet(path).count() == 3
    assert tables.replace_period(rows.withColumn("period_id", F.lit(9)), path, None) == 10
    assert {r.period_id for r in spark.read.parquet(path).select("period_id").distinct().collect()} == {9}


@pytest.mark.parametrize("kind", ["parquet", "orc", "json", "csv"])
def test_formats_round_trip(spark, kind):
    options = {"header": "true", "inferSchema": "true"} if kind == "csv" else {}
    target = tables.Table(kind, new_table_path(spark, kind), options)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "ID long, Name string")
    tables.overwrite_table(df, target)
    tables.append_table(df, target)
    back = tables.read_table(spark, target)
    assert back.columns and set(back.columns) == {"id", "name"}
    assert back.count() == 4


def test_transfer_stamps_transforms_and_counts(spark):
    source = tables.Table("parquet", f"{FOLDER}/nation.parquet")
    target = tables.Table("parquet", new_table_path(spark, "transfer"))

    def keep_first_region(df):
        return df.filter("n_regionkey = 0")

    assert tables.transfer(spark, source, target, term_id=7, transform=keep_first_region) == 5
    assert tables.transfer(spark, source, target, term_id=8, transform=lambda df: df.filter("n_nationkey < 3")) == 3
    assert tables.transfer(spark, source, target, term_id=7, transform=keep_first_region) == 5
    tables.as_view(spark, target, "moved")
    counts = spark.sql("SELECT period_id, COUNT(*) AS n FROM moved GROUP BY period_id").collect()
    assert {row.period_id: row.n for row in counts} == {7: 5, 8: 3}
    spark.catalog.dropTempView("moved")


def test_jdbc_needs_all_bounds_for_a_parallel_read():
    source = tables.jdbc_source("jdbc:x", "(SELECT 1) t", "id", 0, 10, partitions=4, user="u")
    assert source.options["partitionColumn"] == "id" and source.options["numPartitions"] == "4"
    assert "partitionColumn" not in tables.jdbc_source("jdbc:x", "t").options
    with pytest.raises(ValueError):
        tables.jdbc_source("jdbc:x", "t", "id")
    assert tables.jdbc_sink("jdbc:x", "t").options["batchsize"] == "100000"
