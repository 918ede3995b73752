"""Hand-made edge cases."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import (
    changes, clients, joins, movements, numbering, quality, reports, returns, rules, runlog, statements, valuation,
    withdrawals,
)
from tallyspark.operators.terms import Term

TERM = Term(
    3, "03/2023", date(2023, 3, 1), date(2023, 3, 31), date(2023, 4, 1), date(2023, 3, 31), date(2023, 3, 1),
    date(2023, 2, 28),
)
HISTORY = "account_id long, fund_id int, subaccount_id int, settled_at timestamp_ntz, units decimal(18,6)"
PRICE = "fund_id int, regime_id int, price_date date, price decimal(18,6)"
SUBACCOUNT = "subaccount_id int, regime_id int"


def rows(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


# --- valuation ---------------------------------------------------------------------------------
def test_all_rows_of_the_latest_day_are_kept(spark):
    history = spark.createDataFrame(
        [
            (1, 1, 1, datetime(2023, 3, 5), Decimal(1)),
            (1, 1, 1, datetime(2023, 3, 9), Decimal(2)),
            (1, 1, 1, datetime(2023, 3, 9, 15, 30), Decimal(3)),
            (1, 1, 1, datetime(2023, 5, 9), Decimal(4)),
        ],
        HISTORY,
    )
    latest = valuation.latest_per_group(history, F.lit(datetime(2023, 3, 31)).cast("timestamp_ntz"))
    assert rows(latest, "units") == [(Decimal(2),), (Decimal(3),)]


def test_cutoff_is_strictly_after(spark):
    history = spark.createDataFrame(
        [(1, 1, 1, datetime(2023, 4, 1), Decimal(1)), (1, 1, 1, datetime(2023, 4, 3), Decimal(1))], HISTORY
    )
    assert valuation.cutoff_date(history, date(2023, 4, 1)).first().cutoff == datetime(2023, 4, 3)
    assert valuation.cutoff_date(history, date(2023, 4, 3)).first().cutoff == datetime(2023, 4, 3)


def test_balance_without_price_is_dropped_and_rounding_is_last(spark):
    history = spark.createDataFrame(
        [
            (1, 1, 1, datetime(2023, 3, 9), Decimal("0.333333")),
            (1, 1, 1, datetime(2023, 3, 9), Decimal("0.333333")),
            (1, 2, 1, datetime(2023, 3, 9), Decimal("5")),
            (9, 1, 1, datetime(2023, 4, 5), Decimal("7")),
        ],
        HISTORY,
    )
    subaccounts = spark.createDataFrame([(1, 7)], SUBACCOUNT)
    prices = spark.createDataFrame(
        [
            (1, 7, date(2023, 3, 30), Decimal("1.5")),
            (1, 7, date(2023, 4, 2), Decimal("99")),
            (2, 7, date(2023, 4, 2), Decimal("99")),
        ],
        PRICE,
    )
    valued = valuation.value_balances(
        history, subaccounts, prices,
        valuation.cutoff_date(history, TERM.next_start).scalar(), F.lit(TERM.price_date),
    )
    assert rows(valued, "account_id", "fund_id", "price_date", "units", "amount", "kind") == [
        (1, 1, date(2023, 3, 30), Decimal("0.666666"), Decimal("1.00"), "F"),
        (9, 1, date(2023, 3, 30), Decimal("7.000000"), Decimal("10.50"), "F"),
    ]


# --- movements ---------------------------------------------------------------------------------
def test_families_without_reference_are_null_filled(spark):
    columns = "account_id long, amount decimal(18,4), settled_at timestamp_ntz"
    with_reference = spark.createDataFrame(
        [(1, Decimal("10.125"), datetime(2023, 3, 31), 77)], f"{columns}, reference_id long"
    )
    without = spark.createDataFrame(
        [(2, Decimal("0.005"), datetime(2023, 3, 1)), (3, Decimal("1"), datetime(2023, 4, 1))], columns
    )
    loaded = movements.union_movements({"AVOL": with_reference, "BONO": without}, TERM)
    assert rows(loaded, "account_id", "amount", "family", "origin_db", "period_id") == [
        (1, Decimal("10.13"), "AVOL", "M", 3), (2, Decimal("0.01"), "BONO", "M", 3),
    ]
    assert loaded.filter("account_id = 2").first().reference_id is None


@pytest.fixture
def wide(spark):
    return spark.createDataFrame(
        [
            (1, 5, Decimal(10), Decimal(20)), (2, 5, Decimal(10), Decimal(0)), (3, 5, Decimal(-1), Decimal(0)),
            (4, 6, Decimal(10), Decimal(20)), (5, 5, None, Decimal(4)),
        ],
        "id long, code int, slot_1 decimal(18,2), slot_3 decimal(18,2)",
    )


@pytest.fixture
def switches(spark):
    return spark.createDataFrame(
        [(5, 1, 51, 9), (5, 3, 53, 2), (5, 8, 58, 10)], "code int, slot int, subaccount_id int, ordinal int"
    )


def test_last_switch_wins_and_missing_slots_are_skipped(wide, switches):
    assert rows(movements.map_switches(wide, switches), "id", "subaccount_id", "amount") == [
        (1, 51, Decimal(10)), (2, 51, Decimal(10)), (3, 0, Decimal(0)), (4, 0, Decimal(0)), (5, 53, Decimal(4)),
    ]


def test_all_positive_slots(wide, switches):
    assert rows(movements.explode_switches(wide, switches), "id", "slot", "subaccount_id", "amount") == [
        (1, 1, 51, Decimal(10)), (1, 3, 53, Decimal(20)), (2, 1, 51, Decimal(10)), (5, 3, 53, Decimal(4)),
    ]


def test_recodes(spark):
    legacy = spark.createDataFrame(
        [
            (1, 114, 98, "INT. RET08"), (2, 113, 99, "INT. RET08"), (7_000_000_000, 200, 5, "INT. CYVTRA"),
            (6_999_999_999, 200, 5, "OTHER"), (5, 200, 5, None),
        ],
        "account_id long, code int, fund_id int, employer_tag string",
    )
    assert rows(movements.recode(legacy, True), "account_id", "code", "fund_id", "account_class") == [
        (1, 117, 14, 1), (2, 113, 15, 1), (5, 200, 5, 1), (6_999_999_999, 200, 5, 1), (7_000_000_000, 117, 5, 2),
    ]
    assert {row.code for row in movements.recode(legacy).collect()} == {113, 114, 200}


# --- returns -----------------------------------------------------------------------------------
def measure(spark, name, *values):
    return spark.createDataFrame(
        [(account, sub, Decimal(value)) for account, sub, value in values],
        f"account_id long, subaccount_id int, {name} decimal(18,2)",
    )


@pytest.fixture
def measures(spark):
    flow = spark.createDataFrame(
        [(1, 1, Decimal(30), Decimal(5))],
        "account_id long, subaccount_id int, credit decimal(18,2), charge decimal(18,2)",
    )
    return (
        measure(spark, "initial", (1, 1, 100), (1, 1, 50)),
        measure(spark, "final", (1, 1, 200), (2, 1, 10)),
        flow,
        measure(spark, "commission", (1, 1, 2), (3, 1, 4)),
    )


def test_each_measure_counts_once(measures):
    computed = returns.compute_returns(*measures, TERM)
    columns = ("account_id", "initial", "final", "credit", "charge", "commission", "computed_return")
    assert rows(computed, *columns) == [
        (1, Decimal(150), Decimal(200), Decimal(30), Decimal(5), Decimal(2), Decimal(27)),
        (2, Decimal(0), Decimal(10), Decimal(0), Decimal(0), Decimal(0), Decimal(10)),
        (3, Decimal(0), Decimal(0), Decimal(0), Decimal(0), Decimal(4), Decimal(4)),
    ]


def test_return_filters(measures):
    kept = returns.compute_returns(*measures, TERM, include_commission_only=False)
    assert rows(kept, "account_id") == [(1,), (2,)]
    final_only = (measures[0], measures[1].limit(0), measures[2], measures[3])
    assert rows(returns.compute_returns(*final_only, TERM, positive_only=True), "account_id") == [(3,)]


# --- clients -----------------------------------------------------------------------------------
def test_generation_priority(spark):
    history = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 3)], "account_id long, subaccount_id int")
    labels = spark.createDataFrame([(1, "SAR IMSS"), (2, "VIV 97"), (4, "RCV 92")], "subaccount_id int, label string")
    assert rows(clients.generation_of(history, labels), "account_id", "generation") == [
        (1, "AFORE"), (2, "TRANSICION"),
    ]


def test_classification_is_deterministic_and_defaults_are_false(spark):
    indicators = spark.createDataFrame(
        [(1, 1, "69", 1), (1, 1, "66", 1), (2, 1, "69", 1), (3, 12, "713", 1), (2, 11, "1", 1), (1, 11, "1", 0),
         (8, 1, "66", 1)],
        "account_id long, indicator_id int, code string, valid int",
    )
    config = spark.createDataFrame([(1,), (2,), (11,), (12,)], "indicator_id int")
    holdings = spark.createDataFrame([(1, "AFORE", True)], "account_id long, generation string, is_bond boolean")
    none = spark.createDataFrame([], "account_id long, pension_type string")
    profiles = spark.createDataFrame([(2, "B"), (2, "A")], "account_id long, profile string")
    known = spark.createDataFrame([(1,), (2,), (3,)], "account_id long")
    facts = clients.classify_clients(known, indicators, config, holdings, none, profiles, TERM)
    columns = ("account_id", "is_pension", "origin", "generation", "is_bond", "profile")
    assert sorted(map(tuple, facts.select(*columns).collect())) == [
        (1, False, "IMSS", "AFORE", True, None), (2, True, "MIXTO", "MIXTO", False, "A"),
    ]


# --- tables ------------------------------------------------------------------------------------
def test_upsert_uses_the_whole_key_and_is_idempotent(spark):
    schema = "code int, slot int, label string"
    target = spark.createDataFrame([(1, 0, "old"), (1, 3, "keep")], schema)
    source = spark.createDataFrame([(1, 0, "new"), (2, 0, "a"), (2, 3, "b"), (2, 3, "z")], schema)
    once = changes.upsert(target, source, ["code", "slot"])
    expected = [(1, 0, "new"), (1, 3, "keep"), (2, 0, "a"), (2, 3, "b")]
    assert rows(once, "code", "slot", "label") == expected
    assert rows(changes.upsert(once, source, ["code", "slot"]), "code", "slot", "label") == expected


def test_update_keeps_unnamed_rows(spark):
    target = spark.createDataFrame([(1, "a"), (2, None)], "account_id long, label string")
    source = spark.createDataFrame([(2, "b"), (3, "c")], "account_id long, value string")
    assert rows(changes.update_from(target, source, "account_id", "label"), "account_id", "label") == [
        (1, "a"), (2, "b"),
    ]


def test_joins_give_the_same_rows_with_and_without_broadcasts(spark, wide, switches):
    expected = rows(movements.map_switches(wide, switches), "id", "subaccount_id", "amount")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(movements.map_switches(wide, switches), "id", "subaccount_id", "amount") == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# --- numbering ---------------------------------------------------------------------------------
def test_numbers_are_consecutive_in_order_whatever_the_partitions(spark):
    df = spark.range(0, 1000, 1, 13).select(((F.col("id") * 7919) % 1000).alias("k"), F.lit("hot").alias("g"))
    numbered = numbering.number_rows(df, ["g", "k"], "n")
    assert numbered.filter(F.col("n") != F.col("k") + 1).count() == 0
    assert numbered.agg(F.count_distinct("n"), F.max("n")).first()[:] == (1000, 1000)


def test_last_page_is_complete(spark):
    paged = numbering.page_rows(spark.range(0, 301), 150)
    assert rows(paged.groupBy("page").count(), "page", "count") == [(0, 150), (1, 150), (2, 1)]


# --- rules -------------------------------------------------------------------------------------
def test_rules_see_their_source_and_the_period(spark):
    first = spark.createDataFrame([(1, 3), (2, 4)], "account long, period int")
    second = spark.createDataFrame([(9, 3)], "account long, period int")
    outer = spark.createDataFrame([(0, 0)], "account long, period int")
    outer.createOrReplaceTempView("base")
    sql = "SELECT account FROM base WHERE period = :term"
    listed = [
        rules.IndicatorRule(10, sql, "CORE", True, True, False, False), rules.IndicatorRule(11, sql, "X", generated=True),
    ]
    found = rules.run_indicator_rules(spark, listed, {"CORE": {"base": first}, "WAREHOUSE": {"base": second}}, TERM)
    assert rows(found, "account_id", "indicator_id", "flags", "period_id") == [(1, 10, 12, 3), (9, 11, 1, 3)]
    assert spark.table("base").collect() == outer.collect()
    spark.catalog.dropTempView("base")


# --- reports -----------------------------------------------------------------------------------
def test_null_labels_and_both_kinds_of_counts(spark):
    facts = spark.createDataFrame(
        [("a", "x", 1, Decimal(1)), ("a", "y", 1, Decimal(2)), (None, "x", 2, Decimal(4)), (None, "x", 3, Decimal(8))],
        "g string, h string, account_id long, amount decimal(18,2)",
    )

    def report(**options):
        found = reports.control_report(facts, ["g", "h"], {"amount": "amount"}, {"clients": "account_id"}, **options)
        return {(r.row_kind, r.grouped_by, r.g, r.h): (r.clients, r.amount) for r in found.collect()}

    exact = report()
    assert exact["detail", None, None, "x"] == (2, 12)
    assert exact["subtotal", "g", "a", None] == (1, 3)
    assert exact["subtotal", "g", None, None] == (2, 12)
    assert exact["subtotal", "h", None, "x"] == (3, 13)
    assert exact["total", None, None, None] == (3, 15)
    assert len(exact) == 3 + 2 + 2 + 1
    assert report(additive=True)["subtotal", "g", "a", None] == (2, 3)


def test_report_of_nothing_has_a_zero_total(spark):
    empty = spark.createDataFrame([], "g string, account_id long, amount decimal(18,2)")
    found = reports.control_report(empty, ["g"], {"amount": "amount"}, {"clients": "account_id"}).collect()
    assert [(r.row_kind, r.clients, r.amount) for r in found] == [("total", 0, None)]


def test_run_subtotals_follow_the_order(spark):
    detail = spark.createDataFrame(
        [(1, "a", 1), (2, "a", 2), (3, "b", 4), (4, "a", 8), (5, None, 16), (6, None, 32)], "n int, g string, v long"
    )
    runs = reports.run_subtotals(detail, ["g"], ["v"], ["n"], blocks=3)
    assert sorted((r.last_row, r.value, r.v) for r in runs.collect()) == [
        (2, "a", 3), (3, "b", 4), (4, "a", 8), (6, None, 48),
    ]


def test_load_summary_counts_values(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(reports.load_summary(df), "row_count", "column_name", "column_type", "non_null") == [
        (2, "a", "int", 2), (2, "b", "string", 1),
    ]


# --- run log -----------------------------------------------------------------------------------
def test_limits_belong_to_the_better_level(spark):
    start = datetime(2023, 3, 1, 12)
    log = spark.createDataFrame(
        [
            (1, 1, start, datetime(2023, 3, 1, 13, 30), False), (2, 1, start, datetime(2023, 3, 1, 13, 30, 1), False),
            (3, 1, start, datetime(2023, 3, 1, 15, 0, 0, 1), False), (4, 1, start, start, True),
        ],
        "run_id int, phase_id int, started_at timestamp_ntz, ended_at timestamp_ntz, failed boolean",
    )
    phases = spark.createDataFrame([(1, "01:30", "03:00")], "phase_id int, green string, yellow string")
    assert rows(runlog.sla_flag(log, phases), "run_id", "flag") == [
        (1, "Verde"), (2, "Amarillo"), (3, "Rojo"), (4, "Error"),
    ]


def test_notices_of_areas_without_users(spark):
    notices = spark.createDataFrame([(1, 10), (2, 11)], "area_id int, notice_id int")
    recipients = spark.createDataFrame([(1, 100), (1, 101)], "area_id int, user_id int")
    assert rows(runlog.notification_fanout(notices, recipients), "notice_id", "user_id") == [(10, 100), (10, 101)]
    assert rows(runlog.notices_without_recipients(notices, recipients), "notice_id") == [(11,)]


# --- quality -----------------------------------------------------------------------------------
def test_checks_on_an_empty_and_a_broken_table(spark):
    schema = "id int, parent int, kind string"
    spec = quality.CheckSpec(
        required=["kind"], expected={"kind": F.col("kind").isin("a", "b")}, keys=[["id"]],
        references={"parent": (spark.createDataFrame([(1,)], "p int"), "p")}, metrics=["parent"],
    )
    broken = spark.createDataFrame([(1, 1, "a"), (1, 5, "c"), (1, None, None)], schema)
    found = {(r.check_name, r.subject): r.failures for r in quality.quality_checks(broken, spec).collect()}
    assert found == {
        ("TABLE_NO_DATA", ""): 0, ("TABLE_MISSED_VALUES", "kind"): 1, ("TABLE_UNEXPECTED_VALUES", "kind"): 1,
        ("CONTROL_METRICS_NULL_VALUES", "parent"): 1, ("TABLE_DUPLICATED_VALUES", "id"): 2,
        ("TABLE_INVALID_FOREIGN_VALUES", "parent"): 1,
    }
    empty = quality.quality_checks(spark.createDataFrame([], schema), spec).collect()
    assert [r.check_name for r in empty if r.failures] == ["TABLE_NO_DATA"]
    assert quality.missing_tables(["a", "b"], ["b", "c"]) == ["a"]


# --- statements --------------------------------------------------------------------------------
@pytest.fixture
def statement_inputs(spark):
    chosen = spark.createDataFrame(
        [(1, 7, 2, 1, 2, 2)],
        "account_id long, format_id int, generation_id int, generation_months int, front_months int, back_months int",
    )
    formats = spark.createDataFrame([(7, 2)], "format_id int, front_months int")
    lines = spark.createDataFrame(
        [(2, "s", "one", "AHO", [1]), (2, "s", "both", "TOT", [1, 2]), (2, "s", "none", "VIV", [9])],
        "generation_id int, savings_type string, concept string, section string, subaccounts array<int>",
    )
    periods = spark.createDataFrame(
        [(0, "12/2022"), (1, "01/2023"), (2, "02/2023"), (3, "03/2023"), (4, "04/2023")], "period_id int, period string"
    )
    facts = spark.createDataFrame(
        [(1, p, s, *map(Decimal, (100 * p + s, 1000 * p + s, 1, 2, 3))) for p in (0, 1, 2, 3, 4) for s in (1, 2)],
        "account_id long, period_id int, subaccount_id int, initial decimal(18,2), final decimal(18,2), "
        "credit decimal(18,2), charge decimal(18,2), commission decimal(18,2)",
    )
    return facts, chosen, formats, lines, periods


def test_overlapping_lines_have_their_own_sums(statement_inputs):
    front = statements.statement_front(*statement_inputs, TERM)
    found = rows(front, "concept", "contribution", "withdrawal", "commission", "initial", "final", "computed_return")
    assert found == [
        ("both", 6, 12, 18, 203, 6003, Decimal(6003 - (6 + 203 - 18 - 12))),
        ("none", 0, 0, 0, 0, 0, 0),
        ("one", 3, 6, 9, 101, 3001, Decimal(3001 - (3 + 101 - 9 - 6))),
    ]


def test_flows_of_all_periods_by_flag(statement_inputs):
    front = statements.statement_front(*statement_inputs, TERM, flows_in_window=False)
    assert rows(front.filter("concept = 'one'"), "contribution", "initial", "final") == [(5, 101, 3001)]


def test_header_without_savings_section(spark):
    header = spark.createDataFrame([(1, 7), (2, 7)], "account_id long, format_id int")
    front = spark.createDataFrame(
        [(1, 7, "AHO", Decimal(5)), (1, 7, "VIV", Decimal(6)), (2, 7, "VIV", Decimal(8))],
        "account_id long, format_id int, section string, final decimal(16,2)",
    )
    assert rows(statements.with_balances(header, front), "account_id", "subtotal", "total") == [(1, 5, 11)]
    everyone = statements.with_balances(header, front, require_subtotal=False)
    assert rows(everyone, "account_id", "subtotal", "total") == [(1, 5, 11), (2, None, 8)]


def test_uuid_ids_are_unique(spark):
    ids = statements.with_uuid_ids(spark.range(100))
    assert ids.select("statement_id").union(ids.select("folio")).distinct().count() == 200


# --- withdrawals -------------------------------------------------------------------------------
def test_named_procedure_of_any_branch_comes_first(spark):
    schema = "folio long, procedure_type int"
    named = spark.createDataFrame([(1, "T97", 1, "x")], "new_code int, legacy_description string, legacy_code int, "
                                  "new_description string")
    chosen = withdrawals.procedure_of_folio(
        spark.createDataFrame([(10, 5), (11, 1)], schema), spark.createDataFrame([(11, 1)], schema),
        spark.createDataFrame([(10, 1)], schema), named,
    )
    assert rows(chosen, "folio", "procedure_type", "procedure_name") == [(10, 1, "T97"), (11, 1, "T97")]


def test_missing_tax_leaves_the_opening_balance_missing(spark):
    withdrawn = spark.createDataFrame(
        [(1, 10, 3, 1, Decimal(5), Decimal(7), None), (2, 11, 3, 0, Decimal(5), Decimal(7), Decimal(1)),
         (3, 12, 4, 0, Decimal(5), Decimal(7), Decimal(1))],
        "account_id long, folio long, period_id int, savings_type int, balance decimal(18,4), paid decimal(18,2), "
        "tax decimal(18,2)",
    )
    found = withdrawals.withdrawal_figures(withdrawn, TERM)
    assert [(r.id, r.savings, r.opening) for r in found.orderBy("id").collect()] == [
        (1, "RET", None), (2, "VIV", Decimal(13)),
    ]
