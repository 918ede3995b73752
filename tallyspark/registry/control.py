"""Control reports of the loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import bitmaps, reports
from tallyspark.plans import figures
from tallyspark.registry.base import TERM, register, with_views
from tallyspark.registry.clients import CLASSIFY_STEPS, CLASSIFY_VIEWS, client_facts
from tallyspark.registry.movements import LEGACY_LOAD, LEGACY_SWITCH, LEGACY_WIDE, NUMBERED, RECODED, legacy_load
from tallyspark.registry.returns import (
    COMMISSION, COMMISSION_VIEWS, RETURN_STEPS, RETURN_VIEWS, commission_rows, return_facts,
)
from tallyspark.registry.valuation import BALANCE_VIEWS, BALANCES, balances
from tallyspark.operators.terms import stamp_period
from tallyspark.sources import roles
from tallyspark.sources.shared import written_once


def report_sql(source: str, display: list[str], sums: list[str], distinct: dict[str, str] | None = None) -> str:
    """Detail, one subtotal set per display column, and the total, written out as a union of plain aggregations."""
    distinct = distinct or {}
    measures = [f"COUNT(DISTINCT {key}) AS {name}" for name, key in distinct.items()]
    measures += [f"CAST(SUM({name}) AS DECIMAL(38,2)) AS {name}" for name in sums]

    def part(kind: str, grouped_by: str, kept: list[str]) -> str:
        columns = [name if name in kept else f"NULL AS {name}" for name in display]
        group = f"GROUP BY {', '.join(kept)}" if kept else ""
        selected = ", ".join([f"'{kind}' AS row_kind", f"{grouped_by} AS grouped_by", *columns, *measures])
        return f"SELECT {selected} FROM {source} {group}"

    parts = [part("detail", "NULL", display)]
    parts += [part("subtotal", f"'{name}'", [name]) for name in display]
    parts.append(part("total", "NULL", []))
    return "\nUNION ALL ".join(parts)


PROFILE = ["generation", "validity", "client_type", "origin"]
MOVEMENT_39 = """
    SELECT * FROM movement WHERE settled_at BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'"""


def loaded_movements(spark, folder):
    rows = roles.movement(spark, folder).filter(TERM.covers(F.col("settled_at")))
    return stamp_period(rows, TERM.period_id)


@register(
    "report_clients",
    with_views(report_sql("client_fact", PROFILE, [], {"clients": "account_id"}), *CLASSIFY_VIEWS, **CLASSIFY_STEPS),
)
def report_clients(spark, folder):
    return figures.client_figures(client_facts(spark, folder), TERM)


@register(
    "report_movements_by_concept",
    with_views(
        report_sql("joined", [*PROFILE, "regulator_concept"], ["amount"], {"clients": "account_id"}),
        *CLASSIFY_VIEWS, "movement", "concept_bridge",
        **CLASSIFY_STEPS,
        regulator="SELECT * FROM (VALUES (101, 'APORTACION'), (102, 'RETIRO'), (103, 'TRASPASO'), (104, 'AJUSTE')) "
        "AS t(regulator_id, regulator_concept)",
        movement_39=MOVEMENT_39,
        joined="""
            SELECT c.generation, c.validity, c.client_type, c.origin, k.regulator_concept, m.account_id, m.amount
            FROM movement_39 m JOIN client_fact c ON c.account_id = m.account_id
            JOIN concept_bridge b ON b.concept_id = m.concept_id JOIN regulator k ON k.regulator_id = b.regulator_id""",
    ),
)
def report_movements_by_concept(spark, folder):
    return figures.movement_figures_by_concept(
        loaded_movements(spark, folder), client_facts(spark, folder), roles.concept_bridge(spark, folder),
        roles.regulator_concept(spark, folder), TERM,
    )


@register(
    "report_movements_by_fund",
    with_views(
        report_sql("joined", ["period", "fund", "subaccount", "type_id"], ["amount"]),
        "movement", "fund", "subaccount_type",
        joined="""
            SELECT '03/1998' AS period, f.description AS fund, s.label AS subaccount, m.type_id, m.amount
            FROM movement m JOIN fund f ON f.fund_id = m.fund_id
            JOIN subaccount_type s ON s.subaccount_id = m.subaccount_id
            WHERE m.settled_at BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'""",
    ),
)
def report_movements_by_fund(spark, folder):
    return figures.movement_figures_by_fund(
        loaded_movements(spark, folder), roles.fund(spark, folder), roles.subaccount_type(spark, folder), TERM
    )


@register(
    "report_legacy_movements",
    with_views(
        report_sql("joined", ["period", "fund_id", "subaccount_id"], ["amount"]),
        legacy_wide=LEGACY_WIDE,
        recoded=RECODED,
        numbered=NUMBERED.format(table="recoded"),
        legacy_switch=LEGACY_SWITCH,
        joined=f"SELECT '03/1998' AS period, * FROM ({LEGACY_LOAD}) WHERE booked BETWEEN 19980301 AND 19980331",
    ),
)
def report_legacy_movements(spark, folder):
    return figures.legacy_movement_figures(legacy_load(spark, folder), TERM)


BALANCE_JOINED = f"""
    WITH {BALANCES}
    SELECT c.generation, c.validity, c.client_type, c.origin, s.label AS subaccount, f.description AS fund,
           b.amount AS final_amount, b.units AS final_units
    FROM balance b JOIN client_fact c ON c.account_id = b.account_id
    JOIN subaccount_type s ON s.subaccount_id = b.subaccount_id JOIN fund f ON f.fund_id = b.fund_id
    WHERE b.kind = 'F'"""
BALANCE_REPORT = report_sql("joined", [*PROFILE, "subaccount", "fund"], ["final_amount", "final_units"])


def _units_as_decimal_6(sql: str) -> str:
    return sql.replace(
        "CAST(SUM(final_units) AS DECIMAL(38,2))", "CAST(SUM(final_units) AS DECIMAL(38,6))"
    ).replace("CAST(SUM(final_amount) AS DECIMAL(38,2))", "CAST(SUM(final_amount) AS DECIMAL(38,6))")


@register(
    "report_balances_by_client",
    with_views(
        _units_as_decimal_6(BALANCE_REPORT), *CLASSIFY_VIEWS, "share_price", "fund", **CLASSIFY_STEPS,
        joined=BALANCE_JOINED,
    ),
)
def report_balances_by_client(spark, folder):
    return figures.balance_figures_by_client(
        stamp_period(balances(spark, folder), TERM.period_id), client_facts(spark, folder),
        roles.subaccount_type(spark, folder), roles.fund(spark, folder), TERM,
    )


@register(
    "report_balances_by_fund",
    with_views(
        _units_as_decimal_6(report_sql("joined", ["subaccount", "fund"], ["final_amount", "final_units"])),
        *BALANCE_VIEWS, "fund",
        joined=f"""
            WITH {BALANCES}
            SELECT s.label AS subaccount, f.description AS fund, b.amount AS final_amount, b.units AS final_units
            FROM balance b JOIN subaccount_type s ON s.subaccount_id = b.subaccount_id
            JOIN fund f ON f.fund_id = b.fund_id""",
    ),
)
def report_balances_by_fund(spark, folder):
    return figures.balance_figures_by_fund(
        stamp_period(balances(spark, folder), TERM.period_id), roles.subaccount_type(spark, folder),
        roles.fund(spark, folder), TERM,
    )


@register(
    "report_commissions",
    with_views(
        report_sql("joined", [*PROFILE, "subaccount"], ["commission"]),
        *CLASSIFY_VIEWS, *COMMISSION_VIEWS,
        **CLASSIFY_STEPS,
        commission=COMMISSION,
        joined="""
            SELECT c.generation, c.validity, c.client_type, c.origin, s.label AS subaccount, m.amount AS commission
            FROM commission m JOIN client_fact c ON c.account_id = m.account_id
            JOIN subaccount_type s ON s.subaccount_id = m.subaccount_id""",
    ),
)
def report_commissions(spark, folder):
    return figures.commission_figures(
        commission_rows(spark, folder), client_facts(spark, folder), roles.subaccount_type(spark, folder), TERM
    )


RETURN_SUMS = ["initial", "final", "credit", "charge", "commission", "computed_return"]


@register(
    "report_returns",
    with_views(
        report_sql("joined", PROFILE, RETURN_SUMS, {"clients": "account_id"}),
        *dict.fromkeys([*CLASSIFY_VIEWS, *RETURN_VIEWS]),
        **CLASSIFY_STEPS,
        **RETURN_STEPS,
        joined="""
            SELECT c.generation, c.validity, c.client_type, c.origin, r.* EXCLUDE (beyond, period_id)
            FROM return_fact r JOIN client_fact c ON c.account_id = r.account_id""",
    ),
)
def report_returns(spark, folder):
    return figures.return_figures(return_facts(spark, folder), client_facts(spark, folder), TERM)


@register(
    "report_movements_by_description",
    with_views(
        report_sql("joined", [*PROFILE, "fund", "concept"], ["amount"]),
        *CLASSIFY_VIEWS, "movement", "fund",
        **CLASSIFY_STEPS,
        joined="""
            SELECT c.generation, c.validity, c.client_type, c.origin, f.description AS fund,
                   'CONCEPTO ' || CAST(m.concept_id AS VARCHAR) AS concept, m.amount
            FROM movement m JOIN client_fact c ON c.account_id = m.account_id JOIN fund f ON f.fund_id = m.fund_id
            WHERE m.settled_at BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'""",
    ),
)
def report_movements_by_description(spark, folder):
    return figures.movement_figures_by_description(
        loaded_movements(spark, folder), client_facts(spark, folder), roles.fund(spark, folder),
        roles.concept(spark, folder), TERM,
    )


@register(
    "report_additive_counts",
    with_views(
        """
        WITH d AS (
            SELECT state, region, COUNT(DISTINCT account_id) AS clients, CAST(SUM(amount) AS DECIMAL(38,2)) AS amount
            FROM joined GROUP BY 1, 2)
        SELECT 'detail' AS row_kind, NULL AS grouped_by, state, region, clients, amount FROM d
        UNION ALL SELECT 'subtotal', 'state', state, NULL, CAST(SUM(clients) AS BIGINT),
                         CAST(SUM(amount) AS DECIMAL(38,2)) FROM d GROUP BY state
        UNION ALL SELECT 'subtotal', 'region', NULL, region, CAST(SUM(clients) AS BIGINT),
                         CAST(SUM(amount) AS DECIMAL(38,2)) FROM d GROUP BY region
        UNION ALL SELECT 'total', NULL, NULL, NULL, CAST(SUM(clients) AS BIGINT), CAST(SUM(amount) AS DECIMAL(38,2))
                  FROM d
        """,
        "movement", "client",
        joined="""
            SELECT c.account_id, c.state, c.region, m.amount
            FROM movement m JOIN client c ON c.account_id = m.account_id""",
    ),
)
def report_additive_counts(spark, folder):
    rows = roles.movement(spark, folder).join(roles.client(spark, folder), "account_id")
    return reports.control_report(
        rows, ["state", "region"], {"amount": "amount"}, {"clients": "account_id"}, additive=True
    )


@register(
    "report_run_subtotals",
    with_views(
        """
        WITH numbered AS (
            SELECT *, ROW_NUMBER() OVER (ORDER BY account_id, subaccount_id, fund_id) AS n FROM detail),
        long AS (
            SELECT n, 'subaccount_id' AS grouped_by, subaccount_id AS value, amount FROM numbered
            UNION ALL SELECT n, 'fund_id', fund_id, amount FROM numbered),
        flagged AS (
            SELECT *, CASE WHEN LAG(n) OVER w IS NOT NULL AND value IS DISTINCT FROM LAG(value) OVER w THEN 1 ELSE 0
                      END AS changed
            FROM long WINDOW w AS (PARTITION BY grouped_by ORDER BY n)),
        runs AS (SELECT *, SUM(changed) OVER (PARTITION BY grouped_by ORDER BY n) AS run FROM flagged)
        SELECT grouped_by, value, MAX(n) AS last_row, SUM(amount) AS amount FROM runs GROUP BY grouped_by, run, value
        """,
        "movement",
        detail="""
            SELECT account_id, subaccount_id, fund_id, CAST(SUM(amount) AS DECIMAL(28,2)) AS amount
            FROM movement GROUP BY 1, 2, 3""",
    ),
)
def report_run_subtotals(spark, folder):
    detail = roles.movement(spark, folder).groupBy("account_id", "subaccount_id", "fund_id").agg(
        F.sum("amount").cast("decimal(28,2)").alias("amount")
    )
    return reports.run_subtotals(
        detail, ["subaccount_id", "fund_id"], ["amount"], ["account_id", "subaccount_id", "fund_id"]
    )


@register(
    "distinct_clients",
    with_views(
        """
        SELECT CAST(floor(period_id / 12) AS BIGINT) AS year, fund_id, concept_id,
               CAST(GROUPING(fund_id) + GROUPING(concept_id) AS INTEGER) AS level, COUNT(DISTINCT account_id) AS clients
        FROM (SELECT *, (year(settled_at) - 1995) * 12 + month(settled_at) AS period_id FROM movement)
        GROUP BY GROUPING SETS ((year, fund_id, concept_id), (year, fund_id), (year))
        """,
        "movement",
    ),
)
def distinct_clients(spark, folder):
    """Clients per year and subtotal, from bitmaps stored per month: accounts are read once, and months share many."""
    monthly = bitmaps.id_bitmaps(
        roles.dated_movement(spark, folder), ["period_id", "fund_id", "concept_id"], "account_id"
    )
    stored = written_once(monthly, "client-bitmaps").withColumn("year", F.floor(F.col("period_id") / 12))
    return bitmaps.distinct_subtotals(stored, [["year", "fund_id", "concept_id"], ["year", "fund_id"], ["year"]])
