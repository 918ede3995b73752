"""Commissions, flows, balances of the period and returns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import changes, returns
from tallyspark.registry.base import TERM, register, with_views
from tallyspark.registry.valuation import BALANCE_VIEWS, BALANCES, balances
from tallyspark.operators.valuation import value_balances
from tallyspark.sources import roles
from tallyspark.sources.shared import written_once

COMMISSION_VIEWS = ("commission_src", "concept_subaccount")
COMMISSION = """
    SELECT c.concept_id, c.account_id, c.settled_at, c.amount, s.subaccount_id, CAST(39 AS INTEGER) AS period_id
    FROM commission_src c JOIN concept_subaccount s ON s.concept_id = c.concept_id
    WHERE c.settled_at BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'"""
COMMISSION_TOTAL = """
    SELECT account_id, subaccount_id, CAST(SUM(amount) AS DECIMAL(18,4)) AS commission
    FROM commission GROUP BY 1, 2"""
FLOW = """
    SELECT account_id, subaccount_id,
           CAST(SUM(CASE WHEN type_id = 180 THEN amount END) AS DECIMAL(18,2)) AS credit,
           CAST(SUM(CASE WHEN type_id = 181 THEN amount END) AS DECIMAL(18,2)) AS charge
    FROM movement
    WHERE settled_at BETWEEN DATE '1998-03-01' AND DATE '1998-03-31' AND type_id IN (180, 181)
    GROUP BY 1, 2"""
FINAL = """
    SELECT account_id, subaccount_id, CAST(SUM(amount) AS DECIMAL(18,2)) AS final
    FROM balance
    WHERE kind = 'F' AND settled_at BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'
    GROUP BY 1, 2"""
OPENING = BALANCES.replace(
    "<= (SELECT MIN(settled_at) FROM balance_history WHERE settled_at > DATE '1998-04-01')", "<= DATE '1998-03-01'"
).replace("DATE '1998-03-31'", "DATE '1998-02-28'")


def commission_rows(spark, folder):
    return returns.commissions(
        roles.commission_src(spark, folder),
        roles.concept_config(spark, folder),
        roles.concept_subaccount(spark, folder),
        TERM,
    )


def opening_balances(spark, folder):
    return value_balances(
        roles.balance_history(spark, folder),
        roles.subaccount_type(spark, folder),
        roles.share_price(spark, folder),
        cutoff=F.lit(TERM.previous_cutoff),
        price_date=F.lit(TERM.previous_price_date),
    ).withColumnRenamed("amount", "initial")


def return_facts(spark, folder, **options):
    return returns.compute_returns(
        opening_balances(spark, folder),
        returns.final_rows(balances(spark, folder), TERM),
        returns.flow_rows(roles.movement(spark, folder), TERM),
        commission_rows(spark, folder).withColumnRenamed("amount", "commission"),
        TERM,
        **options,
    )


@register("commissions", with_views(COMMISSION, *COMMISSION_VIEWS))
def commissions(spark, folder):
    return commission_rows(spark, folder)


@register("commission_totals", with_views(COMMISSION_TOTAL, *COMMISSION_VIEWS, commission=COMMISSION))
def commission_totals(spark, folder):
    return returns.commission_totals(commission_rows(spark, folder))


@register("flows", with_views(FLOW, "movement"))
def flows(spark, folder):
    return returns.flows(roles.movement(spark, folder), TERM)


@register("final_balances", with_views(f"WITH {BALANCES} {FINAL}", *BALANCE_VIEWS))
def final_balances(spark, folder):
    return returns.final_balances(balances(spark, folder), TERM)


@register(
    "initial_balances",
    with_views(
        f"""
        WITH {BALANCES}
        SELECT account_id, subaccount_id, CAST(SUM(amount) AS DECIMAL(18,2)) AS initial
        FROM balance WHERE kind = 'F' AND settled_at BETWEEN DATE '1998-03-01' AND DATE '1998-03-01' GROUP BY 1, 2
        """,
        *BALANCE_VIEWS,
    ),
)
def initial_balances(spark, folder):
    return returns.initial_balances(balances(spark, folder), TERM)


OPENING_BALANCE = f"WITH {OPENING} SELECT account_id, subaccount_id, amount AS initial FROM balance"
CLOSING_BALANCE = f"WITH {BALANCES} {FINAL}"
RETURN_FACT = """
    SELECT account_id, subaccount_id,
           CAST(COALESCE(SUM(initial), 0) AS DECIMAL(18,4)) AS initial,
           CAST(COALESCE(SUM(final), 0) AS DECIMAL(18,4)) AS final,
           CAST(COALESCE(SUM(credit), 0) AS DECIMAL(18,4)) AS credit,
           CAST(COALESCE(SUM(charge), 0) AS DECIMAL(18,4)) AS charge,
           CAST(COALESCE(SUM(commission), 0) AS DECIMAL(18,4)) AS commission,
           CAST(COALESCE(SUM(final), 0) - (COALESCE(SUM(credit), 0) + COALESCE(SUM(initial), 0)
                - COALESCE(SUM(commission), 0) - COALESCE(SUM(charge), 0)) AS DECIMAL(18,4)) AS computed_return,
           CAST(39 AS INTEGER) AS period_id,
           MAX(beyond) AS beyond
    FROM (SELECT account_id, subaccount_id, initial, NULL AS final, NULL AS credit, NULL AS charge,
                 NULL AS commission, 1 AS beyond FROM opening_balance
          UNION ALL SELECT account_id, subaccount_id, NULL, final, NULL, NULL, NULL, 1 FROM closing_balance
          UNION ALL SELECT account_id, subaccount_id, NULL, NULL, credit, charge, NULL, 1 FROM flow
          UNION ALL SELECT account_id, subaccount_id, NULL, NULL, NULL, NULL, commission, 0 FROM commission_total)
    GROUP BY 1, 2"""
RETURN_VIEWS = (*BALANCE_VIEWS, "movement", *COMMISSION_VIEWS)
RETURN_STEPS = {
    "opening_balance": OPENING_BALANCE,
    "closing_balance": CLOSING_BALANCE,
    "flow": FLOW,
    "commission": COMMISSION,
    "commission_total": COMMISSION_TOTAL,
    "return_fact": RETURN_FACT,
}


@register("returns", with_views("SELECT * EXCLUDE (beyond) FROM return_fact", *RETURN_VIEWS, **RETURN_STEPS))
def returns_query(spark, folder):
    return return_facts(spark, folder)


@register(
    "returns_positive",
    with_views(
        "SELECT * EXCLUDE (beyond) FROM return_fact WHERE computed_return > 0 AND beyond = 1",
        *RETURN_VIEWS,
        **RETURN_STEPS,
    ),
)
def returns_positive(spark, folder):
    return return_facts(spark, folder, include_commission_only=False, positive_only=True)


BREAKDOWN = """
        SELECT json_extract_string(indicators, '$."34"') AS generation,
               json_extract_string(indicators, '$."21"') AS validity,
               CASE WHEN json_extract_string(indicators, '$."3"') = 'Asignado' THEN 'Asignado'
                    WHEN json_extract_string(indicators, '$."4"') = 'Pensionado' THEN 'Pensionado'
                    WHEN json_extract_string(indicators, '$."3"') = 'Afiliado' THEN 'Afiliado' END AS affiliation,
               json_extract_string(indicators, '$."33"') AS client_type,
               s.label AS subaccount, COUNT(DISTINCT c.account_id) AS clients,
               CAST(SUM(r.computed_return) AS DECIMAL(38,4)) AS total_return
        FROM return_fact r JOIN subaccount_type s ON s.subaccount_id = r.subaccount_id
        JOIN (SELECT c_custkey AS account_id,
                     '{"34": "' || c_mktsegment || '", "21": "V", "3": "'
                     || CASE WHEN c_acctbal > 5000 THEN 'Asignado' ELSE 'Afiliado' END || '"'
                     || CASE WHEN c_acctbal < 0 THEN ', "4": "Pensionado"' ELSE '' END || '}' AS indicators
              FROM customer) c ON c.account_id = r.account_id
        GROUP BY 1, 2, 3, 4, 5"""


@register("json_breakdown", with_views(BREAKDOWN, *RETURN_VIEWS, **RETURN_STEPS))
def json_breakdown(spark, folder):
    balance = F.col("c_acctbal")
    clients = roles.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("account_id"),
        F.concat(
            F.lit('{"34": "'), F.col("c_mktsegment"), F.lit('", "21": "V", "3": "'),
            F.when(balance > 5000, "Asignado").otherwise("Afiliado"), F.lit('"'),
            F.when(balance < 0, ', "4": "Pensionado"').otherwise(""), F.lit("}"),
        ).alias("indicators"),
    )
    return returns.json_breakdown(return_facts(spark, folder), clients, roles.subaccount_type(spark, folder))


@register("variant_breakdown", with_views(BREAKDOWN, *RETURN_VIEWS, **RETURN_STEPS))
def variant_breakdown(spark, folder):
    """The breakdown from indicators of four sources, merged in one pass and stored as VARIANT."""
    customer = roles.table(spark, folder, "customer").withColumnRenamed("c_custkey", "account_id")
    balance = F.col("c_acctbal")
    sources = {
        "34": customer.select("account_id", F.col("c_mktsegment").alias("value")),
        "21": customer.select("account_id", F.lit("V").alias("value")),
        "3": customer.select("account_id", F.when(balance > 5000, "Asignado").otherwise("Afiliado").alias("value")),
        "4": customer.filter(balance < 0).select("account_id", F.lit("Pensionado").alias("value")),
    }
    stored = written_once(changes.indicator_objects(customer.select("account_id"), sources), "indicators")
    return returns.variant_breakdown(return_facts(spark, folder), stored, roles.subaccount_type(spark, folder))
