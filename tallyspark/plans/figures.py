"""Control figures: the report that follows each load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.codes import BALANCE_KIND
from tallyspark.operators.reports import control_report
from tallyspark.operators.terms import Term

PROFILE = ("generation", "validity", "client_type", "origin")


def _of_term(df: DataFrame, term: Term) -> DataFrame:
    return df.filter(F.col("period_id") == term.period_id)


def _profiles(client_facts: DataFrame, term: Term) -> DataFrame:
    return _of_term(client_facts, term).select("account_id", *PROFILE)


def _label(df: DataFrame, key: str, label: str, name: str) -> DataFrame:
    return df.select(key, F.col(label).alias(name))


def _per_account(df: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Sums at the grain of the report plus the account, taken before clients are joined."""
    return df.groupBy("account_id", *keys).agg(*(F.sum(name).alias(name) for name in sums))


def client_figures(client_facts: DataFrame, term: Term) -> DataFrame:
    """Clients by generation, validity, type and origin."""
    return control_report(_of_term(client_facts, term), PROFILE, {}, {"clients": "account_id"})


def movement_figures_by_concept(
    movements: DataFrame, client_facts: DataFrame, bridge: DataFrame, regulator_concepts: DataFrame, term: Term
) -> DataFrame:
    """Clients and amount by client profile and regulator concept."""
    names = bridge.select("concept_id", "regulator_id").join(
        regulator_concepts.select("regulator_id", F.col("description").alias("regulator_concept")), "regulator_id"
    )
    amounts = _of_term(movements, term).join(
        names.select("concept_id", "regulator_concept"), "concept_id"
    )
    rows = _per_account(amounts, ["regulator_concept"], ["amount"]).join(_profiles(client_facts, term), "account_id")
    return control_report(rows, [*PROFILE, "regulator_concept"], {"amount": "amount"}, {"clients": "account_id"})


def movement_figures_by_fund(movements: DataFrame, funds: DataFrame, subaccounts: DataFrame, term: Term) -> DataFrame:
    """Amount by fund, sub-account and movement type."""
    rows = (
        _of_term(movements, term)
        .join(_label(funds, "fund_id", "description", "fund"), "fund_id")
        .join(_label(subaccounts, "subaccount_id", "label", "subaccount"), "subaccount_id")
        .withColumn("period", F.lit(term.label))
    )
    return control_report(rows, ["period", "fund", "subaccount", "type_id"], {"amount": "amount"})


def legacy_movement_figures(movements: DataFrame, term: Term) -> DataFrame:
    """Amount of legacy movements by fund and switched sub-account."""
    rows = _of_term(movements, term).withColumn("period", F.lit(term.label))
    return control_report(rows, ["period", "fund_id", "subaccount_id"], {"amount": "amount"})


def _final_measures(balances: DataFrame, term: Term) -> DataFrame:
    final = F.col("kind") == BALANCE_KIND
    return _of_term(balances, term).withColumns(
        {
            "final_amount": F.when(final, F.col("amount")).otherwise(0),
            "final_units": F.when(final, F.col("units")).otherwise(0),
        }
    )


FINAL_SUMS = {"final_amount": "final_amount", "final_units": "final_units"}


def balance_figures_by_client(
    balances: DataFrame, client_facts: DataFrame, subaccounts: DataFrame, funds: DataFrame, term: Term
) -> DataFrame:
    """Final balance in money and units by client profile, sub-account and fund."""
    labelled = (
        _final_measures(balances, term)
        .join(_label(subaccounts, "subaccount_id", "label", "subaccount"), "subaccount_id")
        .join(_label(funds, "fund_id", "description", "fund"), "fund_id")
    )
    rows = _per_account(labelled, ["subaccount", "fund"], list(FINAL_SUMS)).join(
        _profiles(client_facts, term), "account_id"
    )
    return control_report(rows, [*PROFILE, "subaccount", "fund"], FINAL_SUMS, sum_type="decimal(38,6)")


def balance_figures_by_fund(balances: DataFrame, subaccounts: DataFrame, funds: DataFrame, term: Term) -> DataFrame:
    """Final balance in money and units by sub-account and fund."""
    rows = (
        _final_measures(balances, term)
        .join(_label(subaccounts, "subaccount_id", "label", "subaccount"), "subaccount_id")
        .join(_label(funds, "fund_id", "description", "fund"), "fund_id")
    )
    return control_report(rows, ["subaccount", "fund"], FINAL_SUMS, sum_type="decimal(38,6)")


def commission_figures(
    commissions: DataFrame, client_facts: DataFrame, subaccounts: DataFrame, term: Term
) -> DataFrame:
    """Commission by client profile and sub-account."""
    labelled = _of_term(commissions, term).join(
        _label(subaccounts, "subaccount_id", "label", "subaccount"), "subaccount_id"
    )
    charged = labelled.withColumnRenamed("amount", "commission")
    rows = _per_account(charged, ["subaccount"], ["commission"]).join(_profiles(client_facts, term), "account_id")
    return control_report(rows, [*PROFILE, "subaccount"], {"commission": "commission"})


RETURN_SUMS = ("initial", "final", "credit", "charge", "commission", "computed_return")


def return_figures(returns: DataFrame, client_facts: DataFrame, term: Term) -> DataFrame:
    """Clients, balances, flows and return by client profile."""
    rows = _per_account(_of_term(returns, term), [], RETURN_SUMS).join(_profiles(client_facts, term), "account_id")
    return control_report(rows, PROFILE, {name: name for name in RETURN_SUMS}, {"clients": "account_id"})


def movement_figures_by_description(
    movements: DataFrame, client_facts: DataFrame, funds: DataFrame, concepts: DataFrame, term: Term
) -> DataFrame:
    """Amount by client profile, fund and movement concept."""
    labelled = (
        _of_term(movements, term)
        .join(_label(funds, "fund_id", "description", "fund"), "fund_id")
        .join(_label(concepts, "concept_id", "description", "concept"), "concept_id")
    )
    rows = _per_account(labelled, ["fund", "concept"], ["amount"]).join(_profiles(client_facts, term), "account_id")
    return control_report(rows, [*PROFILE, "fund", "concept"], {"amount": "amount"})
