"""Withdrawals of the period: settled requests with movements, procedure, payment and remaining balance."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import codes
from tallyspark.operators.joins import first_per_key
from tallyspark.operators.movements import union_all
from tallyspark.operators.numbering import number_rows
from tallyspark.operators.terms import Term, stamp_period
from tallyspark.operators.valuation import cutoff_date, latest_units, subaccount_prices
from tallyspark.sources.shared import written_once

PROCEDURE_COLUMNS = (
    "procedure_type", "benefit_type", "regime_code", "insurance_code", "pension_code", "transfer_insurance",
    "transfer_pension", "transfer_regime", "pension_start", "pension_resolution",
)


def settled_requests(current: DataFrame, historic: DataFrame, term: Term) -> DataFrame:
    """Grouped, settled requests created in the period, from the current and the historic table."""
    wanted = (
        (F.col("grouped") == codes.SETTLED_GROUP)
        & (F.col("status_id") == codes.SETTLED_STATUS)
        & F.col("process_id").isin(*codes.SETTLED_PROCESSES)
        & term.covers(F.col("created_at"))
    )
    columns = ("folio", "account_id", "process_id", "subprocess_id", "status_id", "created_at")
    return historic.filter(wanted).select(*columns).unionByName(current.filter(wanted).select(*columns))


def settlements(requests: DataFrame, movements: DataFrame, term: Term) -> DataFrame:
    """Requests with the movements of their folio; requests without any keep one row."""
    paid = movements.filter(term.covers(F.col("settled_at"))).select(
        "folio", "subaccount_id", "fund_id", F.round("amount", 2).cast("decimal(18,2)").alias("paid")
    )
    return requests.join(paid, "folio", "left")


def procedure_of_folio(
    procedures: DataFrame,
    transfers: DataFrame,
    historic_transfers: DataFrame,
    procedure_map: DataFrame,
    folios: DataFrame | None = None,
) -> DataFrame:
    """One procedure per folio: named procedures first, then procedures before transfers before historic ones.

    Every settlement row of a folio would meet the same candidates, so the choice is made once per folio and not after
    multiplying the settlements by three sources. ``folios`` restricts the sources, which reach back over years, to the
    folios of the period before anything is ranked.
    """
    branches = [
        df.select("folio", *(name for name in PROCEDURE_COLUMNS if name in df.columns)).withColumn("_branch", F.lit(n))
        for n, df in enumerate((procedures, transfers, historic_transfers))
    ]
    names = procedure_map.select(
        F.col("new_code").alias("procedure_type"),
        F.col("legacy_description").alias("procedure_name"),
        F.col("legacy_code").alias("procedure_legacy_code"),
        F.col("new_description").alias("procedure_description"),
    )
    candidates = union_all(branches)
    if folios is not None:
        candidates = candidates.join(folios.select("folio"), "folio", "left_semi")
    named = candidates.join(names, "procedure_type", "left")
    ties = [F.col(name).asc_nulls_last() for name in ("procedure_name", *PROCEDURE_COLUMNS) if name in named.columns]
    order = [F.col("procedure_name").isNull(), F.col("_branch"), *ties]
    return first_per_key(named, ["folio"], order).drop("_branch")


def payment_of_folio(payments: DataFrame, catalog: DataFrame, term: Term) -> DataFrame:
    """One payment per folio: tax is summed, the rest comes from the first payment; bank and medium are named."""
    order = ("created_at", "settlement_folio", "subprocess_id", "pay_type_id", "bank")
    first = (
        payments.filter(term.covers(F.col("created_at")))
        .groupBy("folio")
        .agg(F.sum("tax").cast("decimal(18,2)").alias("tax"), F.min(F.struct(*order)).alias("_first"))
        .select("folio", "tax", "_first.*")
    )
    names = catalog.select("catalog_id", "value")
    banks = names.select(F.col("catalog_id").cast("string").alias("bank"), F.col("value").alias("bank_name"))
    media = names.select(F.col("catalog_id").alias("pay_type_id"), F.col("value").alias("pay_medium"))
    return (
        first.join(banks, "bank", "left")
        .join(media, "pay_type_id", "left")
        .select(
            "folio",
            F.col("subprocess_id").alias("payment_subprocess_id"),
            "pay_type_id",
            "settlement_folio",
            "tax",
            F.col("bank").try_cast("int").alias("bank_code"),
            "bank_name",
            "pay_medium",
        )
    )


def balances_of_accounts(
    settled: DataFrame,
    history: DataFrame,
    subaccounts: DataFrame,
    prices: DataFrame,
    after: date,
    price_date: date,
) -> DataFrame:
    """Valued balance per account and sub-account that was settled, as of the first history date after ``after``."""
    touched = settled.select("account_id", "subaccount_id").filter(F.col("subaccount_id").isNotNull()).distinct()
    own = history.join(touched, ["account_id", "subaccount_id"], "left_semi")
    latest = latest_units(own, cutoff_date(history, after).scalar())
    price = subaccount_prices(subaccounts, prices, F.lit(price_date))
    return (
        latest.join(price, ["fund_id", "subaccount_id"])
        .groupBy("account_id", "subaccount_id")
        .agg(F.sum(F.col("units") * F.col("price")).cast("decimal(18,4)").alias("balance"))
    )


def withdrawals(
    current_requests: DataFrame,
    historic_requests: DataFrame,
    movements: DataFrame,
    procedures: DataFrame,
    transfers: DataFrame,
    historic_transfers: DataFrame,
    procedure_map: DataFrame,
    payments: DataFrame,
    catalog: DataFrame,
    history: DataFrame,
    subaccounts: DataFrame,
    prices: DataFrame,
    term: Term,
    balance_after: date | None = None,
    price_date: date | None = None,
) -> DataFrame:
    """One row per settled folio whose procedure is a known withdrawal.

    The balance date and price date default to the end of the period. The folios of the month, and those of them that
    are withdrawals, are written once: they select the procedures to rank and the balances to value, and carry the
    result.
    """
    requests = settled_requests(current_requests, historic_requests, term)
    settled = settlements(requests, movements, term)
    order = ["account_id", "subaccount_id", "fund_id", "paid", "process_id", "subprocess_id", "created_at"]
    per_folio = written_once(
        first_per_key(settled, ["folio"], [F.col(name).asc_nulls_last() for name in order]), "folios"
    )
    chosen = procedure_of_folio(procedures, transfers, historic_transfers, procedure_map, per_folio).filter(
        F.col("procedure_name").isin(*codes.WITHDRAWAL_PROCEDURES)
    )
    rows = written_once(per_folio.join(chosen, "folio"), "settled")
    balance = balances_of_accounts(
        rows, history, subaccounts, prices, balance_after or term.end, price_date or term.price_date
    )
    result = (
        rows.join(payment_of_folio(payments, catalog, term), "folio", "left")
        .join(balance, ["account_id", "subaccount_id"], "left")
        .withColumn("savings_type", codes.savings_type(F.col("subaccount_id")))
    )
    return stamp_period(result, term.period_id)


def withdrawal_figures(withdrawn: DataFrame, term: Term) -> DataFrame:
    """Numbered withdrawals with the opening balance: what remains plus what was paid and taxed.

    A missing amount leaves the opening balance missing.
    """
    in_term = withdrawn.filter(F.col("period_id") == term.period_id)
    numbered = number_rows(written_once(in_term, "withdrawn"), ["account_id", "folio"], "id")
    amounts = {
        name: F.round(source, 2).cast("decimal(18,2)")
        for name, source in (("remaining", "balance"), ("paid", "paid"), ("tax", "tax"))
    }
    figures = numbered.withColumns(amounts)
    return figures.withColumns(
        {
            "opening": (F.col("remaining") + F.col("paid") + F.col("tax")).cast("decimal(18,2)"),
            "savings": F.when(F.col("savings_type") == codes.DEFAULT_SAVINGS_TYPE, "RET").otherwise("VIV"),
        }
    ).drop("balance", "savings_type")
