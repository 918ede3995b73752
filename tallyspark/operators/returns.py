"""Commissions, flows, final balances and the return of each account and sub-account."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import codes
from tallyspark.operators.movements import union_all
from tallyspark.operators.terms import Term, stamp_period

RETURN_KEYS = ("account_id", "subaccount_id")
MEASURES = ("initial", "final", "credit", "charge", "commission")


def commissions(
    charged: DataFrame, concept_config: DataFrame, concept_subaccount: DataFrame, term: Term
) -> DataFrame:
    """Commission rows of the period with the sub-account found through the concept configuration.

    Both lookups are joined with each other first, so the facts meet one small side.
    """
    lookup = concept_config.select("concept_id", "mov_subacc_id").join(
        concept_subaccount.select("mov_subacc_id", "subaccount_id"), "mov_subacc_id"
    )
    rows = charged.filter(term.covers(F.col("settled_at"))).join(
        lookup.select("concept_id", "subaccount_id"), "concept_id"
    )
    return stamp_period(rows, term.period_id)


def commission_totals(commission_rows: DataFrame) -> DataFrame:
    """Commission per account and sub-account."""
    return commission_rows.groupBy(*RETURN_KEYS).agg(F.sum("amount").cast("decimal(18,4)").alias("commission"))


def flow_rows(movements: DataFrame, term: Term) -> DataFrame:
    """Credits and charges of the period, one row per movement."""
    kind = F.col("type_id")
    wanted = term.covers(F.col("settled_at")) & kind.isin(codes.CREDIT_TYPE, codes.CHARGE_TYPE)
    amount = codes.money(F.col("amount"))
    return movements.filter(wanted).select(
        *RETURN_KEYS,
        F.when(kind == codes.CREDIT_TYPE, amount).alias("credit"),
        F.when(kind == codes.CHARGE_TYPE, amount).alias("charge"),
    )


def flows(movements: DataFrame, term: Term) -> DataFrame:
    """Credits and charges of the period per account and sub-account, in one pass over the movements."""
    return flow_rows(movements, term).groupBy(*RETURN_KEYS).agg(
        *(F.sum(name).cast("decimal(18,2)").alias(name) for name in ("credit", "charge"))
    )


def final_rows(balances: DataFrame, term: Term, kind: str = codes.BALANCE_KIND) -> DataFrame:
    """Balances of one kind dated in the period, one row per balance."""
    wanted = (F.col("kind") == kind) & term.covers(F.col("settled_at"))
    return balances.filter(wanted).select(*RETURN_KEYS, F.col("amount").alias("final"))


def final_balances(balances: DataFrame, term: Term, kind: str = codes.BALANCE_KIND) -> DataFrame:
    """Balances of one kind dated in the period, per account and sub-account."""
    return final_rows(balances, term, kind).groupBy(*RETURN_KEYS).agg(
        F.sum("final").cast("decimal(18,2)").alias("final")
    )


def initial_balances(balances: DataFrame, term: Term, kind: str = codes.BALANCE_KIND) -> DataFrame:
    """Opening balances from already valued facts: those dated from the period start to the previous cut-off."""
    dated = F.col("settled_at").between(F.lit(term.start), F.lit(term.previous_cutoff))
    return (
        balances.filter((F.col("kind") == kind) & dated)
        .groupBy(*RETURN_KEYS)
        .agg(F.sum("amount").cast("decimal(18,2)").alias("initial"))
    )


def compute_returns(
    initial: DataFrame,
    final: DataFrame,
    flow: DataFrame,
    commission: DataFrame,
    term: Term,
    include_commission_only: bool = True,
    positive_only: bool = False,
) -> DataFrame:
    """Return = final - (credits + initial - commissions - charges), per account and sub-account.

    The inputs are unioned and summed in one aggregation instead of chained full joins: one shuffle, partial sums
    map-side, and each measure counted once however many rows the others have. So the inputs need not be summed before:
    pass single rows (``flow_rows``, ``final_rows``) and they are shuffled once instead of twice.
    """
    inputs = [
        initial.select(*RETURN_KEYS, "initial"),
        final.select(*RETURN_KEYS, "final"),
        flow.select(*RETURN_KEYS, "credit", "charge"),
    ]
    tagged = [df.withColumn("_beyond_commission", F.lit(1)) for df in inputs]
    tagged.append(commission.select(*RETURN_KEYS, "commission").withColumn("_beyond_commission", F.lit(0)))
    totals = [
        F.coalesce(F.sum(name), F.lit(0)).cast("decimal(18,4)").alias(name) for name in MEASURES
    ]
    merged = (
        union_all(tagged)
        .groupBy(*RETURN_KEYS)
        .agg(*totals, F.max("_beyond_commission").alias("_beyond_commission"))
    )
    if not include_commission_only:
        merged = merged.filter(F.col("_beyond_commission") == 1)
    computed = F.col("final") - (F.col("credit") + F.col("initial") - F.col("commission") - F.col("charge"))
    result = merged.drop("_beyond_commission").withColumn("computed_return", computed.cast("decimal(18,4)"))
    if positive_only:
        result = result.filter(F.col("computed_return") > 0)
    return stamp_period(result, term.period_id)


def json_breakdown(returns: DataFrame, clients: DataFrame, subaccounts: DataFrame) -> DataFrame:
    """Clients and return by indicators kept as JSON text, affiliation label and sub-account label."""
    return _breakdown(returns, clients, subaccounts, lambda key: F.get_json_object("indicators", f"$.{key}"))


def variant_breakdown(returns: DataFrame, clients: DataFrame, subaccounts: DataFrame) -> DataFrame:
    """``json_breakdown`` of indicators kept as VARIANT, which were parsed when they were stored."""
    return _breakdown(
        returns, clients, subaccounts, lambda key: F.try_variant_get("indicators", f"$['{key}']", "string")
    )


def _breakdown(
    returns: DataFrame, clients: DataFrame, subaccounts: DataFrame, indicator: Callable[[str], Column]
) -> DataFrame:
    """Sums per account are taken before the clients are attached, so the join carries one row per account and
    sub-account.
    """
    affiliation = (
        F.when(indicator("3") == "Asignado", "Asignado")
        .when(indicator("4") == "Pensionado", "Pensionado")
        .when(indicator("3") == "Afiliado", "Afiliado")
    )
    profile = clients.select(
        "account_id",
        indicator("34").alias("generation"),
        indicator("21").alias("validity"),
        affiliation.alias("affiliation"),
        indicator("33").alias("client_type"),
    )
    labels = subaccounts.select("subaccount_id", F.col("label").alias("subaccount"))
    per_account = returns.groupBy(*RETURN_KEYS).agg(F.sum("computed_return").alias("computed_return"))
    return (
        per_account.join(labels, "subaccount_id")
        .join(profile, "account_id")
        .groupBy("generation", "validity", "affiliation", "client_type", "subaccount")
        .agg(
            F.countDistinct("account_id").alias("clients"),
            F.sum("computed_return").cast("decimal(38,4)").alias("total_return"),
        )
    )
