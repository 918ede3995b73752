"""Loads of one period: each replaces its period in the warehouse and returns the control figures that follow it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.operators import (
    catalogs, changes, clients, movements, returns, rules, sampling, statements, withdrawals,
)
from tallyspark.operators.numbering import page_rows
from tallyspark.operators.terms import Term
from tallyspark.operators.valuation import cutoff_date, value_balances
from tallyspark.plans import figures
from tallyspark.plans.statements import StatementConfig, build_statements
from tallyspark.plans.warehouse import Warehouse
from tallyspark.sources.shared import new_table_path, written_once
from tallyspark.sources.tables import Table, replace_period_in

FIGURE_PAGE = 150_000


def load_catalogs(
    warehouse: Warehouse,
    funds: DataFrame,
    subaccounts: DataFrame,
    catalog: DataFrame,
    concept_config: DataFrame,
    concept_subaccount: DataFrame,
) -> None:
    """Upsert funds, sub-account types and both kinds of movement concepts."""
    warehouse.upsert("fund", catalogs.fund_catalog(funds, catalog), ["fund_id"])
    warehouse.upsert("subaccount_type", catalogs.subaccount_catalog(subaccounts, catalog), ["subaccount_id"])
    for concepts in (
        catalogs.concept_catalog(concept_config, concept_subaccount),
        catalogs.legacy_concept_catalog(concept_config, concept_subaccount),
    ):
        warehouse.upsert("concept", concepts, ["code", "slot"])


def load_clients(
    warehouse: Warehouse,
    master: DataFrame,
    indicators: DataFrame,
    indicator_config: DataFrame,
    holdings: DataFrame,
    pensions: DataFrame,
    profiles: DataFrame,
    term: Term,
    merge_master: bool = False,
) -> DataFrame:
    """Client master (replaced, or merged by account) and the classification of the period.

    A merge rewrites only the buckets of the accounts that the master names.
    """
    if merge_master:
        warehouse.upsert_buckets("client", master, ["account_id"])
    else:
        warehouse.replace("client", master)
    facts = clients.classify_clients(
        warehouse.table("client"), indicators, indicator_config, holdings, pensions, profiles, term
    )
    warehouse.load("client_fact", facts, term)
    return figures.client_figures(warehouse.table("client_fact"), term)


def load_client_indicators(
    warehouse: Warehouse, updates: Sequence[tuple[DataFrame, str]], term: Term
) -> None:
    """Seed one row per client, then fill one column after the other from ``(account_id, value)`` frames."""
    rows = changes.seed_clients(warehouse.table("client"), term.period_id)
    for source, column in updates:
        if column not in rows.columns:
            rows = rows.withColumn(column, F.lit(None).cast(source.schema["value"].dataType))
        rows = changes.update_from(rows, source, "account_id", column)
    warehouse.load("client_seed", rows, term)


def load_indicator_rules(
    warehouse: Warehouse,
    spark: SparkSession,
    indicators: DataFrame,
    statements: DataFrame,
    sources: Mapping[str, Mapping[str, DataFrame]],
    uploads: DataFrame,
    term: Term,
    publish: Table | None = None,
    clear: Callable[[int], None] | None = None,
) -> None:
    """Indicators by rule and by hand; the period is also replaced in another sink when one is given.

    Rules run in groups of a fixed number, so no plan grows with the catalog.
    """
    manual = rules.manual_indicators(uploads, indicators, term)
    collected = new_table_path(spark, "indicators")
    manual.write.parquet(collected)
    listed = iter(rules.read_rules(indicators, statements))
    while group := list(islice(listed, rules.RULES_PER_PLAN)):
        ruled = rules.run_indicator_rules(spark, group, sources, term)
        ruled.select(*manual.columns).write.mode("append").parquet(collected)
    warehouse.load("client_indicator", spark.read.schema(manual.schema).parquet(collected), term)
    if publish is not None:
        replace_period_in(warehouse.of_term("client_indicator", term), publish, term.period_id, clear)


def load_movements(
    warehouse: Warehouse,
    families: Mapping[str, DataFrame],
    bridge: DataFrame,
    regulator_concepts: DataFrame,
    funds: DataFrame,
    subaccounts: DataFrame,
    term: Term,
) -> dict[str, DataFrame]:
    """Movements of all families, with figures by regulator concept and by fund."""
    warehouse.load("movement", movements.union_movements(families, term), term)
    loaded = warehouse.table("movement")
    return {
        "by_concept": figures.movement_figures_by_concept(
            loaded, warehouse.table("client_fact"), bridge, regulator_concepts, term
        ),
        "by_fund": figures.movement_figures_by_fund(loaded, funds, subaccounts, term),
    }


def load_legacy_movements(
    warehouse: Warehouse, families: Mapping[str, DataFrame], concepts: DataFrame, term: Term, **options
) -> DataFrame:
    """Legacy movements switched to sub-accounts; ``concepts`` is the concept catalog with an ``ordinal``."""
    switched = movements.legacy_movements(families, movements.legacy_switches(concepts), term, **options)
    warehouse.load("legacy_movement", switched, term)
    return figures.legacy_movement_figures(warehouse.table("legacy_movement"), term)


def load_balances(
    warehouse: Warehouse, history: DataFrame, subaccounts: DataFrame, prices: DataFrame, funds: DataFrame, term: Term
) -> dict[str, DataFrame]:
    """Closing balances of the period, with figures by client and by fund."""
    valued = value_balances(
        history, subaccounts, prices,
        cutoff=cutoff_date(history, term.next_start).scalar(), price_date=F.lit(term.price_date),
    )
    warehouse.load("balance", valued, term)
    loaded = warehouse.table("balance")
    return {
        "by_client": figures.balance_figures_by_client(
            loaded, warehouse.table("client_fact"), subaccounts, funds, term
        ),
        "by_fund": figures.balance_figures_by_fund(loaded, subaccounts, funds, term),
    }


def load_commissions(
    warehouse: Warehouse,
    charged: DataFrame,
    concept_config: DataFrame,
    concept_subaccount: DataFrame,
    subaccounts: DataFrame,
    term: Term,
) -> DataFrame:
    """Commissions of the period."""
    warehouse.load("commission", returns.commissions(charged, concept_config, concept_subaccount, term), term)
    return figures.commission_figures(
        warehouse.table("commission"), warehouse.table("client_fact"), subaccounts, term
    )


def load_returns(
    warehouse: Warehouse,
    history: DataFrame,
    subaccounts: DataFrame,
    prices: DataFrame,
    funds: DataFrame,
    concepts: DataFrame,
    term: Term,
    **options,
) -> dict[str, DataFrame]:
    """Returns from the loaded balances, movements and commissions and the opening balances of the history."""
    opening = value_balances(
        history, subaccounts, prices,
        cutoff=F.lit(term.previous_cutoff), price_date=F.lit(term.previous_price_date),
    ).withColumnRenamed("amount", "initial")
    computed = returns.compute_returns(
        opening,
        returns.final_rows(warehouse.of_term("balance", term), term),
        returns.flow_rows(warehouse.of_term("movement", term), term),
        warehouse.of_term("commission", term).withColumnRenamed("amount", "commission"),
        term,
        **options,
    )
    warehouse.load("return_fact", computed, term)
    facts = warehouse.table("client_fact")
    return {
        "by_client": figures.return_figures(warehouse.table("return_fact"), facts, term),
        "by_concept": figures.movement_figures_by_description(
            warehouse.table("movement"), facts, funds, concepts, term
        ),
    }


def return_breakdown(warehouse: Warehouse, subaccounts: DataFrame, term: Term) -> DataFrame:
    """Returns of the period by indicators that are kept as JSON."""
    return returns.json_breakdown(
        warehouse.of_term("return_fact", term), warehouse.of_term("client_seed", term), subaccounts
    )


def load_history(warehouse: Warehouse, contributions: DataFrame, term: Term) -> int:
    """Payroll contributions of the period."""
    return warehouse.load("contribution_history", movements.history_extract(contributions, term), term)


def load_withdrawals(warehouse: Warehouse, term: Term, page_size: int = FIGURE_PAGE, **inputs) -> DataFrame:
    """Withdrawals of the period and their figures in pages."""
    warehouse.load("withdrawal", withdrawals.withdrawals(term=term, **inputs), term)
    return page_rows(withdrawals.withdrawal_figures(warehouse.table("withdrawal"), term), page_size)


def load_sample(
    warehouse: Warehouse,
    uploads: DataFrame,
    bridge: DataFrame,
    quotas: DataFrame,
    term: Term,
    user_id: int,
    area_id: int,
    url_base: str,
    only_active: bool = True,
    only_clients: bool = True,
) -> int:
    """Draw and store the sample; fails before writing when a quota cannot be met.

    The movements are read once: their distinct pairs of account and concept are written and serve the check and the
    draw.
    """
    pairs = sampling.account_concepts(warehouse.of_term("movement", term), bridge).distinct()
    concepts = written_once(pairs, "concepts")
    accounts = warehouse.table("client") if only_clients else None
    sampling.require_quotas(concepts, quotas, only_active, accounts)
    automatic = sampling.quota_sample(concepts, quotas, only_active, accounts)
    rows = sampling.build_sample(
        sampling.manual_accounts(uploads), automatic, term, user_id, area_id, url_base
    )
    return warehouse.load("sample", rows, term)


def load_statements(
    warehouse: Warehouse, config: StatementConfig, term: Term, url_base: str, sampled: bool = True, user: str = "0"
) -> dict[str, int]:
    """Header, front and back of the period, of the sampled accounts or of all, each replacing its period.

    For a sample, its rows of the period are replaced by those with the address of each statement. Returns the rows
    written to each table.
    """
    sample = warehouse.table("sample") if sampled else None
    made = build_statements(
        warehouse.table("client_fact"), warehouse.table("client"), warehouse.table("return_fact"),
        warehouse.table("movement"), config, sample, term, user,
    )
    rows = {
        f"statement_{name}": warehouse.load(f"statement_{name}", product, term)
        for name, product in (("header", made.header), ("front", made.front), ("back", made.back))
    }
    if sampled:
        stored = warehouse.of_term("sample", term)
        linked = written_once(statements.sample_update(stored, made.header, term, url_base), "sample-links")
        rows["sample"] = warehouse.load("sample", linked, term)
    return rows
