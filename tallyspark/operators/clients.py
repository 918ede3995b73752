"""The client dimension and the classification of clients by indicators."""

from __future__ import annotations

from collections.abc import Mapping
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import codes
from tallyspark.operators.joins import first_per_key
from tallyspark.operators.terms import Term, stamp_period


def identifiers_by_person(identifiers: DataFrame) -> DataFrame:
    """Valid and active identifiers, one row per person: the identifier table is read once, not once per type."""
    usable = identifiers.filter((F.col("is_valid") == 1) & (F.col("is_active") == 1))

    def of_type(type_id: int) -> Column:
        return F.min(F.when(F.col("type_id") == type_id, F.col("value")))

    wanted = usable.filter(F.col("type_id").isin(codes.RFC_ID, codes.CURP_ID, codes.NSS_ID))
    return wanted.groupBy("person_id").agg(
        of_type(codes.NSS_ID).alias("nss"),
        of_type(codes.CURP_ID).alias("curp"),
        of_type(codes.RFC_ID).alias("rfc"),
    )


def client_master(
    contracts: DataFrame,
    roles: DataFrame,
    persons: DataFrame,
    homes: DataFrame,
    addresses: DataFrame,
    zip_codes: DataFrame,
    states: DataFrame,
    municipalities: DataFrame,
    settlements: DataFrame,
    identifiers: DataFrame,
) -> DataFrame:
    """One row per account: the first contract (by number) of a client, with name, home address and identifiers.

    The account is the digits of the contract number. Role, line and home type are filtered on their own scans before
    anything is joined; the joins by person follow each other and share one shuffle; geography is a chain of
    size-checked lookups.
    """
    line = contracts.filter(F.col("line_id") == codes.BUSINESS_LINE).select("contract_id", "contract_number")
    holders = roles.filter(F.col("role_id") == codes.CLIENT_ROLE).select("contract_id", "person_id")
    home = homes.filter(F.col("home_type") == codes.HOME_TYPE).select("person_id", "address_id")

    def named(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.select(key, F.col("name").alias(name))

    places = (
        addresses.join(zip_codes, "zip_id", "left")
        .join(named(states, "state_id", "state"), "state_id", "left")
        .join(named(municipalities, "municipality_id", "municipality"), "municipality_id", "left")
        .join(named(settlements, "settlement_id", "colony"), "settlement_id", "left")
    )
    rows = (
        line.join(holders, "contract_id")
        .join(persons, "person_id")
        .join(home, "person_id")
        .join(identifiers_by_person(identifiers), "person_id", "left")
        .join(places, "address_id")
        .withColumn("account_id", codes.digits_key(F.col("contract_number")))
    )
    order = [F.col(name) for name in ("contract_number", "contract_id", "person_id", "address_id")]
    return first_per_key(rows, ["account_id"], order).select(
        "account_id", "first_name", "paternal_name", "maternal_name", "street", "street_number", "colony",
        "municipality", F.col("zip").cast("int").alias("zip"), "state", "nss", "curp", "rfc",
    )


def indicator_values(
    indicators: DataFrame, config: DataFrame, indicator_id: int, labels: Mapping[str, str], only_valid: bool = True
) -> DataFrame:
    """Accounts and labels of one configured indicator, each pair once."""
    wanted = F.col("indicator_id") == indicator_id
    rows = indicators.filter(wanted & (F.col("valid") == 1) if only_valid else wanted)
    known = config.filter(wanted).select("indicator_id")
    return (
        rows.join(known, "indicator_id", "left_semi")
        .select("account_id", codes.decode(F.col("code"), dict(labels)).alias("value"))
        .distinct()
    )


def indicator_profile(indicators: DataFrame, config: DataFrame) -> DataFrame:
    """Origin, client type, validity and pension flag of every account, in one scan of the indicator table.

    An account with several values of one indicator takes the first label in alphabetical order. Labels are compared as
    their position in that order, so the aggregation works on integers.
    """
    columns = {
        "origin": (codes.INDICATOR_ORIGIN, codes.ORIGIN_LABELS),
        "client_type": (codes.INDICATOR_CLIENT_TYPE, codes.CLIENT_TYPE_LABELS),
        "validity": (codes.INDICATOR_VALIDITY, codes.VALIDITY_LABELS),
        "pension": (codes.INDICATOR_PENSION, codes.PENSION_LABELS),
    }
    ids = [indicator_id for indicator_id, _ in columns.values()]
    rows = indicators.filter((F.col("valid") == 1) & F.col("indicator_id").isin(ids)).join(
        config.select("indicator_id").distinct(), "indicator_id", "left_semi"
    )

    def first_position(indicator_id: int, labels: Mapping[str, str]) -> Column:
        ordered = sorted(labels.values())
        positions = {code: ordered.index(label) for code, label in labels.items()}
        return F.min(F.when(F.col("indicator_id") == indicator_id, codes.decode(F.col("code"), positions)))

    def label(name: str, labels: Mapping[str, str]) -> Column:
        return codes.decode(F.col(f"_{name}"), dict(enumerate(sorted(labels.values())))).alias(name)

    has_origin_row = F.max((F.col("indicator_id") == codes.INDICATOR_ORIGIN).cast("int"))
    return rows.groupBy("account_id").agg(
        *(first_position(*spec).alias(f"_{name}") for name, spec in columns.items()),
        has_origin_row.alias("has_origin"),
    ).select("account_id", *(label(name, labels) for name, (_, labels) in columns.items()), "has_origin")


def has_generation_mark(label: Column) -> Column:
    """Sub-account labels that belong to the older generation."""
    first, second = codes.GENERATION_MARKS
    return label.contains(first) | label.contains(second)


def _marked_subaccounts(subaccounts: DataFrame) -> DataFrame:
    marked = has_generation_mark(F.col("label")).cast("int").alias("_marked")
    return subaccounts.select("subaccount_id", marked).distinct()


def _generation(highest_mark: Column) -> Column:
    return F.when(highest_mark == 1, codes.AFORE).when(highest_mark == 0, codes.TRANSITION)


def generation_of(history: DataFrame, subaccounts: DataFrame) -> DataFrame:
    """Generation per account: the older one if any of its sub-accounts is marked, else transition.

    Only one flag per account is shuffled, after combining map-side.
    """
    per_account = history.select("account_id", "subaccount_id").join(_marked_subaccounts(subaccounts), "subaccount_id")
    return per_account.groupBy("account_id").agg(_generation(F.max("_marked")).alias("generation"))


def bond_holders(history: DataFrame, fund_id: int | str = codes.BOND_FUND) -> DataFrame:
    """Accounts that ever held the bond fund."""
    return history.filter(F.col("fund_id") == fund_id).select("account_id").distinct()


def history_profile(history: DataFrame, subaccounts: DataFrame, fund_id: int | str = codes.BOND_FUND) -> DataFrame:
    """Generation and bond flag per account in one scan of the balance history, the largest input of the month."""
    columns = history.select("account_id", "subaccount_id", "fund_id")
    flags = (
        columns.join(_marked_subaccounts(subaccounts), "subaccount_id", "left")
        .groupBy("account_id")
        .agg(
            _generation(F.max("_marked")).alias("generation"),
            F.max((F.col("fund_id") == fund_id).cast("int")).alias("_holds_bond"),
        )
    )
    is_bond = F.coalesce(F.col("_holds_bond") == 1, F.lit(False))
    return flags.withColumn("is_bond", is_bond).drop("_holds_bond")


def pension_type(
    payments: DataFrame,
    payment_subaccounts: DataFrame,
    catalog: DataFrame,
    term: Term,
) -> DataFrame:
    """Pension payments of the period with the name of their sub-process."""
    chosen = payments.filter(
        F.col("process_id").isin(*codes.PENSION_PROCESSES)
        & F.col("subprocess_id").isin(*codes.PENSION_SUBPROCESSES)
        & term.covers(F.col("settled_at"))
    ).select("account_id", "folio", "settlement_folio", "subprocess_id")
    eligible = payment_subaccounts.filter(~F.col("subaccount_id").isin(*codes.NON_PENSION_SUBACCOUNTS)).select(
        "folio", "settlement_folio"
    )
    names = catalog.select(F.col("catalog_id").alias("subprocess_id"), F.col("value").alias("pension_type"))
    return (
        chosen.join(eligible, ["folio", "settlement_folio"])
        .join(names, "subprocess_id")
        .select("account_id", "pension_type")
    )


def investment_profile(groups: DataFrame, catalog: DataFrame) -> DataFrame:
    """Description of the investment group of each account."""
    names = catalog.select(F.col("catalog_id").alias("group_id"), F.col("description").alias("profile"))
    return groups.join(names, "group_id").select("account_id", "profile")


def classify_clients(
    clients: DataFrame,
    indicators: DataFrame,
    config: DataFrame,
    holdings: DataFrame,
    pensions: DataFrame,
    profiles: DataFrame,
    term: Term,
) -> DataFrame:
    """One row per known client that has an origin, with every label and flag of the period.

    ``holdings`` is the history profile. Each input is brought to one row per account before the joins, so the joins share one partitioning by account and
    no account can multiply rows. Accounts of mixed origin without any balance get the mixed generation.
    """
    base = indicator_profile(indicators, config).filter(F.col("has_origin") == 1)
    pension = pensions.groupBy("account_id").agg(F.min("pension_type").alias("pension_type"))
    profile = profiles.groupBy("account_id").agg(F.min("profile").alias("profile"))
    joined = (
        base.join(clients.select("account_id"), "account_id", "left_semi")
        .join(holdings, "account_id", "left")
        .join(pension, "account_id", "left")
        .join(profile, "account_id", "left")
    )
    mixed = F.when(F.col("origin") == codes.MIXED, F.lit(codes.MIXED))
    classified = joined.select(
        "account_id",
        F.coalesce(F.col("pension").cast("boolean"), F.lit(False)).alias("is_pension"),
        "client_type",
        "origin",
        "validity",
        F.coalesce("generation", mixed).alias("generation"),
        F.coalesce("is_bond", F.lit(False)).alias("is_bond"),
        "pension_type",
        "profile",
    )
    return stamp_period(classified, term.period_id)
