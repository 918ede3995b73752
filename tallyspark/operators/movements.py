"""Movement families brought to one shape: unions, recodes and wide-to-long switches."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import codes
from tallyspark.operators.terms import Term, stamp_period

MOVEMENT_COLUMNS = (
    "account_id", "type_id", "concept_id", "subaccount_id", "fund_id", "folio", "reference_id", "units", "amount",
    "settled_at",
)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name; columns that a family lacks are NULL."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def union_movements(
    families: Mapping[str, DataFrame], term: Term, origin: str = codes.MOVEMENT_ORIGIN
) -> DataFrame:
    """Movements of the period from every family, in one schema and with amounts rounded to cents.

    Each branch filters on its own scan, so the date range reaches every source and nothing is shuffled.
    """

    def normalise(family: str, df: DataFrame) -> DataFrame:
        present = [F.col(name) for name in MOVEMENT_COLUMNS if name in df.columns and name != "amount"]
        return df.filter(term.covers(F.col("settled_at"))).select(
            *present,
            F.round("amount", 2).cast("decimal(18,2)").alias("amount"),
            F.lit(family).alias("family"),
            F.lit(origin).alias("origin_db"),
        )

    merged = union_all(normalise(family, df) for family, df in families.items())
    return stamp_period(merged, term.period_id)


def recode(df: DataFrame, employer_codes: bool = False) -> DataFrame:
    """Fixed overrides of movement code and fund, and the account class by account number.

    ``employer_codes`` applies the movement override that only one family needs.
    """
    code = F.col("code")
    if employer_codes:
        tagged = F.col("employer_tag").isin(*codes.RECODE_EMPLOYER_TAGS)
        code = F.when((code >= codes.RECODE_FROM) & tagged, codes.RECODED_MOVEMENT).otherwise(code)
    fund = F.coalesce(codes.decode(F.col("fund_id"), codes.FUND_RECODES), F.col("fund_id"))
    account_class = F.when(
        F.col("account_id") < codes.ASSIGNED_ACCOUNT_START, codes.AFFILIATED_ACCOUNT
    ).otherwise(codes.ASSIGNED_ACCOUNT)
    return df.withColumns(
        {"code": code.cast("int"), "fund_id": fund.cast("int"), "account_class": account_class.cast("int")}
    )


def _slots(df: DataFrame) -> dict[int, str]:
    return {int(name.removeprefix("slot_")): name for name in df.columns if name.startswith("slot_")}


def map_switches(wide: DataFrame, switches: DataFrame) -> DataFrame:
    """Sub-account and amount of each wide movement, taken from the slot its code is switched to.

    A slot counts when it is positive and a switch exists for ``(code, slot)``; of several, the switch with the highest
    ordinal wins; without any, sub-account and amount are 0. The switches become one row per code with one column per
    slot that the source has, so the movements need a single broadcast join and are never shuffled or unpivoted.
    """
    slots = _slots(wide)
    per_code = switches.groupBy("code").agg(
        *(
            F.max(F.when(F.col("slot") == slot, F.struct("ordinal", "subaccount_id"))).alias(f"_switch_{slot}")
            for slot in slots
        )
    )
    matches = F.array(
        *(
            F.when(
                (F.col(name) > 0) & F.col(f"_switch_{slot}").isNotNull(),
                F.struct(
                    F.col(f"_switch_{slot}.ordinal").alias("ordinal"),
                    F.col(f"_switch_{slot}.subaccount_id").alias("subaccount_id"),
                    codes.money(F.col(name)).alias("amount"),
                ),
            )
            for slot, name in slots.items()
        )
    )
    helpers = [f"_switch_{slot}" for slot in slots]
    return (
        wide.join(per_code, "code", "left")
        .withColumn("_match", F.array_max(matches))
        .select(
            *[F.col(name) for name in wide.columns],
            F.coalesce(F.col("_match.subaccount_id"), F.lit(0)).cast("int").alias("subaccount_id"),
            F.coalesce(F.col("_match.amount"), F.lit(0)).cast("decimal(18,2)").alias("amount"),
        )
        .drop(*helpers)
    )


def explode_switches(wide: DataFrame, switches: DataFrame) -> DataFrame:
    """One row for every positive slot that has a switch, instead of the last one only."""
    slots = _slots(wide)
    keep = [name for name in wide.columns if name not in slots.values()]
    entries = F.array(
        *(
            F.struct(F.lit(slot).alias("slot"), codes.money(F.col(name)).alias("amount"))
            for slot, name in slots.items()
        )
    )
    long = wide.select(*keep, F.inline(entries)).filter(F.col("amount") > 0)
    targets = switches.groupBy("code", "slot").agg(
        F.max(F.struct("ordinal", "subaccount_id")).getField("subaccount_id").cast("int").alias("subaccount_id")
    )
    return long.join(targets, ["code", "slot"])


def legacy_movements(
    families: Mapping[str, DataFrame],
    switches: DataFrame,
    term: Term,
    movement_codes: Sequence[int] | None = codes.LEGACY_CODES,
    employer_coded: Sequence[str] = ("RCV",),
    explode_all: bool = False,
) -> DataFrame:
    """Wide legacy movements of the period: filtered, recoded, switched to sub-accounts and unioned."""
    first, last = term.yyyymmdd_bounds
    switch = explode_switches if explode_all else map_switches

    def load(family: str, df: DataFrame) -> DataFrame:
        wanted: Column = F.col("booked").between(first, last)
        if movement_codes is not None:
            wanted = wanted & F.col("code").isin(*movement_codes)
        recoded = recode(df.filter(wanted), employer_codes=family in employer_coded)
        return switch(recoded, switches).withColumn("family", F.lit(family))

    return stamp_period(union_all(load(family, df) for family, df in families.items()), term.period_id)


def legacy_switches(concepts: DataFrame) -> DataFrame:
    """Switch rows of the legacy system from the concept catalog, each once."""
    chosen = concepts.filter(F.col("is_switch") & (F.col("origin") == codes.LEGACY_ORIGIN))
    return chosen.select("code", "slot", "subaccount_id", "ordinal").distinct()


HISTORY_COLUMNS = (
    "account_id", "nss", "transferred", "lot_sequence", "pay_period", "correlative", "regime_type", "base_salary",
    "days_paid", "days_absent", "days_disabled", "rcv_settled", "employer_id", "employer_rfc", "folio",
)


def history_extract(contributions: DataFrame, term: Term, columns: Sequence[str] = HISTORY_COLUMNS) -> DataFrame:
    """Payroll contributions of the period; the source keeps its dates as ``yyyymmdd`` integers."""
    in_term = F.col("transferred").between(*term.yyyymmdd_bounds)
    present = [name for name in columns if name in contributions.columns]
    return stamp_period(contributions.filter(in_term).select(*present), term.period_id)
