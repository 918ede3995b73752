"""Quota-driven account samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions import codes
from tallyspark.operators.terms import Term

WEIGHT_SCALE = 10**15
WEIGHT_TYPE = "decimal(38,0)"
SALTS = 64


def account_concepts(movements: DataFrame, bridge: DataFrame) -> DataFrame:
    """Regulator concepts that each account has movements of.

    Pairs may repeat: every use below is insensitive to that, and a ``distinct`` here would only add a shuffle.
    """
    pairs = movements.select("account_id", "concept_id").join(
        bridge.select("concept_id", "regulator_id"), "concept_id"
    )
    return pairs.select("account_id", "regulator_id")


def _active(quotas: DataFrame, only_active: bool) -> DataFrame:
    chosen = quotas.filter("active") if only_active else quotas
    return chosen.select("regulator_id", "quantity")


def _held_concepts(
    concepts: DataFrame, quotas: DataFrame, only_active: bool, accounts: DataFrame | None
) -> DataFrame:
    """Per account the set of configured concepts it holds, which their number bounds.

    The sets are combined map-side, so a hot account arrives as one row per task; the given accounts are matched after
    that, on the same partitioning.
    """
    share = F.greatest(F.lit(1), F.expr(f"bigint({WEIGHT_SCALE}) div bigint(quantity)")).alias("share")
    held = (
        concepts.join(_active(quotas, only_active), "regulator_id")
        .groupBy("account_id")
        .agg(F.collect_set(F.struct("regulator_id", "quantity", share)).alias("_held"))
    )
    return held if accounts is None else held.join(accounts.select("account_id"), "account_id", "left_semi")


def _plus_share(total: Column, held: Column) -> Column:
    return (total + held["share"]).cast(WEIGHT_TYPE)


def quota_ranks(
    concepts: DataFrame,
    quotas: DataFrame,
    only_active: bool = False,
    accounts: DataFrame | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """The accounts that fill each concept's quota, with their rank in it; ``accounts`` limits who can be drawn.

    Accounts that serve rare concepts come first: the weight is the sum of 1/quota over the account's concepts, kept as
    a scaled whole number so that it depends on no order of summation; ties go to the lower account. A concept may hold
    most accounts, so ranks are taken twice: within ``(concept, salt)`` first, where nothing below the quota can reach
    the final ranks, and then among the few survivors of each concept.
    """
    weight = F.aggregate("_held", F.lit(0).cast(WEIGHT_TYPE), _plus_share)
    held = _held_concepts(concepts, quotas, only_active, accounts)
    pairs = held.select("account_id", weight.alias("weight"), F.inline("_held")).select(
        "account_id", "weight", "regulator_id", "quantity",
        F.pmod(F.xxhash64("account_id"), F.lit(salts)).alias("_salt"),
    )
    order = [F.col("weight").desc(), F.col("account_id")]

    def keep(df: DataFrame, *partition: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
        return df.withColumn("rank", rank).filter(F.col("rank") <= F.col("quantity"))

    return keep(keep(pairs, "regulator_id", "_salt"), "regulator_id").drop("_salt")


def quota_sample(
    concepts: DataFrame, quotas: DataFrame, only_active: bool = False, accounts: DataFrame | None = None
) -> DataFrame:
    """The sampled accounts. An account is in the sample as soon as it fills a place of any quota."""
    return quota_ranks(concepts, quotas, only_active, accounts).select("account_id").distinct()


def quota_check(
    concepts: DataFrame, quotas: DataFrame, only_active: bool = False, accounts: DataFrame | None = None
) -> DataFrame:
    """Per configured concept: its quota, how many accounts hold it, and whether the quota can be met."""
    holders = (
        _held_concepts(concepts, quotas, only_active, accounts)
        .select(F.inline("_held"))
        .groupBy("regulator_id")
        .agg(F.count(F.lit(1)).alias("holders"))
    )
    counted = F.coalesce("holders", F.lit(0))
    return _active(quotas, only_active).join(holders, "regulator_id", "left").select(
        "regulator_id",
        "quantity",
        counted.cast("bigint").alias("holders"),
        (counted >= F.col("quantity")).alias("is_satisfied"),
    )


def require_quotas(
    concepts: DataFrame, quotas: DataFrame, only_active: bool = False, accounts: DataFrame | None = None
) -> None:
    """Raise when a quota cannot be met, or when the configuration itself is not usable."""
    config = (quotas.filter("active") if only_active else quotas).groupBy("regulator_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min("quantity").alias("quantity")
    )
    if config.filter((F.col("rows") > 1) | (F.col("quantity") < 1)).take(1):
        raise ValueError("every concept needs one quota of at least 1")
    if quota_check(concepts, quotas, only_active, accounts).filter(~F.col("is_satisfied")).take(1):
        raise ValueError("not enough accounts to meet every quota")


def manual_accounts(uploads: DataFrame) -> DataFrame:
    """Accounts uploaded by hand for the sample."""
    wanted = (F.col("procedure") == codes.MANUAL_SAMPLE_PROCEDURE) & (F.col("area_id") == codes.MANUAL_SAMPLE_AREA)
    return uploads.filter(wanted).select("account_id")


def build_sample(
    manual: DataFrame, automatic: DataFrame, term: Term, user_id: int, area_id: int, url_base: str
) -> DataFrame:
    """Manual and automatic accounts with status, time and document address."""
    document = F.concat(
        F.lit(url_base), F.col("account_id").cast("string"), F.lit(f"_{term.period_id}_{user_id}.pdf")
    )
    return manual.select("account_id").unionByName(automatic.select("account_id")).select(
        "account_id",
        F.lit(term.period_id).alias("period_id"),
        F.lit(user_id).alias("user_id"),
        F.lit(area_id).alias("area_id"),
        F.lit(codes.SAMPLE_STATUS).alias("status"),
        F.current_timestamp().alias("created_at"),
        document.alias("url"),
    )
