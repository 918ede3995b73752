"""Catalog rows brought from the source systems, ready to be upserted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import codes


def _named(df: DataFrame, key: str, catalog: DataFrame, name: str) -> DataFrame:
    names = catalog.select(F.col("catalog_id").alias(key), F.col("value").alias(name))
    return df.join(names, key)


def fund_catalog(funds: DataFrame, catalog: DataFrame) -> DataFrame:
    """Funds with their description."""
    return _named(funds.select("fund_id"), "fund_id", catalog, "description")


def subaccount_catalog(subaccounts: DataFrame, catalog: DataFrame) -> DataFrame:
    """Sub-account types with regime, category and label."""
    columns = subaccounts.select("subaccount_id", "regime_id", "category_id")
    return _named(columns, "category_id", catalog, "label").select(
        "subaccount_id", "regime_id", "category_id", "label"
    )


def _concepts(
    config: DataFrame, concept_subaccount: DataFrame, slot, description: str, origin: str, is_switch: bool
) -> DataFrame:
    return config.join(concept_subaccount.select("mov_subacc_id", "subaccount_id"), "mov_subacc_id").select(
        F.col("concept_id").alias("code"),
        slot.cast("int").alias("slot"),
        "subaccount_id",
        F.lit(origin).alias("origin"),
        F.col(description).alias("description"),
        F.lit(is_switch).alias("is_switch"),
        slot.cast("int").alias("ordinal"),
    )


def concept_catalog(config: DataFrame, concept_subaccount: DataFrame) -> DataFrame:
    """Movement concepts of the current system; they use no slots."""
    return _concepts(config, concept_subaccount, F.lit(0), "description", codes.CURRENT_ORIGIN, False)


def legacy_concept_catalog(config: DataFrame, concept_subaccount: DataFrame) -> DataFrame:
    """Movement concepts of the legacy system, which switch amount slots to sub-accounts.

    Of several slots of a movement the highest counts, so the slot is the ordinal.
    """
    known = config.filter(F.col("legacy_code").isin(*codes.LEGACY_CODES))
    slot = F.coalesce("slot", F.lit(0))
    return _concepts(known, concept_subaccount, slot, "legacy_description", codes.LEGACY_ORIGIN, True)
