"""Catalog rows, played by parts and suppliers."""

from __future__ import annotations

from tallyspark.functions.codes import LEGACY_CODES
from tallyspark.operators import catalogs
from tallyspark.registry.base import register
from tallyspark.sources import roles


@register("catalog_funds", "SELECT s_suppkey AS fund_id, s_name AS description FROM supplier")
def catalog_funds(spark, folder):
    return catalogs.fund_catalog(roles.fund_source(spark, folder), roles.supplier_catalog(spark, folder))


@register(
    "catalog_subaccounts",
    """
    SELECT p_partkey AS subaccount_id, p_size AS regime_id, CAST(p_size AS BIGINT) AS category_id, s_name AS label
    FROM part JOIN supplier ON s_suppkey = p_size
    """,
)
def catalog_subaccounts(spark, folder):
    return catalogs.subaccount_catalog(roles.subaccount_source(spark, folder), roles.supplier_catalog(spark, folder))


@register(
    "catalog_concepts",
    """
    SELECT p_partkey AS code, CAST(0 AS INTEGER) AS slot, p_size AS subaccount_id, 'MIT' AS origin,
           p_name AS description, FALSE AS is_switch, CAST(0 AS INTEGER) AS ordinal
    FROM part
    """,
)
def catalog_concepts(spark, folder):
    return catalogs.concept_catalog(roles.concept_source(spark, folder), roles.concept_subaccount_source(spark, folder))


@register(
    "catalog_legacy_concepts",
    f"""
    SELECT p_partkey AS code, CAST(CASE WHEN p_brand = 'Brand#1' THEN 0 ELSE 3 END AS INTEGER) AS slot,
           p_size AS subaccount_id, 'INTEGRITY' AS origin, p_type AS description, TRUE AS is_switch,
           CAST(CASE WHEN p_brand = 'Brand#1' THEN 0 ELSE 3 END AS INTEGER) AS ordinal
    FROM part WHERE p_size + 400 IN ({", ".join(map(str, LEGACY_CODES))})
    """,
)
def catalog_legacy_concepts(spark, folder):
    return catalogs.legacy_concept_catalog(
        roles.concept_source(spark, folder), roles.concept_subaccount_source(spark, folder)
    )
