"""Movement unions, recodes and switches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.functions import codes
from tallyspark.operators import catalogs, movements
from tallyspark.registry.base import TERM, register, with_views
from tallyspark.sources import roles

FAMILIES = {1: "AVOL", 2: "BONO", 3: "COMP", 4: "GOB", 5: "RCV", 6: "SAR", 7: "VIV"}


def movement_union(spark, folder):
    every = roles.movement(spark, folder)
    families = {name: every.filter(F.col("family") == number).drop("family") for number, name in FAMILIES.items()}
    return movements.union_movements(families, TERM)


@register(
    "movements_union",
    with_views(
        """
        SELECT account_id, type_id, concept_id, subaccount_id, fund_id, folio, settled_at,
               CAST(ROUND(amount, 2) AS DECIMAL(18,2)) AS amount,
               CASE family WHEN 1 THEN 'AVOL' WHEN 2 THEN 'BONO' WHEN 3 THEN 'COMP' WHEN 4 THEN 'GOB'
                           WHEN 5 THEN 'RCV' WHEN 6 THEN 'SAR' ELSE 'VIV' END AS family,
               'M' AS origin_db, CAST(39 AS INTEGER) AS period_id
        FROM movement WHERE settled_at BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'
        """,
        "movement",
    ),
)
def movements_union(spark, folder):
    return movement_union(spark, folder)


RECODED = """
    SELECT account_id, folio, booked, employer_tag, slot_1, slot_3,
           CAST(CASE WHEN code >= 114 AND employer_tag IN ('INT. RET08', 'INT. CYVTRA') THEN 117 ELSE code END
                AS INTEGER) AS code,
           CAST(CASE fund_id WHEN 98 THEN 14 WHEN 99 THEN 15 ELSE fund_id END AS INTEGER) AS fund_id,
           CAST(CASE WHEN account_id < 7000000000 THEN 1 ELSE 2 END AS INTEGER) AS account_class
    FROM legacy_wide"""
LEGACY_WIDE = """
    SELECT l_partkey + 6999999000 AS account_id, l_orderkey AS folio, l_linenumber + 110 AS code,
           CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS booked, CAST(l_suppkey AS INTEGER) AS fund_id,
           CASE l_returnflag WHEN 'R' THEN 'INT. RET08' WHEN 'A' THEN 'INT. CYVTRA' ELSE 'OTHER' END AS employer_tag,
           CASE WHEN l_returnflag IN ('A', 'N') THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END AS slot_1,
           CASE WHEN l_returnflag IN ('R', 'N') THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END AS slot_3
    FROM lineitem"""


@register("movement_recode", with_views("SELECT * FROM recoded", legacy_wide=LEGACY_WIDE, recoded=RECODED))
def movement_recode(spark, folder):
    return movements.recode(roles.legacy_wide(spark, folder), employer_codes=True)


SWITCHED = """
    WITH slot AS (
        SELECT rid, code, 1 AS slot, slot_1 AS amount FROM numbered
        UNION ALL SELECT rid, code, 3, slot_3 FROM numbered),
    hit AS (
        SELECT rid, s.subaccount_id, p.amount, ROW_NUMBER() OVER (PARTITION BY rid ORDER BY s.ordinal DESC) AS n
        FROM slot p JOIN {switch} s ON s.code = p.code AND s.slot = p.slot WHERE p.amount > 0)
    SELECT {columns}, CAST(COALESCE(h.subaccount_id, 0) AS INTEGER) AS subaccount_id,
           CAST(COALESCE(h.amount, 0) AS DECIMAL(18,2)) AS amount
    FROM numbered w LEFT JOIN hit h ON h.rid = w.rid AND h.n = 1"""
NUMBERED = "SELECT *, ROW_NUMBER() OVER () AS rid FROM {table}"


@register(
    "switch_mapping",
    with_views(
        SWITCHED.format(switch="switch", columns="w.folio, w.code, w.fund_id, w.slot_1, w.slot_3"),
        "movement_wide",
        "switch",
        numbered=NUMBERED.format(table="movement_wide"),
    ),
)
def switch_mapping(spark, folder):
    return movements.map_switches(roles.movement_wide(spark, folder), roles.switch(spark, folder))


@register(
    "switch_mapping_all_slots",
    with_views(
        """
        SELECT p.folio, p.code, p.fund_id, p.slot, p.amount, CAST(s.subaccount_id AS INTEGER) AS subaccount_id
        FROM (SELECT folio, code, fund_id, 1 AS slot, CAST(slot_1 AS DECIMAL(18,2)) AS amount FROM movement_wide
              UNION ALL SELECT folio, code, fund_id, 3, CAST(slot_3 AS DECIMAL(18,2)) FROM movement_wide) p
        JOIN switch s ON s.code = p.code AND s.slot = p.slot
        WHERE p.amount > 0
        """,
        "movement_wide",
        "switch",
    ),
)
def switch_mapping_all_slots(spark, folder):
    return movements.explode_switches(roles.movement_wide(spark, folder), roles.switch(spark, folder))


LEGACY_SWITCH = """
    SELECT * FROM (VALUES (111, 1, 11, 1), (111, 3, 13, 2), (112, 1, 21, 3), (113, 3, 33, 4), (117, 1, 71, 5),
                          (117, 3, 73, 6), (117, 5, 75, 7)) AS t(code, slot, subaccount_id, ordinal)"""
LEGACY_LOAD = SWITCHED.format(
    switch="legacy_switch",
    columns="w.account_id, w.folio, w.booked, w.employer_tag, w.slot_1, w.slot_3, w.code, w.fund_id, w.account_class",
)


def legacy_load(spark, folder):
    return movements.legacy_movements(
        {"RCV": roles.legacy_wide(spark, folder)}, roles.legacy_switch(spark, folder), TERM, movement_codes=None
    )


@register(
    "legacy_movements",
    with_views(
        f"""
        SELECT *, 'RCV' AS family, CAST(39 AS INTEGER) AS period_id FROM ({LEGACY_LOAD})
        WHERE booked BETWEEN 19980301 AND 19980331
        """,
        legacy_wide=LEGACY_WIDE,
        recoded=RECODED,
        numbered=NUMBERED.format(table="recoded"),
        legacy_switch=LEGACY_SWITCH,
    ),
)
def legacy_movements(spark, folder):
    return legacy_load(spark, folder)


LEGACY_FAMILIES = ("GOB", "RCV", "VIV97", "COMRET", "SAR92", "VIV92", "BONO")
LEGACY_FAMILY_CODE = 400


def legacy_families(spark, folder):
    """Seven wide families by supplier, whose codes are partly in the list of legacy codes."""
    wide = roles.legacy_wide(spark, folder).withColumn("code", (F.col("fund_id") + LEGACY_FAMILY_CODE).cast("int"))
    return {
        name: wide.filter(F.pmod(F.col("fund_id"), F.lit(7)) == number) for number, name in enumerate(LEGACY_FAMILIES)
    }


def legacy_family_switches(spark, folder):
    """One switch per code and slot from the parts, as the concept catalog gives them."""
    return movements.legacy_switches(
        catalogs.legacy_concept_catalog(
            roles.concept_source(spark, folder), roles.concept_subaccount_source(spark, folder)
        ).withColumn("code", F.lit(LEGACY_FAMILY_CODE) + F.col("subaccount_id"))
    ).groupBy("code", "slot").agg(F.max("subaccount_id").alias("subaccount_id"), F.max("ordinal").alias("ordinal"))


@register(
    "legacy_families",
    f"""
    WITH wide AS (
        SELECT ROW_NUMBER() OVER () AS rid, l_partkey + 6999999000 AS account_id, l_orderkey AS folio,
               CAST(l_suppkey + 400 AS INTEGER) AS raw_code, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS booked,
               CAST(l_suppkey AS INTEGER) AS supplier,
               CASE l_returnflag WHEN 'R' THEN 'INT. RET08' WHEN 'A' THEN 'INT. CYVTRA' ELSE 'OTHER' END AS employer_tag,
               CASE WHEN l_returnflag IN ('A', 'N') THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END AS slot_1,
               CASE WHEN l_returnflag IN ('R', 'N') THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END AS slot_3
        FROM lineitem),
    loaded AS (
        SELECT *, list_extract(['GOB', 'RCV', 'VIV97', 'COMRET', 'SAR92', 'VIV92', 'BONO'], supplier % 7 + 1) AS family
        FROM wide
        WHERE booked BETWEEN 19980301 AND 19980331 AND raw_code IN ({", ".join(map(str, codes.LEGACY_CODES))})),
    recoded AS (
        SELECT *, CAST(CASE WHEN family = 'RCV' AND raw_code >= 114 AND employer_tag IN ('INT. RET08', 'INT. CYVTRA')
                            THEN 117 ELSE raw_code END AS INTEGER) AS code,
               CAST(CASE supplier WHEN 98 THEN 14 WHEN 99 THEN 15 ELSE supplier END AS INTEGER) AS fund_id,
               CAST(CASE WHEN account_id < 7000000000 THEN 1 ELSE 2 END AS INTEGER) AS account_class
        FROM loaded),
    switch AS (
        SELECT p_size + 400 AS code, CASE WHEN p_brand = 'Brand#1' THEN 0 ELSE 3 END AS slot,
               MAX(p_size) AS subaccount_id
        FROM part WHERE p_size + 400 IN ({", ".join(map(str, codes.LEGACY_CODES))}) GROUP BY 1, 2)
    SELECT r.account_id, r.folio, r.booked, r.employer_tag, r.slot_1, r.slot_3, r.code, r.fund_id, r.account_class,
           CAST(COALESCE(s.subaccount_id, 0) AS INTEGER) AS subaccount_id,
           CAST(CASE WHEN s.code IS NULL THEN 0 ELSE r.slot_3 END AS DECIMAL(18,2)) AS amount, r.family,
           CAST(39 AS INTEGER) AS period_id
    FROM recoded r LEFT JOIN switch s ON s.code = r.code AND s.slot = 3 AND r.slot_3 > 0
    """,
)
def legacy_families_query(spark, folder):
    """All seven families, with the code list on and switches from the concept catalog."""
    return movements.legacy_movements(legacy_families(spark, folder), legacy_family_switches(spark, folder), TERM)


@register(
    "history_extract",
    """
    SELECT l_partkey AS account_id, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS transferred,
           l_linenumber AS correlative, CAST(l_extendedprice AS DECIMAL(18,2)) AS base_salary, l_orderkey AS folio,
           CAST(39 AS INTEGER) AS period_id
    FROM lineitem WHERE CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) BETWEEN 19980301 AND 19980331
    """,
)
def history_extract(spark, folder):
    return movements.history_extract(roles.contribution(spark, folder), TERM)
