"""Client master, indicators and classification."""

from __future__ import annotations

from tallyspark.functions import codes
from tallyspark.operators import clients
from tallyspark.registry.base import TERM, register, with_views
from tallyspark.sources import roles

TEST_BOND_FUND = "R"

PARTY = """
    SELECT c_custkey AS party_id, c_name AS name, c_nationkey AS nation_id, c_acctbal AS balance,
           c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey + 10000000, s_name, s_nationkey, s_acctbal, NULL FROM supplier"""
MASTER = """
    SELECT account_id, first_name, paternal_name, maternal_name, street, street_number, colony, municipality, zip,
           state, nss, curp, rfc
    FROM (
        SELECT CAST(NULLIF(regexp_replace(p.name, '[^0-9]', '', 'g'), '') AS BIGINT) AS account_id,
               p.name AS first_name, p.segment AS paternal_name,
               CASE WHEN p.balance > 0 THEN 'POSITIVE' END AS maternal_name,
               'STREET ' || CAST(p.nation_id AS VARCHAR) AS street, CAST(p.party_id AS VARCHAR) AS street_number,
               CASE WHEN p.nation_id < 5 THEN 'COL ' || s.r_name END AS colony, m.r_name AS municipality,
               CAST(n.n_nationkey + 10000 AS INTEGER) AS zip, n.n_name AS state,
               'NSS' || CAST(p.party_id AS VARCHAR) AS nss,
               CASE WHEN p.balance > 1000 THEN 'CURP' || CAST(p.party_id AS VARCHAR) END AS curp,
               CASE WHEN p.balance > 0 THEN 'RFC' || CAST(p.party_id AS VARCHAR) END AS rfc,
               ROW_NUMBER() OVER (PARTITION BY CAST(NULLIF(regexp_replace(p.name, '[^0-9]', '', 'g'), '') AS BIGINT)
                                  ORDER BY p.name, p.party_id) AS n
        FROM party p
        LEFT JOIN nation n ON n.n_nationkey = p.nation_id
        LEFT JOIN region m ON m.r_regionkey = n.n_regionkey
        LEFT JOIN region s ON s.r_regionkey = p.nation_id
        WHERE (p.segment IS NULL OR p.segment <> 'FURNITURE') AND p.balance >= -900 AND p.nation_id <> 24)
    WHERE n = 1"""
PROFILE = """
    SELECT account_id,
           MIN(CASE WHEN indicator_id = 1 THEN CASE code WHEN '66' THEN 'IMSS' WHEN '67' THEN 'ISSSTE'
                    WHEN '68' THEN 'INDEPENDIENTE' WHEN '69' THEN 'MIXTO' END END) AS origin,
           MIN(CASE WHEN indicator_id = 12 THEN CASE code WHEN '713' THEN 'Asignado' WHEN '714' THEN 'Afiliado' END
               END) AS client_type,
           MIN(CASE WHEN indicator_id = 2 THEN CASE code WHEN '1' THEN 'V' WHEN '0' THEN 'N' END END) AS validity,
           MIN(CASE WHEN indicator_id = 11 THEN CASE code WHEN '1' THEN 'TRUE' WHEN '0' THEN 'FALSE' END END)
               AS pension,
           CAST(MAX(CASE WHEN indicator_id = 1 THEN 1 ELSE 0 END) AS INTEGER) AS has_origin
    FROM account_indicator WHERE valid = 1 AND indicator_id IN (1, 2, 11, 12) GROUP BY 1"""
GENERATION = """
    SELECT h.account_id,
           CASE WHEN MAX(CASE WHEN s.label LIKE '%SAR%' OR s.label LIKE '%92%' THEN 1 ELSE 0 END) = 1 THEN 'AFORE'
                ELSE 'TRANSICION' END AS generation
    FROM balance_history h JOIN subaccount_type s ON s.subaccount_id = h.subaccount_id GROUP BY 1"""
PENSION = """
    SELECT o.o_custkey AS account_id, CASE o.o_orderstatus WHEN 'F' THEN 'JUBILACION' ELSE 'INVALIDEZ' END
               AS pension_type
    FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    WHERE o.o_orderpriority IN ('1-URGENT', '2-HIGH') AND o.o_orderstatus IN ('F', 'P')
      AND o.o_orderdate BETWEEN DATE '1998-03-01' AND DATE '1998-03-31' AND l.l_linenumber + 12 NOT IN (15, 16, 17, 18)"""
INVESTMENT = """
    SELECT c_custkey AS account_id, 'Perfil ' || CAST(n_regionkey AS VARCHAR) AS profile
    FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_regionkey < 4"""
BOND = "SELECT DISTINCT account_id FROM balance_history WHERE fund_id = 'R'"
CLASSIFIED = """
    SELECT i.account_id, COALESCE(i.pension = 'TRUE', FALSE) AS is_pension, i.client_type, i.origin, i.validity,
           COALESCE(g.generation, CASE WHEN i.origin = 'MIXTO' THEN 'MIXTO' END) AS generation,
           b.account_id IS NOT NULL AS is_bond, p.pension_type, v.profile, CAST(39 AS INTEGER) AS period_id
    FROM profile i
    LEFT JOIN generation g ON g.account_id = i.account_id
    LEFT JOIN bond b ON b.account_id = i.account_id
    LEFT JOIN (SELECT account_id, MIN(pension_type) AS pension_type FROM pension GROUP BY 1) p
           ON p.account_id = i.account_id
    LEFT JOIN (SELECT account_id, MIN(profile) AS profile FROM investment GROUP BY 1) v
           ON v.account_id = i.account_id
    WHERE i.has_origin = 1 AND i.account_id IN (SELECT account_id FROM client)"""
CLASSIFY_VIEWS = ("account_indicator", "balance_history", "subaccount_type", "client")
CLASSIFY_STEPS = {
    "profile": PROFILE,
    "generation": GENERATION,
    "pension": PENSION,
    "investment": INVESTMENT,
    "bond": BOND,
    "client_fact": CLASSIFIED,
}


def master(spark, folder):
    return clients.client_master(
        *(
            source(spark, folder)
            for source in (
                roles.contract, roles.contract_role, roles.person, roles.home, roles.address, roles.zip_code,
                roles.state, roles.municipality, roles.settlement, roles.identifier,
            )
        )
    )


def client_facts(spark, folder):
    catalog = roles.catalog(spark, folder)
    return clients.classify_clients(
        roles.client(spark, folder),
        roles.account_indicator(spark, folder),
        roles.indicator_config(spark, folder),
        clients.history_profile(
            roles.balance_history(spark, folder), roles.subaccount_type(spark, folder), TEST_BOND_FUND
        ),
        clients.pension_type(roles.payment(spark, folder), roles.payment_subaccount(spark, folder), catalog, TERM),
        clients.investment_profile(roles.investment_group(spark, folder), catalog),
        TERM,
    )


@register("client_master", with_views(MASTER, party=PARTY))
def client_master(spark, folder):
    return master(spark, folder)


INDICATORS = {
    "origin": (codes.INDICATOR_ORIGIN, codes.ORIGIN_LABELS),
    "client_type": (codes.INDICATOR_CLIENT_TYPE, codes.CLIENT_TYPE_LABELS),
    "validity": (codes.INDICATOR_VALIDITY, codes.VALIDITY_LABELS),
    "pension": (codes.INDICATOR_PENSION, codes.PENSION_LABELS),
}


def _indicator(name, indicator_id, labels):
    decoded = " ".join(f"WHEN '{code}' THEN '{label}'" for code, label in labels.items())
    sql = f"""
        SELECT DISTINCT account_id, CASE code {decoded} END AS value
        FROM account_indicator WHERE indicator_id = {indicator_id} AND valid = 1"""

    @register(f"indicator_{name}", with_views(sql, "account_indicator"))
    def query(spark, folder):
        return clients.indicator_values(
            roles.account_indicator(spark, folder), roles.indicator_config(spark, folder), indicator_id, labels
        )


for _name, (_indicator_id, _labels) in INDICATORS.items():
    _indicator(_name, _indicator_id, _labels)


@register("indicator_profile", with_views(PROFILE, "account_indicator"))
def indicator_profile(spark, folder):
    return clients.indicator_profile(roles.account_indicator(spark, folder), roles.indicator_config(spark, folder))


@register("client_generation", with_views(GENERATION, "balance_history", "subaccount_type"))
def client_generation(spark, folder):
    return clients.generation_of(roles.balance_history(spark, folder), roles.subaccount_type(spark, folder))


@register("bond_holders", with_views(BOND, "balance_history"))
def bond_holders(spark, folder):
    return clients.bond_holders(roles.balance_history(spark, folder), TEST_BOND_FUND)


@register("pension_type", PENSION.strip())
def pension_type(spark, folder):
    return clients.pension_type(
        roles.payment(spark, folder), roles.payment_subaccount(spark, folder), roles.catalog(spark, folder), TERM
    )


@register("investment_profile", INVESTMENT.strip())
def investment_profile(spark, folder):
    return clients.investment_profile(roles.investment_group(spark, folder), roles.catalog(spark, folder))


@register("client_classification", with_views("SELECT * FROM client_fact", *CLASSIFY_VIEWS, **CLASSIFY_STEPS))
def client_classification(spark, folder):
    return client_facts(spark, folder)
