"""How a query is registered, and the SQL forms of the domain tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tallyspark.operators.terms import Term

Query = Callable[[SparkSession, str], DataFrame]

TERM = Term(
    period_id=39,
    label="03/1998",
    start=date(1998, 3, 1),
    end=date(1998, 3, 31),
    next_start=date(1998, 4, 1),
    price_date=date(1998, 3, 31),
    previous_cutoff=date(1998, 3, 1),
    previous_price_date=date(1998, 2, 28),
)

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

VIEWS = {
    "order_lines": """
        SELECT * FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""",
    "period": """
        SELECT DISTINCT CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER) AS period_id,
               strftime(o_orderdate, '%m/%Y') AS period
        FROM orders""",
    "balance_history": """
        SELECT o_custkey AS account_id, l_returnflag AS fund_id, l_linestatus AS subaccount_id,
               o_orderdate AS settled_at, CAST(l_quantity AS DECIMAL(18,6)) AS units
        FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""",
    "subaccount_type": """
        SELECT * FROM (VALUES ('F', 1, 'RCV 92'), ('O', 2, 'VIV 97')) AS t(subaccount_id, regime_id, label)""",
    "share_price": """
        SELECT l_returnflag AS fund_id, CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END AS regime_id,
               CAST(l_shipdate AS DATE) AS price_date, MAX(CAST(l_extendedprice AS DECIMAL(18,2))) AS price
        FROM lineitem GROUP BY 1, 2, 3""",
    "movement": """
        SELECT o_custkey AS account_id,
               CASE l_returnflag WHEN 'A' THEN 180 WHEN 'R' THEN 181 ELSE 182 END AS type_id,
               l_linenumber AS concept_id, l_linestatus AS subaccount_id, l_returnflag AS fund_id,
               l_orderkey AS folio, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_shipdate AS settled_at,
               l_linenumber AS family
        FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""",
    "commission_src": """
        SELECT o_custkey AS account_id, l_linenumber AS concept_id, l_shipdate AS settled_at,
               CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(6,2)) AS amount
        FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""",
    "concept_subaccount": """
        SELECT * FROM (VALUES (1, 'F'), (2, 'F'), (3, 'F'), (4, 'O'), (5, 'O'), (6, 'O'), (7, 'O'))
        AS t(concept_id, subaccount_id)""",
    "concept_bridge": """
        SELECT * FROM (VALUES (1, 101), (2, 101), (3, 102), (4, 102), (5, 103), (6, 104), (7, 104))
        AS t(concept_id, regulator_id)""",
    "regulator_concept": """
        SELECT * FROM (VALUES (101, 'APORTACION', 'AHO'), (102, 'RETIRO', 'AHO'), (103, 'TRASPASO', 'VIV'),
                              (104, 'AJUSTE', 'VIV')) AS t(regulator_id, description, section)""",
    "fund": """
        SELECT * FROM (VALUES ('A', 'BASICA A'), ('N', 'BASICA N'), ('R', 'BASICA R')) AS t(fund_id, description)""",
    "sample_quota": """
        SELECT * FROM (VALUES (101, 5), (102, 3), (103, 4), (104, 2)) AS t(regulator_id, quantity)""",
    "account_indicator": """
        SELECT user_id AS account_id, event_id,
               CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 12 WHEN 'purchase' THEN 11 WHEN 'signup' THEN 2
                    ELSE 99 END AS indicator_id,
               CAST(CASE event_type WHEN 'view' THEN 66 + event_id % 4 WHEN 'click' THEN 713 + event_id % 2
                         ELSE event_id % 2 END AS VARCHAR) AS code,
               CASE WHEN event_id % 10 = 0 THEN 0 ELSE 1 END AS valid
        FROM events""",
    "client": """
        SELECT c_custkey AS account_id, c_name AS contract_number, c_mktsegment AS segment, n_name AS state,
               r_name AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "movement_wide": """
        SELECT l_orderkey AS folio, l_linenumber AS code, CAST(l_suppkey AS INTEGER) AS fund_id,
               CASE WHEN l_returnflag IN ('A', 'N') THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END AS slot_1,
               CASE WHEN l_returnflag IN ('R', 'N') THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END AS slot_3
        FROM lineitem""",
    "switch": """
        SELECT * FROM (VALUES (1, 1, 11, 1), (1, 3, 13, 2), (2, 1, 21, 3), (3, 3, 33, 4), (9, 1, 91, 5))
        AS t(code, slot, subaccount_id, ordinal)""",
}


def with_views(body: str, *names: str, **extra: str) -> str:
    """Prefix a statement with the domain tables it uses. A body may start with its own ``WITH``."""
    ctes = [f"{name} AS ({VIEWS[name].strip()})" for name in names]
    ctes += [f"{name} AS ({text.strip()})" for name, text in extra.items()]
    body = body.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL counterpart unless it has none."""

    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return add
