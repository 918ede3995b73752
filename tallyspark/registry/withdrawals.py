"""Withdrawals and their figures. The SQL ranks after multiplying every settlement by three procedure sources."""

from __future__ import annotations

from tallyspark.operators import numbering, withdrawals
from tallyspark.registry.base import TERM, register, with_views
from tallyspark.sources import roles

REQUEST = """
    SELECT folio, account_id, process_id, subprocess_id, status_id, created_at
    FROM (SELECT o_orderkey AS folio, o_custkey AS account_id,
                 CASE o_orderpriority WHEN '5-LOW' THEN 4060 WHEN '1-URGENT' THEN 4050 ELSE 4045 END AS process_id,
                 CASE o_orderstatus WHEN 'F' THEN 309 ELSE 310 END AS subprocess_id,
                 CASE o_orderstatus WHEN 'O' THEN 6600 ELSE 6649 END AS status_id,
                 CASE WHEN o_totalprice > 450000 THEN '0' ELSE '1' END AS grouped, o_orderdate AS created_at
          FROM orders)
    WHERE grouped = '1' AND status_id = 6649 AND process_id BETWEEN 4045 AND 4051
      AND created_at BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'"""
SETTLED = """
    SELECT r.*, m.subaccount_id, m.fund_id, m.paid
    FROM request r
    LEFT JOIN (SELECT l_orderkey AS folio, l_linenumber + 12 AS subaccount_id, l_returnflag AS fund_id,
                      CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) AS paid
               FROM orders JOIN lineitem ON o_orderkey = l_orderkey
               WHERE o_orderdate BETWEEN DATE '1998-03-01' AND DATE '1998-03-31') m ON m.folio = r.folio"""
PROCEDURE_MAP = """
    SELECT * FROM (VALUES (1, 'T97', 11, 'Trabajador 97'), (2, 'TRU', 12, 'Trabajador RU'), (3, 'XXX', 13, 'Otro'),
                          (4, 'TNP', 14, 'Negativa'))
    AS t(new_code, procedure_name, procedure_legacy_code, procedure_description)"""
CANDIDATE = """
    SELECT s.*, c.branch, c.procedure_type, c.benefit_type, c.regime_code, c.transfer_regime, p.procedure_name,
           p.procedure_legacy_code, p.procedure_description
    FROM (SELECT s.*, b.branch FROM settled s, (VALUES (0), (1), (2)) AS b(branch)) s
    LEFT JOIN (
        SELECT 0 AS branch, o_orderkey AS folio, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS procedure_type,
               o_orderpriority AS benefit_type, '73' AS regime_code, NULL AS transfer_regime
        FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT 1, o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 2, NULL, NULL, 'CUR'
        FROM orders WHERE o_orderstatus = 'P'
        UNION ALL SELECT 2, o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER), NULL, NULL, 'HIST'
        FROM orders WHERE o_orderstatus = 'P') c ON c.folio = s.folio AND c.branch = s.branch
    LEFT JOIN procedure_map p ON p.new_code = c.procedure_type"""
FIRST = """
    SELECT * EXCLUDE (n) FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY folio ORDER BY procedure_name IS NULL, branch,
                                     account_id NULLS LAST, subaccount_id NULLS LAST, fund_id NULLS LAST,
                                     paid NULLS LAST, procedure_name NULLS LAST) AS n
        FROM candidate)
    WHERE n = 1 AND procedure_name IN ('T97', 'TRU', 'TNP')"""
HISTORY = """
    SELECT o_custkey AS account_id, l_returnflag AS fund_id, l_linenumber + 12 AS subaccount_id,
           o_orderdate AS settled_at, CAST(l_quantity AS DECIMAL(18,6)) AS units
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""
BALANCE = """
    SELECT h.account_id, h.subaccount_id, CAST(SUM(h.units * p.price) AS DECIMAL(18,4)) AS balance
    FROM history h
    JOIN (SELECT account_id, fund_id, subaccount_id, MAX(CAST(settled_at AS DATE)) AS day
          FROM history
          WHERE settled_at <= (SELECT MIN(settled_at) FROM history WHERE settled_at > DATE '1998-03-31')
          GROUP BY 1, 2, 3) l
      ON l.account_id = h.account_id AND l.fund_id = h.fund_id AND l.subaccount_id = h.subaccount_id
     AND l.day = CAST(h.settled_at AS DATE)
    JOIN (VALUES (13, 1), (14, 2), (15, 2), (16, 2), (17, 1), (18, 1), (19, 1)) AS s(subaccount_id, regime_id)
      ON s.subaccount_id = h.subaccount_id
    JOIN (SELECT fund_id, regime_id, price,
                 ROW_NUMBER() OVER (PARTITION BY fund_id, regime_id ORDER BY price_date DESC) AS n
          FROM share_price WHERE price_date <= DATE '1998-03-31') p
      ON p.fund_id = h.fund_id AND p.regime_id = s.regime_id AND p.n = 1
    GROUP BY 1, 2"""
PAYMENT = """
    SELECT o_orderkey AS folio,
           CAST(CASE o_orderstatus WHEN 'F' THEN 309 WHEN 'P' THEN 310 ELSE 311 END AS INTEGER) AS payment_subprocess_id,
           CAST(CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END AS INTEGER) AS pay_type_id,
           'L' || CAST(o_orderkey AS VARCHAR) AS settlement_folio,
           CAST(ROUND(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS tax,
           CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 40012 WHEN '2-HIGH' THEN 40014 END AS INTEGER) AS bank_code,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'BANCO UNO' WHEN '2-HIGH' THEN 'BANCO DOS' END AS bank_name,
           CASE o_orderstatus WHEN 'F' THEN 'TRANSFERENCIA' ELSE 'CHEQUE' END AS pay_medium
    FROM orders WHERE o_orderdate BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'"""
WITHDRAWAL = """
    SELECT f.folio, f.account_id, f.process_id, f.subprocess_id, f.status_id, f.created_at, f.subaccount_id, f.fund_id,
           f.paid, f.procedure_type, f.benefit_type, f.regime_code, f.transfer_regime, f.procedure_name,
           f.procedure_legacy_code, f.procedure_description, y.payment_subprocess_id, y.pay_type_id,
           y.settlement_folio, y.tax, y.bank_code, y.bank_name, y.pay_medium, b.balance,
           CAST(CASE f.subaccount_id WHEN 14 THEN 0 WHEN 15 THEN 2 WHEN 16 THEN 2 ELSE 1 END AS INTEGER)
               AS savings_type,
           CAST(39 AS INTEGER) AS period_id
    FROM first_row f
    LEFT JOIN payment y ON y.folio = f.folio
    LEFT JOIN balance b ON b.account_id = f.account_id AND b.subaccount_id = f.subaccount_id"""
STEPS = {
    "request": REQUEST,
    "settled": SETTLED,
    "procedure_map": PROCEDURE_MAP,
    "candidate": CANDIDATE,
    "first_row": FIRST,
    "history": HISTORY,
    "balance": BALANCE,
    "payment": PAYMENT,
    "withdrawal": WITHDRAWAL,
}


def withdrawn(spark, folder):
    return withdrawals.withdrawals(
        current_requests=roles.settled_request(spark, folder, historic=False),
        historic_requests=roles.settled_request(spark, folder, historic=True),
        movements=roles.withdrawal_movement(spark, folder),
        procedures=roles.procedure(spark, folder),
        transfers=roles.transfer(spark, folder, historic=False),
        historic_transfers=roles.transfer(spark, folder, historic=True),
        procedure_map=roles.procedure_map(spark, folder),
        payments=roles.payment(spark, folder),
        catalog=roles.catalog(spark, folder),
        history=roles.withdrawal_history(spark, folder),
        subaccounts=roles.withdrawal_subaccount(spark, folder),
        prices=roles.share_price(spark, folder),
        term=TERM,
    )


@register("withdrawals", with_views("SELECT * FROM withdrawal", "share_price", **STEPS))
def withdrawals_query(spark, folder):
    return withdrawn(spark, folder)


@register(
    "withdrawal_figures",
    with_views(
        """
        SELECT * EXCLUDE (balance, savings_type, paid, tax),
               CAST(ROUND(paid, 2) AS DECIMAL(18,2)) AS paid, CAST(ROUND(tax, 2) AS DECIMAL(18,2)) AS tax,
               CAST(ROUND(balance, 2) AS DECIMAL(18,2)) AS remaining,
               CAST(ROUND(balance, 2) + ROUND(paid, 2) + ROUND(tax, 2) AS DECIMAL(18,2)) AS opening,
               CASE savings_type WHEN 1 THEN 'RET' ELSE 'VIV' END AS savings,
               ROW_NUMBER() OVER (ORDER BY account_id, folio) AS id
        FROM withdrawal
        """,
        "share_price",
        **STEPS,
    ),
)
def withdrawal_figures(spark, folder):
    return withdrawals.withdrawal_figures(withdrawn(spark, folder), TERM)


@register(
    "pages",
    """
    SELECT o_orderkey, o_custkey, id, id // 1000 AS page
    FROM (SELECT o_orderkey, o_custkey, ROW_NUMBER() OVER (ORDER BY o_custkey, o_orderkey) AS id FROM orders)
    """,
)
def pages(spark, folder):
    orders = roles.table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return numbering.page_rows(numbering.number_rows(orders, ["o_custkey", "o_orderkey"]), 1000)
