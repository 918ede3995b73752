"""Statement formats, headers, fronts, backs and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.functions.calendar import is_due, lookback_start, period_start
from tallyspark.operators import statements
from tallyspark.plans import running_sums
from tallyspark.plans.statements import StatementConfig, build_statements
from tallyspark.plans.warehouse import Warehouse
from tallyspark.registry.base import TERM, register, with_views
from tallyspark.registry.clients import CLASSIFY_STEPS, CLASSIFY_VIEWS, MASTER, PARTY, client_facts, master
from tallyspark.sources import roles
from tallyspark.sources.shared import new_table_path

URL_BASE = "https://example.org/statements/"

FORMAT = """
    SELECT f.format_id, f.generation_id, 1 AS generation_months, a.months AS front_months, b.months AS back_months,
           o.value AS origin_code, x.value AS affiliation_code
    FROM (SELECT 10 * g + n AS format_id, g AS generation_id, front, back, origin, affiliation
          FROM (VALUES (2), (3)) AS t(g)
          CROSS JOIN (VALUES (0, 3, 4, 1, 5), (1, 3, 1, 2, 6), (2, 2, 2, 3, 5), (3, 4, 3, 4, 6), (4, 1, 1, 1, 7),
                             (6, 2, 2, 1, 6))
                     AS u(n, front, back, origin, affiliation)) f
    JOIN (VALUES (1, 1), (2, 2), (3, 3), (4, 12)) AS a(id, months) ON a.id = f.front
    JOIN (VALUES (1, 1), (2, 2), (3, 3), (4, 12)) AS b(id, months) ON b.id = f.back
    JOIN (VALUES (1, 66), (2, 67), (3, 68), (4, 69), (5, 713), (6, 714), (7, 1)) AS o(id, value) ON o.id = f.origin
    JOIN (VALUES (1, 66), (2, 67), (3, 68), (4, 69), (5, 713), (6, 714), (7, 1)) AS x(id, value)
         ON x.id = f.affiliation"""
CHOSEN = """
    SELECT c.*, f.format_id, f.generation_id, f.generation_months, f.front_months, f.back_months
    FROM client_fact c
    JOIN format f
      ON f.generation_id = CASE c.generation WHEN 'AFORE' THEN 2 WHEN 'TRANSICION' THEN 3 END
     AND f.origin_code = CASE c.origin WHEN 'ISSSTE' THEN 67 WHEN 'IMSS' THEN 66 WHEN 'MIXTO' THEN 69
                                       WHEN 'INDEPENDIENTE' THEN 68 END
     AND f.affiliation_code = CASE WHEN c.client_type = 'Afiliado' THEN 714 WHEN c.client_type = 'Asignado' THEN 713
                                   WHEN c.is_pension THEN 1 END"""
PERIOD_DATE = "CAST(strptime('01/' || p.period, '%d/%m/%Y') AS DATE)"
RETURN_HISTORY = """
    SELECT o_custkey AS account_id,
           CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS INTEGER) AS period_id,
           l_linestatus AS subaccount_id,
           SUM(CAST(l_quantity AS DECIMAL(18,2))) AS initial,
           SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS final,
           SUM(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS credit,
           SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS charge,
           SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(6,2))) AS commission
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2, 3"""
WINDOWED = f"""
    SELECT r.*, {PERIOD_DATE} AS starts FROM return_history r JOIN period p ON p.period_id = r.period_id"""
BOUNDS = """
    SELECT m.front_months, MIN(w.period_id) AS first_period, MAX(w.period_id) AS last_period
    FROM (SELECT DISTINCT front_months FROM chosen) m
    JOIN (SELECT DISTINCT period_id, starts FROM windowed) w
      ON w.starts BETWEEN DATE '1998-03-01' - to_months(m.front_months) AND DATE '1998-03-31'
    GROUP BY 1"""
LINE = """
    SELECT * FROM (VALUES
        (2, 'RETIRO', 'AHORRO PARA EL RETIRO', 'AHO', ['F']), (2, 'TOTAL', 'TODAS LAS SUBCUENTAS', 'TOT', ['F', 'O']),
        (3, 'VIVIENDA', 'AHORRO PARA VIVIENDA', 'VIV', ['O']), (3, 'RETIRO', 'AHORRO PARA EL RETIRO', 'AHO', ['F', 'O']),
        (3, 'VOLUNTARIO', 'AHORRO VOLUNTARIO', 'AHO', ['X']))
    AS t(generation_id, savings_type, concept, section, subaccounts)"""
FRONT_SUM = """
    SELECT c.account_id, c.format_id, l.savings_type, l.concept, l.section,
           CAST(SUM(CASE WHEN list_contains(l.subaccounts, w.subaccount_id) THEN w.credit ELSE 0 END)
                AS DECIMAL(16,2)) AS contribution,
           CAST(SUM(CASE WHEN list_contains(l.subaccounts, w.subaccount_id) THEN w.charge ELSE 0 END)
                AS DECIMAL(16,2)) AS withdrawal,
           CAST(SUM(CASE WHEN list_contains(l.subaccounts, w.subaccount_id) THEN w.commission ELSE 0 END)
                AS DECIMAL(16,2)) AS commission,
           CAST(SUM(CASE WHEN list_contains(l.subaccounts, w.subaccount_id) AND w.period_id = b.first_period
                         THEN w.initial ELSE 0 END) AS DECIMAL(16,2)) AS initial,
           CAST(SUM(CASE WHEN list_contains(l.subaccounts, w.subaccount_id) AND w.period_id = b.last_period
                         THEN w.final ELSE 0 END) AS DECIMAL(16,2)) AS final
    FROM chosen c
    JOIN bounds b ON b.front_months = c.front_months
    JOIN line l ON l.generation_id = c.generation_id
    JOIN windowed w ON w.account_id = c.account_id
     AND w.starts BETWEEN DATE '1998-03-01' - to_months(c.front_months) AND DATE '1998-03-31'
    GROUP BY 1, 2, 3, 4, 5"""
FRONT = """
    SELECT *, CAST(final - (contribution + initial - commission - withdrawal) AS DECIMAL(16,2)) AS computed_return,
           CAST(0 AS DECIMAL(16,2)) AS current_value, CAST(0 AS DECIMAL(16,6)) AS current_value_udi,
           CAST(0 AS DECIMAL(16,2)) AS nominal_value, CAST(0 AS DECIMAL(16,6)) AS nominal_value_udi,
           CAST(1 AS INTEGER) AS pension_type, CAST(0 AS DECIMAL(16,2)) AS pension_amount, '0' AS created_by
    FROM front_sum"""
HEADER_BASE = """
    SELECT CAST(CAST(c.account_id AS VARCHAR) || '199803' || CAST(c.format_id AS VARCHAR) AS BIGINT) AS statement_id,
           c.generation_id AS segment_id, 'CANDADO' AS lock, c.format_id, c.period_id, c.account_id,
           DATE '1998-03-31' AS cutoff_date,
           CAST(DATE '1998-03-01' - to_months(c.back_months - 1) AS DATE) AS general_start,
           DATE '1998-03-31' AS general_end,
           CAST(DATE '1998-03-01' - to_months(c.front_months - 1) AS DATE) AS movement_start,
           DATE '1998-03-31' AS movement_end, CAST(0 AS INTEGER) AS fund_id, c.profile AS fund_description,
           c.generation AS generation_description,
           concat_ws(' ', m.first_name, m.paternal_name, m.maternal_name) AS full_name, m.street, m.colony,
           m.municipality, m.zip, m.state, m.nss, m.rfc, m.curp
    FROM chosen c JOIN master m ON m.account_id = c.account_id"""
HEADER = """
    SELECT h.*, s.subtotal, s.total, '0' AS created_by
    FROM (SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY statement_id) AS VARCHAR) AS folio FROM header_base) h
    JOIN (SELECT account_id, format_id,
                 CAST(SUM(CASE WHEN section = 'AHO' THEN final END) AS DECIMAL(18,2)) AS subtotal,
                 CAST(SUM(final) AS DECIMAL(18,2)) AS total,
                 MAX(CASE WHEN section = 'AHO' THEN 1 ELSE 0 END) AS has_savings
          FROM front GROUP BY 1, 2) s
      ON s.account_id = h.account_id AND s.format_id = h.format_id AND s.has_savings = 1"""
BACK = f"""
    SELECT c.account_id, c.format_id, k.section, k.regulator_id, k.description, m.settled_at,
           CAST(SUM(m.amount) AS DECIMAL(18,2)) AS amount, 'Desconocido' AS reference_period,
           CAST(0 AS INTEGER) AS days_paid, CAST(0 AS DECIMAL(18,2)) AS base_salary, '0' AS created_by
    FROM chosen c
    JOIN movement m ON m.account_id = c.account_id
    JOIN (SELECT p.period_id, {PERIOD_DATE} AS starts FROM period p) t
      ON t.period_id = (year(m.settled_at) - 1995) * 12 + month(m.settled_at)
    JOIN concept_bridge b ON b.concept_id = m.concept_id
    JOIN regulator_concept k ON k.regulator_id = b.regulator_id
    WHERE month(t.starts) % c.generation_months = 0
      AND t.starts BETWEEN DATE '1998-03-01' - to_months(c.back_months - 1) AND DATE '1998-03-31'
    GROUP BY 1, 2, 3, 4, 5, 6"""
VIEWS = (*CLASSIFY_VIEWS, "period", "movement", "concept_bridge", "regulator_concept")
STEPS = {
    **CLASSIFY_STEPS,
    "party": PARTY,
    "master": MASTER,
    "format": FORMAT,
    "chosen": CHOSEN,
    "return_history": RETURN_HISTORY,
    "windowed": WINDOWED,
    "bounds": BOUNDS,
    "line": LINE,
    "front_sum": FRONT_SUM,
    "front": FRONT,
    "header_base": HEADER_BASE,
    "header": HEADER,
    "back": BACK,
}


def formats(spark, folder):
    return statements.statement_formats(
        roles.statement_format(spark, folder), roles.periodicity(spark, folder), roles.format_indicator(spark, folder)
    )


def chosen(spark, folder):
    """Every classified client with a matching format; the sample is all clients."""
    return statements.client_formats(client_facts(spark, folder), formats(spark, folder), None, TERM)


def front(spark, folder):
    return statements.statement_front(
        roles.return_fact(spark, folder),
        chosen(spark, folder),
        formats(spark, folder),
        roles.front_line(spark, folder),
        roles.period(spark, folder),
        TERM,
    ).drop("created_at")


def products(spark, folder):
    """All statement products, for every client."""
    config = StatementConfig(
        formats=roles.statement_format(spark, folder),
        periodicity=roles.periodicity(spark, folder),
        format_indicators=roles.format_indicator(spark, folder),
        lines=roles.front_line(spark, folder),
        bridge=roles.concept_bridge(spark, folder),
        regulator_concepts=roles.regulator_concept(spark, folder),
        periods=roles.period(spark, folder),
    )
    return build_statements(
        client_facts(spark, folder), master(spark, folder), roles.return_fact(spark, folder),
        roles.dated_movement(spark, folder), config, None, TERM,
    )


@register(
    "due_periods",
    with_views(
        f"""
        SELECT p.period_id, m.months, month({PERIOD_DATE}) % m.months = 0 AS is_due
        FROM period p, (VALUES (1), (2), (3), (4), (6), (12)) AS m(months)
        """,
        "period",
    ),
)
def due_periods(spark, folder):
    every = F.explode(F.array(*(F.lit(n) for n in (1, 2, 3, 4, 6, 12))))
    periods = roles.period(spark, folder).withColumn("months", every)
    return periods.select(
        "period_id", "months", is_due(period_start(F.col("period")), F.col("months")).alias("is_due")
    )


@register(
    "lookback_windows",
    with_views(
        f"""
        SELECT p.period_id, m.months, CAST({PERIOD_DATE} - to_months(m.months - 1) AS DATE) AS inclusive_start,
               CAST({PERIOD_DATE} - to_months(m.months) AS DATE) AS opening_start
        FROM period p, (VALUES (1), (2), (3), (12)) AS m(months)
        """,
        "period",
    ),
)
def lookback_windows(spark, folder):
    every = F.explode(F.array(*(F.lit(n) for n in (1, 2, 3, 12))))
    starts, months = period_start(F.col("period")), F.col("months")
    return roles.period(spark, folder).withColumn("months", every).select(
        "period_id", "months", lookback_start(starts, months).alias("inclusive_start"),
        lookback_start(starts, months, inclusive=False).alias("opening_start"),
    )


@register("statement_formats_of_clients", with_views("SELECT * FROM chosen", *VIEWS, **STEPS))
def statement_formats_of_clients(spark, folder):
    return chosen(spark, folder)


@register("statement_front", with_views("SELECT * FROM front", *VIEWS, **STEPS))
def statement_front(spark, folder):
    return front(spark, folder)


@register("statement_front_from_sums", with_views("SELECT * FROM front", *VIEWS, **STEPS))
def statement_front_from_sums(spark, folder):
    """The front from running sums at the ends of its windows, after five loads have advanced them."""
    store = Warehouse(spark, new_table_path(spark, "sums"))
    roles.return_fact(spark, folder).write.partitionBy("period_id").parquet(store.path("return_fact"))
    returns, shapes = store.table("return_fact"), formats(spark, folder)
    lengths = [row[0] for row in shapes.select("front_months").distinct().collect()]
    for period_id in sorted({TERM.period_id - months - 1 for months in lengths}) + [TERM.period_id]:
        running_sums.advance_sums(store, returns, period_id)
    windows = statements.front_windows(
        shapes, roles.period(spark, folder), TERM, store.periods("return_fact"), store.periods(running_sums.SUMS)
    )
    return statements.statement_front_from_sums(
        returns, store.table(running_sums.SUMS), windows, chosen(spark, folder), roles.front_line(spark, folder), TERM
    ).drop("created_at")


@register("statement_front_clustered", with_views("SELECT * FROM front", *VIEWS, **STEPS))
def statement_front_clustered(spark, folder):
    """The front over returns and formats that are stored clustered by account."""
    store = Warehouse(spark, new_table_path(spark, "clustered"))
    facts = store.cluster("return_fact", roles.return_fact(spark, folder), "account_id", 8, "period_id")
    of_clients = store.cluster("chosen", chosen(spark, folder), "account_id", 8)
    return statements.statement_front(
        facts, of_clients, formats(spark, folder), roles.front_line(spark, folder), roles.period(spark, folder), TERM
    ).drop("created_at")


@register("statement_header", with_views("SELECT * FROM header", *VIEWS, **STEPS))
def statement_header(spark, folder):
    return products(spark, folder).header.drop("created_at")


@register(
    "statement_front_with_id",
    with_views(
        """
        SELECT f.*, h.statement_id
        FROM front f JOIN header h ON h.account_id = f.account_id AND h.format_id = f.format_id
        """,
        *VIEWS,
        **STEPS,
    ),
)
def statement_front_with_id(spark, folder):
    return products(spark, folder).front.drop("created_at")


@register(
    "statement_ids",
    with_views(
        """
        SELECT account_id, format_id, statement_id, CAST(ROW_NUMBER() OVER (ORDER BY statement_id) AS VARCHAR) AS folio
        FROM header_base
        """,
        *VIEWS,
        **STEPS,
    ),
)
def statement_ids(spark, folder):
    base = statements.header_base(chosen(spark, folder), master(spark, folder), TERM)
    return statements.with_folio(base.select("account_id", "format_id", "statement_id"))


@register(
    "statement_back",
    with_views(
        """
        SELECT b.*, h.statement_id FROM back b
        JOIN header h ON h.account_id = b.account_id AND h.format_id = b.format_id
        WHERE b.account_id IN (SELECT account_id FROM front)
        """,
        *VIEWS,
        **STEPS,
    ),
)
def statement_back(spark, folder):
    return products(spark, folder).back.drop("created_at")


@register(
    "sample_links",
    with_views(
        f"""
        SELECT s.account_id, s.period_id, s.status, s.user_id, s.area_id, '{URL_BASE}' || h.folio || '.pdf' AS url
        FROM (SELECT c_custkey AS account_id, CAST(39 AS INTEGER) AS period_id, 'Pendiente' AS status,
                     CAST(34 AS INTEGER) AS user_id, CAST(5 AS INTEGER) AS area_id
              FROM customer WHERE c_mktsegment = 'BUILDING') s
        RIGHT JOIN header h ON h.account_id = s.account_id
        """,
        *VIEWS,
        **STEPS,
    ),
)
def sample_links(spark, folder):
    sample = roles.table(spark, folder, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("account_id"), F.lit(TERM.period_id).alias("period_id"),
        F.lit("Pendiente").alias("status"), F.lit(34).alias("user_id"), F.lit(5).alias("area_id"),
    )
    return statements.sample_links(sample, products(spark, folder).header, TERM, URL_BASE)


SAMPLE_ROWS = """
    SELECT c_custkey AS account_id, CAST(39 AS INTEGER) AS period_id, CAST(34 AS INTEGER) AS user_id,
           CAST(5 AS INTEGER) AS area_id, 'Pendiente' AS status, 'none' AS url
    FROM customer WHERE c_mktsegment = 'BUILDING'"""


def sample_rows(spark, folder):
    """A stored sample: the clients of one segment."""
    return roles.table(spark, folder, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("account_id"), F.lit(TERM.period_id).alias("period_id"), F.lit(34).alias("user_id"),
        F.lit(5).alias("area_id"), F.lit("Pendiente").alias("status"), F.lit("none").alias("url"),
    )


@register(
    "statement_sample_update",
    with_views(
        f"""
        SELECT s.account_id, s.period_id, s.user_id, s.area_id, s.status,
               COALESCE('{URL_BASE}' || h.folio || '.pdf', s.url) AS url
        FROM sample_rows s LEFT JOIN header h ON h.account_id = s.account_id
        """,
        *VIEWS,
        **STEPS,
        sample_rows=SAMPLE_ROWS,
    ),
)
def statement_sample_update(spark, folder):
    return statements.sample_update(sample_rows(spark, folder), products(spark, folder).header, TERM, URL_BASE)


@register(
    "statement_formats_of_sample",
    with_views(
        "SELECT * FROM chosen WHERE account_id IN (SELECT account_id FROM sample_rows)",
        *VIEWS,
        **STEPS,
        sample_rows=SAMPLE_ROWS,
    ),
)
def statement_formats_of_sample(spark, folder):
    return statements.client_formats(
        client_facts(spark, folder), formats(spark, folder), sample_rows(spark, folder), TERM
    )


ALL_FLOWS = FRONT_SUM.replace(
    """     AND w.starts BETWEEN DATE '1998-03-01' - to_months(c.front_months) AND DATE '1998-03-31'
""",
    "",
)


@register(
    "statement_front_all_flows",
    with_views(
        "SELECT * FROM front", *VIEWS, **{**STEPS, "front_sum": ALL_FLOWS},
    ),
)
def statement_front_all_flows(spark, folder):
    """Contributions, withdrawals and commissions of all periods."""
    return statements.statement_front(
        roles.return_fact(spark, folder), chosen(spark, folder), formats(spark, folder),
        roles.front_line(spark, folder), roles.period(spark, folder), TERM, flows_in_window=False,
    ).drop("created_at")
