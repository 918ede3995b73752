"""Terms, as-of lookups and balances."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import terms, valuation
from tallyspark.operators.asof import asof_join
from tallyspark.plans import balance_state
from tallyspark.plans.warehouse import Warehouse
from tallyspark.registry.base import TERM, register, with_views
from tallyspark.sources import roles
from tallyspark.sources.shared import new_table_path

BALANCES = """
    latest AS (
        SELECT account_id, fund_id, subaccount_id, MAX(CAST(settled_at AS DATE)) AS day
        FROM balance_history
        WHERE settled_at <= (SELECT MIN(settled_at) FROM balance_history WHERE settled_at > DATE '1998-04-01')
        GROUP BY 1, 2, 3),
    price AS (
        SELECT fund_id, regime_id, price_date, price,
               ROW_NUMBER() OVER (PARTITION BY fund_id, regime_id ORDER BY price_date DESC) AS n
        FROM share_price WHERE price_date <= DATE '1998-03-31'),
    balance AS (
        SELECT h.account_id, h.fund_id, h.subaccount_id, h.settled_at, 'F' AS kind, MAX(p.price_date) AS price_date,
               CAST(ROUND(SUM(h.units), 6) AS DECIMAL(18,6)) AS units,
               CAST(ROUND(SUM(h.units * p.price), 2) AS DECIMAL(18,2)) AS amount
        FROM balance_history h
        JOIN subaccount_type s ON s.subaccount_id = h.subaccount_id
        JOIN latest l ON l.account_id = h.account_id AND l.fund_id = h.fund_id
                     AND l.subaccount_id = h.subaccount_id AND l.day = CAST(h.settled_at AS DATE)
        JOIN price p ON p.fund_id = h.fund_id AND p.regime_id = s.regime_id AND p.n = 1
        WHERE h.settled_at <= (SELECT MIN(settled_at) FROM balance_history WHERE settled_at > DATE '1998-04-01')
        GROUP BY h.account_id, h.fund_id, h.subaccount_id, h.settled_at)"""
BALANCE_VIEWS = ("balance_history", "subaccount_type", "share_price")


def balances(spark, folder):
    """Closing balances of the period: cut-off strictly after the next period start, price as of its end."""
    history = roles.balance_history(spark, folder)
    return valuation.value_balances(
        history,
        roles.subaccount_type(spark, folder),
        roles.share_price(spark, folder),
        cutoff=valuation.cutoff_date(history, TERM.next_start).scalar(),
        price_date=F.lit(TERM.price_date),
    )


@register(
    "term_calendar",
    with_views(
        """
        SELECT period_id, period, start_date, last_day(start_date) AS end_date,
               CAST(start_date + INTERVAL 1 MONTH AS DATE) AS next_start, last_day(start_date) AS price_date,
               start_date AS previous_cutoff, CAST(start_date - INTERVAL 1 DAY AS DATE) AS previous_price_date
        FROM (SELECT period_id, period, CAST(strptime('01/' || period, '%d/%m/%Y') AS DATE) AS start_date FROM period)
        """,
        "period",
    ),
)
def term_calendar(spark, folder):
    return terms.term_dates(roles.period(spark, folder))


@register(
    "period_stamp",
    with_views(
        """
        SELECT *, CAST(39 AS INTEGER) AS period_id FROM movement
        WHERE settled_at BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'
        """,
        "movement",
    ),
)
def period_stamp(spark, folder):
    movements = roles.movement(spark, folder).filter(TERM.covers(F.col("settled_at")))
    return terms.stamp_period(movements, TERM.period_id)


@register(
    "cutoff_date",
    with_views("SELECT MIN(settled_at) AS cutoff FROM balance_history WHERE settled_at > DATE '1998-04-01'",
               "balance_history"),
)
def cutoff(spark, folder):
    return valuation.cutoff_date(roles.balance_history(spark, folder), TERM.next_start)


@register(
    "latest_balance_rows",
    with_views(
        """
        SELECT h.* FROM balance_history h
        JOIN (SELECT account_id, fund_id, subaccount_id, MAX(CAST(settled_at AS DATE)) AS day
              FROM balance_history WHERE settled_at <= DATE '1998-03-01' GROUP BY 1, 2, 3) l
          ON l.account_id = h.account_id AND l.fund_id = h.fund_id AND l.subaccount_id = h.subaccount_id
         AND l.day = CAST(h.settled_at AS DATE)
        WHERE h.settled_at <= DATE '1998-03-01'
        """,
        "balance_history",
    ),
)
def latest_balance_rows(spark, folder):
    return valuation.latest_per_group(roles.balance_history(spark, folder), F.lit(TERM.previous_cutoff))


@register(
    "price_as_of",
    with_views(
        """
        SELECT fund_id, regime_id, price_date, price
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY fund_id, regime_id ORDER BY price_date DESC) AS n
              FROM share_price WHERE price_date <= DATE '1998-03-31')
        WHERE n = 1
        """,
        "share_price",
    ),
)
def price_as_of(spark, folder):
    return valuation.price_as_of(roles.share_price(spark, folder), F.lit(TERM.price_date))


@register("balances", with_views(f"WITH {BALANCES} SELECT * FROM balance", *BALANCE_VIEWS))
def balances_query(spark, folder):
    return balances(spark, folder)


NEWEST = "(SELECT MAX(settled_at) FROM balance_history)"


@register(
    "balances_newest_period",
    with_views(
        f"""
        WITH {BALANCES.replace("(SELECT MIN(settled_at) FROM balance_history WHERE settled_at > DATE '1998-04-01')", NEWEST)}
        SELECT * FROM balance
        """,
        *BALANCE_VIEWS,
    ),
)
def balances_newest_period(spark, folder):
    """Balances on the day a period is closed: no later day is in the history yet."""
    history = roles.balance_history(spark, folder)
    newest = history.agg(F.max("settled_at")).first()[0]
    return valuation.value_balances(
        history, roles.subaccount_type(spark, folder), roles.share_price(spark, folder),
        cutoff=valuation.cutoff_date(history, newest).scalar(), price_date=F.lit(TERM.price_date),
    )


TERM_DATES = """
    SELECT period_id, CAST(month_start + INTERVAL 1 MONTH AS DATE) AS next_start, last_day(month_start) AS price_date
    FROM (SELECT period_id, CAST(strptime('01/' || period, '%d/%m/%Y') AS DATE) AS month_start FROM period)"""
TERM_CUTOFFS = """
    SELECT t.*, coalesce(h.moment, CAST(t.next_start AS TIMESTAMP)) AS cutoff
    FROM term_date t ASOF LEFT JOIN (SELECT DISTINCT settled_at AS moment FROM balance_history) h
      ON CAST(t.next_start AS TIMESTAMP) < h.moment"""


def term_cutoffs(spark, folder, history=None):
    dates = terms.term_dates(roles.period(spark, folder)).select("period_id", "next_start", "price_date")
    return valuation.cutoff_dates(roles.balance_history(spark, folder) if history is None else history, dates)


@register(
    "term_cutoffs",
    with_views("SELECT * FROM term_cutoff", "balance_history", "period", term_date=TERM_DATES, term_cutoff=TERM_CUTOFFS),
)
def term_cutoffs_query(spark, folder):
    """The cut-off of every period: the first day of the history after the start of the next one."""
    return term_cutoffs(spark, folder)


@register(
    "balances_all_periods",
    with_views(
        """
        WITH latest AS (
            SELECT c.period_id, c.cutoff, c.price_date AS asked, h.account_id, h.fund_id, h.subaccount_id,
                   MAX(CAST(h.settled_at AS DATE)) AS day
            FROM term_cutoff c JOIN balance_history h ON h.settled_at <= c.cutoff
            GROUP BY ALL),
        unit AS (
            SELECT l.period_id, l.asked, h.account_id, h.fund_id, h.subaccount_id, h.settled_at, s.regime_id,
                   CAST(ROUND(SUM(h.units), 6) AS DECIMAL(18,6)) AS units
            FROM latest l
            JOIN balance_history h ON h.account_id = l.account_id AND h.fund_id = l.fund_id
                 AND h.subaccount_id = l.subaccount_id AND CAST(h.settled_at AS DATE) = l.day AND h.settled_at <= l.cutoff
            JOIN subaccount_type s ON s.subaccount_id = h.subaccount_id
            GROUP BY ALL)
        SELECT u.period_id, u.account_id, u.fund_id, u.subaccount_id, u.settled_at, 'F' AS kind, p.price_date, u.units,
               CAST(ROUND(u.units * p.price, 2) AS DECIMAL(18,2)) AS amount
        FROM unit u ASOF JOIN share_price p
          ON p.fund_id = u.fund_id AND p.regime_id = u.regime_id AND p.price_date <= u.asked
        """,
        "balance_history", "period", "subaccount_type", "share_price", term_date=TERM_DATES, term_cutoff=TERM_CUTOFFS,
    ),
)
def balances_all_periods(spark, folder):
    """Balances of every period in one pass over the history; its sums give the cut-offs as well."""
    units = valuation.units_by_moment(roles.balance_history(spark, folder))
    return valuation.balances_of_terms(
        units, roles.subaccount_type(spark, folder), roles.share_price(spark, folder),
        term_cutoffs(spark, folder, units), summed=True,
    )


@register(
    "movement_prices",
    with_views(
        """
        SELECT m.account_id, m.folio, m.concept_id, m.fund_id, m.subaccount_id, m.settled_at, m.amount, p.price_date,
               p.price
        FROM (SELECT m.*, s.regime_id, CAST(m.settled_at AS DATE) AS day
              FROM movement m JOIN subaccount_type s ON s.subaccount_id = m.subaccount_id) m
        ASOF LEFT JOIN (SELECT fund_id, regime_id, price_date, price FROM share_price
                        WHERE dayofmonth(price_date) % 7 = 0) p
          ON p.fund_id = m.fund_id AND p.regime_id = m.regime_id AND p.price_date < m.day
        """,
        "movement", "subaccount_type", "share_price",
    ),
)
def movement_prices(spark, folder):
    """Every movement with the last weekly price before its day: three funds hold all rows, so keys are hot."""
    regimes = roles.subaccount_type(spark, folder).select("subaccount_id", "regime_id")
    movements = (
        roles.movement(spark, folder)
        .select("account_id", "folio", "concept_id", "fund_id", "subaccount_id", "settled_at", "amount")
        .join(regimes, "subaccount_id")
        .withColumn("day", F.to_date("settled_at"))
    )
    weekly = roles.share_price(spark, folder).filter(F.dayofmonth("price_date") % 7 == 0)
    priced = asof_join(movements, weekly, ["fund_id", "regime_id"], "day", "price_date", ["price"], strict=True)
    return priced.drop("regime_id", "day")


LOADED = """
    SELECT * FROM balance_history
    WHERE (year(settled_at) - 1995) * 12 + month(settled_at) + CASE WHEN account_id % 5 = 0 THEN 1 ELSE 0 END <= 39"""
LOADED_BALANCES = BALANCES.replace("FROM balance_history h", "FROM loaded h").replace(
    "FROM balance_history\n        WHERE settled_at <=", "FROM loaded\n        WHERE settled_at <="
)


@register(
    "balances_incremental",
    with_views(
        f"WITH {LOADED_BALANCES} SELECT * FROM balance",
        *BALANCE_VIEWS, loaded=LOADED,
    ),
)
def balances_incremental(spark, folder):
    """Balances from a state that three loads have advanced, one of them twice; a fifth of the accounts is always late."""
    store = Warehouse(spark, new_table_path(spark, "balance-state"))
    history = roles.balance_history(spark, folder)
    late = F.when(F.col("account_id") % 5 == 0, 1).otherwise(0)
    month = roles.period_of(F.col("settled_at")) + late
    loads = history.withColumn("period_id", F.greatest(month, F.lit(TERM.period_id - 2)).cast("int"))
    loads.filter(F.col("period_id") <= TERM.period_id).write.partitionBy("period_id").parquet(store.path("loaded"))
    cutoffs = {
        row.period_id: row.cutoff for row in term_cutoffs(spark, folder).filter(
            F.col("period_id").between(TERM.period_id - 2, TERM.period_id)
        ).collect()
    }

    def loaded(period_id):
        return store.table("loaded").filter(F.col("period_id") == period_id)

    for period_id in sorted(cutoffs):
        balance_state.advance(store, loaded(period_id), period_id, cutoffs[period_id])
    balance_state.restate(store, loaded, cutoffs.get, TERM.period_id - 1)
    return valuation.value_units(
        balance_state.balances_at(store, TERM.period_id), roles.subaccount_type(spark, folder),
        roles.share_price(spark, folder), F.lit(TERM.price_date),
    )
