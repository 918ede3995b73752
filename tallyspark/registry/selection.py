"""Indicator rules, manual uploads and account samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.operators import rules, sampling
from tallyspark.registry.base import TERM, register, with_views
from tallyspark.sources import roles
from tallyspark.sources.shared import written_once

URL_BASE = "https://example.org/statements/"

CORE_RULE = """
    SELECT account_id FROM movement WHERE settled_at BETWEEN :start AND :end GROUP BY account_id HAVING COUNT(*) > 1"""
CRM_RULE = "SELECT account_id FROM client WHERE segment = 'BUILDING'"
DEFAULT_RULE = "SELECT account_id FROM uploads WHERE period_id = :term AND procedure = 'MM'"


def _rule_catalog(spark):
    indicators = spark.sql(
        """
        SELECT * FROM VALUES (1, true, true, true, false, false, 'MM'), (2, true, false, false, true, true, 'IND'),
                             (3, false, true, true, true, true, 'NONE'), (4, true, true, false, false, true, 'NONE')
        AS t(indicator_id, active, available, printed, sent, generated, procedure)
        """
    )
    statements = spark.sql(
        "SELECT * FROM VALUES (1, :core, 'CORE'), (2, :crm, 'CRM'), (3, :crm, 'CRM'), (4, :other, 'OTHER') "
        "AS t(indicator_id, sql, source)",
        args={"core": CORE_RULE, "crm": CRM_RULE, "other": DEFAULT_RULE},
    )
    return indicators, statements


@register(
    "indicator_rules",
    with_views(
        """
        SELECT account_id, CAST(1 AS INTEGER) AS indicator_id, CAST(12 AS INTEGER) AS flags,
               CAST(39 AS INTEGER) AS period_id
        FROM movement WHERE settled_at BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'
        GROUP BY account_id HAVING COUNT(*) > 1
        UNION ALL SELECT account_id, 2, 3, 39 FROM client WHERE segment = 'BUILDING'
        UNION ALL SELECT c_custkey, 4, 9, 39 FROM customer WHERE c_mktsegment = 'BUILDING'
        UNION ALL SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 1 ELSE 2 END, 1, 39 FROM customer
        """,
        "movement",
        "client",
    ),
)
def indicator_rules(spark, folder):
    indicators, statements = _rule_catalog(spark)
    uploads = roles.manual_upload(spark, folder)
    sources = {
        "CORE": {"movement": roles.movement(spark, folder)},
        "CRM": {"client": roles.client(spark, folder)},
        "WAREHOUSE": {"uploads": uploads},
    }
    ruled = rules.run_indicator_rules(spark, rules.read_rules(indicators, statements), sources, TERM)
    return ruled.unionByName(rules.manual_indicators(uploads, indicators, TERM))


TERM_CONCEPTS = """
    SELECT DISTINCT m.account_id, b.regulator_id
    FROM movement m JOIN concept_bridge b ON b.concept_id = m.concept_id
    WHERE m.settled_at BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'
      AND m.account_id IN (SELECT account_id FROM client)"""
SAMPLED = """
    SELECT regulator_id, account_id, weight, quantity, CAST(n AS INTEGER) AS rank
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY regulator_id ORDER BY weight DESC, account_id) AS n
          FROM (SELECT c.account_id, c.regulator_id, q.quantity,
                       CAST(SUM(1000000000000000 // q.quantity) OVER (PARTITION BY c.account_id) AS DECIMAL(38,0)) AS weight
                FROM concepts c JOIN sample_quota q ON q.regulator_id = c.regulator_id))
    WHERE n <= quantity"""
SAMPLE_VIEWS = ("movement", "concept_bridge", "client", "sample_quota")


def draw(spark, folder):
    """Arguments of a draw: concepts of the period's movements, quotas, and the clients who may be drawn."""
    movements = roles.movement(spark, folder).filter(TERM.covers(F.col("settled_at")))
    return dict(
        concepts=sampling.account_concepts(movements, roles.concept_bridge(spark, folder)),
        quotas=roles.sample_quota(spark, folder),
        accounts=roles.client(spark, folder),
    )


@register("quota_ranks", with_views(SAMPLED, *SAMPLE_VIEWS, concepts=TERM_CONCEPTS))
def quota_ranks(spark, folder):
    return sampling.quota_ranks(**draw(spark, folder))


@register(
    "quota_sample",
    with_views("SELECT DISTINCT account_id FROM ranked", *SAMPLE_VIEWS, concepts=TERM_CONCEPTS, ranked=SAMPLED),
)
def quota_sample(spark, folder):
    return sampling.quota_sample(**draw(spark, folder), only_active=True)


@register(
    "quota_check",
    with_views(
        """
        SELECT q.regulator_id, q.quantity, COUNT(c.account_id) AS holders,
               COUNT(c.account_id) >= q.quantity AS is_satisfied
        FROM sample_quota q LEFT JOIN concepts c ON c.regulator_id = q.regulator_id GROUP BY 1, 2
        """,
        *SAMPLE_VIEWS,
        concepts=TERM_CONCEPTS,
    ),
)
def quota_check(spark, folder):
    return sampling.quota_check(**draw(spark, folder))


@register(
    "sample",
    with_views(
        f"""
        SELECT account_id, CAST(39 AS INTEGER) AS period_id, CAST(34 AS INTEGER) AS user_id,
               CAST(5 AS INTEGER) AS area_id, 'Pendiente' AS status,
               '{URL_BASE}' || CAST(account_id AS VARCHAR) || '_39_34.pdf' AS url
        FROM (SELECT c_custkey AS account_id FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 9000
              UNION ALL SELECT DISTINCT account_id FROM ranked)
        """,
        *SAMPLE_VIEWS,
        concepts=TERM_CONCEPTS,
        ranked=SAMPLED,
    ),
)
def sample(spark, folder):
    arguments = draw(spark, folder)
    arguments["concepts"] = written_once(arguments["concepts"].distinct(), "concepts")
    sampling.require_quotas(**arguments)
    return sampling.build_sample(
        sampling.manual_accounts(roles.manual_upload(spark, folder)),
        sampling.quota_sample(**arguments),
        TERM, user_id=34, area_id=5, url_base=URL_BASE,
    ).drop("created_at")


SCAN_RULES = 50
SCAN_RULE = "SELECT user_id FROM signal WHERE event_type IN ('view', 'click') AND value > {low} AND value <= {high}"


@register(
    "indicator_rules_one_scan",
    " UNION ALL ".join(
        f"SELECT user_id AS account_id, CAST({n} AS INTEGER) AS indicator_id, CAST({n % 2} AS INTEGER) AS flags, "
        f"CAST(39 AS INTEGER) AS period_id FROM ({SCAN_RULE.format(low=n, high=n + 3).replace('signal', 'events')}) r{n}"
        for n in range(SCAN_RULES)
    ),
)
def indicator_rules_one_scan(spark, folder):
    """Fifty stored rules over one table, whose rows are read once and tagged with the rules they meet."""
    listed = [
        rules.IndicatorRule(n, SCAN_RULE.format(low=n, high=n + 3), "CORE", generated=n % 2 == 1)
        for n in range(SCAN_RULES)
    ]
    return rules.run_indicator_rules(spark, listed, {"CORE": {"signal": roles.table(spark, folder, "events")}}, TERM)
