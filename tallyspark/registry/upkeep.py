"""Period loads, upserts, updates, run log, notifications, checks and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspark.functions import codes
from tallyspark.operators import changes, quality, reports, runlog
from tallyspark.operators.clients import indicator_values
from tallyspark.plans.warehouse import Warehouse
from tallyspark.registry.base import TERM, register, with_views
from tallyspark.sources import roles
from tallyspark.sources.shared import new_table_path
from tallyspark.sources.tables import replace_period, replace_period_with_summary
from tallyspark.sources.versions import VersionedTable


@register(
    "period_reload",
    with_views(
        """
        SELECT account_id, folio, amount, settled_at,
               CAST((year(settled_at) - 1995) * 12 + month(settled_at) AS INTEGER) AS period_id
        FROM movement
        WHERE settled_at >= DATE '1998-02-01' AND settled_at < DATE '1998-04-01'
        """,
        "movement",
    ),
)
def period_reload(spark, folder):
    """Two periods are loaded, one of them twice; the table must hold each once."""
    path = new_table_path(spark, "movement")
    rows = roles.dated_movement(spark, folder).select("account_id", "folio", "amount", "settled_at", "period_id")
    for period_id in (TERM.period_id - 1, TERM.period_id, TERM.period_id):
        replace_period(rows.filter(F.col("period_id") == period_id), path, period_id)
    return spark.read.parquet(path)


@register(
    "upsert",
    """
    SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal <= 5000
    UNION ALL
    SELECT s_suppkey, CASE WHEN s_acctbal > 7000 THEN 'second' ELSE 'first' END, s_acctbal + 100
    FROM supplier WHERE s_acctbal > 5000
    UNION ALL
    SELECT s_suppkey + 1000000, 'new', s_acctbal FROM supplier WHERE s_acctbal < 0
    """,
)
def upsert(spark, folder):
    """Two batches with repeated keys: the later batch wins, and the first row inside a batch."""
    target = roles.table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    balance = F.col("s_acctbal")

    def batch(rows, number, position, label):
        return rows.select(
            "s_suppkey", F.lit(label).alias("s_name"), (balance + (0 if label == "new" else 100)).alias("s_acctbal"),
            F.lit(number).alias("batch"), F.lit(position).alias("position"),
        )

    source = (
        batch(target.filter(balance > 5000), 1, 1, "first")
        .unionByName(batch(target.filter(balance > 5000), 1, 2, "repeated"))
        .unionByName(batch(target.filter(balance > 7000), 2, 1, "second"))
        .unionByName(
            batch(target.filter(balance < 0).withColumn("s_suppkey", F.col("s_suppkey") + 1_000_000), 1, 1, "new")
        )
    )
    return changes.upsert(target, source, ["s_suppkey"], batch="batch", position="position")


@register(
    "load_as_of",
    with_views(
        """
        SELECT 'now' AS seen, account_id, folio, amount, period_id FROM loaded WHERE period_id = 38 AND amount > 0
        UNION ALL SELECT 'now', account_id, folio, amount * 2, period_id FROM loaded WHERE period_id = 39
        UNION ALL SELECT 'then', account_id, folio, amount, period_id FROM loaded WHERE period_id IN (38, 39)
        """,
        "movement",
        loaded="""
        SELECT account_id, folio, amount,
               CAST((year(settled_at) - 1995) * 12 + month(settled_at) AS INTEGER) AS period_id FROM movement""",
    ),
)
def load_as_of(spark, folder):
    """Periods are loaded again and one is dropped; the table is read now and as it was after its second load."""
    table = VersionedTable(spark, new_table_path(spark, "versions"))
    rows = roles.dated_movement(spark, folder).select("account_id", "folio", "amount", "period_id")
    before, current = rows.filter(F.col("period_id") == TERM.period_id - 1), rows.filter(F.col("period_id") == TERM.period_id)
    table.load(before, TERM.period_id - 1)
    table.load(current, TERM.period_id)
    table.load(current.withColumn("amount", (F.col("amount") * 2).cast("decimal(18,2)")), TERM.period_id)
    table.load(rows.filter(F.col("period_id") == 1), 1)
    table.load(before.filter("amount > 0"), TERM.period_id - 1)
    table.drop(1)
    seen = [table.read().withColumn("seen", F.lit("now")), table.read(as_of=2).withColumn("seen", F.lit("then"))]
    return seen[0].unionByName(seen[1])


@register(
    "upsert_buckets",
    """
    SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 37 <> 5
    UNION ALL SELECT c_custkey, 'merged', NULL FROM customer WHERE c_custkey % 37 = 5
    UNION ALL SELECT -c_custkey, 'new', 'NONE' FROM customer WHERE c_custkey % 100 = 1
    """,
)
def upsert_buckets(spark, folder):
    """A keyed table in buckets: the first load writes all of them, the merge those of its keys."""
    store = Warehouse(spark, new_table_path(spark, "keyed"))
    clients = roles.table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    store.upsert_buckets("client", clients, ["c_custkey"], buckets=16)
    key = F.col("c_custkey")
    changed = clients.filter(key % 37 == 5).select(
        key, F.lit("merged").alias("c_name"), F.lit(None).cast("string").alias("c_mktsegment"), F.lit(1).alias("rank")
    )
    repeated = changed.withColumn("c_name", F.lit("later in the batch")).withColumn("rank", F.lit(2))
    new = clients.filter(key % 100 == 1).select(
        -key, F.lit("new").alias("c_name"), F.lit("NONE").alias("c_mktsegment"), F.lit(1).alias("rank")
    ).toDF("c_custkey", "c_name", "c_mktsegment", "rank")
    store.upsert_buckets("client", changed.unionByName(repeated).unionByName(new), ["c_custkey"], position="rank")
    return store.table("client")


@register(
    "update_from",
    with_views(
        """
        SELECT c.account_id, CAST(39 AS INTEGER) AS period_id,
               COALESCE('{"3": "' || i.value || '"}', '{}') AS indicators
        FROM client c
        LEFT JOIN (SELECT account_id, MIN(CASE code WHEN '713' THEN 'Asignado' WHEN '714' THEN 'Afiliado' END) AS value
                   FROM account_indicator WHERE indicator_id = 12 GROUP BY 1) i ON i.account_id = c.account_id
        """,
        "client",
        "account_indicator",
    ),
)
def update_from(spark, folder):
    seeded = changes.seed_clients(roles.client(spark, folder), TERM.period_id)
    labels = indicator_values(
        roles.account_indicator(spark, folder), roles.indicator_config(spark, folder), codes.INDICATOR_CLIENT_TYPE,
        codes.CLIENT_TYPE_LABELS, only_valid=False,
    )
    values = labels.withColumn("value", F.concat(F.lit('{"3": "'), F.col("value"), F.lit('"}')))
    return changes.update_from(seeded, values, "account_id", "indicators")


@register(
    "client_seed",
    with_views("SELECT account_id, CAST(39 AS INTEGER) AS period_id, '{}' AS indicators FROM client", "client"),
)
def client_seed(spark, folder):
    return changes.seed_clients(roles.client(spark, folder), TERM.period_id)


@register(
    "sla_flags",
    """
    SELECT r.event_type AS phase_id, r.event_id AS run_id, r.ts AS started_at,
           r.ts + to_seconds(CAST(floor(r.value * 60) AS INTEGER)) AS ended_at, r.event_type = 'error' AS failed,
           CASE WHEN r.event_type = 'error' THEN 'Error'
                WHEN p.phase_id IS NULL THEN 'Sin fase'
                WHEN floor(r.value * 60) <= p.green THEN 'Verde'
                WHEN floor(r.value * 60) <= p.yellow THEN 'Amarillo' ELSE 'Rojo' END AS flag
    FROM events r
    LEFT JOIN (VALUES ('view', 300, 900), ('click', 600, 1800), ('purchase', 1200, 3600), ('error', 60, 120))
         AS p(phase_id, green, yellow) ON p.phase_id = r.event_type
    """,
)
def sla_flags(spark, folder):
    return runlog.sla_flag(roles.run_log(spark, folder), roles.phase(spark, folder))


@register(
    "notification_fanout",
    """
    SELECT n.n_regionkey AS area_id, n.n_nationkey AS notice_id, n.n_name AS title, u.user_id
    FROM nation n
    JOIN (SELECT DISTINCT r.n_regionkey AS area_id, s.s_suppkey AS user_id
          FROM nation r JOIN supplier s ON s.s_nationkey = r.n_nationkey
          WHERE r.n_regionkey <> 3) u ON u.area_id = n.n_regionkey
    """,
)
def notification_fanout(spark, folder):
    """Regions are areas, nations are roles and notices, suppliers are users."""
    nation = roles.table(spark, folder, "nation")
    key, region = F.col("n_nationkey"), F.col("n_regionkey")
    recipients = runlog.area_recipients(
        areas=roles.table(spark, folder, "region").select(F.col("r_regionkey").alias("area_id")),
        area_roles=nation.select(region.alias("area_id"), key.alias("role_id")),
        roles=nation.select(key.alias("role_id")),
        role_menus=nation.select(key.alias("role_id"), region.alias("role_menu_id")),
        role_users=roles.table(spark, folder, "supplier").select(
            F.col("s_nationkey").alias("role_id"), F.col("s_suppkey").alias("user_id")
        ),
        menu_functions=spark.sql(
            "SELECT * FROM VALUES (0, 7), (1, 7), (2, 7), (3, 8), (4, 7) AS t(function_id, menu_id)"
        ),
    )
    notices = nation.select(region.alias("area_id"), key.alias("notice_id"), F.col("n_name").alias("title"))
    return runlog.notification_fanout(notices, recipients)


@register(
    "quality_checks",
    """
    SELECT 'TABLE_NO_DATA' AS check_name, '' AS subject, CAST(CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS BIGINT)
           AS failures FROM orders
    UNION ALL SELECT 'TABLE_MISSED_VALUES', 'o_custkey', CAST(COUNT(*) - COUNT(o_custkey) AS BIGINT) FROM orders
    UNION ALL SELECT 'TABLE_UNEXPECTED_VALUES', 'o_orderstatus',
                     CAST(SUM(CASE WHEN o_orderstatus NOT IN ('F', 'P') THEN 1 ELSE 0 END) AS BIGINT) FROM orders
    UNION ALL SELECT 'CONTROL_METRICS_NULL_VALUES', 'o_totalprice', CAST(COUNT(*) - COUNT(o_totalprice) AS BIGINT)
              FROM orders
    UNION ALL SELECT 'TABLE_DUPLICATED_VALUES', 'o_custkey,o_orderdate',
                     CAST(SUM(n - 1) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM orders GROUP BY o_custkey, o_orderdate)
    UNION ALL SELECT 'TABLE_INVALID_FOREIGN_VALUES', 'o_custkey',
                     CAST(COUNT(*) AS BIGINT) FROM orders
              WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
    """,
)
def quality_checks(spark, folder):
    solvent = roles.table(spark, folder, "customer").filter(F.col("c_acctbal") > 0)
    spec = quality.CheckSpec(
        required=["o_custkey"],
        expected={"o_orderstatus": F.col("o_orderstatus").isin("F", "P")},
        keys=[["o_custkey", "o_orderdate"]],
        references={"o_custkey": (solvent, "c_custkey")},
        metrics=["o_totalprice"],
    )
    return quality.quality_checks(roles.table(spark, folder, "orders"), spec)


_SUMMARY = [
    ("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
    ("value", "double"), ("props", "string"),
]


@register(
    "load_summary",
    " UNION ALL ".join(
        f"SELECT COUNT(*) AS row_count, '{name}' AS column_name, '{kind}' AS column_type, COUNT({name}) AS non_null "
        "FROM events"
        for name, kind in _SUMMARY
    ),
)
def load_summary(spark, folder):
    return reports.load_summary(roles.table(spark, folder, "events"))


@register(
    "load_summary_in_one_pass",
    " UNION ALL ".join(
        f"SELECT COUNT(*) AS row_count, '{name}' AS column_name, '{kind}' AS column_type, COUNT({name}) AS non_null "
        "FROM events WHERE event_type = 'click'"
        for name, kind in _SUMMARY
    ),
)
def load_summary_in_one_pass(spark, folder):
    """The summary of a period's load, counted by its write."""
    clicks = roles.table(spark, folder, "events").filter("event_type = 'click'")
    return replace_period_with_summary(clicks, new_table_path(spark, "events"), TERM.period_id)
