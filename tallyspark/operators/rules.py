"""Indicators whose rules are SQL texts kept in a catalog."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions import codes
from tallyspark.functions.codes import pack_flags
from tallyspark.operators.movements import union_all
from tallyspark.operators.terms import Term, stamp_period

RULES_PER_PLAN = 50


@dataclass(frozen=True)
class IndicatorRule:
    """One catalog row: an indicator, its SQL, the source the SQL runs on, and its four flags."""

    indicator_id: int
    sql: str
    source: str
    available: bool = False
    printed: bool = False
    sent: bool = False
    generated: bool = False


def read_rules(indicators: DataFrame, statements: DataFrame) -> Iterator[IndicatorRule]:
    """Active rules of the catalog in order, fetched a partition at a time: the driver never holds the catalog."""
    rows = (
        indicators.filter("active")
        .join(statements, "indicator_id")
        .select("indicator_id", "sql", "source", "available", "printed", "sent", "generated")
        .orderBy("indicator_id", "source", "sql")
        .toLocalIterator()
    )
    return (IndicatorRule(*row) for row in rows)


@contextmanager
def source_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> Iterator[None]:
    """The tables of one source as temporary views; views of the same name are put back afterwards."""
    before = {name: spark.table(name) for name in tables if spark.catalog.tableExists(name)}
    try:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
        yield
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
        for name, df in before.items():
            df.createOrReplaceTempView(name)


def run_indicator_rules(
    spark: SparkSession,
    rules: Iterable[IndicatorRule],
    sources: Mapping[str, Mapping[str, DataFrame]],
    term: Term,
    default_source: str = "WAREHOUSE",
) -> DataFrame:
    """Accounts of every rule with its indicator and flags, as one plan.

    A rule sees the tables of the source it names (or of the default source), and ``:term``, ``:start`` and ``:end``
    bound to the period. Its first column is the account. The loop runs over statements, never over rows.

    Rules that only select rows of one table share a scan of it: every row is tagged with the rules it meets. Rules of
    any other form (joins, groups, several tables) run by themselves.
    """
    bindings = {"term": term.period_id, "start": term.start, "end": term.end}
    shared: dict[tuple[str, str], list[tuple[IndicatorRule, RowTest]]] = {}
    parts = []
    for rule in rules:
        source = rule.source if rule.source in sources else default_source
        with source_views(spark, sources.get(source, {})):
            accounts = spark.sql(rule.sql, args=bindings)
        test = row_test(accounts)
        if test is not None and test.table in sources.get(source, {}):
            shared.setdefault((source, test.table), []).append((rule, test))
        else:
            parts.append(accounts.select(_hit(rule, F.col(accounts.columns[0])).alias("hit")).select("hit.*"))
    for (source, name), tests in shared.items():
        parts.append(tagged_rows(sources[source][name].alias(name), tests))
    return stamp_period(union_all(parts), term.period_id)


def _hit(rule: IndicatorRule, account: Column) -> Column:
    flags = pack_flags(*(F.lit(bit) for bit in (rule.available, rule.printed, rule.sent, rule.generated)))
    return F.struct(
        account.cast("bigint").alias("account_id"), F.lit(rule.indicator_id).alias("indicator_id"),
        flags.cast("int").alias("flags"),
    )


def tagged_rows(table: DataFrame, tests: Iterable[tuple[IndicatorRule, RowTest]]) -> DataFrame:
    """One row per row of the table and rule it meets, from one scan."""
    hits = [F.when(F.expr(test.condition), _hit(rule, F.expr(test.account))) for rule, test in tests]
    return table.select(F.explode(F.array_compact(F.array(*hits))).alias("hit")).select("hit.*")


@dataclass(frozen=True)
class RowTest:
    """A rule that selects rows of one view: which ones, and the account in them."""

    table: str
    condition: str
    account: str


def row_test(accounts: DataFrame) -> RowTest | None:
    """The test of a rule whose analysed plan is a projection of a view, filtered or not; otherwise nothing.

    Names are resolved and parameters bound in that plan, so the test does not depend on how the rule was written.
    Subqueries, aggregates, windows, generators and random functions make a rule more than a test of a row.
    """
    plan = accounts._jdf.queryExecution().analyzed()
    patterns = accounts.sparkSession._jvm.org.apache.spark.sql.catalyst.trees.TreePattern
    barred = [getattr(patterns, name)() for name in _NOT_OF_A_ROW]

    def plain(expression) -> bool:
        return expression.deterministic() and not any(expression.containsPattern(one) for one in barred)

    if _kind(plan) != "Project":
        return None
    account = plan.projectList().apply(0)
    columns = [plan.projectList().apply(place) for place in range(plan.projectList().size())]
    inner, conditions = plan.child(), []
    while _kind(inner) == "Filter":
        conditions.append(inner.condition())
        inner = inner.child()
    if _kind(inner) != "SubqueryAlias" or _kind(inner.child()) != "View" or not all(plain(one) for one in [*columns, *conditions]):
        return None
    if _kind(account) == "Alias":
        account = account.child()
    condition = " AND ".join(f"({one.sql()})" for one in conditions) or "true"
    return RowTest(inner.identifier().name(), condition, account.sql())


_NOT_OF_A_ROW = ("AGGREGATE_EXPRESSION", "WINDOW_EXPRESSION", "PLAN_EXPRESSION", "GENERATOR", "PYTHON_UDF", "SCALA_UDF")


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def manual_indicators(uploads: DataFrame, indicators: DataFrame, term: Term) -> DataFrame:
    """Indicators of accounts uploaded by hand for the period, matched by procedure."""
    known = indicators.select("procedure", "indicator_id")
    rows = uploads.filter(F.col("period_id") == term.period_id).select("account_id", "procedure").join(
        known, "procedure"
    )
    return stamp_period(
        rows.select("account_id", "indicator_id", F.lit(codes.MANUAL_FLAGS).alias("flags")), term.period_id
    )
