"""Registered queries over the test tables, each next to the SQL that must give the same rows."""

from tallyspark.registry.base import QUERIES, SQL
from tallyspark.registry import (  # noqa: F401
    catalogs, clients, control, movements, returns, selection, statements, upkeep, valuation, withdrawals,
)


def all_queries():
    return dict(QUERIES)


def all_sql():
    return dict(SQL)
