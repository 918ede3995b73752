"""Statements of the sampled accounts, or of all clients."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyspark.operators import statements
from tallyspark.operators.terms import Term
from tallyspark.sources.shared import written_once


@dataclass(frozen=True)
class StatementConfig:
    """Configuration tables of the statements."""

    formats: DataFrame
    periodicity: DataFrame
    format_indicators: DataFrame
    lines: DataFrame
    bridge: DataFrame
    regulator_concepts: DataFrame
    periods: DataFrame


@dataclass(frozen=True)
class Statements:
    """The products of one run."""

    header: DataFrame
    front: DataFrame
    back: DataFrame


def build_statements(
    client_facts: DataFrame,
    clients: DataFrame,
    returns: DataFrame,
    movements: DataFrame,
    config: StatementConfig,
    sample: DataFrame | None,
    term: Term,
    user: str = "0",
) -> Statements:
    """Header, front and back of the period; without a sample, of every client.

    The clients' formats, the front and the header are each needed by later products, so they are written to the
    shared folder once instead of being computed again from the facts.
    """
    formats = statements.statement_formats(config.formats, config.periodicity, config.format_indicators)
    chosen = written_once(statements.client_formats(client_facts, formats, sample, term), "chosen")
    front = written_once(
        statements.statement_front(returns, chosen, formats, config.lines, config.periods, term, user), "front"
    )
    header = written_once(statements.statement_header(chosen, clients, front, term), "header")
    back = statements.statement_back(
        movements, chosen, config.bridge, config.regulator_concepts, config.periods, term, user, formats=formats
    )
    return Statements(
        header=header,
        front=statements.with_statement_id(front, header),
        back=statements.with_statement_id(back, header, front),
    )
