"""Account statements: header, front, back, and the links of the sampled accounts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import codes
from tallyspark.functions.calendar import compact_period, in_window, is_due, lookback_start, period_start
from tallyspark.operators.movements import union_all
from tallyspark.operators.numbering import number_rows
from tallyspark.operators.terms import Term
from tallyspark.sources.shared import written_once

FLOWS = ("credit", "charge", "commission")
STATEMENT_KEYS = ("account_id", "format_id")


def statement_formats(formats: DataFrame, periodicity: DataFrame, format_indicators: DataFrame) -> DataFrame:
    """Active formats with their periodicities in months and the codes of the clients they are for."""

    def months(role: str) -> DataFrame:
        return periodicity.select(
            F.col("periodicity_id").alias(f"{role}_periodicity_id"), F.col("months").alias(f"{role}_months")
        )

    def code(role: str) -> DataFrame:
        return format_indicators.select(
            F.col("indicator_id").alias(f"{role}_indicator_id"), F.col("value").alias(f"{role}_code")
        )

    resolved = formats.filter("active")
    for role in ("generation", "front", "back"):
        resolved = resolved.join(months(role), f"{role}_periodicity_id")
    for role in ("origin", "affiliation"):
        resolved = resolved.join(code(role), f"{role}_indicator_id")
    return resolved.select(
        "format_id", "generation_id", "generation_months", "front_months", "back_months", "origin_code",
        "affiliation_code",
    )


def affiliation_code(client_type: Column, is_pension: Column) -> Column:
    return F.coalesce(
        codes.decode(client_type, codes.CLIENT_TYPE_CODES), F.when(is_pension, F.lit(codes.PENSIONER_CODE))
    )


def client_formats(client_facts: DataFrame, formats: DataFrame, sample: DataFrame | None, term: Term) -> DataFrame:
    """The statement formats of each client of the period, restricted to the sample when one is given.

    Labels are decoded to the codes of the format table first, which makes this an equi-join against a small side.
    """
    facts = client_facts.filter(F.col("period_id") == term.period_id)
    if sample is not None:
        wanted = sample.filter(F.col("period_id") == term.period_id).select("account_id")
        facts = facts.join(wanted, "account_id", "left_semi")
    decoded = facts.withColumns(
        {
            "generation_id": codes.decode(F.col("generation"), codes.GENERATION_IDS),
            "origin_code": codes.decode(F.col("origin"), codes.ORIGIN_CODES),
            "affiliation_code": affiliation_code(F.col("client_type"), F.col("is_pension")),
        }
    )
    return decoded.join(
        formats, ["generation_id", "origin_code", "affiliation_code"]
    ).drop("origin_code", "affiliation_code")


def statement_id(account: Column, period: Column, format_id: Column) -> Column:
    """Account, ``yyyyMM`` and format, written one after the other, as a number."""
    return F.concat(account.cast("string"), period, format_id.cast("string")).cast("bigint")


def header_base(chosen: DataFrame, clients: DataFrame, term: Term) -> DataFrame:
    """Statement headers that are due in the period, before folio and balances."""
    start, end = F.lit(term.start), F.lit(term.end)
    due = chosen.filter(is_due(start, F.col("generation_months"))).select(
        "account_id", "period_id", "format_id", "generation_id", "generation", "profile", "front_months", "back_months"
    )
    return due.join(clients, "account_id").select(
        statement_id(F.col("account_id"), compact_period(F.lit(term.label), True), F.col("format_id")).alias(
            "statement_id"
        ),
        F.col("generation_id").alias("segment_id"),
        F.lit(codes.STATEMENT_LOCK).alias("lock"),
        "format_id",
        "period_id",
        "account_id",
        end.alias("cutoff_date"),
        lookback_start(start, F.col("back_months")).alias("general_start"),
        end.alias("general_end"),
        lookback_start(start, F.col("front_months")).alias("movement_start"),
        end.alias("movement_end"),
        F.lit(0).alias("fund_id"),
        F.col("profile").alias("fund_description"),
        F.col("generation").alias("generation_description"),
        F.concat_ws(" ", "first_name", "paternal_name", "maternal_name").alias("full_name"),
        "street",
        "colony",
        "municipality",
        "zip",
        "state",
        "nss",
        "rfc",
        "curp",
    )


def with_folio(header: DataFrame) -> DataFrame:
    """Consecutive folios in statement id order, as text.

    The header is stored once, because it is needed twice: only its keys are sorted and numbered, and the wide rows meet
    their folio in one join. Headers have one row per account and format.
    """
    stored = written_once(header, "statement-base")
    folios = number_rows(stored.select(*STATEMENT_KEYS, "statement_id"), ["statement_id"], "folio").select(
        *STATEMENT_KEYS, F.col("folio").cast("string").alias("folio")
    )
    return stored.join(folios, list(STATEMENT_KEYS)).select(*header.columns, "folio")


def with_uuid_ids(header: DataFrame) -> DataFrame:
    """Random ids for statements and folios, where consecutive ones are not wanted."""
    return header.withColumns({"statement_id": F.expr("uuid()"), "folio": F.expr("uuid()")})


def with_balances(header: DataFrame, front: DataFrame, require_subtotal: bool = True) -> DataFrame:
    """Savings subtotal and total balance from the front. Headers without a savings section are dropped by default."""
    final = F.col("final")
    sums = front.groupBy(*STATEMENT_KEYS).agg(
        F.sum(F.when(F.col("section") == codes.SAVINGS_SECTION, final)).cast("decimal(18,2)").alias("subtotal"),
        F.sum(final).cast("decimal(18,2)").alias("total"),
        F.max((F.col("section") == codes.SAVINGS_SECTION).cast("int")).alias("_has_savings"),
    )
    if require_subtotal:
        sums = sums.filter(F.col("_has_savings") == 1)
    return header.join(sums.drop("_has_savings"), list(STATEMENT_KEYS), "inner" if require_subtotal else "left")


def _audit(df: DataFrame, user: str) -> DataFrame:
    return df.withColumns({"created_at": F.current_timestamp(), "created_by": F.lit(user)})


def statement_header(
    chosen: DataFrame, clients: DataFrame, front: DataFrame, term: Term, user: str = "0", require_subtotal: bool = True
) -> DataFrame:
    """Complete headers: ids, date ranges, name and address, folio, balances.

    Folios number every due statement, so they do not change when the balance condition drops some.
    """
    numbered = with_folio(header_base(chosen, clients, term))
    return _audit(with_balances(numbered, front, require_subtotal), user)


def window_bounds(returns: DataFrame, formats: DataFrame, periods: DataFrame, term: Term) -> DataFrame:
    """First and last period with returns inside each front window length.

    The months of a window are enumerated, so periods meet them in an equi-join. Every side has one row per month or
    per window length.
    """
    first_month = lookback_start(F.lit(term.start), F.col("front_months"), inclusive=False)
    months = formats.select("front_months").distinct().select(
        "front_months", F.explode(F.sequence(first_month, F.lit(term.start), F.expr("INTERVAL 1 MONTH"))).alias("starts")
    )
    present = returns.select("period_id").distinct().join(_period_starts(periods), "period_id")
    return months.join(present, "starts").groupBy("front_months").agg(
        F.min_by("period_id", "starts").alias("first_period"), F.max_by("period_id", "starts").alias("last_period")
    )


def period_range(periods: DataFrame, term: Term, months: DataFrame, column: str) -> Column:
    """Whether a row's period can lie in the longest window that ``column`` names, as bounds that prune partitions.

    Three numbers are looked up, in the formats and the periods; the caller still checks the exact window of each row.
    """
    longest = months.agg(F.max(column)).first()[0]
    reached = in_window(
        F.col("starts"), F.lit(term.start), F.lit(term.end), F.lit(longest).cast("int"), inclusive=False
    )
    first, last = _period_starts(periods).filter(reached).agg(F.min("period_id"), F.max("period_id")).first()
    return F.col("period_id").between(F.lit(first), F.lit(last))


def _period_starts(periods: DataFrame) -> DataFrame:
    return periods.select("period_id", period_start(F.col("period")).alias("starts"))


def statement_front(
    returns: DataFrame,
    chosen: DataFrame,
    formats: DataFrame,
    lines: DataFrame,
    periods: DataFrame,
    term: Term,
    user: str = "0",
    flows_in_window: bool = True,
) -> DataFrame:
    """One row per statement and configured line, with the sums of the sub-accounts that the line lists.

    Contributions, withdrawals and commissions are summed over the look-back window, the opening balance is that of the
    first period in it and the closing balance that of the last. A line without matching sub-accounts shows zeros, and
    overlapping lines each have their own sum. Returns are summed per sub-account before the few lines multiply them,
    and the window bounds, a few rows, are written once. Literal bounds on the period prune the partitions of the
    returns; with ``flows_in_window=False`` the flows of all periods are summed, and all returns are read.
    """
    due = chosen.filter(is_due(F.lit(term.end), F.col("generation_months"))).select(
        "account_id", "format_id", "generation_id", "front_months"
    )
    inside_range = period_range(periods, term, formats, "front_months")
    recent = returns.filter(inside_range)
    bounds = written_once(window_bounds(recent, formats, periods, term), "bounds")
    if flows_in_window:
        returns = recent
    windows = due.join(bounds, "front_months", "left")
    rows = returns.join(_period_starts(periods), "period_id").join(windows, "account_id")
    inside = in_window(
        F.col("starts"), F.lit(term.start), F.lit(term.end), F.col("front_months"), inclusive=False
    )
    if flows_in_window:
        rows = rows.filter(inside)

    def at(period: str, measure: str) -> Column:
        return F.sum(F.when(F.col("period_id") == F.col(period), F.col(measure)).otherwise(0)).alias(measure)

    per_subaccount = rows.groupBy("account_id", "format_id", "generation_id", "subaccount_id").agg(
        F.sum("credit").alias("credit"),
        F.sum("charge").alias("charge"),
        F.sum("commission").alias("commission"),
        at("first_period", "initial"),
        at("last_period", "final"),
    )
    return front_lines(per_subaccount, lines, user)


def front_lines(per_subaccount: DataFrame, lines: DataFrame, user: str = "0") -> DataFrame:
    """The configured lines of each statement from its sums per sub-account."""
    listed = F.array_contains("subaccounts", F.col("subaccount_id"))

    def listed_sum(measure: str, name: str) -> Column:
        return F.sum(F.when(listed, F.col(measure)).otherwise(0)).cast("decimal(16,2)").alias(name)

    shown = (
        per_subaccount.join(lines, "generation_id")
        .groupBy("account_id", "format_id", "savings_type", "concept", "section")
        .agg(
            listed_sum("credit", "contribution"),
            listed_sum("charge", "withdrawal"),
            listed_sum("commission", "commission"),
            listed_sum("initial", "initial"),
            listed_sum("final", "final"),
        )
    )
    earned = F.col("final") - (
        F.col("contribution") + F.col("initial") - F.col("commission") - F.col("withdrawal")
    )
    zero = {2: F.lit(0).cast("decimal(16,2)"), 6: F.lit(0).cast("decimal(16,6)")}
    return _audit(
        shown.withColumns(
            {
                "computed_return": earned.cast("decimal(16,2)"),
                "current_value": zero[2],
                "current_value_udi": zero[6],
                "nominal_value": zero[2],
                "nominal_value_udi": zero[6],
                "pension_type": F.lit(1),
                "pension_amount": zero[2],
            }
        ),
        user,
    )


def front_windows(
    formats: DataFrame, periods: DataFrame, term: Term, fact_periods: Sequence[int], sum_periods: Sequence[int]
) -> dict[int, dict[str, int]]:
    """Where each front window of the formats begins and ends, by its length in months.

    ``first`` and ``last`` are the first and last period with facts in it, ``upto`` the newest period with running sums
    that is not after it, and ``before`` the newest one that is before it, if there is one. Lengths and periods are
    catalogs: one row per periodicity and per month.
    """
    starts = {row.period_id: row.starts for row in _period_starts(periods).collect()}
    opening = lookback_start(F.lit(term.start), F.col("front_months"), inclusive=False)
    found = {}
    for row in formats.select("front_months", opening.alias("opening")).distinct().collect():
        inside = [one for one in fact_periods if one in starts and row.opening <= starts[one] <= term.end]
        summed = [one for one in sum_periods if one in starts and starts[one] <= term.end]
        if not inside or not summed:
            continue
        window = {
            "first": min(inside, key=starts.get), "last": max(inside, key=starts.get), "upto": max(summed, key=starts.get)
        }
        earlier = [one for one in summed if starts[one] < row.opening]
        if earlier:
            window["before"] = max(earlier, key=starts.get)
        found[row.front_months] = window
    return found


def statement_front_from_sums(
    returns: DataFrame, sums: DataFrame, windows: Mapping[int, Mapping[str, int]], chosen: DataFrame, lines: DataFrame,
    term: Term, user: str = "0",
) -> DataFrame:
    """``statement_front`` from running sums: flows of a window are those up to its end less those before it.

    Of the sums and of the returns only the periods at the two ends of a window are read (see ``front_windows``), so the
    cost does not grow with the length of the windows, nor with the number of formats that share one.
    """
    due = chosen.filter(is_due(F.lit(term.end), F.col("generation_months"))).select(
        "account_id", "format_id", "generation_id", "front_months"
    )

    def ends(table: DataFrame, end: str, **measures: Column) -> DataFrame:
        of_period: dict[int, list[int]] = {}
        for months, window in windows.items():
            if end in window:
                of_period.setdefault(window[end], []).append(months)
        lengths = F.lit(None).cast("array<int>")
        for period_id, months in of_period.items():
            lengths = F.when(F.col("period_id") == period_id, F.array(*map(F.lit, months))).otherwise(lengths)
        none = F.lit(0).cast("decimal(28,4)")
        return table.filter(F.col("period_id").isin(list(of_period))).select(
            "account_id", "subaccount_id", F.explode(lengths).alias("front_months"),
            measures.get("rows", F.lit(0)).cast("bigint").alias("rows"),
            *[measures.get(name, none).cast("decimal(28,4)").alias(name) for name in (*FLOWS, "initial", "final")],
        )

    running = (*FLOWS, "rows")
    parts = (
        ends(sums, "upto", **{name: F.col(name) for name in running}),
        ends(sums, "before", **{name: -F.col(name) for name in running}),
        ends(returns, "first", initial=F.col("initial")),
        ends(returns, "last", final=F.col("final")),
    )
    per_window = union_all(parts).groupBy("account_id", "subaccount_id", "front_months").agg(
        *[F.sum(name).alias(name) for name in (*running, "initial", "final")]
    ).filter("rows > 0")
    return front_lines(per_window.join(due, ["account_id", "front_months"]), lines, user)


def statement_back(
    movements: DataFrame,
    chosen: DataFrame,
    bridge: DataFrame,
    regulator_concepts: DataFrame,
    periods: DataFrame,
    term: Term,
    user: str = "0",
    due_on_term: bool = False,
    formats: DataFrame | None = None,
) -> DataFrame:
    """Movements of the look-back window, summed per statement, regulator concept and date.

    Amounts are summed per account, period, concept and date before the clients are joined, so a hot account arrives
    already reduced; concept texts are attached last. Literal bounds on the period prune the movements' partitions. Only movements of due months count; with ``due_on_term`` the
    month of the statement decides.
    """
    texts = regulator_concepts.select("regulator_id", "section", "description")
    starts = _period_starts(periods).filter(F.col("starts") <= F.lit(term.end))
    summed = (
        movements.filter(period_range(periods, term, chosen if formats is None else formats, "back_months"))
        .join(starts, "period_id")
        .join(bridge.select("concept_id", "regulator_id"), "concept_id")
        .groupBy("account_id", "starts", "regulator_id", "settled_at")
        .agg(F.sum("amount").alias("amount"))
    )
    shown = summed.join(
        chosen.select("account_id", "format_id", "generation_months", "back_months"), "account_id"
    ).filter(
        is_due(F.lit(term.start) if due_on_term else F.col("starts"), F.col("generation_months"))
        & in_window(F.col("starts"), F.lit(term.start), F.lit(term.end), F.col("back_months"))
    )
    return _audit(
        shown.groupBy(*STATEMENT_KEYS, "regulator_id", "settled_at")
        .agg(F.sum("amount").cast("decimal(18,2)").alias("amount"))
        .join(texts, "regulator_id")
        .withColumns(
            {
                "reference_period": F.lit(codes.UNKNOWN_REFERENCE),
                "days_paid": F.lit(0),
                "base_salary": F.lit(0).cast("decimal(18,2)"),
            }
        ),
        user,
    )


def with_statement_id(rows: DataFrame, header: DataFrame, front: DataFrame | None = None) -> DataFrame:
    """Front or back rows with the id of their statement; back rows also need a front."""
    if front is not None:
        rows = rows.join(front.select("account_id"), "account_id", "left_semi")
    return rows.join(header.select(*STATEMENT_KEYS, "statement_id"), list(STATEMENT_KEYS))


def sample_links(sample: DataFrame, header: DataFrame, term: Term, url_base: str, user_id: int | None = None) -> DataFrame:
    """One row per header with its sample row, if any, and the address of its document."""
    chosen = sample.filter(F.col("period_id") == term.period_id).select(
        "account_id",
        "period_id",
        "status",
        (F.col("user_id") if user_id is None else F.lit(user_id)).alias("user_id"),
        F.col("area_id").cast("int").alias("area_id"),
    )
    folios = header.select(F.col("account_id").alias("_account"), "folio")
    return chosen.join(folios, F.col("account_id") == F.col("_account"), "right").select(
        "account_id",
        "period_id",
        "status",
        "user_id",
        "area_id",
        F.concat(F.lit(url_base), F.col("folio"), F.lit(".pdf")).alias("url"),
    )


def sample_update(sample: DataFrame, header: DataFrame, term: Term, url_base: str) -> DataFrame:
    """The sample rows of the period with the address of their statement; rows without a statement keep theirs.

    An account with statements in several formats has one row per statement.
    """
    folios = header.select("account_id", F.concat(F.lit(url_base), F.col("folio"), F.lit(".pdf")).alias("_url"))
    rows = sample.filter(F.col("period_id") == term.period_id).join(folios, "account_id", "left")
    return rows.withColumn("url", F.coalesce("_url", "url")).select(*sample.columns)
