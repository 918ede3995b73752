"""Conversation repair: the cheapest edits that give legal turns, by Knuth's lightest-derivation agenda."""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.numbering import number_rows
from tallyspark.sources.shared import written_once

SEGMENT = 256  # turns whose deductions one agenda holds
FAN = 256  # segments, or groups of them, that one agenda joins
SPACES = " \t\n\x0b\f\r"
LEGAL = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1  # added to a truncated turn that stays

# states: nothing said yet, after a system turn, after a user's, after an assistant's
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_MAY_KEEP = {EMPTY: "su", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
_NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # what may be inserted, or given as a role
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_LEFT = {EMPTY: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}  # insertions that close a conversation
_CLOSING = {EMPTY: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


# ---- the agenda

def lightest(start, rules, goals) -> dict:
    """Lightest values of the goal items, as ``{item: (cost, audit)}``, by Knuth's generalisation of Dijkstra's method.

    ``rules(item)`` gives the deductions that the item is the antecedent of, as (item, cost, letters); their functions
    add the cost and append the letters, so they are monotone and give no less than they get. Values are compared as
    (cost, audit), hence an item that leaves the agenda is final; the search ends when all ``goals`` are, or nothing is
    left to deduce.
    """
    agenda = [(0, "", start)]
    final, found, open_goals = set(), {}, set(goals)
    while agenda and open_goals:
        cost, audit, item = heappop(agenda)
        if item in final:
            continue
        final.add(item)
        if item in open_goals:
            open_goals.discard(item)
            found[item] = (cost, audit)
        for reached, more, letters in rules(item):
            if reached not in final:
                heappush(agenda, (cost + more, audit + letters, reached))
    return found


def segment_moves(turns: list[tuple[str, str]], sources: tuple[int, ...], whole: bool) -> list[tuple[int, int, int, str]]:
    """Lightest (source, target, cost, audit) from each source state to each state that these turns can end in.

    A turn is (initial of its role, fault); faults are ``b`` (blank), ``d`` (duplicate), ``t`` (truncated) or empty.
    Items are (turns done, state, whether an insertion came last). Edits of a segment end with that of its last turn:
    insertions behind it belong to the next segment, so of two audits from one source neither begins the other, and
    which is less does not depend on what follows. With ``whole`` there is no next segment: closing insertions count,
    and only the lightest legal end is given.
    """
    count = len(turns)
    goal = (count, -1, 0)

    def rules(item):
        done, state, _ = item
        reached = _NEXT[state]
        if whole and done == count:
            if state in (EMPTY, ASSISTANT):
                yield goal, 0, ""
            yield (done, reached, 1), INSERT, "I"
            return
        if done == count:
            return
        initial, fault = turns[done]
        yield (done, reached, 1), INSERT, "I"
        yield (done + 1, state, 0), DELETE, "D"
        if fault in ("b", "d"):
            return
        more = TRUNCATED if fault == "t" else 0
        if initial and initial in _MAY_KEEP[state]:
            yield (done + 1, _AFTER[initial], 0), KEEP + more, "K"
        yield (done + 1, reached, 0), REROLE + more, "R"

    out = []
    for source in sources:
        goals = [goal] if whole else [(count, state, 0) for state in range(4)]

        def stopped(item):
            return () if item == goal else rules(item)

        for item, (cost, audit) in lightest((0, source, 0), stopped, goals).items():
            target = item[1]
            if item == goal:
                target = source
                for letter, state in _states(source, audit, turns):
                    target = state
            out.append((source, target, cost, audit))
    return sorted(out, key=lambda move: (move[0], move[3]))


def _states(source: int, audit: str, turns: list[tuple[str, str]]):
    """Letters of an audit with the state after each."""
    state, place = source, 0
    for letter in audit:
        if letter in "IR":
            state = _NEXT[state]
        elif letter == "K":
            state = _AFTER[turns[place][0]]
        if letter != "I":
            place += 1
        yield letter, state


def joined_moves(children: list[list], closing: bool) -> list[tuple[int, int, int, str, str]]:
    """Lightest (source, target, cost, order, targets) through consecutive segments, from their moves.

    Items are (segments done, state); a move (source, target, cost, ...) of the next segment is the second antecedent.
    Moves of one source come in order of their audits, and their numbers there stand for those audits: up to the first
    difference two audits run through the same states. ``targets`` holds the state after each segment. ``closing`` adds
    the insertions that close a conversation and gives only its lightest end.
    """
    count = len(children)
    by_source = []
    for moves in children:
        of = {}
        for move in moves:
            of.setdefault(move[0], []).append((move[1], move[2]))
        by_source.append(of)
    goal = (count, -1)

    def rules(item):
        done, state = item
        if item == goal:
            return
        if done == count:
            if closing:
                yield goal, _LEFT[state], ""
            return
        for number, (target, cost) in enumerate(by_source[done].get(state, ())):
            yield (done + 1, target), cost, chr(48 + number)

    out = []
    for source in sorted(by_source[0]):
        goals = [goal] if closing else [(count, state) for state in range(4)]
        for item, (cost, order) in lightest((0, source), rules, goals).items():
            state, targets = source, []
            for of, number in zip(by_source, order, strict=True):
                state = of[state][ord(number) - 48][0]
                targets.append(str(state))
            out.append((source, state, cost, order, "".join(targets)))
    return sorted(out, key=lambda move: (move[0], move[3]))


def _illegal(initials: list[str]) -> int:
    return sum(one + other not in LEGAL for one, other in zip(initials, initials[1:]))


# ---- inside tasks

_SEGMENT_TYPE = (
    "talk long, node long, first_place long, turns array<struct<initial:string,fault:string>>, opening string, "
    "last string, illegal long, moves array<struct<source:int,target:int,cost:long,audit:string>>"
)
_JOINED_TYPE = (
    "talk long, node long, opening string, last string, illegal long, "
    "moves array<struct<source:int,target:int,cost:long,audit:string,targets:string>>"
)
_EDIT_TYPE = "talk long, place long, slot int, edit string, new_role string"
_MOVE = ("source", "target", "cost", "audit")


def _solve(batches):
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            turns = [(one["initial"], one["fault"]) for one in row["turns"]]
            opens, closes = row["node"] == 0, row["node"] == row["last_node"]
            moves = segment_moves(turns, (EMPTY,) if opens else (EMPTY, SYSTEM, USER, ASSISTANT), opens and closes)
            rows.append(
                {
                    "talk": row["talk"], "node": row["node"], "first_place": row["turns"][0]["place"],
                    "turns": [{"initial": initial, "fault": fault} for initial, fault in turns],
                    "opening": turns[0][0], "last": turns[-1][0], "illegal": _illegal([one for one, _ in turns]),
                    "moves": [dict(zip(_MOVE, move, strict=True)) for move in moves],
                }
            )
        yield _batch(rows, _SEGMENT_ARROW)


def _join(closing: bool):
    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                children = row["children"]
                moves = joined_moves(
                    [[tuple(move[name] for name in _MOVE) for move in child["moves"]] for child in children], closing
                )
                seams = [one["last"] + other["opening"] for one, other in zip(children, children[1:])]
                rows.append(
                    {
                        "talk": row["talk"], "node": row["parent"], "opening": children[0]["opening"],
                        "last": children[-1]["last"],
                        "illegal": sum(child["illegal"] for child in children) + sum(s not in LEGAL for s in seams),
                        "moves": [dict(zip((*_MOVE, "targets"), move, strict=True)) for move in moves],
                    }
                )
            yield _batch(rows, _JOINED_ARROW)

    return run


def _edits(batches):
    """The turns that stay and those that are inserted, from the audit of each segment."""
    names = ["talk", "place", "slot", "edit", "new_role"]
    for batch in batches:
        out = [[] for _ in names]
        for row in batch.to_pylist():
            turns = [(one["initial"], one["fault"]) for one in row["turns"]]
            done, slot = 0, 0
            for letter, state in _states(row["source"], row["edits"], turns):
                place = row["first_place"] + min(done, len(turns) - 1)
                if letter != "D":
                    role = None if letter == "K" else _ROLE[state]
                    for column, value in zip(out, (row["talk"], place, slot, letter, role), strict=True):
                        column.append(value)
                slot += 1
                # behind the last turn only insertions follow, which keep its place and count on
                if letter != "I":
                    done += 1
                    slot = slot if done == len(turns) else 0
        types = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)


_MOVE_ARROW = [("source", pa.int32()), ("target", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]
_SEGMENT_ARROW = pa.schema(
    [
        ("talk", pa.int64()), ("node", pa.int64()), ("first_place", pa.int64()),
        ("turns", pa.list_(pa.struct([("initial", pa.string()), ("fault", pa.string())]))),
        ("opening", pa.string()), ("last", pa.string()), ("illegal", pa.int64()),
        ("moves", pa.list_(pa.struct(_MOVE_ARROW))),
    ]
)
_JOINED_ARROW = pa.schema(
    [
        ("talk", pa.int64()), ("node", pa.int64()), ("opening", pa.string()), ("last", pa.string()),
        ("illegal", pa.int64()), ("moves", pa.list_(pa.struct([*_MOVE_ARROW, ("targets", pa.string())]))),
    ]
)


def _batch(rows, schema):
    return pa.RecordBatch.from_pylist(rows, schema=schema)


# ---- the operator

class Repair(NamedTuple):
    """``turns``: ``talk, conv_id, place, slot, turn, role, text, edit`` of the repaired conversations, in order of
    (place, slot) within each talk. ``report``: one row per conversation with ``talk`` (its number), ``conv_id, gaps,
    blank, duplicate, truncated, illegal, cost, audit``.
    """

    turns: DataFrame
    report: DataFrame


def blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def truncated(text: Column) -> Column:
    """Whether the last character that is no space is other than ``.``, ``!`` and ``?``."""
    return ~F.substring(F.rtrim(text, F.lit(SPACES)), -1, 1).isin(".", "!", "?")


def repair_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> Repair:
    """Conversations as the cheapest edits leave them: an optional system turn, then user and assistant in turn.

    Keep costs 0, a new role (user or assistant) 2, deletion 3, insertion of a user or assistant turn without text 2;
    blank and duplicate turns must go, a truncated one that stays adds 1. Of equally cheap edits those of the least
    audit (first letters of the edits in order) are taken, which makes the result unique. Roles count by first letter.

    Turns go by ``turn`` (nulls first), ties by a digest of role and text; repeated rows are turns of their own, so all
    but one are duplicates. Null roles and texts are empty: such a text is blank, such a role must be replaced. Rows
    with a null conversation are one conversation. Other columns are not read. An empty table gives no rows.

    Texts are stored and take no part in the sorting; they move once, to the edits of their rows.

    A conversation is cut into segments of 256 turns. For each the agenda finds the lightest edits from every state
    before it to every state after it; a second agenda joins up to 256 of those, as often as the longest conversation
    needs. So no task holds a whole conversation, however long; only the audit is one string per conversation.
    """
    columns = [F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn")]
    for name, to in ((role_col, "role"), (text_col, "text")):
        columns.append(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(to))
    stored = written_once(turns.select(*columns, F.monotonically_increasing_id().alias("row")), "turn-texts")
    light = number_rows(
        stored.select(
            "conv_id", "turn", "row",
            F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("digest"),
            F.substring("role", 1, 1).alias("initial"), blank(F.col("text")).alias("blank"),
            truncated(F.col("text")).alias("truncated"),
        ),
        [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("digest")], "place",
    )
    seen = light.groupBy(F.col("conv_id").alias("of"), F.col("digest").alias("same")).agg(F.min("place").alias("earliest"))
    told = light.join(seen, light.conv_id.eqNullSafe(seen.of) & (light.digest == seen.same)).select(
        "conv_id", "turn", "place", "initial",
        F.when(F.col("blank"), "b").when(F.col("place") > F.col("earliest"), "d").when(F.col("truncated"), "t")
        .otherwise("").alias("fault"),
    )
    told = written_once(told, "turns")
    of_turn = told.groupBy("conv_id", "turn").agg(
        F.min("place").alias("low"), F.max("place").alias("high"),
        *[F.sum(F.when(F.col("fault") == fault, 1).otherwise(0)).alias(fault) for fault in "bdt"],
    )
    facts = written_once(
        of_turn.groupBy("conv_id").agg(
            F.min("low").alias("talk"), F.max("high").alias("final"),
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("bigint").alias("gaps"),
            *[F.sum(fault).alias(name) for fault, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))],
        ),
        "facts",
    )
    segment = F.floor(F.col("place") / F.lit(SEGMENT)).cast("bigint")
    cut = told.groupBy("conv_id", segment.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("place", "initial", "fault"))).alias("turns")  # at most SEGMENT
    )
    ends = facts.select(
        F.col("conv_id").alias("of"), "talk", F.floor(F.col("talk") / F.lit(SEGMENT)).cast("bigint").alias("first_part"),
        F.floor(F.col("final") / F.lit(SEGMENT)).cast("bigint").alias("last_part"),
    )
    numbered = cut.join(ends, cut.conv_id.eqNullSafe(ends.of)).select(
        "talk", (F.col("part") - F.col("first_part")).alias("node"),
        (F.col("last_part") - F.col("first_part")).alias("last_node"), "turns",
    )
    segments = written_once(numbered.mapInArrow(_solve, _SEGMENT_TYPE), "segments")
    longest = ends.agg(F.max(F.col("last_part") - F.col("first_part"))).first()[0] or 0
    levels = [segments.select("talk", "node", "opening", "last", "illegal", "moves")]
    while longest > 0 or len(levels) == 1:
        longest //= FAN
        levels.append(_joined(levels[-1], closing=longest == 0))
    root = levels[-1].select("talk", "illegal", F.col("moves")[0].alias("move"))
    chosen = root.select("talk", F.lit(0).cast("bigint").alias("node"), F.col("move.source"), F.col("move.target"))
    for level in reversed(levels[1:]):
        chosen = _chosen_below(level, chosen)
    audits = written_once(
        segments.join(chosen, ["talk", "node"]).select(
            "talk", "node", "first_place", "turns", "source", "target",
            F.filter(
                "moves", lambda move: (move["source"] == F.col("source")) & (move["target"] == F.col("target"))
            )[0]["audit"].alias("audit"),
        ),
        "audits",
    )
    closing = root.select("talk", F.element_at(_closing_letters(), F.col("move.target")).alias("closing"))
    last = ends.select("talk", (F.col("last_part") - F.col("first_part")).alias("last_node"))
    whole = audits.join(last.join(closing, "talk"), "talk").withColumn(
        "edits", F.when(F.col("node") == F.col("last_node"), F.concat("audit", "closing")).otherwise(F.col("audit"))
    )
    edits = whole.mapInArrow(_edits, _EDIT_TYPE)
    text = F.when(F.col("edit") == "I", "").otherwise(F.col("text"))
    placed = edits.join(light.select("place", "conv_id", "turn", "row"), "place")
    repaired = placed.join(stored.select("row", "role", "text"), "row").select(
        "talk", "conv_id", "place", "slot", F.when(F.col("edit") != "I", F.col("turn")).alias("turn"),
        F.coalesce("new_role", "role").alias("role"), text.alias("text"), "edit",
    )
    spelled = whole.groupBy("talk").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("node", "edits"))), lambda one: one["edits"]), ""
        ).alias("audit")
    )
    report = (
        facts.drop("final").join(root.select("talk", "illegal", F.col("move.cost").alias("cost")), "talk")
        .join(spelled, "talk")
        .select("talk", "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    )
    return Repair(repaired, report)


def _closing_letters() -> Column:
    return F.create_map(*[F.lit(value) for pair in _CLOSING.items() for value in pair])


def _joined(level: DataFrame, closing: bool) -> DataFrame:
    """The next level: the moves of ``FAN`` neighbouring nodes of a conversation joined."""
    child = F.struct("node", "opening", "last", "illegal", "moves")
    groups = level.groupBy("talk", F.floor(F.col("node") / F.lit(FAN)).cast("bigint").alias("parent")).agg(
        F.array_sort(F.collect_list(child)).alias("children")  # at most FAN
    )
    return written_once(groups.mapInArrow(_join(closing), _JOINED_TYPE), "joined")


def _chosen_below(level: DataFrame, chosen: DataFrame) -> DataFrame:
    """``talk, node, source, target`` of the nodes below those that are chosen."""
    targets = F.filter(
        "moves", lambda move: (move["source"] == F.col("source")) & (move["target"] == F.col("target"))
    )[0]["targets"]
    found = level.join(chosen, ["talk", "node"]).select("talk", "node", "source", targets.alias("targets"))
    steps = found.select("talk", "node", "source", "targets", F.posexplode(F.split("targets", "")).alias("at", "target"))
    before = F.substr(F.col("targets"), F.col("at"), F.lit(1))
    return steps.select(
        "talk", (F.col("node") * FAN + F.col("at")).alias("node"),
        F.when(F.col("at") == 0, F.col("source")).otherwise(before.cast("int")).alias("source"),
        F.col("target").cast("int").alias("target"),
    )


def conversation_digests(turns: DataFrame) -> DataFrame:
    """``talk, sha256`` of each conversation's ``role:text`` lines.

    A digest runs through its lines in order, so a conversation passes through one task, as a stream.
    """

    def run(batches):
        talk, state = None, None
        for batch in batches:
            keys, digests = [], []
            for key, line in zip(batch.column("talk").to_pylist(), batch.column("line").to_pylist(), strict=True):
                if key != talk:
                    if state is not None:
                        keys.append(talk)
                        digests.append(state.hexdigest())
                    talk, state = key, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(line.encode())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(digests)], names=["talk", "sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([talk], pa.int64()), pa.array([state.hexdigest()])], names=["talk", "sha256"]
            )

    lines = turns.select("talk", "place", "slot", F.concat("role", F.lit(":"), "text").alias("line"))
    ordered = lines.repartition("talk").sortWithinPartitions("talk", "place", "slot").select("talk", "line")
    return ordered.mapInArrow(run, "talk long, sha256 string")


def damage(turns: DataFrame) -> DataFrame:
    """Conversations with one turn in four damaged, by a checksum of conversation and turn; nulls become one space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")])
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    fate = F.col("fate")
    hit = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("fate"))
    return hit.filter(fate != 0).select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


SQL = r"""
WITH RECURSIVE k AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
    FROM conversations),
x AS (
    SELECT * EXCLUDE (name), xor(list_reduce(
               list_concat([4294967295], list_transform(string_split(name, ''), lambda c: CAST(ascii(c) AS BIGINT))),
               lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
                                        lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 20 AS fate
    FROM k),
d AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
           CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM x, range(2) AS r(copy) WHERE fate <> 0 AND (copy = 0 OR fate = 3)),
n AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, length(role), role, text) AS i,
           regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare
    FROM d),
t AS (
    SELECT conv_id, turn, role, text, i, substr(role, 1, 1) AS initial,
           CASE WHEN bare = '' THEN 'b' WHEN min(i) OVER (PARTITION BY conv_id, role, text) < i THEN 'd'
                WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault
    FROM n),
step AS (  -- what a turn may become between two states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant
    SELECT * FROM (VALUES
        (0, 's', 1, ''), (0, 'u', 2, ''), (0, 'a', 3, 'user:'), (1, 'u', 2, ''), (1, 'a', 3, 'user:'), (2, 'a', 3, ''),
        (2, 'u', 2, 'assistant:'), (3, 'u', 2, ''), (3, 'a', 3, 'user:')) AS v(state, initial, after, put)),
ways AS (
    SELECT state, initial, after, 'K' AS edit, put FROM step
    UNION ALL SELECT state, initial, after, 'R', put FROM step WHERE initial <> 's'
    UNION ALL SELECT state, '', state, 'D', '' FROM range(4) AS r(state)),
walk AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS state,
           {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS best
    FROM t
    UNION ALL
    SELECT w.conv_id, w.i + 1, s.after, min({
               'cost': w.best.cost + CASE WHEN s.put = '' THEN 0 ELSE 2 END
                       + CASE s.edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
                       + CASE WHEN t.fault = 't' AND s.edit <> 'D' THEN 1 ELSE 0 END,
               'audit': w.best.audit || CASE WHEN s.put = '' THEN '' ELSE 'I' END || s.edit,
               'lines': list_concat(w.best.lines, CASE WHEN s.put = '' THEN CAST([] AS VARCHAR[]) ELSE [s.put] END,
                        CASE s.edit WHEN 'D' THEN CAST([] AS VARCHAR[]) WHEN 'K' THEN [t.role || ':' || t.text]
                        ELSE [CASE s.initial WHEN 'u' THEN 'user:' ELSE 'assistant:' END || t.text] END)})
    FROM walk w JOIN t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1
    JOIN ways s ON s.state = w.state AND (s.edit = 'D' OR t.fault NOT IN ('b', 'd'))
        AND (s.edit <> 'K' OR s.initial = t.initial)
    GROUP BY w.conv_id, w.i + 1, s.after),
f AS (
    SELECT conv_id, turn, fault, i, initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS pair FROM t),
g AS (
    SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
           count(*) FILTER (WHERE fault = 't') AS truncated,
           count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM f GROUP BY conv_id),
e AS (
    SELECT g.conv_id, min({
               'cost': best.cost + CASE state WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END,
               'audit': best.audit || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
               'lines': list_concat(best.lines, CASE state WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:']
                        ELSE CAST([] AS VARCHAR[]) END)}) AS best
    FROM walk w JOIN g ON g.conv_id IS NOT DISTINCT FROM w.conv_id AND g.n = w.i GROUP BY g.conv_id),
o AS (SELECT DISTINCT conv_id FROM conversations)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM o LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM o.conv_id"""


def op11_lightest_repair(spark, folder):
    original = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    repair = repair_conversations(damage(original))
    digests = conversation_digests(repair.turns)
    found = repair.report.join(digests, "talk", "left").drop("talk").withColumnRenamed("conv_id", "of")
    every = original.select("conv_id").distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, every.conv_id.eqNullSafe(found.of), "left").select(
        "conv_id", *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
