import hashlib
import random
import re
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.llm import dialogue_repair as repair
from tallyspark.llm.dialogue_repair import conversation_digests, joined_moves, repair_conversations, segment_moves

LEGAL = re.compile("(s?(ua)+)?")
TURNS = st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from(["", "t", "b", "d"])), max_size=12)
SCHEMA = "conv_id long, turn long, role string, text string"


def every_edit(turns):
    """Cheapest (cost, audit) among all edits with up to two insertions at each place."""
    puts = ["", "u", "a", "ua", "au", "uu", "aa"]
    own = []
    for initial, fault in turns:
        late = fault == "t"
        ways = [(3, "D", "")]
        if fault not in ("b", "d"):
            ways += [(late, "K", initial), (2 + late, "R", "u"), (2 + late, "R", "a")]
        own.append([(2 * len(p) + c, "I" * len(p) + e, p + r) for p in puts for c, e, r in ways])
    own.append([(2 * len(p), "I" * len(p), p) for p in puts])
    best = None
    for chosen in product(*own):
        if LEGAL.fullmatch("".join(roles for _, _, roles in chosen)):
            value = (sum(c for c, _, _ in chosen), "".join(e for _, e, _ in chosen))
            best = value if best is None else min(best, value)
    return best


def in_turn(turns):
    """The same by one pass over the turns with the best of each state."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    def inserted(best):
        out = dict(best)
        for _ in range(3):
            for state, (cost, audit) in list(out.items()):
                for role in follow[state].replace("s", ""):
                    value = (cost + 2, audit + "I")
                    out[role] = min(out.get(role, value), value)
        return out

    best = {"": (0, "")}
    for initial, fault in turns:
        late = int(fault == "t")
        new = {}
        for state, (cost, audit) in inserted(best).items():
            ways = [(state, cost + 3, audit + "D")]
            if fault not in ("b", "d"):
                ways += [(initial, cost + late, audit + "K")] if initial and initial in follow[state] else []
                ways += [(role, cost + 2 + late, audit + "R") for role in follow[state] if role != "s"]
            for to, *value in ways:
                new[to] = min(new.get(to, tuple(value)), tuple(value))
        best = new
    ends = inserted(best)
    return min(ends[state] for state in ("", "a") if state in ends)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from(["", "t", "b"])), max_size=3))
def test_lightest_of_all_edits(turns):
    (_, _, cost, audit), = segment_moves(turns, (repair.EMPTY,), True)
    assert (cost, audit) == every_edit(turns) == in_turn(turns)


@settings(max_examples=150, deadline=None)
@given(TURNS, st.integers(1, 4), st.integers(2, 3))
def test_segments_joined_as_whole(turns, size, fan):
    (_, _, cost, audit), = segment_moves(turns, (repair.EMPTY,), True)
    assert (cost, audit) == in_turn(turns)
    if not turns:
        return
    cut = [turns[at : at + size] for at in range(0, len(turns), size)]
    level = [
        segment_moves(part, (0,) if place == 0 else (0, 1, 2, 3), False) for place, part in enumerate(cut)
    ]
    paths = [{(move[0], move[1]): [move[3]] for move in moves} for moves in level]
    while True:
        closing = len(level) <= fan
        joined, spelled = [], []
        for at in range(0, len(level), fan):
            moves = joined_moves([[move[:4] for move in child] for child in level[at : at + fan]], closing)
            told = {}
            for source, target, _, _, targets in moves:
                state, parts = source, []
                for child, to in zip(paths[at : at + fan], targets, strict=True):
                    parts += child[state, int(to)]
                    state = int(to)
                told[source, target] = parts
            joined.append(moves)
            spelled.append(told)
        level, paths = joined, spelled
        if closing:
            break
    (source, target, total, *_), = level[0]
    assert (total, "".join(paths[0][source, target]) + repair._CLOSING[target]) == (cost, audit)


def plain(rows):
    """Report and digest of the rows of one conversation, after sorting."""
    ordered = sorted(
        ((turn, role or "", text or "") for turn, role, text in rows),
        key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()),
    )
    seen, faults = set(), []
    for _, role, text in ordered:
        bare = text.strip(" \t\n\x0b\f\r")
        faults.append("b" if not bare else "d" if (role, text) in seen else "" if bare[-1] in ".!?" else "t")
        seen.add((role, text))
    turns = [(role[:1], fault) for (_, role, _), fault in zip(ordered, faults, strict=True)]
    cost, audit = in_turn(turns)
    state, lines, at = "", [], 0
    for letter in audit:
        role = "assistant" if state == "u" else "user"
        if letter == "I":
            lines.append(f"{role}:")
        elif letter == "R":
            lines.append(f"{role}:{ordered[at][2]}")
        elif letter == "K":
            role = ordered[at][1]
            lines.append(f"{role}:{ordered[at][2]}")
        state = state if letter == "D" else role[0]
        at += letter != "I"
    known = [turn for turn, _, _ in ordered if turn is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(turns, turns[1:]))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest() if lines else None
    return (gaps, *[faults.count(f) for f in "bdt"], illegal, cost, audit), digest


def held(spark, rows):
    talks = {}
    for row in rows:
        talks.setdefault(row[0], []).append(row[1:])
    done = repair_conversations(spark.createDataFrame(rows, SCHEMA))
    digests = {row.talk: row.sha256 for row in conversation_digests(done.turns).collect()}
    found = {row.conv_id: (tuple(row)[2:], digests.get(row.talk)) for row in done.report.collect()}
    assert found == {key: plain(rows) for key, rows in talks.items()}
    return done


def test_odd_rows(spark):
    long = "word " * 50_000 + "."
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Hello there."), (2, None, "user", "a"), (2, 3, None, "b."),
        (2, 7, "", None), (2, 7, "user", " \n"), (None, 1, "assistant", "x!"), (None, None, "tool", "y?"), (3, 0, None, None),
        (4, 0, "user", long), (4, 0, "user", long), (4, 0, "user", long), (5, 5, "system", "S."), (6, 1, "unknown", "u."),
        (7, 0, "assistant", "a."), (7, 1, "assistant", "b."), (7, 1, "system", "c."), (8, None, None, None), (8, None, None, None),
    ]
    held(spark, rows)


def test_names_and_empty_table(spark):
    rows = [(1, 0, "user", "Hi."), (1, 2, "user", "There")]
    names = "place long, talk long, slot string, edit string, node int, digest string, turn int"
    df = spark.createDataFrame([(*row, 1, "x", 2) for row in rows], names)
    done = repair_conversations(df, "place", "talk", "slot", "edit")
    assert [tuple(row)[1:] for row in done.report.collect()] == [(1, 1, 0, 0, 1, 1, 3, "KR")]
    none = repair_conversations(spark.createDataFrame([], SCHEMA))
    assert none.report.count() == 0 and none.turns.count() == 0 and conversation_digests(none.turns).count() == 0


@pytest.mark.parametrize(("segment", "fan"), [(256, 256), (16, 256), (4, 5)])
def test_long_conversations(spark, monkeypatch, segment, fan):
    """Conversations of many segments and, with few joined at once, of several levels."""
    monkeypatch.setattr(repair, "SEGMENT", segment)
    monkeypatch.setattr(repair, "FAN", fan)
    dice = random.Random(5)
    rows = []
    for conv, count in enumerate([700, 3, 1, 90, 17]):
        for turn in range(count):
            role = dice.choice(["user", "assistant"] * 4 + ["system"])
            rows.append((conv, turn, role, dice.choice(["Yes.", "", f"n {turn}.", f"m {turn}", f"k {turn}!"])))
    done = held(spark, rows)
    turns = done.turns.orderBy("talk", "place", "slot").collect()
    for conv in range(5):
        roles = "".join(row.role[0] for row in turns if row.conv_id == conv)
        assert LEGAL.fullmatch(roles)
