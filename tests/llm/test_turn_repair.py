"""Role repair: cells against all edits and all splits, whole tables against a plain model."""

from __future__ import annotations

import hashlib
import re
from itertools import product
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from promptmill.llm import turn_repair as tr

_GRAMMAR = re.compile(r"(s?(ua)+)?")


def _cheapest(rows):
    """(cost, audit) of all edits with at most two insertions in a gap; rows are (initial, fault, dup)."""
    best = None
    for letters in product("DKR", repeat=len(rows)):
        if any(letter != "D" and (fault == tr.BLANK or dup) for letter, (_, fault, dup) in zip(letters, rows)):
            continue
        cost = sum({"D": 4, "K": 0, "R": 3}[x] + 3 * (x != "D" and r[1] == tr.CUT_OFF) for x, r in zip(letters, rows))
        for gaps in product(range(3), repeat=len(rows) + 1):
            audit = "I" * gaps[0] + "".join(x + "I" * g for x, g in zip(letters, gaps[1:]))
            total = cost + 3 * sum(gaps)
            if best is not None and (total, audit) >= best:
                continue
            if _fits(audit, [r[0] for r in rows]):
                best = (total, audit)
    return best


def _fits(audit, initials):
    left = iter(initials)
    options = []
    for letter in audit:
        initial = next(left) if letter != "I" else ""
        if letter != "D":
            options.append([initial] if letter == "K" else ["u", "a"])
    return any(_GRAMMAR.fullmatch("".join(o)) and all(o) for o in product(*options))


_ROW = st.tuples(st.sampled_from(["s", "u", "a", "t", ""]), st.sampled_from([0, 0, 0, 1, 2]), st.booleans())


@settings(max_examples=25, deadline=None)
@given(st.lists(_ROW, max_size=3))
def test_cheapest_edits_equal_all_edits(rows):
    spans = [tr.row_span(i, initial, fault, 1, dup) for i, (initial, fault, dup) in enumerate(rows)]
    found = tr.outcome(tr.bottom_up(spans, tr.join) if spans else None)
    assert (found["cost"], found["audit"]) == _cheapest(rows)


@settings(max_examples=30, deadline=None)
@given(st.lists(_ROW, min_size=1, max_size=9))
def test_one_split_of_a_span_equals_all_splits(rows):
    leaves = [tr.row_cells(*row) for row in rows]
    chart = {(i, i + 1): cells for i, cells in enumerate(leaves)}
    for length in range(2, len(rows) + 1):
        for i in range(len(rows) - length + 1):
            ways = [tr.combine(chart[i, k], chart[k, i + length]) for k in range(i + 1, i + length)]
            chart[i, i + length] = tuple(min((w[n] for w in ways if w[n]), default=None) for n in range(len(tr.NONTERMINALS)))
    assert tr.bottom_up(leaves, tr.combine) == chart[0, len(rows)]
    twice = tr.combine(leaves[0], tr.combine(leaves[0], leaves[0]))
    assert tr.repeated(leaves[0], 3) == twice


def _model(table):
    """The contract, row by row."""
    conversations = {}
    for conv, turn, role, text in table:
        rows = conversations.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        case = crc32(key.encode()) % 20
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        row = (turn, "user" if case == 4 else role, text)
        rows += [row] * (0 if case == 0 else 2 if case == 3 else 1)
    out = {}
    for conv, rows in conversations.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        met, faults = set(), []
        for _, role, text in rows:
            body = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in met else "truncated" if body[-1] not in ".!?" else "")
            met.add((role, text))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        # Forward: best (cost, audit, lines) of each state.
        best = {0: (0, "", ())}

        def insert(best):
            for _ in range(3):
                for state, (cost, audit, lines) in list(best.items()):
                    for role in "ua":
                        if (to := tr.NEXT[role].get(state)) is not None:
                            new = (cost + 3, audit + "I", (*lines, tr.NAMES[role] + ":"))
                            if to not in best or new[:2] < best[to][:2]:
                                best[to] = new

        insert(best)
        for (_, role, text), fault in zip(rows, faults):
            after = {}

            def offer(state, cost, audit, lines):
                if state not in after or (cost, audit) < after[state][:2]:
                    after[state] = (cost, audit, lines)

            for state, (cost, audit, lines) in best.items():
                offer(state, cost + 4, audit + "D", lines)
                if fault in ("blank", "duplicate"):
                    continue
                more = 3 if fault == "truncated" else 0
                for r in "ua":
                    if (to := tr.NEXT[r].get(state)) is not None:
                        offer(to, cost + 3 + more, audit + "R", (*lines, f"{tr.NAMES[r]}:{text}"))
                if (to := tr.NEXT.get(role[:1], {}).get(state)) is not None:
                    offer(to, cost + more, audit + "K", (*lines, f"{role}:{text}"))
            insert(after)
            best = after
        cost, audit, lines = min((best[s] for s in (0, 3) if s in best), key=lambda b: b[:2])
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)
    return out


def _check(spark, table):
    rows = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    rows = rows.selectExpr("conv_id", "turn", "role", "text", "1 as part", "'x' as audit", "2 as copies")
    found = tr.repair(tr.damaged(rows)).collect()
    got = {r.conv_id: tuple(r)[1:] for r in found}
    assert len(found) == len(got)
    assert got == _model(table)


@pytest.fixture
def turns():
    import random

    rng = random.Random(5)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None])
            rows.append((conv, turn * rng.choice([1, 1, 2]), role, rng.choice(["Yes.", "No!", "why", " ", "", None, "Ünï 中文?\n"])))
    rows += [(None, 1, "user", "no id."), (None, None, "assistant", "no turn."), (7, None, "user", "first?"), (7, None, "user", "b")]
    # One turn only, so that some conversations lose all of their rows.
    rows += [(100 + i, 3, "user", "Only.") for i in range(60)]
    # A hot conversation, one row that it repeats, and a long text.
    rows += [(500, t, ("user", "assistant")[t % 2], f"{t % 90} words.") for t in range(900)]
    rows += [(500, 17, "user", "again and again.")] * 200 + [(501, 2, "user", "long " * 40_000)]
    return rows


def test_whole_table_equals_the_model(spark, turns):
    _check(spark, turns)


def test_conversations_cut_by_ranges_and_blocks(spark, turns, monkeypatch):
    monkeypatch.setattr(tr, "BLOCK_ROWS", 16)
    monkeypatch.setattr(tr, "MOST_ROWS", 64)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        _check(spark, turns)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_table(spark):
    _check(spark, [])
