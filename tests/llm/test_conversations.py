"""Repair of conversations against a search over all edits."""

import functools
import hashlib
import random
import zlib

import pytest

from recordloom.llm import conversations
from recordloom.llm.conversations import Block, Solver
from recordloom.llm.queries import damaged

SPACES = " \t\n\x0b\x0c\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
FULL = {"u": "user", "a": "assistant"}


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        end = text.rstrip(SPACES)
        again = (role, text) in seen
        out.append("blank" if not end else "duplicate" if again else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain(rows):
    """The report of rows ``(turn, role, text)`` in order, and what is left of them."""
    faults = faults_of(rows)

    @functools.lru_cache(None)
    def best(i, state, inserted):
        out = []
        if i == len(rows) and state in ("", "a"):
            out.append((0, "", ()))
        if inserted < 4 and (rest := best(i, NEXT[state], inserted + 1)):
            out.append((rest[0] + 3, "I" + rest[1], ((FULL[NEXT[state]], ""), *rest[2])))
        if i < len(rows):
            _, role, text = rows[i]
            extra = 3 if faults[i] == "truncated" else 0
            choices = [("D", 4, state, ())]
            if faults[i] not in ("blank", "duplicate"):
                if role[:1] == NEXT[state] or (role[:1] == "s" and state == ""):
                    choices.append(("K", extra, role[:1], ((role, text),)))
                choices.append(("R", 3 + extra, NEXT[state], ((FULL[NEXT[state]], text),)))
            for letter, cost, to, said in choices:
                if rest := best(i + 1, to, 0):
                    out.append((rest[0] + cost, letter + rest[1], (*said, *rest[2])))
        return min(out) if out else None

    for i in reversed(range(len(rows))):
        for state in NEXT:
            best(i, state, 0)  # keeps the recursion flat
    cost, audit, left = best(0, "", 0)
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    counts = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
    text = "\n".join(f"{role}:{text}" for role, text in left)
    illegal = sum(pair not in ("su", "ua", "au") for pair in pairs)
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), left


def reports(rows):
    """Per conversation of ``(conv_id, turn, role, text, copies)`` the report, and the turns that are left."""
    by_id = {}
    for conv_id, turn, role, text, copies in rows:
        own = by_id.setdefault(conv_id, [])
        own += [(turn, " " if role is None else role, " " if text is None else text)] * copies
    out = {}
    for conv_id, own in by_id.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        out[conv_id] = plain(tuple(own))
    return out


def drawn(seed, conversations_, longest=9, ids=None):
    choose = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "u", "tool", " ", "", None]
    texts = ["hi.", "ho", "  ", "", "x?", "y! ", "z\n", "long " * 50, "é. ", "a\x85", None]
    rows = []
    for k in range(conversations_):
        for turn in range(choose.randint(1, longest)):
            text = choose.choice([*texts, f"own {turn}.", f"own {turn}"])
            number = choose.choice([turn, turn, turn, turn * 3, None])
            rows.append((ids[k] if ids else k, number, choose.choice(roles), text, choose.choice([1] * 6 + [0, 2, 5])))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, copies int, cost string, audit int, part string, rows int"


def check(spark, rows, **more):
    df = spark.createDataFrame([(*r, "c", 1, "p", 2) for r in rows], SCHEMA).repartition(4)
    repair = conversations.repair(df, with_turns=True, **more)
    expected = reports(rows)
    found = {r.conv_id: tuple(r)[1:] for r in repair.report.collect()}
    assert repair.report.count() == len(found)
    assert found == {k: report for k, (report, _) in expected.items()}
    left = {}
    for r in repair.turns.orderBy("part", "seq", "place").collect():
        left.setdefault(r.conv_id, []).append((r.role, r.text))
    assert left == {k: list(turns) for k, (_, turns) in expected.items() if turns}


def test_solver_against_all_edits():
    for seed in range(2000):
        rows = sorted(((t or 0, r or "", x or "") for _, t, r, x, _ in drawn(seed, 1)), key=lambda r: r[0])
        faults = faults_of(rows)
        block = Block([(t, r, x, 1, f == "blank", f == "duplicate", f == "truncated") for (t, r, x), f in zip(rows, faults)])
        audit, cost, _, turns = Solver(block, None).path(conversations.START)
        report, left = plain(tuple(rows))
        assert (cost, audit) == report[5:7]
        assert [(role, text) for _, role, text in turns] == list(left)


def test_against_all_edits(spark):
    check(spark, drawn(1, 150) + drawn(2, 1, ids=[None]))


@pytest.mark.parametrize("block_rows", [1, 2, 5])
def test_long_conversations_in_blocks(spark, block_rows):
    """One conversation holds most rows, another is in the middle of a range."""
    rows = drawn(3, 3, longest=120, ids=[7, 8, None]) + drawn(4, 30, ids=list(range(100, 130)))
    check(spark, rows, block_rows=block_rows)


def test_a_text_that_most_rows_share(spark, monkeypatch):
    monkeypatch.setattr(conversations, "SHARED_ROWS", 20)
    rows = [(1, turn, "user", "same.", 1) for turn in range(200)] + [(1, None, "user", "same.", 300)]
    rows += [(2, turn, "assistant", "other", 1) for turn in range(10)] + drawn(5, 20, ids=list(range(10, 30)))
    check(spark, rows, block_rows=16)


def test_empty_and_dropped(spark):
    check(spark, [])
    check(spark, [(1, 1, "user", "a.", 0), (None, None, None, None, 0), (2, 2, "user", "b.", 1), (2, 3, "assistant", "c.", 1)])
    check(spark, [(None, None, None, None, 3), (5, -(2**63), "user", "a.", 1)])


def test_turns_far_apart(spark):
    df = spark.createDataFrame([(1, -(2**63), "user", "a."), (1, 2**63 - 1, "assistant", "b.")], "conv_id long, turn long, role string, text string")
    assert conversations.repair(df).report.first().gaps == -2  # 2^64 - 2, as a 64-bit number


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! three?") for c in (*range(30), None) for t in (0, 1, 2, None)] + [(1, 9, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {(r.conv_id, r.turn): r for r in damaged(df).collect()}
    for conv_id, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        fate, row = zlib.crc32(key.encode()) % 20, found[conv_id, turn]
        assert row.copies == {0: 0, 3: 2}.get(fate, 1)
        assert row.role == ("user" if fate == 4 else " " if role is None else role)
        whole = " " if text is None else text
        assert row.text == {1: "", 2: "".join(c for c in whole if c not in ".!?")}.get(fate, whole)
