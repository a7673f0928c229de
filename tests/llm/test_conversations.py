"""Repairs against the least of all edit sequences, and conversations longer than a slab."""

import hashlib
import itertools
import random
import re

import pytest

from cdcstrata.llm import conversations as C

WELL = re.compile(r"(s?(ua)+)?")
COLUMNS = "conv_id bigint, turn bigint, role string, text string"


def all_edits(rows):
    """Least (cost, audit) by trying every sequence: at most two inserts in a gap, as a third comes back to a state."""
    choices = []
    for letter, fault in rows:
        ways = [("D", 3, "")]
        if fault in ("", "T"):
            late = fault == "T"
            ways += [("R", 2 + late, "u"), ("R", 2 + late, "a"), ("K", late, letter or "?")]
        choices.append(ways)
    gaps = [("", 0, ""), ("I", 2, "u"), ("I", 2, "a"), ("II", 4, "ua"), ("II", 4, "au")]
    best = None
    for way in itertools.product(*choices):
        for put in itertools.product(gaps, repeat=len(rows) + 1):
            parts = [put[0]] + [x for pair in zip(way, put[1:], strict=True) for x in pair]
            if WELL.fullmatch("".join(p[2] for p in parts)):
                found = sum(p[1] for p in parts), "".join(p[0] for p in parts)
                best = min(best, found) if best else found
    return best


@pytest.mark.parametrize("seed", range(40))
def test_cheapest_of_all_edits(seed):
    r = random.Random(seed)
    rows = [(r.choice("suaat "), r.choice(["", "", "T", "B", "D"])) for _ in range(r.randint(0, 4))]
    assert C.cheapest(rows) == all_edits(rows)


def backward(rows, start, ends):
    """Best endings from the last row back, for longer conversations."""
    n = len(rows)
    best = [{} for _ in range(n + 1)]
    for i in range(n, -1, -1):
        here = {q: (0, "") for q in ends} if i == n else {}
        if i < n:
            for q in C.STATES:
                found = [
                    (cost + best[j][p][0], initial + best[j][p][1])
                    for j, p, cost, initial in C._forward(rows, i, q)
                    if j > i and p in best[j]
                ]
                if found:
                    here[q] = min(found)
        for _ in range(3):
            for q in C.STATES:
                p = C.NEXT[q]
                if p in here:
                    way = here[p][0] + 2, "I" + here[p][1]
                    here[q] = min(here.get(q, way), way)
        best[i] = here
    return best[0].get(start)


@pytest.mark.parametrize("seed", range(60))
def test_between_any_states(seed):
    r = random.Random(1000 + seed)
    rows = [(r.choice(["s", "u", "a", "t", ""]), r.choice(["", "", "", "T", "B", "D"])) for _ in range(r.randint(0, 25))]
    for start in C.STATES:
        assert C.cheapest(rows, start) == backward(rows, start, C.ENDS)
        for end in C.STATES:
            assert C.cheapest(rows, start, (end,)) == backward(rows, start, (end,))


def plain(rows):
    """Faults, edits and repaired text of one conversation's rows in order."""
    rows = [(role if role is not None else " ", text if text is not None else " ") for role, text in rows]
    seen, steps = set(), []
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\f\r")
        fault = "B" if not bare else "D" if (role, text) in seen else "" if bare[-1] in ".!?" else "T"
        seen.add((role, text))
        steps.append((role[:1], fault))
    cost, audit = backward(steps, C.START, C.ENDS)
    state, lines, left = C.START, [], list(zip(rows, steps, strict=True))
    for e in audit:
        if e == "I":
            state = C.NEXT[state]
            lines.append(f"{C.NAMES[state]}:")
            continue
        (role, text), (letter, _) = left.pop(0)
        state = C._leads(letter, state, e)
        if e != "D":
            lines.append(f"{role if e == 'K' else C.NAMES[state]}:{text}")
    letters = [s[0] for s in steps]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:], strict=False))
    kinds = [s[1] for s in steps]
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return kinds.count("B"), kinds.count("D"), kinds.count("T"), illegal, cost, audit, digest


def test_conversations_as_a_plain_reading(spark):
    r = random.Random(3)
    table, want = [], {}
    for conv in [None, *range(60)]:
        rows = []
        for turn in [None, *range(r.randint(0, 9))]:
            if r.random() < 0.8:
                text = r.choice([None, "", " \t", "Yes.", "No", "Why? ", "long " * 50 + "end.", f"turn {turn}!"])
                rows.append((turn, r.choice(["user", "assistant", "assistant", "system", None, "", "tool"]), text))
        if conv == 7:  # far longer than a slab
            rows = [(t, r.choice(["user", "assistant"]), r.choice([f"t{t}.", f"t{t}", "Again.", ""])) for t in range(2600)]
        if rows:
            want[conv] = plain([x[1:] for x in rows])
        table += [(conv, *x) for x in rows]
    df = spark.createDataFrame(table, COLUMNS).selectExpr("*", "1 AS place", "'x' AS slab", "2 AS fault", "3 AS piece").repartition(6)
    got = {r["conv_id"]: r for r in C.repaired(df).collect()}
    assert set(got) == set(want)
    for conv, w in want.items():
        g = got[conv]
        assert (g["blank"], g["duplicate"], g["truncated"], g["illegal"], g["cost"], g["audit"], g["repaired_sha256"]) == w


def test_gaps_and_lost_conversations(spark):
    rows = [(1, 3, "user", "Hi."), (1, 9, "assistant", "Yes."), (2, None, "user", "Hi."), (None, 1, "user", "Hi.")]
    df = spark.createDataFrame(rows, COLUMNS)
    got = {r["conv_id"]: r for r in C.repaired(df).collect()}
    assert (got[1]["gaps"], got[2]["gaps"], got[None]["gaps"]) == (5, 0, 0)
    assert got[1]["audit"] == "KK" and got[1]["cost"] == 0
    many = spark.range(200).selectExpr("id AS conv_id", "1L AS turn", "'user' AS role", "'Hi.' AS text")
    damaged = {r["conv_id"]: r for r in C.repair_damage(many).collect()}
    assert len(damaged) == 200
    empty = hashlib.sha256(b"").hexdigest()
    lost = [r for r in damaged.values() if r["audit"] == ""]
    assert lost and all(r["cost"] == 0 and r["repaired_sha256"] == empty for r in lost)
    assert C.repair_damage(many.filter("conv_id < 0")).count() == 0
