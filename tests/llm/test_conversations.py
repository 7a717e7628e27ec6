"""Conversation repair: the search against plain dynamic programming and full enumeration, the query against brute force."""

import hashlib
import itertools
import os
import random
import re
import zlib

import pytest

from rasterloom.llm import conversations as cv
from rasterloom.llm.queries import QUERIES

SPACE = " \t\n\x0b\x0c\r"


def table(steps, start):
    """Per state the (cost, least audit) of the cheapest edits that consume all steps, one row after the other."""
    best = {start: (0, "")}
    for i in range(len(steps) + 1):
        for _ in range(3):
            for q, (c, a) in list(best.items()):
                z = cv.FOLLOWS[q]
                best[z] = min(best.get(z, (10**9, "")), (c + 5, a + "I"))
        if i == len(steps):
            return best
        m, initial, short = steps[i]
        after = {}
        for q, (c, a) in best.items():
            moves = [(2 * m, "D" * m, q)]
            if initial is not None:
                moves.append((1 + 5 * short, "R", cv.FOLLOWS[q]))
                allowed = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[q]
                if initial in allowed:
                    moves.append((5 * short, "K", allowed[initial]))
            for more, op, z in moves:
                after[z] = min(after.get(z, (10**9, "")), (c + more, a + op))
        best = after


def random_steps(rng, n):
    return [rng.choice([(1, rng.choice("suax"), rng.random() < 0.3), (rng.randint(1, 3), None, False), (1, rng.choice("ua"), False)]) for _ in range(n)]


def test_meeting_searches_find_the_least_audit():
    rng = random.Random(3)
    for _ in range(3000):
        steps, start = random_steps(rng, rng.randint(0, 9)), rng.randrange(4)
        want = table(steps, start)
        for z in range(4):
            assert cv.cheapest(steps, start, (z,)) == ((*want[z], z) if z in want else None)
        ends = [(*want[z], z) for z in cv.ENDS if z in want]
        assert cv.cheapest(steps, start, cv.ENDS) == min(ends)


def test_cheapest_of_all_audits_by_enumeration():
    rng = random.Random(4)
    for _ in range(60):
        steps = random_steps(rng, rng.randint(0, 3))
        found = []
        for ops in itertools.chain.from_iterable(itertools.product("KRDI", repeat=k) for k in range(sum(s[0] for s in steps) + 4)):
            rows = [x for m, c, s in steps for x in [(c, s)] * m]
            if sum(o != "I" for o in ops) != len(rows):
                continue
            for roles in itertools.product("ua", repeat=sum(o in "RI" for o in ops)):
                made, cost, it, names = "", 0, iter(rows), iter(roles)
                for o in ops:
                    c, short = (None, False) if o == "I" else next(it)
                    if o in "KR" and c is None:
                        break
                    cost += {"K": 0, "R": 1, "D": 2, "I": 5}[o] + 5 * (o in "KR" and short)
                    made += c if o == "K" else next(names) if o in "RI" else ""
                else:
                    if re.fullmatch("(s?(ua)+)?", made):
                        found.append((cost, "".join(ops)))
        assert cv.cheapest(steps, 0, cv.ENDS)[:2] == min(found)


def brute(rows):
    """The contract row by row."""
    by, out = {}, {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, [])
        say = lambda x: " " if x is None else str(x)
        kind, role, text = zlib.crc32(f"{say(conv)}:{say(turn)}".encode()) % 20, say(role), say(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, damaged in by.items():
        damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, _, _ in damaged if t is not None}
        counts, seen, steps, bodies = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), [], []
        for _, role, text in damaged:
            stripped = text.rstrip(SPACE)
            fault = "blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            steps.append((1, None if fault in ("blank", "duplicate") else role[:1], fault == "truncated"))
        cost, audit = min(x for z, x in table(steps, 0).items() if z in (0, 3))
        it, state = iter(damaged), 0
        for op in audit:
            row = None if op == "I" else next(it)
            if op == "D":
                continue
            role = row[1] if op == "K" else "assistant" if state == 2 else "user"
            state = {"s": 1, "u": 2, "a": 3}[role[:1]]
            bodies.append(f"{role}:{row[2] if row else ''}")
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(damaged, damaged[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(bodies).encode()).hexdigest())
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
result = lambda df: {r.conv_id: tuple(r[c] for c in NAMES) for r in df.collect()}


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_against_brute_force(spark, size):
    folder = os.path.join(os.environ.get("TEST_DATA", "/root/testdata"), size)
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = result(QUERIES["op13_conversation_repair"](spark, folder))
    assert got == brute(rows) and len({x[5] for x in got.values()}) > 4


SCHEMA = "conv_id long, turn long, role string, text string, k string, rank int, seg string"


def odd_rows(rng, n, convs):
    said = ["Yes.", "No", "", " \t", None, "Why? ", "a" * 5000 + "!", "…", "Yes. \x0b\n", "naïve?"]
    return [(rng.choice([*range(convs), None]), rng.choice([*range(12), None]), rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(said), "x", 1, None) for _ in range(n)]


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return result(cv.repaired(cv.damaged(df), df.select("conv_id").distinct()))


def test_odd_rows_ties_repeats_and_clashing_names(spark):
    rows = odd_rows(random.Random(6), 400, 25)
    assert run(spark, rows + rows[:50]) == brute([r[:4] for r in rows + rows[:50]])


def test_conversations_of_many_segments(spark, monkeypatch):
    monkeypatch.setattr(cv, "SEGMENT", 4)
    monkeypatch.setattr(cv, "JOINED", 3)
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), f"{t % 9} says {rng.choice(['this.', 'that'])}", "x", 1, None) for c in range(3) for t in range(rng.choice([3, 40, 130]))]
    assert run(spark, rows) == brute([r[:4] for r in rows])


def test_a_row_repeated_often_is_counted(spark):
    rows = [(1, 0, "user", "Hello?", "x", 1, None)] * 3000 + [(1, 1, "assistant", "Hello.", "x", 1, None)]
    assert run(spark, rows) == brute([r[:4] for r in rows])


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cv.repaired(cv.damaged(empty), empty.select("conv_id")).collect() == []
    alone = cv.repaired(cv.damaged(empty), spark.createDataFrame([(5,)], "conv_id long")).collect()
    assert [tuple(r) for r in alone] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
