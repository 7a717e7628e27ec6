"""Repair of a conversation's turns at the least cost: bidirectional Dijkstra over the edit lattice.

A node of the lattice is (rows consumed, role state); the edits are its edges: keep a row, give it another role, delete
it, insert an empty turn. A forward search from the start and a reverse search from the goals run on two heaps until no
path over a node that either has yet to settle can be as cheap as the best meeting; then all crossings of that cost are
joined and the least audit is taken. No cheapest audit to a node is a proper prefix of another (what is between them would
be inserts, which cost), so the least audit to a node is always a part of the least audit through it.

Rows alike in turn, role and text are counted, not listed, and a conversation is cut into segments of SEGMENT rows: the
lattice of each is searched from every state to every state, and those tables are joined, neighbours first. So a
conversation may be as long as it likes; only the digest of its repaired text is made by one task, row after row.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.llm.shared import DEALT, met, ranked, written

#: Rows of a conversation whose lattice is searched at once; segments whose tables are joined at once.
SEGMENT, JOINED = 1024, 16
REROLE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
#: Role states: nothing yet, after system, after user, after assistant; the role that may come next; where it may end.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = (USER, USER, ASSISTANT, USER)
ENDS = (START, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}

#: A step of the lattice: number of rows, initial of the role (None: must be deleted), whether its text is cut short.
Step = tuple[int, "str | None", bool]


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role and text after damage by crc32(``conv_id:turn``) % 20: 0 drops a row, 1 empties its text, 2
    removes its ``.!?``, 3 repeats it, 4 sets its role to user. A null is one space in the key, and as role or text."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(said(conv_id), F.lit(":"), said(turn))) % 20
    hurt = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), said(role).alias("role"), said(text).alias("text"), kind.alias("kind")).where("kind <> 0")
    words = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return hurt.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), words.alias("text"), copies.alias("copy")).drop("copy")


def kept_state(state: int, initial: str) -> int | None:
    """The state after a kept row, None if it can't stand there."""
    if initial == "s":
        return SYSTEM if state == START else None
    after = {"u": USER, "a": ASSISTANT}.get(initial)
    return after if after is not None and FOLLOWS[state] == after else None


def edges(steps: list[Step], node: tuple[int, int]) -> Iterator[tuple[int, str, tuple[int, int]]]:
    """(cost, audit, node) of the edges out of a node."""
    i, state = node
    yield INSERT, "I", (i, FOLLOWS[state])
    if i < len(steps):
        times, initial, short = steps[i]
        yield DELETE * times, "D" * times, (i + 1, state)
        if initial is not None:
            more = CUT_SHORT * short
            yield REROLE + more, "R", (i + 1, FOLLOWS[state])
            if (after := kept_state(state, initial)) is not None:
                yield more, "K", (i + 1, after)


def edges_back(steps: list[Step], node: tuple[int, int]) -> Iterator[tuple[int, str, tuple[int, int]]]:
    """(cost, audit, node) of the edges into a node."""
    i, state = node
    for j in (i, i - 1):
        if j >= 0:
            for before in range(4):
                for cost, audit, to in edges(steps, (j, before)):
                    if to == node:
                        yield cost, audit, (j, before)


def cheapest(steps: list[Step], start: int, goals: tuple[int, ...]) -> tuple[int, str, int] | None:
    """Cost, audit and last state of the least audit of the cheapest edits from ``start`` to one of ``goals``."""
    n = len(steps)
    first, last = (0, start), [(n, g) for g in goals]
    ahead, back = {first: (0, "")}, {g: (0, "", g[1]) for g in last}
    heaps = [[(0, 0, first)], [(0, 0, g) for g in last]]
    done: tuple[set, set] = (set(), set())
    best = 0 if first in back else float("inf")
    while True:
        for heap, settled in zip(heaps, done):
            while heap and heap[0][2] in settled:
                heapq.heappop(heap)
        if not heaps[0] or not heaps[1] or heaps[0][0][0] + heaps[1][0][0] > best:
            break
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, _, node = heapq.heappop(heaps[side])
        done[side].add(node)
        # at equal cost those that have consumed more (or less, from behind) come later: keeping a row costs nothing
        if side == 0:
            for more, audit, to in edges(steps, node):
                new = (cost + more, ahead[node][1] + audit)
                if to not in done[0] and (to not in ahead or new < ahead[to]):
                    ahead[to] = new
                    heapq.heappush(heaps[0], (new[0], to[0], to))
                if to in back:
                    best = min(best, new[0] + back[to][0])
        else:
            for more, audit, to in edges_back(steps, node):
                new = (cost + more, audit + back[node][1], back[node][2])
                if to not in done[1] and (to not in back or new < back[to]):
                    back[to] = new
                    heapq.heappush(heaps[1], (new[0], n - to[0], to))
                if to in ahead:
                    best = min(best, new[0] + ahead[to][0])
    if best == float("inf"):
        return None
    behind = done[1].union(last)
    found = [(ahead[v][1] + back[v][1], back[v][2]) for v in done[0].union([first]) & behind if ahead[v][0] + back[v][0] == best]
    for v in done[0]:
        for more, audit, to in edges(steps, v):
            if to in behind and ahead[v][0] + more + back[to][0] == best:
                found.append((ahead[v][1] + audit + back[to][1], back[to][2]))
    return best, *min(found)


def steps_of(initials: list[str], times: list[int], fresh: list[bool], short: list[bool]) -> list[Step]:
    """The steps of rows: one that isn't fresh (blank, or said before) must go, and so must all but its first copy."""
    out: list[Step] = []
    for c, m, f, s in zip(initials, times, fresh, short):
        if f:
            out.append((1, c, s))
            m -= 1
        if m:
            out.append((m, None, False))
    return out


def _by_segment(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[list]]]:
    """The columns of successive rows with equal first ``keys`` columns."""
    now, held = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            if row[:keys] != now:
                if now is not None:
                    yield now, [list(c) for c in zip(*held)]
                now, held = row[:keys], []
            held.append(row[keys:])
    if now is not None:
        yield now, [list(c) for c in zip(*held)]


_TABLE = "k string, seg long, segs long, q int, z int, cost long, audit string, states string, illegal long, head string, tail string"
_LEGAL = {"su", "ua", "au"}


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per segment its table of cheapest edits: of one start for a whole conversation, else between all states."""
    names = [x.split()[0] for x in _TABLE.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    schema = pa.schema([(n, kinds[x.split()[1]]) for n, x in zip(names, _TABLE.split(", "))])
    out: list[tuple] = []
    for (k, seg, segs), (initials, times, fresh, short) in _by_segment(batches, 3):
        steps = steps_of(initials, times, fresh, short)
        illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])) + sum(times) - len(times)
        for q in range(4) if segs > 1 else (START,):
            for goals in [(z,) for z in range(4)] if segs > 1 else [ENDS]:
                if found := cheapest(steps, q, goals):
                    cost, audit, z = found
                    out.append((k, seg, segs, q, z, cost, audit, f"{q}{z}", illegal, initials[0], initials[-1]))
        if len(out) > 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)


def _chained(key: tuple, rows: pa.Table) -> pa.Table:
    """The tables of successive segments joined to one: over each state between, the cheapest and then least audit."""
    parts: dict[int, list[tuple]] = {}
    for r in rows.to_pylist():
        parts.setdefault(r["seg"], []).append((r["q"], r["z"], r["cost"], r["audit"], r["states"]))
    order = sorted(parts)
    made = {(q, z): (cost, audit, states) for q, z, cost, audit, states in parts[order[0]]}
    for seg in order[1:]:
        after: dict[tuple[int, int], tuple[int, str, str]] = {}
        for (q, mid), (cost, audit, states) in made.items():
            for q2, z, more, rest, on in parts[seg]:
                if q2 == mid:
                    new = (cost + more, audit + rest, states + on[1:])
                    if (q, z) not in after or new < after[q, z]:
                        after[q, z] = new
        made = after
    found = [{"k": key[0].as_py(), "seg": key[1].as_py(), "segs": len(order), "q": q, "z": z, "cost": c, "audit": a, "states": s} for (q, z), (c, a, s) in made.items()]
    return pa.Table.from_pylist(found, pa.schema([("k", pa.string()), ("seg", pa.int64()), ("segs", pa.int64()), ("q", pa.int32()), ("z", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("states", pa.string())]))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, repaired_sha256): rows come by (k, seg, rank), a segment's edits before its rows."""
    names = ["k", "repaired_sha256"]
    now, got, any_line = None, [[], []], False
    sha, ops, at, state, drop = hashlib.sha256(), "", 0, START, 0

    def line(role: str, text: str) -> None:
        nonlocal any_line
        sha.update((("\n" if any_line else "") + role + ":" + text).encode())
        any_line = True

    def inserted() -> None:
        nonlocal at, state
        while at < len(ops) and ops[at] == "I":
            state = FOLLOWS[state]
            line(NAMES[state], "")
            at += 1

    for batch in batches:
        for k, rank, edits, start, times, role, text in zip(*(batch.column(i).to_pylist() for i in range(7))):
            if k != now:
                if now is not None:
                    inserted()
                    got[0].append(now)
                    got[1].append(sha.hexdigest())
                now, sha, any_line, ops, at = k, hashlib.sha256(), False, "", 0
            if rank < 0:
                inserted()
                ops, at, state = edits, 0, start
                continue
            inserted()
            op = ops[at]
            if op == "K":
                state = kept_state(state, role[:1])
                line(role, text)
            elif op == "R":
                state = FOLLOWS[state]
                line(NAMES[state], text)
            at += times  # all further copies are deleted, before anything is inserted
        if len(got[0]) > 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in got], names=names)
            got = [[], []]
    if now is not None:
        inserted()
        got[0].append(now)
        got[1].append(sha.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in got], names=names)


def _key(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit("-"))


def repaired(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of each of ``conversations``.

    ``rows`` have conv_id, turn, role and text, the latter two not null, and stand by turn (null first), role and text, so
    copies are adjacent. blank: no character but ASCII white space; duplicate: role and text were said before; truncated:
    the last such character is not one of ``.!?``; the first that holds counts. gaps: turns missing between the least and
    the greatest; illegal: successive roles that don't follow each other. A role goes by its first character; one that
    is neither s, u nor a (or is empty) can't be kept. audit has an initial per edit (Keep, Rerole, Delete, Insert). A
    null conv_id is a conversation; one without rows has zeros, an empty audit and the digest of nothing. Other columns
    are ignored; no conversations give no rows.
    """
    turned = rows.groupBy(_key(F.col("conv_id")).alias("k"), "turn", "role", "text").agg(F.count("*").alias("times"))
    turned = turned.select("k", "turn", "role", "text", "times", F.md5(F.concat("role", F.lit("\0"), "text")).alias("said"))
    placed = ranked(turned, ["k"], ["turn", "role", "text"], "turns").withColumn("seg", F.floor(F.col("rank") / SEGMENT))

    firsts = written(placed.groupBy("k", "said").agg(F.min("rank").alias("first"), F.count("*").alias("n")), "said")
    longest = placed.agg(F.max("total")).first()[0] or 0
    many = firsts.where(F.col("n") > DEALT).select("k", "said", F.ceil(F.col("n") / DEALT).cast("int").alias("parts"))
    many = None if longest <= DEALT else many
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    faults = met(placed, firsts.drop("n"), ["k", "said"], ["rank"], many).select(
        "k", "seg", "rank", "total", "turn", "times", F.substring("role", 1, 1).alias("initial"), (trimmed == "").alias("blank"),
        (F.col("rank") == F.col("first")).alias("new"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("short"),
    )
    faults = written(faults, "faults")
    words = faults.withColumn("fresh", ~F.col("blank") & F.col("new"))

    spans = faults.where("turn is not null").groupBy("k", "turn").agg(F.lit(1).alias("one")).groupBy("k")
    spans = spans.agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).cast("long").alias("gaps"))
    count = lambda c: F.sum(c).cast("long")
    sums = words.groupBy("k").agg(
        count(F.when(F.col("blank"), F.col("times")).otherwise(0)).alias("blank"),
        count(F.when(~F.col("blank"), F.col("times") - F.col("fresh").cast("int")).otherwise(0)).alias("duplicate"),
        count((F.col("fresh") & F.col("short")).cast("int")).alias("truncated"),
    )

    codes = words.select("k", "seg", F.ceil(F.col("total") / SEGMENT).alias("segs"), "rank", "initial", "times", "fresh", "short")
    codes = codes.repartition("k", "seg").sortWithinPartitions("k", "seg", "rank").drop("rank")
    tables = written(codes.mapInArrow(_searched, _TABLE), "segments")
    inside = tables.groupBy("k", "seg").agg(F.first("illegal").alias("illegal"), F.first("head").alias("head"), F.first("tail").alias("tail"))
    before = F.lag("tail").over(Window.partitionBy("k").orderBy("seg"))
    across = (before.isNotNull() & ~F.concat(before, F.col("head")).isin(*_LEGAL)).cast("int")
    illegal = inside.withColumn("across", across).groupBy("k").agg(count(F.col("illegal") + F.col("across")).alias("illegal"))

    found, several = tables.where("segs = 1"), None
    ops = found.select("k", "seg", "q", "audit")
    chosen = found.select("k", "cost", "audit")
    if longest > SEGMENT:
        parts, several = -(-longest // SEGMENT), tables.where("segs > 1")
        kinds = ["k", "seg", "segs", "q", "z", "cost", "audit", "states"]
        joined = several.select(*kinds)
        while parts > 1:
            joined = written(joined.groupBy("k", F.floor(F.col("seg") / JOINED).alias("_up")).applyInArrow(_chained, "k string, seg long, segs long, q int, z int, cost long, audit string, states string"), "joined")
            parts = -(-parts // JOINED)
        ends = joined.where((F.col("q") == START) & F.col("z").isin(*ENDS)).groupBy("k").agg(F.min(F.struct("cost", "audit", "states")).alias("x")).select("k", "x.*")
        ends = written(ends, "ends")
        chosen = chosen.union(ends.select("k", "cost", "audit"))
        taken = ends.select("k", "states", F.explode(F.sequence(F.lit(0), F.length("states") - 2)).alias("seg"))
        state = lambda i: F.substring("states", F.col("seg") + i, F.lit(1)).cast("int")
        taken = taken.select("k", F.col("seg").cast("long").alias("seg"), state(1).alias("q"), state(2).alias("z"))
        ops = ops.union(several.select("k", "seg", "q", "z", "audit").join(taken, ["k", "seg", "q", "z"]).select("k", "seg", "q", "audit"))

    none = lambda kind: F.lit(None).cast(kind)
    heads = ops.select("k", "seg", F.lit(-1).cast("long").alias("rank"), F.col("audit").alias("ops"), "q", none("long").alias("times"), none("string").alias("role"), none("string").alias("text"))
    lines = placed.select("k", "seg", "rank", none("string").alias("ops"), none("int").alias("q"), "times", "role", "text")
    stream = heads.union(lines).repartition("k").sortWithinPartitions("k", "seg", "rank").drop("seg")
    digests = stream.select("k", "rank", "ops", "q", "times", "role", "text").mapInArrow(_digests, "k string, repaired_sha256 string")

    out = conversations.select("conv_id").distinct().withColumn("k", _key(F.col("conv_id")))
    for side in (spans, sums, illegal, chosen, digests):
        out = out.join(side, "k", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(
        "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
