"""Conversation repair (13): the streamed plan against all edit sequences and a plain recursion; edge cases, spilled chunks."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from visitflow.llm import conversations as cv
from visitflow.llm import queries
from visitflow.llm.common import table

PATTERN = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\f\r"
EMPTY = hashlib.sha256(b"").hexdigest()


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_edits(rows):
    """(cost, audit, repaired) of every edit sequence with at most two insertions at a place; for a few rows."""
    found = faults(rows)
    inserts = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    choices = [["D"] if f in ("blank", "duplicate") else ["K", "Ru", "Ra", "D"] for f in found]
    for edits in itertools.product(*choices):
        for places in itertools.product(inserts, repeat=len(rows) + 1):
            cost, audit, lines = 0, "", []
            for n in range(len(rows) + 1):
                for role in places[n]:
                    cost, audit = cost + 2, audit + "I"
                    lines.append((role, ""))
                if n == len(rows):
                    break
                (role, text), edit = rows[n], edits[n]
                audit += edit[0]
                if edit == "D":
                    cost += 3
                    continue
                cost += (found[n] == "truncated") + (2 if edit[0] == "R" else 0)
                lines.append((role if edit == "K" else "user" if edit == "Ru" else "assistant", text))
            if all(r for r, _ in lines) and PATTERN.fullmatch("".join(r[0] for r, _ in lines)):
                yield cost, audit, "\n".join(f"{r}:{t}" for r, t in lines)


def plain(rows):
    """The same minimum by a backward recursion on whole strings."""
    found = faults(rows)
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}
    ends = {"": (0, "", ()), "s": (4, "II", ("user:", "assistant:")), "u": (2, "I", ("assistant:",)), "a": (0, "", ())}
    to_come = ends
    for (role, text), fault in zip(rows[::-1], found[::-1]):
        def add(cost, edit, line, rest):
            return cost + rest[0], edit + rest[1], (line, *rest[2]) if line is not None else rest[2]
        base = {}
        for state in ends:
            options = [add(3, "D", None, to_come[state])]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if role[:1] and role[0] in "sua" and (role[0] == after[state] or (state == "" and role[0] == "s")):
                    options.append(add(more, "K", f"{role}:{text}", to_come[role[0]]))
                options.append(add(2 + more, "R", f"{name[after[state]]}:{text}", to_come[after[state]]))
            base[state] = min(options)
        for _ in range(3):
            base = {s: min(base[s], add(2, "I", name[after[s]] + ":", base[after[s]])) for s in base}
        to_come = base
    cost, audit, lines = to_come[""]
    return cost, audit, "\n".join(lines)


def expected(rows, turns):
    """Report of one conversation's rows, in order."""
    found = faults(rows)
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, text = plain(rows)
    return (gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def conversations(seed, many, longest):
    random.seed(seed)
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "u", ""]
    texts = ["Yes.", "No!", "Why?", "cut", "cut off ", "", " \n", "Fine. \t", "Well"]
    out = []
    for conv in range(many):
        size = random.randint(1, longest)
        turns = sorted(random.sample(range(2 * size), size))
        out += [(conv, t, random.choice(roles), random.choice(texts) if random.random() < .8 else f"Text {conv} {t}.") for t in turns]
    return out


def by_conversation(rows):
    out = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1])):
        out[conv].append((turn, role, text))
    return out


def test_plain_recursion_equals_all_edits():
    for rows in by_conversation(conversations(1, 250, 3)).values():
        pairs = [(r, t) for _, r, t in rows]
        assert plain(pairs) == min(all_edits(pairs))


def test_report_and_rows_equal_brute_force(spark):
    rows = conversations(2, 400, 25)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    got = {r[0]: tuple(r[1:]) for r in cv.repair_report(df).collect()}
    want = {c: expected([x[1:] for x in rs], [x[0] for x in rs]) for c, rs in by_conversation(rows).items()}
    assert got == want
    lines = defaultdict(list)
    for r in cv.repaired_conversations(df).orderBy("conv_id", "position").collect():
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert all(hashlib.sha256("\n".join(lines[c]).encode()).hexdigest() == w[-1] for c, w in want.items())


def test_giant_conversation_over_chunks_and_batches(spark):
    """A third of all rows in one conversation: its edits are spilled in several chunks."""
    rows = conversations(3, 60, 12)
    random.seed(4)
    giant = [(1000, t, random.choice(["user", "assistant", "tool", "system"]), random.choice([f"Text {t}.", f"cut {t}", " ", "Same."]))
             for t in range(3 * cv.CHUNK_ROWS + 11)]
    equal = [(1001, 5, "user", "Same.")] * (cv.CHUNK_ROWS + 500)
    df = spark.createDataFrame(rows + giant + equal, "conv_id long, turn long, role string, text string")
    got = {r[0]: tuple(r[1:]) for r in cv.repair_report(df).collect()}
    sound = by_conversation(rows + equal)
    assert {c: g for c, g in got.items() if c != 1000} == {
        c: expected([x[1:] for x in rs], [x[0] for x in rs]) for c, rs in sound.items()}
    assert got[1000][:5] == expected_counts(giant)
    audit, cost = got[1000][6], got[1000][5]
    assert len(audit) - audit.count("I") == len(giant)
    text, paid = replay(giant, audit)
    assert paid == cost and hashlib.sha256(text.encode()).hexdigest() == got[1000][7]


def expected_counts(rows):
    pairs = [r[2:] for r in rows]
    found = faults(pairs)
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
    return 0, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal


def replay(rows, audit):
    """Text and cost of an audit applied to the rows; it must be legal."""
    found, at, state, lines, cost = faults([r[2:] for r in rows]), 0, "", [], 0
    name = {"u": "user", "a": "assistant"}
    for edit in audit:
        follow = "a" if state == "u" else "u"
        if edit == "I":
            state, cost = follow, cost + 2
            lines.append(name[follow] + ":")
            continue
        (_, _, role, text), fault = rows[at], found[at]
        at += 1
        if edit == "D":
            cost += 3
            continue
        assert fault not in ("blank", "duplicate")
        cost += (fault == "truncated") + 2 * (edit == "R")
        if edit == "R":
            role = name[follow]
        assert role[0] == follow or (role[0] == "s" and state == "")
        state = role[0]
        lines.append(f"{role}:{text}")
    assert state in ("", "a")
    return "\n".join(lines), cost


def test_query_equals_damage_and_recursion_in_python(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.01", "conversations").select("conv_id", "turn", "role", "text").collect()]
    want = {}
    for conv, found in by_conversation(rows).items():
        after = []
        for turn, role, text in found:
            kind = zlib.crc32(f"{conv}:{turn}".encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            after += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
        want[conv] = expected([x[1:] for x in after], [x[0] for x in after])
    got = {r[0]: tuple(r[1:]) for r in queries.op13_secondary_sort(spark, "/root/testdata/sf0.01").collect()}
    assert got == want and any(w[5] for w in want.values())


def test_edge_rows(spark):
    rows = [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (1, None, None, None), (1, None, "user", "A."), (1, 3, "user", "A."),
            (2, 1, "", "Role is empty."), (3, None, "system", "Only me."), (3, None, "system", "Only me."), (4, 9, "user", "gone"),
            (5, -(1 << 63), "user", "x."), (5, (1 << 63) - 1, "assistant", "y."), (6, 0, "user", "long " * 60_000 + "."), (6, 1, "assistant", "ok.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'kept' AS conv", "'kept' AS edits", "'kept' AS text_key", "conv_id = 4 AS lost_row")
    got = {r[0]: tuple(r[1:]) for r in cv.repair_report(df, lost=F.col("lost_row")).collect()}
    assert got[None][:7] == (0, 0, 0, 0, 0, 0, "KK")
    assert got[1] == expected([(" ", " "), ("user", "A."), ("user", "A.")], [None, None, 3])
    assert got[2][5:7] == (3, "D") and got[3][1:7] == expected([("system", "Only me.")] * 2, [None, None])[1:7]
    assert got[4] == (0, 0, 0, 0, 0, 0, "", EMPTY)
    assert got[5][0] == cv.LONGEST and got[6][5:7] == (0, "KK")
    assert cv.repair_report(df.limit(0)).count() == 0 and cv.repaired_conversations(df.limit(0)).count() == 0
    broken = cv.damaged(df)
    assert broken.columns == ["conv_id", "turn", "role", "text", "lost"]
    assert cv.repair_report(broken, lost=F.col("lost")).count() == 7


@pytest.mark.parametrize("fault", range(4))
def test_costs_differ_by_little(fault):
    """The table of cases a task remembers is small: cost differences are bounded."""
    seen, todo = {cv.END}, [cv.END]
    while todo:
        after = todo.pop()
        for kind in range(4):
            for initial in range(4):
                costs, _ = cv.step(after, kind, initial)
                costs = tuple(c - min(costs) for c in costs)
                if costs not in seen:
                    seen.add(costs)
                    todo.append(costs)
    assert len(seen) < 200 and max(map(max, seen)) <= 7
