"""Conversation structure repair: cheapest edits by dynamic programming, streamed over rows sorted by turn.

Two passes over conversations, each ``repartition`` by conversation and a sort inside the partitions:

* from the last turn to the first, ``mapInPandas`` carries the costs to come of the four states of the role pattern across
  Arrow batches. One byte per row (the best edit of each state) is spilled in chunks to a table in the shared folder;
* from the first turn to the last, the chunks are merged into the texts and read along with them.

A task holds one Arrow batch, one chunk, and the audit string it is about to return, however long the conversation.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import SPACE_CHARS, Scratch, small_batches

CHUNK_ROWS = 4096                         # edits of a spilled chunk
START, SYSTEM, USER, ASSISTANT = range(4)  # states: no role yet, after s, after u, after a
NEXT = (USER, USER, ASSISTANT, USER)      # the state after the only role that may be inserted or set
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"                          # codes 0, 1, 2; any other role is 3
KEPT_AFTER = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
LEGAL = {(0, 1), (1, 2), (2, 1)}
EDITS = "DIKR"                            # in ASCII order: of equally cheap edits the smaller code
COST = {"D": 3, "I": 2, "K": 0, "R": 2, "truncated": 1}
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
LONGEST = (1 << 63) - 1
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PLAN = ("conv string, lead int, turn_set boolean, turn long, role string, text_key long, part int, seq long, text string, "
        "edits binary, " + ", ".join(f"{c} long" for c in COUNTS))
ROW_ORDER = ("turn_set", "turn", "role", "text_key")


def closed(base: list[int], edits: list[int]) -> tuple[tuple[int, ...], int]:
    """Costs to come and best edits per state, insertions before the row included; edits packed in two bits a state."""
    cost, best = list(base), list(edits)
    for state in (USER, ASSISTANT):                          # one insertion leads to the other state of the pair
        if (base[NEXT[state]] + COST["I"], 1) < (base[state], edits[state]):
            cost[state], best[state] = base[NEXT[state]] + COST["I"], 1
    for state in (START, SYSTEM):
        if (cost[USER] + COST["I"], 1) < (base[state], edits[state]):
            cost[state], best[state] = cost[USER] + COST["I"], 1
    return tuple(cost), sum(e << 2 * s for s, e in enumerate(best))


END = (0, 4, 2, 0)                        # after the last row: nothing or a finished pair is fine, else insertions


def step(after: tuple[int, ...], fault: int, initial: int) -> tuple[tuple[int, ...], int]:
    """Costs to come before a row, from those after it; the row's packed best edits."""
    base, edits = [], []
    for state in range(4):
        options = [(COST["D"] + after[state], 0)]
        if fault not in (BLANK, DUPLICATE):
            more = COST["truncated"] if fault == TRUNCATED else 0
            kept = KEPT_AFTER.get((state, initial))
            if kept is not None:
                options.append((COST["K"] + more + after[kept], 2))
            options.append((COST["R"] + more + after[NEXT[state]], 3))
        least, edit = min(options)
        base.append(least)
        edits.append(edit)
    return closed(base, edits)


class _Backwards:
    """One conversation read from its last row to its first."""

    def __init__(self, conv):
        self.conv = conv
        self.after, self.cost = END, 0               # costs to come less their least; the least so far
        self.codes = bytearray()
        self.seq = 0
        self.place = (False, 0, None, 0)
        self.highest = self.turn = None
        self.turns = 0
        self.faults = [0, 0, 0, 0]
        self.following, self.illegal = None, 0

    def add(self, place: tuple, fault: int, initial: int, steps: dict) -> None:
        key = (self.after, fault, initial)
        if key not in steps:                         # costs differ by a few units only: a small table of all cases
            costs, code = step(*key)
            low = min(costs)
            steps[key] = tuple(c - low for c in costs), low, code
        self.after, low, code = steps[key]
        self.cost += low
        self.codes.append(code)
        self.faults[fault] += 1
        if self.following is not None and (initial, self.following) not in LEGAL:
            self.illegal += 1
        self.following = initial
        self.place = place
        if place[0] and place[1] != self.turn:
            self.turns += 1
            self.turn = place[1]
            self.highest = place[1] if self.highest is None else self.highest

    def chunk(self, last: bool = False) -> tuple:
        edits = bytes(self.codes[::-1])
        self.codes.clear()
        self.seq += 1
        head = (self.conv, 0 if last else 1, *self.place, 0, -self.seq, None, edits)
        if not last:
            return (*head, *[0] * len(COUNTS))
        gaps = min(self.highest - self.turn + 1 - self.turns, LONGEST) if self.turns else 0
        return (*head, gaps, *self.faults[1:], self.illegal, self.cost + self.after[START])


def _plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows by (conv, place) descending -> chunks of edits; the last one of a conversation also has its counts."""
    names = [f.split()[0] for f in PLAN.split(", ")]
    steps: dict = {}
    at: _Backwards | None = None
    for b in batches:
        out = []
        for conv, *place, fault, initial, lost in zip(*[b[c].tolist() for c in ("conv", *ROW_ORDER, "fault", "initial", "lost")]):
            if at is None or conv != at.conv:
                if at is not None:
                    out.append(at.chunk(last=True))
                at = _Backwards(conv)
            if lost:
                continue
            at.add(tuple(place), fault, initial, steps)
            if len(at.codes) >= CHUNK_ROWS:
                out.append(at.chunk())
        yield _frame(out, names)
    if at is not None:
        yield _frame([at.chunk(last=True)], names)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    found = pd.DataFrame(rows, columns=names, dtype=object)
    return found.astype({"lead": "int32", "turn_set": bool, "turn": "int64", "text_key": "int64", "part": "int32", "seq": "int64",
                         **dict.fromkeys(COUNTS, "int64")})


class _Forwards:
    """One conversation repaired from its first row to its last; ``out`` takes (edit, turn, role, text) of every edit."""

    def __init__(self, conv, counts: list, out):
        self.conv, self.counts, self.out = conv, counts, out
        self.state = START
        self.edits: deque = deque()

    def row(self, turn, role: str, text: str) -> None:
        code = self.edits.popleft()
        while (edit := code >> 2 * self.state & 3) == 1:
            self.insert()
        if edit == 2:
            self.state = KEPT_AFTER[self.state, INITIALS.index(role[0])]
            self.out("K", turn, role, text)
        elif edit == 3:
            self.state = NEXT[self.state]
            self.out("R", turn, ROLE[self.state], text)
        else:
            self.out("D", turn, None, None)

    def insert(self) -> None:
        self.state = NEXT[self.state]
        self.out("I", None, ROLE[self.state], "")

    def end(self) -> None:
        while END[self.state]:
            self.insert()


def _conversations(batches: Iterator[pd.DataFrame], begin) -> Iterator[tuple[_Forwards | None, bool]]:
    """Drives ``_Forwards`` over sorted chunks and rows; yields (conversation that ended or None, batch is over)."""
    at: _Forwards | None = None
    for b in batches:
        columns = ("conv", "lead", "part", "turn_set", "turn", "role", "text", "edits")
        counts = b[list(COUNTS)].to_numpy()
        for n, (conv, lead, part, turn_set, turn, role, text, edits) in enumerate(zip(*[b[c].tolist() for c in columns])):
            if lead == 0:
                if at is not None:
                    at.end()
                    yield at, False
                at = begin(conv, counts[n].tolist())
            if part == 0:
                at.edits.extend(edits)
            else:
                at.row(turn if turn_set else None, role, text)
        yield None, True
    if at is not None:
        at.end()
        yield at, False
    yield None, True


class _Digest:
    def __init__(self):
        self.audit: list[str] = []
        self.hash, self.first = hashlib.sha256(), True

    def __call__(self, edit, turn, role, text) -> None:
        self.audit.append(edit)
        if role is not None:
            self.hash.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
            self.first = False


def _report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out = []
    for done, over in _conversations(batches, lambda conv, counts: _Forwards(conv, counts, _Digest())):
        if done is not None:
            out.append((done.conv, *done.counts, "".join(done.out.audit), done.out.hash.hexdigest()))
        if over:
            yield pd.DataFrame(out, columns=["conv", *COUNTS, "audit", "repaired_sha256"])
            out = []


def _repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out: list[tuple] = []

    def begin(conv, counts) -> _Forwards:
        position = 0

        def add(edit, turn, role, text) -> None:
            nonlocal position
            if role is not None:
                out.append((conv, position, turn, role, text, edit))
                position += 1
        return _Forwards(conv, counts, add)
    for _, over in _conversations(batches, begin):
        if over:
            yield pd.DataFrame(out, columns=["conv", "position", "turn", "role", "text", "edit"], dtype=object)
            out.clear()


def _planned(df: DataFrame, conv_id: str, turn: str, role: str, text: str, lost: Column | None,
             scratch: Scratch) -> DataFrame:
    """Texts and their spilled edits, by conversation and in order."""
    small_batches(df.sparkSession)
    c = {n: F.col(f"`{name}`") for n, name in (("conv", conv_id), ("turn", turn), ("role", role), ("text", text))}
    rows = df.select(c["conv"].cast("string").alias("conv"), c["turn"].isNotNull().alias("turn_set"),
                     F.coalesce(c["turn"].cast("long"), F.lit(0).cast("long")).alias("turn"),
                     F.coalesce(c["role"].cast("string"), F.lit(" ")).alias("role"),
                     F.coalesce(c["text"].cast("string"), F.lit(" ")).alias("text"),
                     (F.lit(False) if lost is None else F.coalesce(lost, F.lit(False))).alias("lost"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    words = F.rtrim(F.col("text"), F.lit(SPACE_CHARS))
    code = F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1
    narrow = rows.select(
        "conv", *ROW_ORDER, "lost", (words == "").alias("blank"), F.right(words, F.lit(1)).isin(".", "!", "?").alias("ended"),
        F.when((F.col("role") == "") | (code < 0), 3).otherwise(code).cast("int").alias("initial"))
    # one exchange by conversation serves the numbering of equal rows and the sort
    same = Window.partitionBy("conv", "lost", "role", "text_key").orderBy("turn_set", "turn")
    narrow = narrow.repartition("conv").withColumn("n", F.row_number().over(same))
    fault = F.when(F.col("blank"), BLANK).when(F.col("n") > 1, DUPLICATE).when(F.col("ended"), FINE).otherwise(TRUNCATED)
    narrow = narrow.withColumn("fault", fault.cast("int")).sortWithinPartitions(
        "conv", *[F.desc(k) for k in (*ROW_ORDER, "n")])
    edits = narrow.select("conv", *ROW_ORDER, "fault", "initial", "lost").mapInPandas(_plan, PLAN)
    edits = scratch.write(edits, "edits")
    texts = rows.where(~F.col("lost")).selectExpr(
        "conv", "1 AS lead", *ROW_ORDER, "1 AS part", "0L AS seq", "text", "CAST(NULL AS BINARY) AS edits",
        *[f"0L AS {n}" for n in COUNTS])
    return (edits.unionByName(texts).repartition("conv")
            .sortWithinPartitions("conv", "lead", *ROW_ORDER, "part", "seq"))


def repair_report(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                  lost: Column | None = None) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn, nulls first; rows of one turn by role and text
    hash, so equal ones are neighbours. The first fault of a row counts: blank
    (no word), duplicate (role and text occur earlier), truncated (the last
    character that is no white space is not ``.``, ``!`` or ``?``). The edits
    are the cheapest that make the role initials ``(s?(ua)+)?``: Keep 0,
    Rerole to user or assistant 2, Delete 3 (a must for blank and duplicate),
    Insert an empty user or assistant text 2, and 1 for a truncated row that
    stays; of equally cheap ones the ASCII-least. ``gaps`` is the number of
    turns missing between the least and the largest, ``illegal`` that of
    neighbours whose initials are not su, ua or au.

    Null roles and texts are one space; an empty role has no initial and cannot
    be kept as it is. Rows for which ``lost`` holds only name their
    conversation: without any other row it has zeros, an empty audit and the
    hash of the empty string. A null conv_id is a conversation of its own, an
    empty table gives no rows, and other columns are ignored. Two texts of one
    role and turn whose 64-bit hashes collide would count as equal.
    """
    kind = df.schema[conv_id].dataType
    scratch = Scratch(df.sparkSession, "conversations")
    schema = "conv string, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    found = _planned(df, conv_id, turn, role, text, lost, scratch).mapInPandas(_report, schema)
    return found.select(F.col("conv").cast(kind).alias("conv_id"), *COUNTS, "audit", "repaired_sha256")


def repaired_conversations(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                           text: str = "text", lost: Column | None = None) -> DataFrame:
    """The repaired rows: conv_id, position (from 0), turn (null: inserted), role, text, edit (K, R or I)."""
    kind = df.schema[conv_id].dataType
    scratch = Scratch(df.sparkSession, "conversations")
    found = _planned(df, conv_id, turn, role, text, lost, scratch).mapInPandas(
        _repaired, "conv string, position long, turn long, role string, text string, edit string")
    return found.select(F.col("conv").cast(kind).alias("conv_id"), "position", "turn", "role", "text", "edit")


def damaged(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows damaged by crc32(``conv_id:turn``) % 20: 0 lost, 1 emptied, 2 without ``[.!?]``, 3 repeated, 4 role user.

    Nulls are one space (a null turn stays null as a turn). Lost rows stay, marked in ``lost``.
    """
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col(f"`{conv_id}`").cast("string"), blank), F.lit(":"),
                    F.coalesce(F.col(f"`{turn}`").cast("string"), blank))
    rows = df.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
                     F.coalesce(F.col(f"`{role}`").cast("string"), blank).alias("role"),
                     F.coalesce(F.col(f"`{text}`").cast("string"), blank).alias("text"),
                     (F.crc32(name.cast("binary")) % 20).alias("damage"))
    kind = F.col("damage")
    words = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), words.alias("text"),
                       (kind == 0).alias("lost"), F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")
