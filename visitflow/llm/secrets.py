"""Secret scans with one combined automaton: all rules in one pass over the bytes.

Rules are small regexes. They are compiled together: Thompson automaton,
subset construction, minimisation, transition array. The array is entered once
for every byte; states that end a rule carry its bit. A rule's reversed
automaton then finds the start of a match from its end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

VALUE = "[A-Za-z0-9+/_.=-]"
WORD = "[A-Za-z0-9_]"


def either(word: str) -> str:
    """A pattern for ``word`` with its letters in either case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern and the least length (code points) of the value at the match's end.

    ``value`` names the characters of that value; None counts the whole match.
    """

    kind: str
    pattern: str
    least: int
    value: str | None = None


# The base kinds in their order, then the kinds this scan adds.
BASE = (
    Rule("assign", f"({either('password')}|{either('passwd')}|{either('secret')}|{either('token')}|"
                   f"{either('api')}_?{either('key')})[\"']? *[:=] *[\"']?{VALUE}+", 8, VALUE),
    Rule("access", "AKIA[A-Z0-9]+", 16),
    Rule("hex", "[0-9a-f]+", 32),
)
MORE = (
    Rule("temporary", "ASIA[A-Z0-9]+", 16),
    Rule("github", f"gh[pousr]_{WORD}+", 24),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", "AIza[A-Za-z0-9_-]+", 39),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 20),
)
BASE_KINDS = tuple(r.kind for r in BASE)


# --- patterns: literals, [classes], groups, | ? * + -----------------------------------------------------------------

def parse(pattern: str):
    """Pattern -> tree of ('set', bytes), ('cat', parts), ('alt', parts), ('rep', part, least, many)."""
    at = 0

    def alternatives():
        nonlocal at
        parts = [sequence()]
        while at < len(pattern) and pattern[at] == "|":
            at += 1
            parts.append(sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence():
        nonlocal at
        parts = []
        while at < len(pattern) and pattern[at] not in "|)":
            part = atom()
            if at < len(pattern) and pattern[at] in "?*+":
                part = ("rep", part, int(pattern[at] == "+"), pattern[at] != "?")
                at += 1
            parts.append(part)
        return ("cat", parts)

    def atom():
        nonlocal at
        c = pattern[at]
        at += 1
        if c == "(":
            inner = alternatives()
            at += 1
            return inner
        if c == "[":
            chosen: set[int] = set()
            while pattern[at] != "]":
                if pattern[at + 1] == "-" and pattern[at + 2] != "]":
                    chosen.update(range(ord(pattern[at]), ord(pattern[at + 2]) + 1))
                    at += 3
                else:
                    chosen.add(ord(pattern[at]))
                    at += 1
            at += 1
            return ("set", frozenset(chosen))
        return ("set", frozenset([ord(c)]))
    return alternatives()


def reverse(tree):
    kind = tree[0]
    if kind == "cat":
        return ("cat", [reverse(p) for p in reversed(tree[1])])
    if kind == "alt":
        return ("alt", [reverse(p) for p in tree[1]])
    return ("rep", reverse(tree[1]), *tree[2:]) if kind == "rep" else tree


class Nfa:
    """Thompson automaton: byte edges and empty edges."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def add(self, tree, start: int) -> int:
        """Builds ``tree`` from ``start``; returns its end state."""
        if tree[0] == "set":
            end = self.state()
            self.edges[start].append((tree[1], end))
            return end
        if tree[0] == "cat":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        if tree[0] == "alt":
            end = self.state()
            for part in tree[1]:
                begin = self.state()
                self.empty[start].append(begin)
                self.empty[self.add(part, begin)].append(end)
            return end
        _, part, least, many = tree
        begin, end = self.state(), self.state()
        self.empty[start].append(begin)
        done = self.add(part, begin)
        self.empty[done].append(end)
        if many:
            self.empty[done].append(begin)
        if not least:
            self.empty[start].append(end)
        return end

    def closure(self, states: frozenset[int]) -> frozenset[int]:
        seen, stack = set(states), list(states)
        while stack:
            for nxt in self.empty[stack.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    stack.append(nxt)
        return frozenset(seen)


@dataclass
class Dfa:
    """table[state * 256 + byte] is the next state; accepts[state] has a bit for each rule that ends there."""

    table: list[int]
    accepts: list[int]
    start: int
    dead: int              # the state that leads nowhere, or -1


def determinise(nfa: Nfa, start: frozenset[int], ends: dict[int, int], restart: bool) -> Dfa:
    """Subset construction; with ``restart`` a match may begin at every byte."""
    first = nfa.closure(start)
    numbers = {first: 0}
    order, table = [first], []
    for states in order:
        moves: list[set[int]] = [set() for _ in range(256)]
        for s in states:
            for chosen, to in nfa.edges[s]:
                for b in chosen:
                    moves[b].add(to)
        closed: dict[frozenset[int], int] = {}
        for b in range(256):
            key = frozenset(moves[b])
            if key not in closed:
                to = nfa.closure(key | start if restart else key)
                if to not in numbers:
                    numbers[to] = len(order)
                    order.append(to)
                closed[key] = numbers[to]
            table.append(closed[key])
    accepts = [sum({1 << ends[s] for s in states if s in ends}) for states in order]
    return minimise(Dfa(table, accepts, 0, -1))


def minimise(d: Dfa) -> Dfa:
    """Merges states that no text tells apart (partition refinement)."""
    n = len(d.accepts)
    block = list(d.accepts)
    count = len(set(block))
    while True:
        keys: dict[tuple, int] = {}
        new = [keys.setdefault((block[s], *[block[t] for t in d.table[s * 256:s * 256 + 256]]), len(keys))
               for s in range(n)]
        block = new
        if len(keys) == count:
            break
        count = len(keys)
    some = {b: s for s, b in reversed(list(enumerate(block)))}
    table = [block[t] for b in range(count) for t in d.table[some[b] * 256:some[b] * 256 + 256]]
    accepts = [d.accepts[some[b]] for b in range(count)]
    dead = next((b for b in range(count) if not accepts[b] and set(table[b * 256:b * 256 + 256]) == {b}), -1)
    return Dfa(table, accepts, block[d.start], dead)


@dataclass
class Scanner:
    """All rules in one automaton, numbered so that states that end a rule come last."""

    kinds: tuple[str, ...]
    table: list[int]           # entry: state << 8, so that table[entry | byte] is the next entry
    start: int
    first_end: int             # entries from here on end a rule
    accepts: list[int]         # by state
    back: list[Dfa]            # one reversed automaton for each rule
    keep: list[Callable[[str], bool]]

    def matches(self, data: bytes) -> list[list[tuple[int, int]]]:
        """For each rule its leftmost, longest, non-overlapping matches, as byte spans."""
        found: list[list[tuple[int, int]]] = [[] for _ in self.kinds]
        last = [0] * len(self.kinds)
        table, first_end, accepts = self.table, self.first_end, self.accepts
        s, live = self.start, 0                  # rules whose match could end before the current byte
        for i, b in enumerate(data):
            s = table[s | b]
            if s >= first_end or live:
                now = accepts[s >> 8]
                over = live & ~now
                if over:
                    self._close(data, i, over, found, last)
                live = now
        if live:
            self._close(data, len(data), live, found, last)
        return found

    def _close(self, data: bytes, end: int, over: int, found: list, last: list) -> None:
        rule = 0
        while over:
            if over & 1:
                d, begin = self.back[rule], -1
                s = d.start
                for i in range(end - 1, last[rule] - 1, -1):
                    s = d.table[s * 256 + data[i]]
                    if s == d.dead:
                        break
                    if d.accepts[s]:
                        begin = i
                if begin >= 0:
                    found[rule].append((begin, end))
                    last[rule] = end
            over >>= 1
            rule += 1

    def scan(self, text: str | None) -> list[tuple[int, int, int]]:
        """(start, rule, end) of the matches that pass their rule's check, in code points, sorted."""
        if not text:
            return []
        data = text.encode()
        plain = len(data) == len(text)
        out = []
        for rule, spans in enumerate(self.matches(data)):
            for a, b in spans:
                if self.keep[rule](data[a:b].decode("utf-8")):
                    out.append((a, rule, b) if plain else (len(data[:a].decode()), rule, len(data[:b].decode())))
        return sorted(out)


def _check(rule: Rule) -> Callable[[str], bool]:
    if rule.value is None:
        return lambda match: len(match) >= rule.least
    chars = {chr(b) for b in parse(rule.value)[1][0][1]}

    def long_enough(match: str) -> bool:
        """The value begins after the first separator, its blanks and its quote."""
        at = min(i for i in (match.find(":"), match.find("=")) if i >= 0) + 1
        value = match[at:].lstrip(" ").lstrip("\"'")
        return len(value) >= rule.least and set(value) <= chars
    return long_enough


def compile_rules(rules: tuple[Rule, ...] = BASE + MORE) -> Scanner:
    nfa = Nfa()
    start, ends = nfa.state(), {}
    back = []
    for i, rule in enumerate(rules):
        tree = parse(rule.pattern)
        begin = nfa.state()
        nfa.empty[start].append(begin)
        ends[nfa.add(tree, begin)] = i
        other = Nfa()
        first = other.state()
        back.append(determinise(other, frozenset([first]), {other.add(reverse(tree), first): 0}, False))
    d = determinise(nfa, frozenset([start]), ends, True)
    order = sorted(range(len(d.accepts)), key=lambda s: bool(d.accepts[s]))
    number = {s: i for i, s in enumerate(order)}
    table = [number[t] << 8 for s in order for t in d.table[s * 256:s * 256 + 256]]
    first_end = next((i for i, s in enumerate(order) if d.accepts[s]), len(order)) << 8
    return Scanner(tuple(r.kind for r in rules), table, number[d.start] << 8, first_end,
                   [d.accepts[s] for s in order], back, [_check(r) for r in rules])


def find_secrets(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """Adds secret_spans: array of (kind, start, end), code points, end exclusive, by start and rule order.

    Every whole text is scanned, each rule leftmost, longest and without
    overlaps; matches that fail a rule's length are dropped, not tried again.
    Null and empty texts have none. Rows and other columns stay; a column of
    that name is replaced.
    """
    small_batches(df.sparkSession)
    scanner = compile_rules(rules)

    @F.pandas_udf("array<struct<kind:string,start:long,end:long>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([[{"kind": scanner.kinds[k], "start": a, "end": e} for a, k, e in scanner.scan(t)]
                             for t in b], dtype=object)
    return df.withColumn("secret_spans", run(F.col(text)))


def mask_secrets(df: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``df`` with every found span of ``text`` replaced by ``mask`` (overlapping spans by one)."""
    scanner = compile_rules()

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def masked(t: str | None) -> str | None:
            out, at = [], 0
            for a, _, e in scanner.scan(t):
                if a >= at:
                    out += [t[at:a], mask]
                at = max(at, e)
            return t if not out else "".join(out) + t[at:]
        for b in batches:
            yield pd.Series([masked(t) for t in b], dtype=object)
    return df.withColumn(text, run(F.col(text)))


def span_report(df: DataFrame, column: str, base: tuple[str, ...]) -> DataFrame:
    """Replaces a span array by one count for each base kind, base_sha256 and spans."""
    names = [f"n_{k}" for k in base]

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(column, lambda s: s["kind"] == kind)).cast("long")
    counts = [count(k).alias(n) for k, n in zip(base, names)]
    text = joined(F.filter(column, lambda s: s["kind"].isin(*base)))
    taken = {c.lower() for c in (*names, "base_sha256", "spans", column)}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken], *counts,
                     F.sha2(text.cast("binary"), 256).alias("base_sha256"), joined(F.col(column)).alias("spans"))
