"""Personal data: patterns, and a skip-chain conditional random field that keeps labels consistent.

The field's nodes are a document's evidence tokens (those with a digit or @;
all others are O). Neighbouring tokens share a chain potential; tokens that
repeat or resemble one another, however far away, share a skip potential with
one hub among them. Tokens that the patterns match keep their label. Loopy
belief propagation passes messages over both until they settle. The potentials are
estimated piece by piece from counts over all documents, labelled by the
patterns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# The kinds, in their order.
KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)

SHAPES = 4096              # hashed token shapes: the unary table has this many rows
DAMPING, PATIENCE = 0.3, 50    # of message passing; after so many rounds without an end damping grows
SETTLED = 1e-4             # largest change of a message at which passing ends
CERTAIN = -1e4             # log weight of the labels that a matched token does not have
CONFIDENT = 0.9            # marginal from which an unmatched token becomes a span
LEAST_KEY = 4              # characters that resembling tokens must have in common

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
EVIDENCE = re.compile(r"[0-9@]")
EDGE = ".,;:!?\"'`<>[]{}|*#$%&="
SPACES = " \t\n\x0b\f\r"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, longest, non-overlapping; found from the @ signs, so a long run of letters costs nothing."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and LOCAL.match(text[start - 1]):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """Each run of dotted numbers, four numbers at a time; those with a part over 255 are dropped."""
    out = []
    for m in DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        at, parts = m.start(), m.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append((at, end))
            at = end + 1
    return out


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 10 <= sum(map(str.isdigit, m.group())) <= 15] \
        if "+" in text else []


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, label, end) of the patterns' matches, sorted."""
    return sorted((a, k, b) for k, found in enumerate((emails(text), ips(text), cards(text), phones(text)), 1)
                  for a, b in found)


def tokens(text: str) -> list[tuple[int, int]]:
    """Evidence tokens: runs without white space that hold a digit or @, less signs at their edges."""
    out, at = [], 0
    while m := EVIDENCE.search(text, at):
        a, b = m.start(), m.end()
        while a > at and text[a - 1] not in SPACES:
            a -= 1
        while b < len(text) and text[b] not in SPACES:
            b += 1
        at = b
        while a < b and text[a] in EDGE:
            a += 1
        while b > a and text[b - 1] in EDGE:
            b -= 1
        out.append((a, b))
    return out


def shape(token: str) -> int:
    """Hashed form of a token: digit runs with their length, letter runs, other signs; all of it."""
    form = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", lambda m: f"9{min(len(m.group()), 20)}", token))
    return xxhash.xxh32_intdigest(form.encode()) % SHAPES


def keys(token: str) -> list[str]:
    """What tokens that repeat or resemble each other have in common."""
    plain = "".join(filter(str.isalnum, token)).lower()
    out = [plain] if len(plain) >= LEAST_KEY else []
    name = "".join(filter(str.isalnum, token.split("@")[0])).lower()
    return out + [name] if "@" in token and len(name) >= LEAST_KEY and name != plain else out


def edges(text: str, found: list[tuple[int, int]],
          known: list[int] | None = None) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges (neighbours with one space or less between) and skip edges (from the hubs of a key to its others).

    Hubs are the first token of each label that the patterns give (``known``), else the key's first token.
    """
    chain = [(i, i + 1) for i in range(len(found) - 1) if found[i + 1][0] - found[i][1] <= 1]
    sharing: dict[str, list[int]] = {}
    for i, (a, b) in enumerate(found):
        for key in keys(text[a:b]):
            sharing.setdefault(key, []).append(i)
    skip: dict[tuple[int, int], None] = {}
    for same in sharing.values():
        sure: dict[int, int] = {}
        for i in same if known else ():
            if known[i]:
                sure.setdefault(known[i], i)
        for hub in sure.values() or same[:1]:
            skip.update(((hub, i), None) for i in same if i != hub and not (known and known[i]))
    return chain, list(skip)


def labels(found: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[int]:
    """Label of each token: of the first span that overlaps it, else O."""
    out, at = [], 0
    for a, b in found:
        while at < len(spans) and spans[at][2] <= a:
            at += 1
        out.append(next((k for s, k, e in spans[at:at + 4] if s < b and e > a), 0))
    return out


def count_pieces(df: DataFrame, text: str = "text") -> DataFrame:
    """(piece, a, b, n): shape and label, chain label pairs, skip label pairs, over all documents."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = len(LABELS)
        unary = np.zeros((SHAPES, n), np.int64)
        pair = np.zeros((2, n, n), np.int64)
        for batch in batches:
            for t in batch["text"]:
                if not t or not (found := tokens(t)):
                    continue
                y = labels(found, base_spans(t))
                for (a, b), k in zip(found, y):
                    unary[shape(t[a:b]), k] += 1
                for kind, linked in enumerate(edges(t, found)):
                    for i, j in linked:
                        pair[kind, y[i], y[j]] += 1
        rows = [(0, int(a), int(b), int(unary[a, b])) for a, b in zip(*np.nonzero(unary))]
        rows += [(1 + int(k), int(a), int(b), int(pair[k, a, b])) for k, a, b in zip(*np.nonzero(pair))]
        yield pd.DataFrame(rows, columns=["piece", "a", "b", "n"]).astype("int64")
    return (df.select(F.col(text).alias("text")).mapInPandas(run, "piece long, a long, b long, n long")
            .groupBy("piece", "a", "b").agg(F.sum("n").alias("n")))


@dataclass
class Field:
    """Log potentials: a label for a shape, label pairs along chain edges and along skip edges."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def marginals(self, text: str, found: list[tuple[int, int]], known: list[int] | None = None) -> np.ndarray:
        """Label probabilities of the tokens after loopy belief propagation; those with a ``known`` label keep it."""
        score = self.unary[[shape(text[a:b]) for a, b in found]]
        for i, k in enumerate(known or ()):
            if k:
                score[i] = np.where(np.arange(len(LABELS)) == k, 0.0, CERTAIN)
        chain, skip = edges(text, found, known)
        if chain or skip:
            ends = np.array(chain + skip)
            pots = np.concatenate([np.repeat(p[None], len(e), 0) for p, e in ((self.chain, chain), (self.skip, skip)) if e])
            src = np.concatenate([ends[:, 0], ends[:, 1]])
            dst = np.concatenate([ends[:, 1], ends[:, 0]])
            pots = np.concatenate([pots, pots.transpose(0, 2, 1)])       # from the sender's label to the receiver's
            half = len(ends)
            back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
            msg = np.zeros((2 * half, len(LABELS)))
            damping, done, change = DAMPING, 0, 1.0
            while change > SETTLED:                  # growing damping ends it even where messages swing
                belief = score.copy()
                np.add.at(belief, dst, msg)
                out = belief[src] - msg[back]
                new = np.logaddexp.reduce(out[:, :, None] + pots, axis=1)
                new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
                new = damping * msg + (1 - damping) * new
                change = float(np.abs(new - msg).max())
                msg, done = new, done + 1
                if done % PATIENCE == 0:
                    damping = (1 + damping) / 2
            score = score.copy()
            np.add.at(score, dst, msg)
        return np.exp(score - np.logaddexp.reduce(score, axis=1, keepdims=True))

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """Base spans, and the confident tokens that no base span touches; neighbours of one label join."""
        if not text:
            return []
        base = base_spans(text)
        found = tokens(text)
        if not found:
            return base
        known = labels(found, base)
        p = self.marginals(text, found, known)
        more: list[tuple[int, int, int]] = []
        for (a, b), was, row in zip(found, known, p):
            k = int(row.argmax())
            if was or not k or row[k] < CONFIDENT or a >= b:
                continue
            if more and more[-1][1] == k and a - more[-1][2] <= 1:
                more[-1] = (more[-1][0], k, b)
            else:
                more.append((a, k, b))
        return sorted(base + more)


def fit(df: DataFrame, text: str = "text") -> Field:
    """Piecewise estimates from the counts: label given shape, and how much likelier than overall a label is
    beside another along an edge. The driver gets at most SHAPES x labels + 2 x labels^2 numbers."""
    n = len(LABELS)
    unary, pair = np.zeros((SHAPES, n)), np.zeros((2, n, n))
    for r in count_pieces(df, text).collect():
        if r["piece"] == 0:
            unary[r["a"], r["b"]] = r["n"]
        else:
            pair[r["piece"] - 1, r["a"], r["b"]] = r["n"]
    prior = (unary.sum(0) + 0.1) / (unary.sum() + 0.1 * n)
    prior = np.where(unary.sum() > 0, prior, np.array([1.0] + [1e-6] * (n - 1)))
    unary = np.log((unary + 2 * prior) / (unary.sum(1, keepdims=True) + 2 * prior.sum()))
    pots = []
    for one in pair:
        both = one + 0.5
        ahead = np.log(both / both.sum(1, keepdims=True) / prior)            # of the second label, given the first
        behind = np.log(both / both.sum(0, keepdims=True) / prior[:, None])
        pots.append((ahead + behind) / 2)
    return Field(unary, pots[0], (pots[1] + pots[1].T) / 2)


def find_personal_data(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds pii_spans: array of (kind, start, end), code points, end exclusive, by start and kind.

    Every whole text is labelled. The patterns' spans always stay; the field
    adds tokens. Null and empty texts have none. Rows and other columns stay;
    a column of that name is replaced.
    """
    small_batches(df.sparkSession)
    field = fit(df, text)

    @F.pandas_udf("array<struct<kind:string,start:long,end:long>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([[{"kind": LABELS[k], "start": a, "end": e} for a, k, e in field.spans(t)] for t in b],
                            dtype=object)
    return df.withColumn("pii_spans", run(F.col(text)))
