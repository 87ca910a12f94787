"""URL filter: host rules, and a weighted vocabulary of strict and soft terms found by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

# one of these rejects a url
STRICT_TERMS = ("casino", "casinos", "porn", "porno", "xxx", "viagra", "cialis", "escort", "escorts", "warez", "malware",
                "phishing", "hentai", "onlyfans")
# of these it takes SOFT_LIMIT different ones
SOFT_TERMS = ("adult", "adults", "ads", "ad", "bet", "bets", "betting", "bonus", "cheap", "click", "coupon", "crypto", "dating",
              "deal", "deals", "farm", "free", "gambling", "hot", "jackpot", "loan", "loans", "lotto", "nude", "pharma", "pill",
              "pills", "poker", "promo", "replica", "sex", "slot", "slots", "spam", "spin", "track", "tracker", "win",
              "winner", "x")
SOFT_LIMIT = 2
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
INSIDE = frozenset(LOWER + "0123456789")          # a term next to one of these is part of a longer word
FOUND = "rule string, rule_verdict string, strict_hits long, soft_hits long"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def term_automaton(strict: Iterable[str], soft: Iterable[str]):
    """Aho-Corasick automaton of the terms, or None without any; a term in both lists is strict."""
    words = {t.lower(): False for t in soft if t} | {t.lower(): True for t in strict if t}
    if not words:
        return None
    found = ahocorasick.Automaton()
    for term, is_strict in words.items():
        found.add_word(term, (term, is_strict))
    found.make_automaton()
    return found


def count_terms(automaton, text: str) -> tuple[int, int]:
    """(strict occurrences, different soft terms) of a lower-cased text; neither end touches a letter or digit."""
    strict, soft = 0, set()
    if automaton is None or not text:
        return 0, 0
    for last, (term, is_strict) in automaton.iter(text):
        first = last - len(term) + 1
        if (first and text[first - 1] in INSIDE) or text[last + 1:last + 2] in INSIDE:
            continue
        if is_strict:
            strict += 1
        else:
            soft.add(term)
    return strict, len(soft)


def rule_table(rules: Iterable[tuple[str, str, str]]) -> dict[str, list[tuple[str, str]]]:
    """(host, path, verdict) rules by host, the longest path first."""
    out: dict[str, list[tuple[str, str]]] = {}
    for host, path, verdict in rules:
        out.setdefault(host.lower(), []).append((path, verdict))
    return {host: sorted(found, key=lambda r: (-len(r[0]), r)) for host, found in out.items()}


def fitting_rule(table: dict[str, list[tuple[str, str]]], host: str, path: str) -> tuple[str | None, str | None]:
    """The longest rule that fits: its host is ``host`` or a parent of it, its path a beginning of ``path``.

    Of rules equally long the one with the longer host wins.
    """
    best, size = (None, None), -1
    while host:
        for start, verdict in table.get(host, ()):
            if path.startswith(start):
                if len(host) + len(start) > size:
                    best, size = (host + start, verdict), len(host) + len(start)
                break
        _, dot, host = host.partition(".")
    return best


def _judge(strict: tuple[str, ...], soft: tuple[str, ...], rules: tuple[tuple[str, str, str], ...]):
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        automaton, table = term_automaton(strict, soft), rule_table(rules)
        for url, host, path in batches:
            rows = [fitting_rule(table, h, p) + count_terms(automaton, u) for u, h, p in zip(url, host, path)]
            yield pd.DataFrame(rows, columns=["rule", "rule_verdict", "strict_hits", "soft_hits"])
    return F.pandas_udf(run, FOUND)


def judge_urls(df: DataFrame, url: str = "url", rules: Iterable[tuple[str, str, str]] = (),
               strict: Iterable[str] = STRICT_TERMS, soft: Iterable[str] = SOFT_TERMS,
               soft_limit: int = SOFT_LIMIT) -> tuple[DataFrame, dict[str, str]]:
    """``df`` and, under names it does not have yet, host, path, rule, verdict, strict_hits and soft_hits.

    A rule (host, path, ``allow`` or ``block``) decides for its host and all
    subdomains where the url's path starts with the rule's; the longest rule
    wins. Without one the vocabulary decides on the whole url, A-Z
    lower-cased: ``block`` at one strict term or ``soft_limit`` different soft
    ones. A term counts where no ASCII letter or digit touches it, so ``sex``
    is not in ``essex``. Terms and rules are parameters, held by each task;
    pages are neither shuffled nor collected, however many share a url.

    A null url, or one without ``://``, has an empty host and path and no rule;
    the terms of the latter count. An empty or null url is allowed. Repeated
    rows are judged alike, null ids are kept, an empty table gives no rows.
    """
    names = dict(zip(("host", "path", "rule", "verdict", "strict_hits", "soft_hits"),
                     fresh(df, "host", "path", "rule", "verdict", "strict_hits", "soft_hits")))
    found, = fresh(df, "_found")
    address = F.col(f"`{url}`")
    rows = df.withColumns({names["host"]: host_of(address), names["path"]: path_of(address)})
    rows = rows.withColumn(found, _judge(tuple(strict), tuple(soft), tuple(tuple(r) for r in rules))(
        ascii_lower(F.coalesce(address, F.lit(""))), F.col(names["host"]), F.col(names["path"])))
    hit = F.col(found)
    by_terms = F.when((hit["strict_hits"] > 0) | (hit["soft_hits"] >= soft_limit), "block").otherwise("allow")
    rows = rows.withColumns({names["rule"]: hit["rule"], names["verdict"]: F.coalesce(hit["rule_verdict"], by_terms),
                             names["strict_hits"]: hit["strict_hits"], names["soft_hits"]: hit["soft_hits"]})
    return rows.drop(found), names


def allowed_pages(df: DataFrame, url: str = "url", **options) -> DataFrame:
    """The rows of ``df`` whose url is allowed, with its own columns."""
    rows, names = judge_urls(df, url, **options)
    return rows.where(F.col(names["verdict"]) == "allow").select(*[F.col(f"`{c}`") for c in df.columns])
