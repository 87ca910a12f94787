"""URL filter (11): rules and vocabulary against plain regular expressions, edge cases."""

import random
import re

from edge_rows import LONG

from visitflow.llm import url_filter as uf
from visitflow.llm.queries import URL_RULES

RULES = URL_RULES + (("a.example.net", "/", "block"), ("Shop.ORG", "/fr/x", "block"))


def brute(url):
    """Host, path, rule, verdict and hits by regular expressions and loops over all rules."""
    url = url or ""
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
    low = re.compile("[A-Z]")
    host, path = (low.sub(lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h) + len(p), len(h), h.lower() + p, v) for h, p, v in RULES
            if (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    _, _, rule, verdict = max(fits) if fits else (0, 0, None, None)
    text = low.sub(lambda c: c[0].lower(), url)
    hits = {t: len(re.findall(rf"(?<![a-z0-9])(?={re.escape(t)}(?![a-z0-9]))", text)) for t in (*uf.STRICT_TERMS, *uf.SOFT_TERMS)}
    strict = sum(hits[t] for t in uf.STRICT_TERMS)
    soft = sum(hits[t] > 0 for t in uf.SOFT_TERMS)
    return host, path, rule, verdict or ("block" if strict or soft >= uf.SOFT_LIMIT else "allow"), strict, soft


def judged(df, **options):
    rows, names = uf.judge_urls(df, rules=RULES, **options)
    return rows, [names[n] for n in ("host", "path", "rule", "verdict", "strict_hits", "soft_hits")]


def test_urls_equal_brute_force(spark):
    random.seed(5)
    bits = ["http://", "https://", "://", "www.", "A.Example.net", "example.com", "b.example.net", "shop.org", "x.shop.org", "/en/", "/de/",
            "/fr/", "/fr/x", "/", "?", "#", "-", ".", "_", "Casino", "casinos", "free", "FREE", "cheap", "win", "winner", "x", "xx",
            "essex", "sex", "é", "ſ", "İ", "\n", " ", "net", "org"]
    urls = ["".join(random.choice(bits) for _ in range(random.randint(0, 9))) for _ in range(1500)]
    urls += [random.choice(["http://", "https://"]) + "".join(random.choice(bits[3:]) for _ in range(6)) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows, names = judged(df)
    got = {r[0]: r[2:] for r in rows.select("page_id", "url", *names).collect()}
    assert {i: brute(u) for i, u in enumerate(urls)} == {i: tuple(r) for i, r in got.items()}
    verdicts = {r[3] for r in got.values()}
    assert verdicts == {"allow", "block"} and len({r[2] for r in got.values()}) >= 5


def test_long_many_terms_and_limits(spark):
    words = tuple(f"term{i}" for i in range(3000))
    rows = [(1, "http://h.example/" + "-".join(words[:40])), (2, "http://h.example/term5-term5"), (3, "http://h/" + LONG.replace(" ", "/")),
            (4, "http://h/term7-" + "a" * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got, names = uf.judge_urls(df, strict=(), soft=words, soft_limit=40)
    assert {r.page_id: (r.verdict, r.soft_hits) for r in got.collect()} == {
        1: ("block", 40), 2: ("allow", 1), 3: ("allow", 0), 4: ("allow", 1)}
    got, _ = uf.judge_urls(df, strict=(), soft=())                 # no vocabulary: nothing is rejected
    assert {r.verdict for r in got.collect()} == {"allow"}


def test_edge_rows(spark):
    rows = [(1, None, "p"), (2, "", "p"), (None, "http://casino.example.org/", "p"), (None, None, None),
            (3, "casino without a scheme", "p"), (4, "http://x.net/", "p"), (4, "http://x.net/", "p"), (5, "http://net", "p")]
    df = spark.createDataFrame(rows, "page_id long, url string, path string").selectExpr(
        "*", "'kept' AS host", "'kept' AS verdict", "'kept' AS rule", "1 AS _found", "'kept' AS strict_hits")
    got, names = judged(df)
    assert got.columns[:8] == df.columns and names[0] == "_host" and names[1] == "_path"
    found = sorted(((r["page_id"] or 0, r[names[2]], r[names[3]]) for r in got.collect()), key=str)
    assert found == sorted([(1, None, "allow"), (2, None, "allow"), (0, None, "block"), (0, None, "allow"), (3, None, "block"),
                            (4, "net/", "block"), (4, "net/", "block"), (5, None, "allow")], key=str)
    kept = uf.allowed_pages(df, rules=RULES)
    assert kept.columns == df.columns and kept.count() == 4
    assert uf.allowed_pages(df.limit(0)).count() == 0
