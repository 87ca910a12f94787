"""Quality rules as a learned decision list over text statistics, all in Spark expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

FEATURES = ("n_words", "mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share",
            "upper_share", "digit_share", "letter_share")
THRESHOLDS = 32            # candidate cuts of a feature: so many quantiles of the good and of the bad rows
MAX_RULES, MAX_CONDITIONS = 8, 4
MIN_PRECISION = 0.9        # of a rule on rows it was not grown on
MIN_COVER = 5              # labelled rows a rule must reject there
POSITION_BITS = 24         # of a packed window: position below, hash above


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the FEATURES of ``text``.

    n_repeat_words counts the words inside three-word windows that occur twice
    or more in the text. Windows are packed as (hash, position) longs and
    sorted; windows that meet there are compared word by word, and a text in
    which different windows share a hash prefix is counted over the windows
    themselves instead, so hashes never decide.
    """
    keep = [c for c in df.columns if c != text]
    t = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("t"))
    t = t.select(*keep, "t", F.regexp_extract_all("t", F.lit(r"([^\x20\x09-\x0D]+)"), 0).alias("words"),
                 F.expr(r"filter(split(t, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')").alias("lines"),
                 F.length(F.regexp_replace("t", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
                 F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
                 F.length(F.regexp_replace("t", r"[^A-Z]+", "")).alias("upper"),
                 F.length(F.regexp_replace("t", r"[^0-9]+", "")).alias("digits"),
                 F.length(F.regexp_replace("t", r"\P{L}+", "")).alias("letters"))
    position = (1 << POSITION_BITS) - 1
    window = "xxhash64(get(words, i), get(words, i + 1), get(words, i + 2))"
    t = t.withColumn("sorted", F.expr(
        f"IF(size(words) < 3, CAST(array() AS ARRAY<BIGINT>), sort_array(transform(sequence(0, size(words) - 3), "
        f"i -> ({window} & {~position}L) | i)))"))
    t = t.withColumn("meet", F.expr(
        f"IF(size(sorted) < 2, CAST(array() AS ARRAY<INT>), filter(sequence(1, size(sorted) - 1), "
        f"j -> shiftright(get(sorted, j), {POSITION_BITS}) = shiftright(get(sorted, j - 1), {POSITION_BITS})))"))

    def at(j: str) -> str:
        return f"CAST(get(sorted, {j}) & {position}L AS INT)"
    same = " AND ".join(f"get(words, {at('j')} + {k}) = get(words, {at('j - 1')} + {k})" for k in range(3))
    t = t.withColumn("exact", F.expr(f"size(words) <= {position} AND forall(meet, j -> {same})"))
    # the plain way: windows as texts, sorted with their positions
    slow = ("transform(sequence(0, size(words) - 3), i -> struct(get(words, i) AS a, get(words, i + 1) AS b, "
            "get(words, i + 2) AS c, i AS i))")
    t = t.withColumn("plain", F.expr(f"IF(exact, NULL, sort_array({slow}))"))
    alike = " AND ".join(f"get(plain, j).{c} = get(plain, j - 1).{c}" for c in "abc")
    t = t.withColumn("plain_meet", F.expr(f"IF(exact, NULL, filter(sequence(1, size(plain) - 1), j -> {alike}))"))
    t = t.withColumn("repeats", F.expr(
        f"IF(exact, sort_array(array_distinct(concat(transform(meet, j -> {at('j')}), transform(meet, j -> {at('j - 1')})))), "
        "sort_array(array_distinct(concat(transform(plain_meet, j -> get(plain, j).i), "
        "transform(plain_meet, j -> get(plain, j - 1).i)))))"))
    t = t.withColumn("n_repeat_words", F.expr(
        "IF(size(repeats) = 0, 0L, aggregate(sequence(0, size(repeats) - 1), 0L, (n, k) -> n + "
        "IF(k = 0, 3, least(3, get(repeats, k) - get(repeats, k - 1)))))"))
    words, chars = F.size("words"), F.length("t")

    def over(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0)
    return t.select(
        *keep, words.cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words",
        over(F.col("word_chars"), words).alias("mean_word"), over(F.col("n_symbols"), words).alias("symbol_share"),
        over(F.size("lines") - F.size(F.array_distinct("lines")), F.size("lines")).alias("dup_line_share"),
        over(F.col("n_repeat_words"), words).alias("repeat_share"),
        over(F.size(F.array_distinct("words")), words).alias("distinct_share"),
        over(F.col("upper"), F.col("letters")).alias("upper_share"), over(F.col("digits"), chars).alias("digit_share"),
        over(F.col("letters"), F.col("word_chars")).alias("letter_share"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool                # value > cut, else value <= cut
    cut: float

    def column(self) -> Column:
        return F.col(self.feature) > F.lit(self.cut) if self.above else F.col(self.feature) <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:g}"


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, (c.column() for c in rule))


def _counts(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, list[tuple[int, int]]]:
    """Per feature and bin: (bad, good) rows. One aggregate; the driver gets features x bins rows."""
    bins = [F.struct(F.lit(f).alias("f"), F.col(f"bin_{f}").alias("bin")) for f in cuts]
    got = (rows.select("bad", F.explode(F.array(*bins)).alias("x")).groupBy("x.f", "x.bin")
           .agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")).collect())
    out = {f: [(0, 0)] * (len(c) + 1) for f, c in cuts.items()}
    for r in got:
        out[r["f"]][r["bin"]] = (r["bad"], r["good"])
    return out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """FOIL's gain of narrowing (p0 bad, n0 good) to (p, n)."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _grow(rows: DataFrame, cuts: dict[str, list[float]], max_conditions: int) -> Rule:
    rule: list[Condition] = []
    while len(rule) < max_conditions:
        part = rows.where(holds(tuple(rule))) if rule else rows
        counts = _counts(part, cuts)
        whole = next(iter(counts.values()))
        p0, n0 = sum(c[0] for c in whole), sum(c[1] for c in whole)
        if not p0 or not n0:
            break
        best = (0.0, None)
        for f, bins in counts.items():
            p = n = 0
            for (bad, good), cut in zip(bins, cuts[f]):
                p, n = p + bad, n + good
                for above, (a, b) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                    gain = _gain(a, b, p0, n0)
                    if gain > best[0] + 1e-9:
                        best = (gain, Condition(f, above, cut))
        if best[1] is None or best[0] < 0.01 * p0:
            break
        rule.append(best[1])
    return tuple(rule)


def learn(stats: DataFrame, labels: DataFrame, scratch: Scratch, doc_id: str = "doc_id", max_rules: int = MAX_RULES,
          max_conditions: int = MAX_CONDITIONS, min_precision: float = MIN_PRECISION,
          min_cover: int = MIN_COVER) -> list[Rule]:
    """Sequential covering: ordered rules that reject documents labelled quality 0.

    A rule grows on two thirds of the labelled rows (by a hash of the id),
    condition by condition with the largest gain; it is pruned to the prefix
    that does best on the last third, where it must also be right in
    ``min_precision`` of the rows it rejects. Rows it covers are set aside and
    the next rule grows on the rest. All labelled rows count; each step is one
    aggregate that returns features x cuts numbers. Without labels of both
    kinds there are no rules. Labels with null ids or classes are ignored; an
    id with several labels takes the lowest.
    """
    known = (labels.select(F.col(doc_id).alias("id"), "quality").where("id IS NOT NULL AND quality IS NOT NULL")
             .groupBy("id").agg(F.min("quality").alias("quality")))
    rows = stats.join(known, stats[doc_id] == known["id"]).select(
        *FEATURES, (F.col("quality") == 0).cast("long").alias("bad"),
        F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(3)).alias("fold"))
    rows = scratch.write(rows, "labelled")
    points = [0.002, 0.01, *[i / THRESHOLDS for i in range(1, THRESHOLDS)], 0.99, 0.998]
    # quantiles of either kind: the rarer one may lie in the other's tail
    edges = [rows.where(F.col("bad") == kind).agg(*[F.percentile_approx(f, points, 10_000).alias(f) for f in FEATURES])
             .first() for kind in (0, 1)]
    if any(e[FEATURES[0]] is None for e in edges):
        return []
    cuts = {f: sorted({float(x) for e in edges for x in e[f]}) for f in FEATURES}

    def bin_of(feature: str) -> Column:
        return F.size(F.filter(F.lit(cuts[feature]), lambda cut: F.col(feature) > cut)).alias(f"bin_{feature}")
    rows = scratch.write(rows.select("*", *[bin_of(f) for f in cuts]), "binned")
    grow, prune = rows.where("fold != 0"), rows.where("fold = 0")
    rules: list[Rule] = []
    while len(rules) < max_rules:
        rule = _grow(grow, cuts, max_conditions)
        if not rule:
            break
        prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
        got = prune.agg(*[F.sum(F.when(holds(p), F.lit(kind) * F.col("bad") + (1 - F.lit(kind)) * (1 - F.col("bad")))
                                .otherwise(0)).alias(f"{i}_{kind}") for i, p in enumerate(prefixes) for kind in (1, 0)]).first()

        def worth(i: int) -> float:
            p, n = got[f"{i}_1"] or 0, got[f"{i}_0"] or 0
            return (p - n) / (p + n) if p + n else -1.0
        best = max(range(len(prefixes)), key=worth)
        p, n = got[f"{best}_1"] or 0, got[f"{best}_0"] or 0
        rule = prefixes[best]
        grow, prune = grow.where(~holds(rule)), prune.where(~holds(rule))
        if p + n < min_cover or p < min_precision * (p + n):
            break
        rules.append(rule)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one conditional expression: the first rule that holds rejects; else keep."""
    out = F.lit(True)
    for rule in reversed(rules):
        out = F.when(holds(rule), F.lit(False)).otherwise(out)
    return out


def quality(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
            name: str = "quality") -> tuple[DataFrame, list[Rule]]:
    """One row per row of ``df``: doc_id, the counts and FEATURES, base_failed, rule (text or null) and kept.

    base_failed: fewer than 50 words, or more than half of them in repeated
    windows. Other texts are kept unless a learned rule rejects them. Null
    texts have no words and fail the base; rows with null ids are judged like
    others, repeated rows alike; an empty table gives no rows. Other columns
    of ``df`` are ignored.
    """
    scratch = Scratch(df.sparkSession, name)
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    stats = scratch.write(statistics(rows), "statistics")
    rules = learn(stats, labels.withColumnRenamed(doc_id, "doc_id"), scratch)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    named = F.lit(None).cast("string")
    for rule in reversed(rules):
        named = F.when(holds(rule), F.lit(" and ".join(map(str, rule)))).otherwise(named)
    return stats.select("*", failed.alias("base_failed"), named.alias("rule"),
                        (~failed & verdict(rules)).alias("kept")), rules
