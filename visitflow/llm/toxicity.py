"""Toxicity: noisy-channel restoration of disguised words, then a score of the restored text.

The channel model is a character lattice: leetspeak signs may stand for
letters, separators inside a word and long repetitions may be noise. A
character trigram model counted over the whole corpus weighs the readings,
and Viterbi decoding picks the best one.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fresh, small_batches

# Which letters a sign may stand for.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
        "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou", "#": "h"}

CLASSES = 64               # character classes of the language model
FIRST_ACCENT, LAST_ACCENT, OTHER_LETTER, DIGIT, SIGN = 0xDF, 0xFF, 60, 61, 62
SUBSTITUTED, DELETED, KEPT_SIGN, DOUBLED = 1.0, 1.5, 3.0, 1.0     # costs of the channel, in nats
TRAIN_ROWS = 12_000        # labelled documents of each class, at most, that the classifier is fitted on
MIN_TOXIC = 3              # toxic training documents a feature must occur in
MAX_FEATURES = 50_000      # size of the model
TOP_WORDS = 4              # strongest words of a document that make its score, beside its number of tokens
THRESHOLD = 0.7
CACHE_WORDS = 200_000      # scored words a task remembers
FLUSH_WORDS = 300_000      # feature counts a task holds before it emits them

SPACED = re.compile(r"(?<![^\W_])(?:[^\W_][ .\-_*]){2,}[^\W_](?![^\W_])")
RUN = re.compile(r"(.)\1\1+")
REPEAT = re.compile(r"(.)\1")
JOINT = re.compile("[^\\w" + re.escape("".join(c for c in LEET if not c.isalnum())) + "]+|_+")     # signs that are no letter
ANY_JOINT = re.compile(r"[\W_]+")
TAIL = re.compile(r"(?:!|([$*#@|+(&%])\1+)+$")      # shouting and ornament after a word


def char_class(c: str) -> int:
    """Class of a lower-case character: 0 ends a word, a-z 1 to 26, Latin-1 letters, other letters, digits, signs."""
    if "a" <= c <= "z":
        return ord(c) - 96
    if FIRST_ACCENT <= ord(c) <= LAST_ACCENT:
        return 27 + ord(c) - FIRST_ACCENT
    if c.isalpha():
        return OTHER_LETTER
    if c.isdigit():
        return DIGIT
    return 0 if c.isspace() else SIGN


def class_table() -> np.ndarray:
    return np.array([char_class(chr(i).lower()[0]) for i in range(0x300)], dtype=np.uint8)


def trigram_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(gram int, n long): class trigrams of all texts; at most 64^3 rows, combined in every task first."""
    table = class_table()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(CLASSES ** 3, np.int64)
        for b in batches:
            for s in b["text"]:
                if not s:
                    continue
                cp = np.frombuffer(f" {s} ".encode("utf-32-le"), np.uint32)
                ids = np.where(cp < 0x300, table[np.minimum(cp, 0x2FF)], OTHER_LETTER).astype(np.int32)
                total += np.bincount((ids[:-2] * CLASSES + ids[1:-1]) * CLASSES + ids[2:], minlength=CLASSES ** 3) \
                    if len(ids) > 20_000 else 0
                if len(ids) <= 20_000:
                    grams, n = np.unique((ids[:-2] * CLASSES + ids[1:-1]) * CLASSES + ids[2:], return_counts=True)
                    total[grams] += n
        found = np.nonzero(total)[0]
        yield pd.DataFrame({"gram": found.astype(np.int32), "n": total[found]})
    return (df.select(F.col(text).alias("text")).mapInPandas(count, "gram int, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")))


def language_model(counts: dict[int, int]) -> np.ndarray:
    """Costs (-log P) of a class after two others, trigram and bigram interpolated."""
    n = np.zeros(CLASSES ** 3)
    for g, c in counts.items():
        n[g] = c
    n = n.reshape(CLASSES, CLASSES, CLASSES)
    one = n.sum((0, 1)) + 0.5
    two = n.sum(0)
    p1 = one / one.sum()
    p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
    p3 = (n + 5 * p2) / (n.sum(2, keepdims=True) + 5)
    return -np.log(p3).astype(np.float32)


def lattice(token: str) -> Iterator[list[tuple[str, float]]]:
    """Readings of each sign of a lower-case token, with channel costs; letters read as themselves, doubled ones as
    two or one."""
    i = 0
    while i < len(token):
        c, j = token[i], i
        while j < len(token) and token[j] == c:
            j += 1
        if c.isalpha():
            if j - i >= 3:
                yield [(c, 0.0), (c + c, DOUBLED)]
            else:
                yield [(c, 0.0)] if j - i == 1 else [(c + c, 0.0), (c, DOUBLED)]
        else:
            stands = [(x, SUBSTITUTED) for x in LEET.get(c, "")]
            stay = [(c, KEPT_SIGN)] if c.isdigit() else [("", DELETED)]
            for _ in range(1 if j - i >= 3 or not stands else j - i):
                yield stands + stay
        i = j


class Trie:
    """The features of a model that consist of letters, to tell which lattices hold a word with one of them."""

    def __init__(self, weights: Mapping[str, float]):
        self.root: dict = {}
        for f, weight in weights.items():
            body, whole = (f[1:-1], True) if f.endswith("$") else (f[1:], False)
            if body.isalpha():
                node = self.root
                for c in body:
                    node = node.setdefault(c, {})
                node["$" if whole else "^"] = weight      # of a whole word; of any word that begins so

    def score(self, word: str) -> float:
        """Largest weight among the features of a word of letters, 0 without one."""
        best, node = 0.0, self.root
        for c in word:
            node = node.get(c)
            if node is None:
                return best
            if "^" in node:
                best = max(best, node["^"])
        return max(best, node.get("$", 0.0))

    def reaches(self, token: str) -> bool:
        """Whether the letters of any reading of a lower-case token have a feature: the lattice met with the trie."""
        nodes = {0: self.root}
        for choices in lattice(token):
            after = {}
            for node in nodes.values():
                for reading, _ in choices:
                    x = node
                    for c in reading:
                        if c.isalpha():
                            x = x.get(c)
                            if x is None:
                                break
                            if "^" in x:
                                return True
                    else:
                        after[id(x)] = x
            if not after:
                return False
            nodes = after
        return any("$" in x for x in nodes.values())


def restore(token: str, cost: np.ndarray) -> str:
    """The cheapest reading of a lower-case token: channel cost plus language model cost (Viterbi)."""
    # a text is a pair of the text before and the last reading, so a long token takes time by its length
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for readings in lattice(token):
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (spent, text) in states.items():
            for reading, price in readings:
                x, y, total = a, b, spent + price
                for c in reading:
                    k = char_class(c)
                    total += float(cost[x, y, k])
                    x, y = y, k
                best = after.get((x, y))
                if best is None or total < best[0]:
                    after[x, y] = (total, (text, reading))
        states = after
    (_, text), out = min(((spent + float(cost[a, b, 0]), text) for (a, b), (spent, text) in states.items()),
                         key=lambda s: s[0]), []
    while text:
        text, reading = text
        out.append(reading)
    return "".join(reversed(out))


def readings(token: str, cost: np.ndarray, trie: Trie | None = None) -> tuple[str, ...]:
    """Words of a lower-case token: the whole token as one, and its parts between signs; each restored.

    Words of letters count as they stand too (unless a letter runs on), and
    so do those before shouting and ornament, whose signs compete as letters
    in the restored reading. With ``trie`` only parts that can be read as a
    word with one of its features are restored: no such word is lost.
    """
    core = token.strip(".,;:?\"'`)]}>[{<&%/\\=~^")
    if core.isalpha() and not REPEAT.search(core):
        return (core,)
    if not any(map(str.isalpha, core)):
        plain = TAIL.sub("", core).rstrip(".,;:?\"'")
        return (plain,) if plain else ()
    parts = [core, *JOINT.split(core), *(p for p in ANY_JOINT.split(core) if len(p) >= 3)]
    found: dict[str, None] = {}
    for part in dict.fromkeys(parts):
        if not any(map(str.isalpha, part)):
            continue
        short = TAIL.sub("", part).rstrip(".,;:?\"'")
        if short.isalpha() and not RUN.search(short):
            found[short] = None
        if (not part.isalpha() or REPEAT.search(part)) and (trie is None or trie.reaches(part)):
            found["".join(filter(str.isalpha, restore(part, cost)))] = None
    return tuple(w for w in found if w)


def tokens(text: str) -> set[str]:
    """Distinct lower-case tokens of a text; spaced-out words count besides their letters."""
    low = text.lower()
    found = set(low.split())
    found.update(re.sub(r"[ .\-_*]", "", m.group()) for m in SPACED.finditer(low))
    return found


def words(text: str, cost: np.ndarray, memo: dict[str, tuple[str, ...]]) -> set[str]:
    """Distinct restored words of a text, lower case."""
    found = set()
    for t in tokens(text):
        w = memo.get(t)
        if w is None:
            w = readings(t, cost)
            if len(memo) >= CACHE_WORDS:
                memo.clear()
            memo[t] = w
        found.update(w)
    return found


def features(word: str) -> list[str]:
    """The whole word and its beginnings of 3 to 10 letters."""
    w = f"^{word}$"
    return [w] + [w[:n] for n in range(4, min(12, len(w)))]


@dataclass
class Model:
    cost: np.ndarray
    weights: dict[str, float]
    coef: list[float]              # intercept, one for each of the strongest words, one for the number of tokens

    def __post_init__(self):
        self.trie = Trie(self.weights)

    def scored(self, token: str) -> dict[str, float]:
        """The readings of a token with a score above 0, and their scores."""
        scores = {w: self.trie.score(w) if w.isalpha() else max(self.weights.get(f, 0.0) for f in features(w))
                  for w in readings(token, self.cost, self.trie)}
        return {w: s for w, s in scores.items() if s > 0}

    def strongest(self, text: str | None, memo: dict[str, dict[str, float]]) -> list[float]:
        """Scores of the TOP_WORDS strongest distinct words, largest first, and the log of the number of tokens."""
        found: dict[str, float] = {}
        all_tokens = tokens(text or "")
        for t in all_tokens:
            scores = memo.get(t)
            if scores is None:
                scores = self.scored(t)
                if len(memo) >= CACHE_WORDS:
                    memo.clear()
                memo[t] = scores
            if scores:
                found.update(scores)
        best = sorted(found.values(), reverse=True)[:TOP_WORDS]
        return [*best, *[0.0] * (TOP_WORDS - len(best)), math.log1p(len(all_tokens))]

    def score(self, best: list[float]) -> float:
        z = self.coef[0] + sum(c * x for c, x in zip(self.coef[1:], best))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def _feature_counts(cost: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, tuple[str, ...]] = {}
        counts: dict[str, list[int]] = {}

        def out() -> pd.DataFrame:
            return pd.DataFrame({"feature": pd.Series(list(counts), dtype=object), "toxic": [c[1] for c in counts.values()],
                                 "clean": [c[0] for c in counts.values()]}).astype({"toxic": "int64", "clean": "int64"})
        for b in batches:
            for text, toxic in zip(b["text"], b["toxic"]):
                for f in {f for w in words(text or "", cost, memo) for f in features(w)}:
                    counts.setdefault(f, [0, 0])[toxic] += 1
                if len(counts) >= FLUSH_WORDS:
                    yield out()
                    counts.clear()
        yield out()
    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, rounds: int = 50) -> list[float]:
    """Ridge logistic regression by Newton steps; x has one row per document."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from: crc32(id as text) mod 3 is 1. A null id: false."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text",
          train_rows: int = TRAIN_ROWS) -> Model:
    """Language model from every document; classifier from a bounded sample of labelled rows.

    At most ``train_rows`` documents of each class, chosen by a hash of the
    id, are used, none of them held out. Two thirds give the weights of the
    features (smoothed log odds of document counts), one third calibrates the
    score on documents that the weights have not seen. The sampled ids (16
    bytes each) are the only broadcast. Without rows of both classes the
    model scores every text 0. Labels with a null id or class are ignored; if an id has several, one
    toxic one decides.
    """
    small_batches(docs.sparkSession)
    counts = {r["gram"]: r["n"] for r in trigram_counts(docs, text).collect()}
    cost = language_model(counts)
    known = (labels.select(F.col(doc_id).alias("id"), "toxic").where("id IS NOT NULL AND toxic IS NOT NULL")
             .where(~held_out("id")).groupBy("id").agg(F.max("toxic").alias("toxic")))
    order = F.xxhash64("id", F.lit("train"))
    chosen = (known.where("toxic = 1").orderBy(order, "id").limit(train_rows)
              .unionByName(known.where("toxic = 0").orderBy(order, "id").limit(train_rows)))
    chosen = scratch.write(chosen.withColumn("fold", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(3))), "chosen")
    sample = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    sample = scratch.write(sample.select("text", F.col("toxic").cast("int"), "fold"), "sample")
    sizes = {r["toxic"]: r["n"] for r in sample.where("fold != 0").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model(cost, {}, [-50.0] + [0.0] * (TOP_WORDS + 1))
    odds = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1)) - F.log((F.col("clean") + 2.0) / (sizes[0] + 1))
    found = (sample.where("fold != 0").select("text", "toxic")
             .repartition(2 * sample.sparkSession.sparkContext.defaultParallelism)
             .mapInPandas(_feature_counts(cost), "feature string, toxic long, clean long")
             .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
             .where(F.col("toxic") >= MIN_TOXIC).withColumn("weight", odds).where("weight > 1")
             .orderBy(F.desc("weight"), "feature").limit(MAX_FEATURES).select("feature", "weight").collect())
    model = Model(cost, {r["feature"]: r["weight"] for r in found}, [0.0] * (TOP_WORDS + 2))

    def strongest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict = {}
        for b in batches:
            rows = [model.strongest(t, memo) for t in b["text"]]
            yield pd.DataFrame({"best": pd.Series(rows, dtype=object), "toxic": b["toxic"]})
    # bounded by the sample: TOP_WORDS + 1 numbers for each document of the third fold
    rows = (sample.where("fold = 0").select("text", "toxic")
            .mapInPandas(strongest, "best array<double>, toxic int").collect())
    if not {0, 1} <= {r["toxic"] for r in rows}:
        model.coef = [-6.0] + [2.0 if i == 0 else 0.5 for i in range(TOP_WORDS)] + [0.0]
    else:
        toxic = np.array([r["toxic"] for r in rows], float)
        model.coef = fit_logistic(np.array([r["best"] for r in rows]), toxic)
        # the sample evens out the classes; the score goes by their shares among all labels
        shares = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        model.coef[0] += math.log(shares[1] / shares[0]) - math.log(toxic.sum() / (len(toxic) - toxic.sum()))
    return model


def with_score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Adds ``name`` double (0 to 1, higher: likelier toxic); null and empty texts get the score of no words."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo: dict = {}
        for s in batches:
            yield pd.Series([model.score(model.strongest(t, memo)) for t in s], dtype="float64")
    return df.withColumn(name, score(F.col(text)))


def toxicity(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``df``: (doc_id, held_out, score, predicted).

    Every whole text is scored; ids, languages and sources are no inputs.
    Null and empty texts have a score too; null ids are kept (not held out);
    repeated rows stay repeated; an empty table gives no rows. Other columns
    are ignored.
    """
    model = train(df, labels, Scratch(df.sparkSession, "toxicity"), doc_id, text)
    rows = df.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"))
    return with_score(rows, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that score below ``threshold``, with all their columns."""
    model = train(df, labels, Scratch(df.sparkSession, "toxicity"), doc_id, text)
    score, = fresh(df, "score")
    return with_score(df, model, text, score).where(F.col(f"`{score}`") < threshold).drop(score)
