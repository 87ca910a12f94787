"""Byte-level BPE: the merges of a rank file replayed over all words of a block of documents at once.

The vocabulary of a block is laid out as one token array with neighbour links.
An inverted index maps each mergeable pair (by the rank it merges to) to the
positions where it stands; merges are applied in rank order, and only the
neighbours of a merge are looked up again.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, small_batches

SHIFT = 20                 # token ids fit in this many bits
NONE = (1 << SHIFT) - 1    # beyond the end of a word
NEVER = 1 << 30            # rank of a pair that does not merge
BLOCK_BYTES = 16 << 20     # text whose words are merged together
MEMO_WORDS = 500_000       # encoded words a task keeps for its next blocks
FEW = 12                   # positions up to which a merge is applied one by one


@dataclass
class Vocabulary:
    """A rank file as arrays: fixed size, whatever the corpus."""

    pattern: str
    whole: dict[bytes, int]        # token bytes -> id
    byte_ids: np.ndarray           # id of each single byte
    pair_keys: np.ndarray          # sorted (left << SHIFT | right)
    pair_ranks: np.ndarray
    token_bytes: np.ndarray        # bytes of all tokens, one after another
    token_starts: np.ndarray
    token_sizes: np.ndarray

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << SHIFT) | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER).astype(np.int32)


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Lines of base64 token and rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


def vocabulary(ranks: dict[bytes, int], pattern: str) -> Vocabulary:
    pairs = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                pairs[a << SHIFT | b] = rank
    keys = np.array(sorted(pairs), dtype=np.int64)
    size = max(ranks.values()) + 1
    tokens = [b""] * size
    for token, rank in ranks.items():
        tokens[rank] = token
    sizes = np.array([len(t) for t in tokens], dtype=np.int64)
    return Vocabulary(pattern, ranks, np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32), keys,
                      np.array([pairs[k] for k in keys.tolist()], dtype=np.int32),
                      np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(sizes) - sizes, sizes)


def replay(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after another, and how many each word has.

    The same ids as merging every word's lowest-ranked pair, leftmost first,
    again and again: words do not touch each other, so merging in rank order
    over all of them gives each word its own order. Where a merge makes a pair
    of lower rank, the rest of that word waits until that pair has had its turn.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    n = int(sizes.sum())
    tok = np.append(v.byte_ids[np.frombuffer(b"".join(words), np.uint8)], NONE).astype(np.int32)
    word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    nxt = np.arange(1, n + 2, dtype=np.int32)
    prv = np.arange(-1, n, dtype=np.int32)
    ends = np.cumsum(sizes)
    nxt[ends - 1] = n
    prv[ends - sizes] = n
    nxt[n] = prv[n] = n
    rank = v.rank(tok, tok[nxt])
    rank[n] = NEVER
    pairs = dict(zip(v.pair_keys.tolist(), v.pair_ranks.tolist()))
    index: dict[int, list[np.ndarray]] = {}      # rank -> positions whose pair merges to it
    single: dict[int, list[int]] = {}            # the same, for positions found one by one
    heap: list[int] = []

    def add(ranks: np.ndarray, at: np.ndarray) -> None:
        keep = ranks < NEVER
        ranks, at = ranks[keep], at[keep]
        if not len(at):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, at = ranks[order], at[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for r, part in zip(ranks[starts].tolist(), np.split(at, cuts)):
            if r not in index:
                index[r] = []
                if r not in single:
                    heappush(heap, r)
            index[r].append(part)

    def add_one(r: int, p: int) -> None:
        if r not in single:
            single[r] = []
            if r not in index:
                heappush(heap, r)
        single[r].append(p)

    def merge_few(r: int, at: list[int]) -> None:
        for i, p in enumerate(at):
            if rank_m[p] != r:
                continue
            q = nxt_m[p]
            after, before = nxt_m[q], prv_m[p]
            tok_m[p], tok_m[q], rank_m[q] = r, -1, NEVER
            nxt_m[p] = after
            right = pairs.get(r << SHIFT | tok_m[after], NEVER) if after != n else NEVER
            left = pairs.get(tok_m[before] << SHIFT | r, NEVER) if before != n else NEVER
            rank_m[p] = right
            if after != n:
                prv_m[after] = p
            if right < NEVER:
                add_one(right, p)
            if before != n:
                rank_m[before] = left
                if left < NEVER:
                    add_one(left, before)
            if min(left, right) < r:
                for rest in at[i + 1:]:
                    add_one(r, rest)
                return

    def merge_many(r: int, at: np.ndarray) -> None:
        found = at = at[rank[at] == r]
        if not len(at):
            return
        second = nxt[at]
        chained = np.append(False, second[:-1] == at[1:])
        if chained.any():                        # aaaa: every other position of a chain, from its start
            i = np.arange(len(at))
            keep = (i - np.maximum.accumulate(np.where(chained, 0, i))) % 2 == 0
            at = at[keep]
            second = nxt[at]
        after, before = nxt[second], prv[at]
        right = v.rank(np.full(len(at), r), tok[after])
        joined = np.append(False, second[:-1] == before[1:]) & (before != n)     # the left neighbour merges too
        left = v.rank(np.where(joined, r, tok[before]), np.full(len(at), r))
        early = (right < r) | (left < r)
        if early.any():
            w = word[at]
            late = w[early]
            wait = np.append(False, w[1:] == w[:-1]) & np.isin(w, late)          # all but the first of the word
            if wait.any():
                now = ~wait
                rest = found[np.isin(word[found], late)]      # also what the chains left out: they may stand free later
                merge_many_now(r, at[now], second[now], after[now], before[now])
                return add(np.full(int((rank[rest] == r).sum()), r), rest[rank[rest] == r])
        merge_many_now(r, at, second, after, before)

    def merge_many_now(r: int, at: np.ndarray, second: np.ndarray, after: np.ndarray, before: np.ndarray) -> None:
        tok[at] = r
        tok[second] = -1
        rank[second] = NEVER
        nxt[at] = after
        prv[after] = at
        prv[n] = n
        before = prv[at]
        before = np.where(tok[before] < 0, prv[before], before)
        prv[at] = before
        right = v.rank(np.full(len(at), r), tok[after])
        left = v.rank(tok[before], np.full(len(at), r))
        rank[at] = right
        rank[before] = left
        rank[n] = NEVER
        add(right, at)
        add(left[before != n], before[before != n])

    add(rank[:n], np.arange(n, dtype=np.int32))
    heapify(heap)
    tok_m, nxt_m, prv_m, rank_m = memoryview(tok), memoryview(nxt), memoryview(prv), memoryview(rank)
    while heap:
        r = heappop(heap)
        parts, few = index.pop(r, None), single.pop(r, None)
        if not parts and few is not None and len(few) <= FEW:
            merge_few(r, sorted(few))
            continue
        if few:
            parts = (parts or []) + [np.array(few, dtype=np.int32)]
        at = parts[0] if len(parts) == 1 and not few else np.unique(np.concatenate(parts))
        if len(at) <= FEW:
            merge_few(r, sorted(at.tolist()))
        else:
            merge_many(r, np.sort(at))
    alive = tok[:n] >= 0
    return tok[:n][alive], np.bincount(word[alive], minlength=len(words))


def gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices of ``values`` at ``starts``, one after another."""
    total = int(sizes.sum())
    return values[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)]


def decode_ids(ids: np.ndarray, v: Vocabulary) -> bytes:
    return gather(v.token_bytes, v.token_starts[ids], v.token_sizes[ids]).tobytes()


class _Words(dict):
    """Word -> its number, given at first sight."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Encoder:
    """Encodes texts block by block; words met in earlier blocks keep their ids."""

    def __init__(self, v: Vocabulary, block_bytes: int = BLOCK_BYTES):
        self.v, self.block_bytes = v, block_bytes
        self.find = regex.compile(v.pattern).findall
        self.clear()

    def clear(self) -> None:
        self.words = _Words()
        self.done = 0
        self.ids = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int64)

    def numbers(self, text: str | None) -> np.ndarray:
        found = self.find(text) if text else []
        return np.fromiter(map(self.words.__getitem__, found), np.int32, len(found))

    def encode_words(self) -> None:
        new = [w.encode() for w in list(self.words)[self.done:]]
        self.done = len(self.words)
        whole = np.array([self.v.whole.get(w, -1) for w in new], dtype=np.int32)
        split = np.flatnonzero(whole < 0)
        ids, sizes = replay([new[i] for i in split.tolist()], self.v) if len(split) else (whole[:0], whole[:0])
        n = np.ones(len(new), np.int64)
        n[split] = sizes
        out = np.empty(int(n.sum()), np.int32)
        at = np.repeat(whole < 0, n)
        out[at] = ids
        out[~at] = whole[whole >= 0]
        self.ids = np.concatenate([self.ids, out])
        self.sizes = np.concatenate([self.sizes, n])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def blocks(self, batches: Iterator[pd.Series]) -> Iterator[list[np.ndarray]]:
        """Ids of every text, batch by batch, a block's words merged together."""
        held: list[list[np.ndarray]] = []
        size = 0

        def flush() -> Iterator[list[np.ndarray]]:
            self.encode_words()
            for batch in held:
                yield [gather(self.ids, self.starts[w], self.sizes[w]) for w in batch]
            held.clear()
            if len(self.words) > MEMO_WORDS:
                self.clear()
        for b in batches:
            held.append([self.numbers(t) for t in b])
            size += sum(len(t) for t in b if t)
            if size >= self.block_bytes:
                yield from flush()
                size = 0
        yield from flush()


def load_vocabulary(path: str, pattern: str) -> Vocabulary:
    """Reads the rank file on the driver; tasks get it by value, so only the driver needs the file."""
    with open(path, "rb") as f:
        return vocabulary(read_ranks(f.read()), pattern)


def encode(df: DataFrame, v: Vocabulary, text: str = "text", ids: str | None = "token_ids",
           digests: bool = False) -> DataFrame:
    """Adds ``ids`` array<int>, or with ``digests`` n_tokens, ids_sha256 and decoded_sha256 (``ids`` may be None).

    Every whole text is encoded; null and empty texts have no tokens. The
    round trip is exact: the decoded bytes are the text's UTF-8. Columns of
    ``df`` with the names of the new ones are replaced; rows, null ids and
    repeated rows stay as they are.
    """
    small_batches(df.sparkSession)
    fields = (["ids array<int>"] if ids else []) + (
        ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"] if digests else [])

    @F.pandas_udf(", ".join(fields))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for rows in Encoder(v).blocks(batches):      # v goes with the function: some MB at any corpus size
            out = {"ids": pd.Series(rows, dtype=object)} if ids else {}
            if digests:
                out["n_tokens"] = np.array([len(r) for r in rows], dtype=np.int64)
                out["ids_sha256"] = pd.Series([hashlib.sha256(r.astype("<u4").tobytes()).hexdigest() for r in rows],
                                              dtype=object)
                out["decoded_sha256"] = pd.Series([hashlib.sha256(decode_ids(r, v)).hexdigest() for r in rows],
                                                  dtype=object)
            yield pd.DataFrame(out)
    made, = fresh(df, "encoded")
    columns = [*df.columns]
    out = df.withColumn(made, run(F.col(text)))
    names = ([(ids, "ids")] if ids else []) + ([(c, c) for c in ("n_tokens", "ids_sha256", "decoded_sha256")]
                                               if digests else [])
    taken = {a.lower() for a, _ in names}
    return out.select(*[F.col(f"`{c}`") for c in columns if c.lower() not in taken],
                      *[F.col(f"{made}.{b}").alias(a) for a, b in names])


def decode(df: DataFrame, v: Vocabulary, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """Adds ``text``: the texts of the token ids (null ids: null)."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([None if r is None else decode_ids(np.asarray(r, dtype=np.int64), v)
                             .decode("utf-8", "replace") for r in b], dtype=object)
    return df.withColumn(text, run(F.col(ids)))
