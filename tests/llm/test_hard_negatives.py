"""Hard negatives (12): bounds hold at every level, results equal plain loops for any blocks, edge cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from visitflow.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"
OUT = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, every=100, k=5, scale=256):
    """Plain loops over all pairs, with Python integers."""
    sound = [(i, [math.floor(scale * float(np.float32(x))) for x in v], c) for i, v, c in rows
             if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, a, c in sound:
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), j, d) for j, v, d in sound if j != i]
        for p, j, _ in sorted(s for s in scored if s[2] == c)[:k]:
            inside = sorted(s for s in scored if s[2] != c and 80 * -p <= 100 * -s[0] <= 100 * -p)[:k]
            out += [(i, j, n + 1, m, -p, -q) for n, (q, m, _) in enumerate(inside)]
    return sorted(out)


def mined(df, every=100):
    return sorted(tuple(r) for r in hn.hard_negatives(df, F.col("vec_id") % every == 0).select(*OUT).collect())


def vectors(seed, n, dims, classes=4):
    random.seed(seed)
    centres = [[random.gauss(0, 1) for _ in range(dims)] for _ in range(classes)]
    return [(i, [random.gauss(0, .7) + c * random.random() for c in centres[i % classes]], random.randrange(classes)) for i in range(n)]


@pytest.mark.parametrize("dims", [1, 2, 7, 16, 33])
def test_bounds_hold_and_narrow(dims):
    rng = np.random.default_rng(dims)
    a, b = (np.floor(256 * rng.normal(size=(40, dims)) * rng.integers(1, 50, (40, 1))) for _ in range(2))
    exact = hn.scores(a.astype(np.int64), b.astype(np.int64))
    tops = []
    for (w, ma, da), (_, mb, db) in zip(hn.hierarchy(*hn.segments(a)), hn.hierarchy(*hn.segments(b))):
        low, high = hn.bounds(w, ma, da, mb, db, 1e-3)
        assert (low <= exact).all() and (exact <= high).all()
        tops.append((high - low).sum())
    assert all(x >= y - 1e-6 for x, y in zip(tops, tops[1:]))


@pytest.mark.parametrize("blocks", [(8192, 8192), (37, 5)])
def test_equals_plain_loops(spark, monkeypatch, blocks):
    monkeypatch.setattr(hn, "ROW_BLOCK", blocks[0])
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", blocks[1])
    rows = vectors(1, 300, 10)
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, every=10)
    assert mined(df, every=10) == want and len(want) > 100


def test_ties_and_few_rows(spark):
    rows = [(i, [1.0, 0.5, -0.25], i % 2) for i in range(12)] + [(100, [1.0, 0.5, -0.25], 7), (200, [-1.0, 0.0, 0.0], 0), (300, [0.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert mined(df) == brute(rows)


def test_clustered_vectors_are_pruned_by_their_summaries():
    """Smooth vectors: coarse segments settle nearly all rows before any exact score."""
    rng = np.random.default_rng(3)
    centres = np.repeat(rng.normal(size=(20, 4)), 16, axis=1) * 300
    b = np.floor(np.repeat(centres, 50, axis=0) + rng.normal(size=(1000, 64)))
    import pandas as pd
    rows = next(hn._store(iter([pd.DataFrame({"vec_id": range(1000), "label": np.arange(1000) // 50, "size": 64, "ints": list(b.astype(int))})])))
    block = hn._Block(rows, 64)
    few = np.array([0, 1])
    exact = hn.scores(block.vectors[few], block.vectors)
    kept = hn._pairs(block, few, block, np.arange(1000), lambda low, high, r: high >= 0.9 * exact.max())
    assert len(kept) < 200 and set(np.flatnonzero((exact >= 0.9 * exact.max()).any(axis=0))) <= set(kept)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = vectors(6, 40, 6, classes=2)
    rows = good + [(100, good[0][1], 0), (100, good[0][1], 0), (200, None, 1), (300, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (400, [nan] * 6, 1),
                   (500, [inf] * 6, 0), (600, [1.0] * 6, None), (None, [1.0] * 6, 1), (700, [], 1), (800, [1.0, 2.0], 0),
                   (900, [3e30] * 6, 0), (41, [2e30] * 6, 1), (42, [2.5e30] * 6, 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(f"kept {c}") for c in ("row", "anchor", "vec", "mean", "size", "rank")})
    got = mined(df)
    assert not [r for r in got if r[0] in (200, 300, 400, 500, 600)]
    assert all(-(1 << 63) <= r[5] < 1 << 63 for r in got)
    # components beyond a long change who is near whom: without them the plain loops apply
    usual = [r for r in rows if r[0] not in (41, 42, 900)]
    assert mined(spark.createDataFrame(usual, SCHEMA)) == brute(usual)
    assert mined(df.limit(0)) == []
