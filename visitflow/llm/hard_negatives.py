"""Hard-negative mining: segment summaries bound inner products level by level, exact scores decide."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

SEGMENT = 2                # components of the finest segment; every level above has twice as many
LEVELS = 4                 # segments of 16, 8, 4 and 2 components
ROW_BLOCK = 8192           # rows of a cell of the grid
ANCHOR_BLOCK = 8192        # anchors of a cell
CHUNK = 32                 # anchors bounded and scored at a time
SLACK = 4e-6               # of the norms' product: what single-precision summaries may be off by
EXACT = 1 << 53            # below it sums of products are exact in double precision
LONG = (-(1 << 63), (1 << 63) - 1)


def segments(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation (length of the rest) of each finest segment; the last one is filled up with zeros."""
    n, d = vectors.shape
    parts = max(1, -(-d // SEGMENT))
    x = np.zeros((n, parts * SEGMENT))
    x[:, :d] = vectors
    x = x.reshape(n, parts, SEGMENT)
    mean = x.mean(axis=2)
    return mean, np.sqrt(((x - mean[:, :, None]) ** 2).sum(axis=2))


def coarser(mean: np.ndarray, deviation: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of pairs of neighbouring segments of ``width`` components, from those of the segments."""
    if mean.shape[1] % 2:
        mean, deviation = (np.pad(x, ((0, 0), (0, 1))) for x in (mean, deviation))
    left, right = mean[:, ::2], mean[:, 1::2]
    spread = deviation[:, ::2] ** 2 + deviation[:, 1::2] ** 2 + width / 2 * (left - right) ** 2
    return (left + right) / 2, np.sqrt(spread)


def hierarchy(mean: np.ndarray, deviation: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(width, means, deviations) of all levels, the coarsest first."""
    out, width = [(SEGMENT, mean, deviation)], SEGMENT
    while len(out) < LEVELS and mean.shape[1] > 1:
        mean, deviation = coarser(mean, deviation, width)
        width *= 2
        out.append((width, mean, deviation))
    return out[::-1]


def bounds(width: int, mean_a, deviation_a, mean_b, deviation_b, slack) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest possible inner products of every a with every b: the means' products, plus or minus the deviations'."""
    middle, around = width * (mean_a @ mean_b.T), deviation_a @ deviation_b.T + slack
    return middle - around, middle + around


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors; those beyond a long are cut to its ends."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * a.shape[1] < EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, *LONG).astype(np.int64)


def _store(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Integer vectors -> their bytes and the summaries of their finest segments."""
    for b in batches:
        vec, mean, deviation = [], [], []
        for v in b["ints"]:
            x = np.asarray(v, np.int64)
            m, d = segments(x[None, :].astype(float))
            small = not len(x) or np.abs(x.astype(float)).max() < 1 << 31
            vec.append(x.astype(np.int32 if small else np.int64).tobytes())
            mean.append(m.astype(np.float32).tobytes())
            deviation.append(d.astype(np.float32).tobytes())
        yield pd.DataFrame({"vec_id": b["vec_id"], "label": b["label"], "size": b["size"], "vec": vec, "mean": mean,
                            "deviation": deviation})


def _matrix(values: pd.Series, kinds: list, width: int, kind) -> np.ndarray:
    """Byte rows as one matrix, shorter ones filled up with zeros."""
    out = np.zeros((len(values), width), kind)
    for n, (v, k) in enumerate(zip(values, kinds)):
        x = np.frombuffer(v, k)
        out[n, :len(x)] = x
    return out


class _Block:
    """Vectors of one side of a cell."""

    def __init__(self, rows: pd.DataFrame, dims: int):
        kinds = [np.int32 if len(v) == 4 * s else np.int64 for v, s in zip(rows["vec"], rows["size"])]
        self.ids = rows["vec_id"].to_numpy(np.int64)
        self.labels = rows["label"].to_numpy(np.int64)
        self.vectors = _matrix(rows["vec"], kinds, dims, np.int64)
        parts = max(1, -(-dims // SEGMENT))
        single = [np.float32] * len(rows)
        mean, deviation = (_matrix(rows[c], single, parts, float) for c in ("mean", "deviation"))
        self.levels = hierarchy(mean, deviation)
        self.norms = np.sqrt((SEGMENT * mean ** 2 + deviation ** 2).sum(axis=1))


def _pairs(a: _Block, few: np.ndarray, b: _Block, rows: np.ndarray, wanted) -> np.ndarray:
    """Those of ``rows`` that some anchor of ``few`` may want, level by level; ``wanted`` says so from the bounds."""
    for (width, mean_a, deviation_a), (_, mean_b, deviation_b) in zip(a.levels, b.levels):
        if not len(rows):
            break
        low, high = bounds(width, mean_a[few], deviation_a[few], mean_b[rows], deviation_b[rows],
                           SLACK * a.norms[few][:, None] * b.norms[rows][None, :] + 1e-3)
        rows = rows[wanted(low, high, rows).any(axis=0)]
    return rows


def _first(values: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first k by larger value, then smaller id."""
    if len(values) > k:
        at = np.flatnonzero(values >= np.partition(values, len(values) - k)[len(values) - k])
    else:
        at = np.arange(len(values))
    return at[np.lexsort((ids[at], -values[at]))][:k]


def _blocks(anchors: pd.DataFrame, rows: pd.DataFrame) -> tuple[_Block, _Block]:
    dims = int(max(anchors["size"].max(), rows["size"].max()))
    return _Block(anchors, dims), _Block(rows, dims)


def _positives(k: int):
    """A cell -> per anchor its first k other rows of the same label."""
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(anchors) and len(rows):
            a, b = _blocks(anchors, rows)
            keys = anchors["anchor"].to_numpy()
            for label in np.unique(a.labels):
                same = np.flatnonzero(b.labels == label)
                mine = np.flatnonzero(a.labels == label)
                for at in range(0, len(mine), CHUNK):
                    few = mine[at:at + CHUNK]

                    def wanted(low, high, kept):
                        low = np.where(a.ids[few][:, None] == b.ids[kept][None, :], -np.inf, low)
                        if len(kept) <= k:
                            return np.ones(low.shape, bool)
                        return high >= np.partition(low, len(kept) - k, axis=1)[:, len(kept) - k][:, None]
                    kept = _pairs(a, few, b, same, wanted)
                    for n, found in zip(few, scores(a.vectors[few], b.vectors[kept])):
                        other = np.flatnonzero(b.ids[kept] != a.ids[n])
                        for m in other[_first(found[other], b.ids[kept][other], k)]:
                            out.append((keys[n], b.ids[kept[m]], found[m]))
        return pd.DataFrame(out, columns=["anchor", "vec_id", "score"]).astype("int64")
    return run


def _negatives(k: int, low_share: int, high_share: int):
    """A cell -> per anchor and positive the first k rows of other labels in the window of its score."""
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(anchors) and len(rows):
            a, b = _blocks(anchors, rows)
            keys = anchors["anchor"].to_numpy()
            # whole scores between low_share and high_share hundredths of the positive's
            windows = [[(-(-low_share * int(p["score"]) // 100), high_share * int(p["score"]) // 100) for p in ps]
                       for ps in anchors["positives"]]
            least = np.array([min((w[0] for w in ws), default=math.inf) for ws in windows], float)
            most = np.array([max((w[1] for w in ws), default=-math.inf) for ws in windows], float)
            order = np.argsort(a.labels, kind="stable")
            for at in range(0, len(order), CHUNK):
                few = order[at:at + CHUNK]

                def wanted(low, high, kept):
                    return ((high >= least[few][:, None]) & (low <= most[few][:, None])
                            & (a.labels[few][:, None] != b.labels[kept][None, :]))
                kept = _pairs(a, few, b, np.arange(len(b.ids)), wanted)
                for n, found in zip(few, scores(a.vectors[few], b.vectors[kept])):
                    other = np.flatnonzero((b.labels[kept] != a.labels[n]) & (b.ids[kept] != a.ids[n])
                                           & (found >= least[n]) & (found <= most[n]))
                    for place, (low, high) in enumerate(windows[n]):
                        inside = other[(found[other] >= low) & (found[other] <= high)]
                        for m in inside[_first(found[inside], b.ids[kept][inside], k)]:
                            out.append((keys[n], place, b.ids[kept[m]], found[m]))
        return pd.DataFrame(out, columns=["anchor", "place", "vec_id", "score"]).astype("int64")
    return run


def _grid(anchors: DataFrame, rows: DataFrame, run, schema: str) -> DataFrame:
    """Every anchor block with every row block, each cell a bounded task."""
    row_blocks = max(1, -(-rows.count() // ROW_BLOCK))
    anchor_blocks = max(1, -(-anchors.count() // ANCHOR_BLOCK))

    def dealt(df: DataFrame, key: str, own: str, n: int, other: str, m: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    left = dealt(anchors, "anchor", "anchor_block", anchor_blocks, "row_block", row_blocks)
    right = dealt(rows, "row", "row_block", row_blocks, "anchor_block", anchor_blocks)
    return left.groupBy("row_block", "anchor_block").cogroup(
        right.groupBy("row_block", "anchor_block")).applyInPandas(run, schema)


def hard_negatives(df: DataFrame, anchors: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
                   positives: int = 5, negatives: int = 5, low_share: int = 80, high_share: int = 100,
                   scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    Components become ``floor(scale * x)``; a score is the integer inner product
    with the anchor. An anchor's positives are its first ``positives`` other
    rows of its label, higher scores first, then smaller ids; a positive's
    negatives the first ``negatives`` rows of other labels whose score lies
    between ``low_share`` and ``high_share`` hundredths of the positive's.

    Vectors are stored once with the mean and deviation of their segments.
    Blocks of anchors meet blocks of rows, each cell one bounded task. In a
    cell the summaries bound all scores, from coarse segments to fine ones,
    and rows that no anchor at hand can want are left out; the rest is scored
    exactly. Results do not depend on the blocks.

    Rows with a null id, label or vector or a null or non-finite component take
    no part. Vectors of another length count as filled up with zeros. Rows
    with the anchor's id are never its positives or negatives; repeated rows
    count one by one, as anchors too. An anchor without positives, or a
    positive without negatives, has no rows; an empty table gives none. Other
    columns are ignored. Scores beyond a long are cut to its ends.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "negatives", tidy=True)
    x = F.col(f"`{vector}`")
    kind = F.col(f"`{label}`") if isinstance(label, str) else label
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), kind.cast("long").alias("label"), x.alias("x"),
                     F.coalesce(anchors, F.lit(False)).alias("is_anchor"), sound.alias("sound"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL AND sound")
    rows = rows.select("vec_id", "label", "is_anchor", F.size("x").alias("size"),
                       F.transform("x", lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("ints"))
    whole = "vec_id long, label long, size int, vec binary, mean binary, deviation binary"
    # one table per side, each row numbered when it is stored
    every = scratch.write(rows.select("vec_id", "label", "size", "ints").mapInPandas(_store, whole)
                          .withColumn("row", F.monotonically_increasing_id()), "rows")
    some = scratch.write(rows.where("is_anchor").select("vec_id", "label", "size", "ints").mapInPandas(_store, whole)
                         .withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    near = _grid(some, every, _positives(positives), "anchor long, vec_id long, score long")
    order = [F.desc("score"), F.asc("vec_id")]
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("anchor").orderBy(*order))).where(
        F.col("rank") <= positives)
    near = scratch.write(near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score")))
                                                    .alias("positives")), "positives")
    some = scratch.write(some.join(near, "anchor"), "with_positives")
    far = _grid(some, every, _negatives(negatives, low_share, high_share), "anchor long, place int, vec_id long, score long")
    far = far.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*order))).where(
        F.col("rank") <= negatives)
    found = far.join(some.select("anchor", F.col("vec_id").alias("anchor_id"), "positives"), "anchor")
    positive = F.get("positives", F.col("place"))
    return found.select("anchor_id", positive["vec_id"].alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
                        positive["score"].alias("positive_score"), F.col("score").alias("negative_score"))
